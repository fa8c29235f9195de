"""Tool-call linking, order, validation and canonical JSON."""

import json

from pyspark.sql import functions as F

from clickloom.llm import chat

MESSAGES = (
    "conv_id long, turn long, role string, text string, kind string, call_id string, "
    "name string, arguments string, after array<string>"
)
SCHEMAS = {
    "sum": {
        "properties": {"b": {"type": "number"}, "a": {"type": "integer"}, "note": {"type": "string"}},
        "required": ["a", "b"],
    }
}


def formatted(spark, rows):
    got = chat.format_chats(spark.createDataFrame(rows, MESSAGES).repartition(3), SCHEMAS)
    return got.orderBy("order_turn", "order_level", "turn").collect()


def call(turn, call_id, arguments='{"a": 1, "b": 2.5}', after=None, name="sum", conv=1):
    return (conv, turn, "assistant", None, "call", call_id, name, arguments, after)


def result(turn, call_id, text="r", conv=1):
    return (conv, turn, "tool", text, "result", call_id, None, None, None)


def test_links_and_status(spark):
    rows = [
        (1, 0, "user", 'hi "you"\n', "message", None, None, None, None),
        call(1, "x"), result(2, "x"),
        call(3, "x"), result(4, "x"),
        call(5, "alone"), result(6, "nothing"), call(7, None), result(8, None),
    ]
    got = formatted(spark, rows)
    assert [r["status"] for r in got] == [
        "message", "linked", "linked", "repeated", "repeated", "no_result", "no_call", "no_id", "no_id",
    ]
    assert json.loads(got[0]["line"]) == {"content": 'hi "you"\n', "role": "user", "type": "message"}
    assert got[1]["line"] == (
        '{"arguments":{"a":1,"b":2.5},"id":"x","name":"sum","role":"assistant","type":"call"}'
    )


def test_validation_and_canonical_arguments(spark):
    cases = {
        '{"b": 1, "a": 2}': True,
        '{"a": 2, "b": 1e3, "note": "n"}': True,
        '{"a": 2.5, "b": 1}': False,
        '{"a": "2", "b": 1}': False,
        '{"a": 2}': False,
        '{"a": 2, "b": null}': False,
        '{"a": 2, "b": 1, "c": 0}': False,
        '[1]': False,
        '{"a": 2, "b"': False,
        None: False,
    }
    got = formatted(spark, [call(i, f"c{i}", a) for i, a in enumerate(cases)] + [call(99, "o", "{}", name="other")])
    assert [r["valid"] for r in got] == [*cases.values(), False]
    assert '"arguments":{"a":2,"b":1}' in got[0]["line"]
    assert '"arguments":null' in got[8]["line"]


def test_results_before_calls_and_dependencies_move(spark):
    rows = [
        result(0, "a"), call(4, "a"),  # the result came first
        call(1, "b", after=["a"]), result(2, "b"),  # b needs a's result
        call(3, "c", after=["gone"]), result(5, "c"),
    ]
    got = formatted(spark, rows)
    place = {(r["kind"], r["call_id"]): i for i, r in enumerate(got)}
    assert place["call", "a"] < place["result", "a"] < place["call", "b"] < place["result", "b"]
    assert place["call", "c"] < place["result", "c"]
    assert all(r["status"] == "linked" for r in got)


def test_cycles_end(spark):
    rows = [call(1, "a", after=["b"]), result(2, "a"), call(3, "b", after=["a"]), result(4, "b"), call(5, "z")]
    got = formatted(spark, rows)
    assert len(got) == 5 and "cycle" in {r["status"] for r in got}
    assert next(r for r in got if r["call_id"] == "z")["status"] == "no_result"


def test_every_row_on_or_behind_a_cycle_is_marked(spark):
    rows = [
        call(1, "a", after=["b"]), result(2, "a"), call(3, "b", after=["a"]), result(4, "b"),
        call(5, "behind", after=["b"]), result(6, "behind"),
        call(1, "own", after=["own"], conv=2), result(2, "own", conv=2),
        call(9, "late", conv=3), result(0, "late", conv=3), call(1, "next", after=["late"], conv=3), result(2, "next", conv=3),
        call(5, "z"),
    ]
    got = {(r["kind"], r["call_id"]): r for r in formatted(spark, rows)}
    assert len(got) == len(rows)
    for name in ("a", "b", "behind", "own"):
        for kind in ("call", "result"):
            r = got[kind, name]
            assert (r["status"], r["order_turn"], r["order_level"]) == ("cycle", r["turn"], 0)
    places = [
        (r["status"], r["order_turn"], r["order_level"])
        for r in (got["call", "late"], got["result", "late"], got["call", "next"], got["result", "next"])
    ]
    assert places == [("linked", 9, level) for level in range(4)]
    assert got["call", "z"]["status"] == "no_result"


def test_conversations_with_odd_rows(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", ""),
        (2, 0, "user", None), (2, 1, "assistant", None), (2, 1, "assistant", None),
        (None, 0, "user", "x"), (3, None, "user", "x"), (4, 0, None, "x"), (5, 0, "user", "long " * 50_000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_chats(chat.as_calls(table.withColumn("kind", F.lit("x"))), chat.REPLY_SCHEMAS)
    assert got.count() == len(rows)
    lines = {(r["conv_id"], r["turn"], r["status"]): r for r in got.collect()}
    assert lines[1, 2, "linked"]["line"] == '{"content":"a","id":"1:1","role":"assistant","type":"result"}'
    assert lines[1, 1, "linked"]["valid"] and not lines[1, 3, "no_result"]["valid"]
    assert not lines[2, 0, "linked"]["valid"] and (2, 1, "repeated") in lines
    assert chat.format_chats(chat.as_calls(table.where("turn < 0")), chat.REPLY_SCHEMAS).count() == 0
