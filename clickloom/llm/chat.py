"""Chat formatting: tool-call linking, order, validation, canonical JSON.

Calls and results are joined by identifier, in two aggregated halves, so no
identifier makes more rows than it has. A result stands after its call and a
call after the results it names in ``after``: rows are ordered by turn, and only
rows that stand too early are moved behind what they depend on, repeatedly,
until all edges point forward. Rows on or behind a cycle are marked, all of them. Arguments
are parsed as JSON and held against the tool's schema (``valid``, true for rows
without arguments). Each row becomes one line
of canonical JSON: keys sorted, no spaces, nulls written.

One row stays one row: a conversation is never gathered, however long it is;
``order_turn``, ``order_level`` and ``turn`` sort its lines.

Status of a row: ``message``; for calls ``linked``, ``no_result``; for results
``linked``, ``no_call``; ``repeated`` for a call or result whose identifier an
earlier row has already used; ``no_id`` without identifier; ``cycle``.

Defined results: null text is JSON null; a null conversation, turn or role is
kept; equal turns of one identifier are decided by the text; an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored
from clickloom.llm.simhash import components

# JSON type -> pattern of the engine's name for the parsed value's type.
TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
}

# Tool of the registered query: every user turn is a call of ``reply``.
REPLY_SCHEMAS = {
    "reply": {
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer"}},
        "required": ["prompt", "turn"],
    }
}


def conforms(name: Column, arguments: Column, schemas: dict) -> Column:
    """Whether JSON ``arguments`` satisfy the schema of tool ``name``.

    Asked: a JSON object, required keys there and not null, no unknown keys,
    types as stated, strings no shorter than ``minLength``.
    """
    parsed = F.try_parse_json(arguments)
    result = F.lit(False)
    for tool, schema in schemas.items():
        fine = F.schema_of_variant(parsed).startswith("OBJECT")
        keys = F.json_object_keys(arguments)
        properties = schema.get("properties", {})
        fine = fine & (F.size(F.array_except(keys, F.array(*map(F.lit, properties)).cast("array<string>"))) == 0)
        for key, rule in properties.items():
            value = F.try_variant_get(parsed, f"$['{key}']", "variant")
            kind = F.schema_of_variant(value)
            present = value.isNotNull() & (kind != "VOID")
            right = kind.rlike(f"^({TYPES[rule['type']]})$")
            if rule.get("minLength"):
                text = F.try_variant_get(parsed, f"$['{key}']", "string")
                right = right & (F.length(text) >= rule["minLength"])
            fine = fine & F.when(present, right).otherwise(F.lit(key not in schema.get("required", [])))
        result = F.when(name == tool, F.coalesce(fine, F.lit(False))).otherwise(result)
    return F.coalesce(result, F.lit(False))


def canonical(**fields: Column) -> Column:
    """One JSON object with its keys in order."""
    return F.to_json(
        F.struct(*[fields[key].alias(key) for key in sorted(fields)]), {"ignoreNullFields": "false"}
    )


def _first_uses(rows: DataFrame, kind: str) -> DataFrame:
    """call_id and ``first``: the earliest row of the kind that uses it."""
    return (
        rows.where((F.col("kind") == kind) & F.col("call_id").isNotNull())
        .groupBy("call_id")
        .agg(F.min(F.struct("turn", "text", "row")).alias("first"))
    )


def link(rows: DataFrame) -> DataFrame:
    """Rows with ``status`` and ``partner_turn`` (of the call a result answers)."""
    calls = _first_uses(rows, "call").select("call_id", F.col("first").alias("call"))
    results = _first_uses(rows, "result").select("call_id", F.col("first").alias("result"))
    linked = rows.join(calls.join(results, "call_id", "full"), "call_id", "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    own = F.when(is_call, F.col("call.row")).when(is_result, F.col("result.row"))
    status = (
        F.when(~is_call & ~is_result, "message")
        .when(F.col("call_id").isNull(), "no_id")
        .when(own != F.col("row"), "repeated")
        .when(is_call & F.col("result").isNull(), "no_result")
        .when(is_result & F.col("call").isNull(), "no_call")
        .otherwise("linked")
    )
    return (
        linked.withColumn("status", status)
        .withColumn("partner_turn", F.when(is_result, F.col("call.turn")))
        .drop("call", "result")
    )


def _stuck(edges: DataFrame) -> DataFrame:
    """Rows on or behind a cycle; ``edges`` are (row, pred, late).

    Components without a late edge have no cycle and are left out. In the others
    rows without open predecessors are taken off until none is left to take, so
    the rounds are the longest chain of one component.
    """
    roots = stored(components(edges.select(F.col("row").alias("a"), F.col("pred").alias("b"))), "chat-roots")
    root_of = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    marked = edges.join(root_of, F.col("row") == F.col("node"))
    suspect = marked.where("late").select("root").distinct()
    open_edges = stored(marked.join(suspect, "root", "left_semi").select("row", "pred"), "chat-open")
    while True:
        waiting = open_edges.select(F.col("row").alias("pred")).distinct()
        left = stored(open_edges.join(waiting, "pred", "left_semi").select("row", "pred"), "chat-open")
        if left.count() == open_edges.count():
            return left.select("row").distinct()
        open_edges = left


def ordered(linked: DataFrame) -> DataFrame:
    """Rows with order_turn and order_level.

    Edges that already point forward cost one join. If some do not, rows on or
    behind a cycle are found exactly and keep their own turn with status
    ``cycle``; of the others only rows that stand too early move, in as many
    rounds as their longest chain.
    """
    start = F.when(
        F.col("partner_turn") >= F.col("turn"), F.struct(F.col("partner_turn").alias("t"), F.lit(1).alias("l"))
    ).otherwise(F.struct(F.col("turn").alias("t"), F.lit(0).alias("l")))
    rows = stored(linked.withColumn("place", start), "chat-placed")
    known = rows.where("status = 'linked'").select(
        "kind", F.col("call_id").alias("needs"), F.col("row").alias("pred"), F.col("place").alias("behind")
    )
    # A result follows its call, so it moves when the call does.
    needs = rows.where(F.size("after") > 0).select("row", "place", F.explode(F.array_distinct("after")).alias("needs"))
    answers = rows.where("kind = 'result' AND status = 'linked'").select("row", "place", F.col("call_id").alias("needs"))
    edges = stored(
        needs.join(known.where("kind = 'result'").drop("kind"), "needs")
        .unionByName(answers.join(known.where("kind = 'call'").drop("kind"), "needs"))
        .select("row", "pred", "place", "behind", (F.col("place") <= F.col("behind")).alias("late")),
        "chat-edges",
    )
    if not edges.where("late").isEmpty():
        stuck = stored(_stuck(edges.select("row", "pred", F.coalesce("late", F.lit(False)).alias("late"))), "chat-stuck")
        # What needs a stuck row is stuck itself, so the other edges have no cycle.
        free = stored(edges.join(stuck, "row", "left_anti").select("row", "pred"), "chat-free")
        rows = stored(
            rows.join(stuck.withColumn("stuck", F.lit(True)), "row", "left")
            .withColumn("status", F.when(F.col("stuck"), "cycle").otherwise(F.col("status")))
            .withColumn(
                "place",
                F.when(F.col("stuck"), F.struct(F.col("turn").alias("t"), F.lit(0).alias("l"))).otherwise(F.col("place")),
            )
            .drop("stuck"),
            "chat-marked",
        )
        while True:
            places = rows.select("row", "place")
            behind = rows.select(F.col("row").alias("pred"), F.col("place").alias("behind"))
            step = stored(
                free.join(places, "row").join(behind, "pred")
                .where(F.col("place") <= F.col("behind"))
                .groupBy("row")
                .agg(F.max("behind").alias("behind"))
                .select("row", F.struct(F.col("behind.t").alias("t"), (F.col("behind.l") + 1).alias("l")).alias("new")),
                "chat-step",
            )
            if step.isEmpty():
                break
            rows = stored(
                rows.join(step, "row", "left").withColumn("place", F.coalesce("new", "place")).drop("new"), "chat-moved"
            )
    return rows.withColumn("order_turn", F.col("place.t")).withColumn("order_level", F.col("place.l")).drop("place")


def format_chats(messages: DataFrame, schemas: dict) -> DataFrame:
    """One canonical JSON line a message, call or result, linked and ordered.

    ``messages``: conv_id, turn, role, text, kind (message, call, result),
    call_id, name, arguments (JSON text) and after (identifiers, may be null).
    """
    rows = messages.select(
        "conv_id", "turn", "role", "text", "kind", "call_id", "name", "arguments",
        F.coalesce("after", F.array().cast("array<string>")).alias("after"),
        F.monotonically_increasing_id().alias("row"),
    )
    done = ordered(link(stored(rows, "chat-rows")))
    is_call = F.col("kind") == "call"
    valid = F.when(is_call, conforms(F.col("name"), F.col("arguments"), schemas)).otherwise(True)
    line = (
        F.when(
            is_call,
            canonical(
                arguments=F.try_parse_json("arguments"), id=F.col("call_id"), name=F.col("name"),
                role=F.col("role"), type=F.lit("call"),
            ),
        )
        .when(
            F.col("kind") == "result",
            canonical(content=F.col("text"), id=F.col("call_id"), role=F.col("role"), type=F.lit("result")),
        )
        .otherwise(canonical(content=F.col("text"), role=F.col("role"), type=F.lit("message")))
    )
    return done.select(
        "conv_id", "turn", "kind", "call_id", "status", valid.alias("valid"),
        "order_turn", "order_level", line.alias("line"),
    )


def as_calls(conversations: DataFrame) -> DataFrame:
    """Conversations read as tool calls.

    A user turn calls ``reply`` with its text; an assistant turn is the result
    of the turn before it; a call comes after the result two turns earlier.
    Other roles are plain messages.
    """
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    kind = F.when(user, "call").when(assistant, "result").otherwise("message")
    return conversations.select(
        "conv_id", "turn", "role", "text",
        kind.alias("kind"),
        F.when(user, name(F.col("turn"))).when(assistant, name(F.col("turn") - 1)).alias("call_id"),
        F.when(user, "reply").alias("name"),
        F.when(user, canonical(prompt=F.col("text"), turn=F.col("turn"))).alias("arguments"),
        F.when(user & (F.col("turn") >= 2), F.array(name(F.col("turn") - 2))).alias("after"),
    )
