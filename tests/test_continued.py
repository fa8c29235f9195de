"""Funnel of sessions that go on after they were closed, against the batch funnel."""

import datetime as dt
import os
import random

import pytest
from conftest import at, make_events, rows

from clickloom import schema as S
from clickloom.operators.funnel import session_funnel
from clickloom.sources import landing
from clickloom.streaming import continued, incremental


def run(spark, folder, batches, **options):
    """Each batch is landed and taken by a stream started anew; all events, all versions."""
    for number, batch in enumerate(batches, start=1):
        landing.write_batch(make_events(spark, batch), number, f"{folder}/in")
        stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
        versions = continued.funnel_versions(stream, **options)
        incremental.append_events(versions, f"{folder}/out", f"{folder}/cp").awaitTermination(180)
    return spark.read.parquet(f"{folder}/out")


def event(number, session, user, clock, name, day=1):
    return (session, user, at(clock, day), name, {"event_id": f"e{number:03d}"})


BEFORE = [
    event(1, "s", "u", "10:00:00", "homepage_view"),
    event(2, "s", "u", "10:05:00.123456", "product_click"),
    event(3, "t", "v", "10:00:00", "add_to_cart"),
    event(4, "quiet", "w", "10:00:00", "search"),
    event(5, "other", "x", "13:00:00", "search"),  # closes the sessions above
]
AFTER = [
    event(6, "s", "u", "13:01:00", "purchase_complete"),  # goes on after its close
    event(7, "t", "v2", "12:30:00", "homepage_view"),  # late, and a second owner
    event(8, "quiet", "w", "13:05:00", "homepage_view"),  # its first funnel event
    event(3, "t", "v", "12:59:00", "add_to_cart"),  # again, later: changes nothing
]
END = [event(9, "end", "z", "23:00:00", "search", day=9)]


def test_last_version_equals_the_batch_funnel(spark, folder):
    got = run(spark, folder, [BEFORE, [event(10, "other", "x", "13:00:01", "search")], AFTER, END, END])
    want = session_funnel(make_events(spark, BEFORE + AFTER))
    latest = continued.latest_funnel(got)
    assert latest.columns == want.columns
    assert rows(latest) == rows(want)
    # A session that does not change is published once, a continued one is corrected.
    assert rows(got, "session_id", "version") == [("quiet", 1), ("s", 1), ("s", 2), ("t", 1), ("t", 2)]
    first = got.where("session_id = 's' AND version = 1").first()
    assert first.at_1 % 1_000_000 == 123456 and first.at_3 is None


def test_order_of_arrival_and_repeated_batches_change_nothing(spark, folder):
    got = run(spark, folder, [list(reversed(BEFORE)), BEFORE, END, END], lateness="4 hours")
    assert rows(continued.latest_funnel(got)) == rows(session_funnel(make_events(spark, BEFORE)))
    assert got.where("version > 1").count() == 0


def test_state_ends_after_its_time(spark, folder):
    back = [event(11, "s", "u", "09:00:00", "add_to_cart", day=3), event(12, "x", "x", "12:00:00", "search", day=3)]
    ahead = [event(13, "x", "x", "08:00:00", "search", day=3)]
    got = run(spark, folder, [BEFORE, ahead, ahead, back, END, END], keep="2 hours")
    # Two days later the session starts anew; the later life counts.
    of_s = got.where("session_id = 's'")
    assert rows(of_s.selectExpr("version", "at_0 IS NULL", "at_2 IS NULL")) == [(1, False, True), (1, True, False)]
    last = continued.latest_funnel(got).where("session_id = 's'").first()
    assert last.reached_cart and not last.reached_homepage


def test_stream_without_events_of_sessions(spark, folder):
    none = [(None, "u", at("10:00:00"), "homepage_view"), ("s", "u", None, "homepage_view")]
    got = run(spark, folder, [none, END, END])
    assert continued.latest_funnel(got).count() == 0


@pytest.mark.parametrize("span, want", [("30 minutes", 1_800_000), ("1 day", 86_400_000), ("90 seconds", 90_000)])
def test_spans(spark, span, want):
    assert continued._milliseconds(span, spark.range(1)) == want


def modelled(batches, gap, lateness, keep):
    """Versions (session, version, firsts by step) by a plain loop, times in seconds."""
    watermark, state, out = None, {}, []
    for batch in batches:
        before = watermark
        for session in {e[0] for e in batch}:
            news = [e for e in batch if e[0] == session and (before is None or e[1] > before)]
            if not news:
                continue
            version, closed, last, firsts, _ = state.get(session, (0, False, -1, {}, 0))
            old, firsts = firsts, dict(firsts)
            for _, at_, step, number in news:
                last = max(last, at_)
                if step >= 0:
                    firsts[step] = min(firsts.get(step, (at_, number)), (at_, number))
            if closed and firsts != old:
                closed = version > 0
                if closed:
                    version += 1
                    out.append((session, version, firsts))
            due = last + gap + (keep if closed else 0)
            state[session] = (version, closed, last, firsts, due if before is None else max(due, before + 0.001))
        watermark = max([w for w in (before, max(e[1] for e in batch) - lateness) if w is not None])
        for session, (version, closed, last, firsts, due) in list(state.items()):
            if due < watermark and closed:
                del state[session]
            elif due < watermark:
                version += bool(firsts)
                if firsts:
                    out.append((session, version, firsts))
                state[session] = (version, True, last, firsts, max(last + gap + keep, watermark + 0.001))
    return out


def test_versions_equal_a_plain_loop(spark, folder):
    rng, number, batches, made = random.Random(3), 0, [], []
    for start in (0, 3000, 6000, 12000, 60000):
        batch = []
        for _ in range(300):
            number += 1
            batch.append((f"s{rng.randrange(90)}", start + rng.randrange(4000), rng.randrange(-1, 4), number))
        batches.append(batch)
        made.append(
            [
                (s, f"u{n}", at("00:00:00") + dt.timedelta(seconds=t), (*S.FUNNEL_STEPS, "search")[step], {"event_id": f"{n:05d}"})
                for s, t, step, n in batch
            ]
        )
    got = run(spark, folder, made, gap="10 minutes", lateness="20 minutes", keep="30 minutes")
    base = at("00:00:00").replace(tzinfo=dt.timezone.utc).timestamp()
    found = [
        (r.session_id, r.version, {i: (r[f"at_{i}"] / 1e6 - base, int(r[f"event_{i}"])) for i in range(4) if r[f"at_{i}"]})
        for r in got.collect()
    ]
    want = modelled(batches, 600, 1200, 1800)
    assert max(v for _, v, _ in want) > 2
    assert sorted(found, key=repr) == sorted([(s, v, dict(sorted((i, (float(a), n)) for i, (a, n) in f.items()))) for s, v, f in want], key=repr)


def test_no_python_for_single_sessions(spark):
    """Thousands of sessions are one join: no plan node hands rows to Python."""
    events = spark.range(20_000).selectExpr(
        "string(id) AS session_id", "'u' AS user_id", "string(id) AS event_id", "id * 1000 AS at", "0 AS step"
    )
    state = spark.createDataFrame([], continued._STATE).drop("given", "over")
    after = continued.next_state(state, continued.folded(events, None), None, 15_000_000, 1000, 1000)
    assert "Python" not in after._jdf.queryExecution().toString() and "Pandas" not in after._jdf.queryExecution().toString()
    assert after.where("given AND closed AND version = 1").count() == after.where("last_at / 1000 + 1000 < 15000000").count()


def test_a_batch_that_is_run_again_changes_nothing(spark, folder):
    got = rows(run(spark, folder, [BEFORE, AFTER]))
    # as if the batch had failed just before its commit
    for name in ("1", ".1.crc"):
        os.remove(f"{folder}/cp/commits/{name}")
    landing.write_batch(make_events(spark, END), 3, f"{folder}/in")
    stream = incremental.landing_stream(spark, landing.landing_glob(f"{folder}/in"))
    incremental.append_events(continued.funnel_versions(stream), f"{folder}/out", f"{folder}/cp").awaitTermination(180)
    again = spark.read.parquet(f"{folder}/out")
    assert rows(again.where("batch < 2")) == got
    assert rows(continued.latest_funnel(again)) == rows(session_funnel(make_events(spark, BEFORE + AFTER)))
