"""Incremental refresh against a full run over all events."""

import random

import pytest
from conftest import at, make_events, rows
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.plans.refresh import SESSION_TABLES, IncrementalWarehouse
from clickloom.sources.commits import CommitConflict
from clickloom.sources.landing import write_batch

NAMES = ["homepage_view", "product_click", "add_to_cart", "purchase_complete", "search", "session_end"]


def made(days, sessions, seed, prefix="e"):
    """Events of sessions that start on one of ``days``; some go on after midnight."""
    rng, out = random.Random(seed), []
    for s in sessions:
        day = rng.choice(days)
        for k in range(rng.randint(1, 7)):
            late = rng.random() < 0.1
            clock = f"{rng.randint(0, 5) if late else rng.randint(8, 23):02d}:{rng.randint(0, 59):02d}:{k:02d}"
            extra = {"event_id": f"{prefix}-{s}-{k}"}
            out.append((s, f"u{hash_of(s) % 9}", at(clock, day + late), rng.choice(NAMES), extra))
    return out


def hash_of(s):
    return sum(map(ord, s))


def land(spark, warehouse, folder, data, number):
    write_batch(make_events(spark, data), number, folder)
    warehouse.land(f"{folder}/batch_{number:06d}")


def check(spark, warehouse, data):
    events = make_events(spark, data)
    for name, table in SESSION_TABLES.items():
        want = table(events, [])
        got = warehouse.table(name).select(*want.columns)
        assert rows(got) == rows(want), name


def rows_read(spark):
    """Rows that all stages so far have read from files."""
    jvm, store = spark._jvm, spark.sparkContext._jsc.sc().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none = spark.sparkContext._gateway.new_array(jvm.double, 0)
    stages = store.stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def test_tables_equal_a_full_run(spark, folder):
    warehouse = IncrementalWarehouse(spark, f"{folder}/w")
    data = made([1, 2, 3], [f"s{i}" for i in range(120)], 1)
    land(spark, warehouse, folder, data, 1)
    first = warehouse.refresh()
    assert first.sessions == 120 and set(first.home_days) <= {f"2026-01-0{d}" for d in range(1, 5)}
    check(spark, warehouse, data)
    # new sessions, old ones that go on, and a late event that moves a session's start
    more = made([4], [f"t{i}" for i in range(40)], 2)
    more += [("s5", "u1", at("09:00:00", 4), "purchase_complete", {"event_id": "on"})]
    more += [("s7", "u1", at("07:00:00", 1), "homepage_view", {"event_id": "late"})]
    land(spark, warehouse, folder, more, 2)
    done = warehouse.refresh()
    assert done.sessions == 42
    check(spark, warehouse, data + more)
    assert warehouse.refresh().sessions == 0


def test_a_second_day_reads_only_what_it_touches(spark, folder):
    def second_day(history):
        """Rows read by the refresh of day 25 after so many days of history, and sessions before."""
        root = f"{folder}/{history}"
        warehouse, days = IncrementalWarehouse(spark, f"{root}/w"), range(25 - history, 25)
        data = [r for d in days for r in made([d], [f"d{d}-{i}" for i in range(60)], d) if r[2].day == d]
        land(spark, warehouse, root, data, 1)
        warehouse.refresh()
        kept = {n: warehouse._part(n).snapshot()["days"] for n in SESSION_TABLES}
        more = [r for r in made([25], [f"d25-{i}" for i in range(60)], 99) if r[2].day == 25]
        more += [("d24-3", "u1", at("00:10:00", 25), "purchase_complete", {"event_id": "on"})]
        land(spark, warehouse, root, more, 2)
        before = rows_read(spark)
        done = warehouse.refresh()
        read = rows_read(spark) - before
        assert done.event_days == done.home_days == ["2026-01-24", "2026-01-25"]
        for name, old in kept.items():
            new = warehouse._part(name).snapshot()["days"]
            assert {d for d in new if new[d] != old.get(d)} == {"2026-01-24", "2026-01-25"}
        check(spark, warehouse, data + more)
        return read, len({r[0] for r in data})

    (less, few), (more, many) = second_day(3), second_day(12)
    # of a longer history nothing is read but the days of its sessions
    assert many > 3 * few and more - less == many - few


def test_a_refresh_that_ended_half_way_is_made_up(spark, folder):
    warehouse = IncrementalWarehouse(spark, f"{folder}/w")
    data = made([2, 3], [f"s{i}" for i in range(40)], 5)
    land(spark, warehouse, folder, data, 1)
    warehouse.refresh()
    more = [(f"s{i}", "u1", at("06:00:00", 2), "add_to_cart", {"event_id": f"m{i}"}) for i in range(9)]
    land(spark, warehouse, folder, more, 2)
    tables = dict(SESSION_TABLES)

    def fails(events, hot):
        raise OSError("lost")

    broken = IncrementalWarehouse(spark, f"{folder}/w", tables | {"analytics_velocity_metrics": fails})
    with pytest.raises(OSError):
        broken.refresh()
    # meanwhile the sessions start earlier still
    last = [(f"s{i}", "u1", at("06:00:00", 1), "homepage_view", {"event_id": f"l{i}"}) for i in range(5)]
    land(spark, warehouse, folder, last, 3)
    warehouse.refresh()
    check(spark, warehouse, data + more + last)


def test_gate_refuses_what_is_known_or_broken(spark, folder):
    warehouse = IncrementalWarehouse(spark, f"{folder}/w")
    data = made([1], ["a", "b"], 1)
    land(spark, warehouse, folder, data, 1)
    with pytest.raises(ValueError, match="known already"):
        land(spark, warehouse, folder, data[:1] + made([2], ["c"], 2), 2)
    with pytest.raises(ValueError, match="quality gate"):
        land(spark, warehouse, folder, [("x", "u", at("10:00:00", 3), "no_such_name")], 3)
    assert rows(warehouse.events.read(), "event_id") == sorted((r[4]["event_id"],) for r in data)


def test_refreshes_do_not_overwrite_each_other(spark, folder):
    warehouse = IncrementalWarehouse(spark, f"{folder}/w")
    land(spark, warehouse, folder, made([1], ["a", "b"], 1), 1)
    part = warehouse._part("analytics_session_funnel")
    state, late = part.snapshot()["number"], part.stage(spark.sql("SELECT date'2026-01-01' AS home_day, 1 AS a"), "home_day")
    warehouse.refresh()
    with pytest.raises(CommitConflict):
        part.replace(["2026-01-01"], late, "home_day date, a int", state)
    assert set(S.FUNNEL_STEPS) <= set(NAMES) and part.read().where(F.col("session_id") == "a").count() <= 1


def test_the_first_refresh_takes_the_events_as_they_lie(spark, folder, monkeypatch):
    """No copy of the touched sessions' events where all sessions are touched; later ones make it."""
    copies = []
    stored = IncrementalWarehouse._stored
    monkeypatch.setattr(IncrementalWarehouse, "_stored", lambda self, df, label: copies.append(label) or stored(self, df, label))
    warehouse = IncrementalWarehouse(spark, f"{folder}/w")
    data = made([1, 2], [f"s{i}" for i in range(30)], 8)
    land(spark, warehouse, folder, data, 1)
    assert warehouse.refresh().sessions == 30
    assert "touched-events" not in copies
    more = made([3], ["s3", "t1"], 9, prefix="f")
    land(spark, warehouse, folder, more, 2)
    assert warehouse.refresh().sessions == 2
    assert "touched-events" in copies
    check(spark, warehouse, data + more)
