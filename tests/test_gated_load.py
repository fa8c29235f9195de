"""The gate counts rows while they are written and reads back their ids only."""

import pytest
from conftest import make_events, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from clickloom.operators import quality
from clickloom.sources import landing
from clickloom.sources.loading import load_events
from clickloom.sources.tables import Warehouse

GOOD = [("s", "u", "10:00:00", "search"), ("s", "u", "10:01:00", "add_to_cart"), ("t", "v", "10:00:00", "search")]
BAD = GOOD + [
    ("t", None, "10:02:00", "search"),
    ("t", "v", "10:03:00", "nothing"),
    ("t", "v", "10:04:00", None),
    ("t", "v", None, "search"),
    ("t", "v", "10:05:00", "search", {"variant": "none"}),
    ("t", "v", "10:06:00", "search", {"event_id": "twice"}),
    ("t", "v", "10:07:00", "search", {"event_id": "twice"}),
    ("t", "v", "10:08:00", "search", {"event_id": None}),
]


def staged(spark, folder, data):
    """What the load writes of these events, and what was counted on the way."""
    gate = Observation("test")
    events = make_events(spark, data)
    path = Warehouse(spark, folder).stage(
        "events", events, F.to_date("event_timestamp"), observed=(gate, *quality.row_counters())
    )
    return spark.read.parquet(path), gate.get


@pytest.mark.parametrize("data", [GOOD, BAD, GOOD[:1], BAD * 40])
def test_counted_report_equals_the_report_of_the_rows(spark, folder, data):
    written, counted = staged(spark, folder, data)
    got, want = quality.report_of_counted(written, counted), quality.quality_report(written)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert rows(got) == rows(want)


def test_counts_that_do_not_fit_are_not_used(spark, folder):
    written, counted = staged(spark, folder, BAD)
    wrong = {**counted, "total_rows": counted["total_rows"] + 1, "invalid_variants": 99}
    assert rows(quality.report_of_counted(written, wrong)) == rows(quality.quality_report(written))


def test_no_events(spark, folder):
    landing_root = f"{folder}/in"
    make_events(spark, GOOD).where("false").write.parquet(f"{landing_root}/batch_000001")
    warehouse = Warehouse(spark, f"{folder}/w")
    with pytest.raises(ValueError, match="no events"):
        load_events(warehouse, landing.landing_glob(landing_root))
    assert warehouse.versions("events") == []


def test_only_ids_are_read_back(spark, folder):
    """Every column but the id is made unreadable before the report is asked for."""
    written, counted = staged(spark, folder, GOOD)
    torn = written.select("event_id", *[F.raise_error(F.lit(c)).alias(c) for c in written.columns if c != "event_id"])
    report = quality.report_of_counted(torn, counted).first()
    assert report.is_valid and report.total_rows == len(GOOD)


def test_a_refused_load_changes_nothing(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    landing.write_batch(make_events(spark, GOOD), 1, f"{folder}/good")
    landing.write_batch(make_events(spark, BAD), 1, f"{folder}/bad")
    load_events(warehouse, landing.landing_glob(f"{folder}/good"))
    with pytest.raises(ValueError, match="quality gate.*'duplicate_event_ids': 1"):
        load_events(warehouse, landing.landing_glob(f"{folder}/bad"))
    assert warehouse.read("events").count() == len(GOOD) and len(warehouse.versions("events")) == 1
