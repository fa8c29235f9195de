import pytest
from conftest import make_events, rows
from pyspark.sql import functions as F

from clickloom import schema as S
from clickloom.operators import quality
from clickloom.session import shared_folder
from clickloom.sources import landing
from clickloom.sources.loading import load_events
from clickloom.sources.tables import Warehouse, describe

VALID = [("s1", "u1", "10:00", "homepage_view"), ("s1", "u1", "10:01", "product_click")]


def report(df):
    return quality.quality_report(df).first().asDict()


def test_valid_events(spark):
    got = report(make_events(spark, VALID))
    assert got["total_rows"] == 2 and got["is_valid"]


@pytest.mark.parametrize(
    "change, counter",
    [
        ({"event_id": "e00000"}, "duplicate_event_ids"),
        ({"event_name": "invalid_event"}, "invalid_event_names"),
        ({"variant": "invalid_variant"}, "invalid_variants"),
        ({"event_timestamp": None}, "invalid_timestamps"),
        ({"user_id": None}, "missing_required_values"),
    ],
)
def test_each_defect_is_counted(spark, change, counter):
    got = report(make_events(spark, [VALID[0], (*VALID[1], change)]))
    assert got[counter] == 1 and not got["is_valid"]


def test_null_name_is_missing_but_not_invalid(spark):
    got = report(make_events(spark, [(*VALID[0], {"event_name": None, "variant": None})]))
    assert got["missing_required_values"] == 1
    assert got["invalid_event_names"] == 0 and got["invalid_variants"] == 0


def test_duplicates_count_ids_not_rows(spark):
    same = [(*VALID[0], {"event_id": "x"})] * 3 + [(*VALID[0], {"event_id": None})] * 2
    assert report(make_events(spark, same))["duplicate_event_ids"] == 2


def test_empty_table_is_valid(spark):
    got = report(spark.createDataFrame([], S.EVENT_SCHEMA))
    assert got["total_rows"] == 0 and got["is_valid"]


def test_session_boundary_and_assignment(spark):
    events = make_events(
        spark,
        [
            ("s1", "u1", "10:00", "session_start"),
            ("s1", "u1", "10:05", "session_end"),
            ("s2", "u2", "11:00", "session_start"),
            ("s2", "u2", "11:01", "session_start", {"variant": "treatment"}),
        ],
    )
    assert rows(quality.session_boundary(events)) == [(1, 1)]
    assert rows(quality.unstable_assignment(events)) == [("u2", 1, 2)]
    assert rows(quality.inconsistent_users(events)) == [(1,)]
    assert rows(quality.session_order_check(events)) == [(0,)]
    assert rows(quality.event_distribution(events, by_name=True)) == [
        ("session_end", 1),
        ("session_start", 3),
    ]


def test_null_profile(spark):
    events = make_events(spark, [(*VALID[0], {"page": "home"}), VALID[1]])
    got = quality.null_profile(events).first().asDict()
    assert got["page"] == 1 and got["event_id"] == 0 and got["price"] == 2
    assert list(got) == events.columns


# ------------------------------------------------------------ landing and tables
def test_batch_rules(spark, folder):
    events = make_events(spark, VALID)
    with pytest.raises(ValueError):
        landing.write_batch(events, 0, folder)
    with pytest.raises(ValueError):
        landing.write_batch(events.limit(0), 1, folder)
    landing.write_batch(events, 1, folder)
    landing.write_batch(events, 1, folder)  # a retry replaces its batch
    landing.write_batch(events, 2, folder)
    back = landing.read_events(spark, landing.landing_glob(folder))
    assert back.count() == 4 and back.schema == S.EVENT_SCHEMA


def test_text_timestamps_are_read_under_the_contract(spark, folder):
    narrow = spark.createDataFrame(
        [
            ("e1", "u1", "s1", "2026-01-01 10:00:00", "homepage_view", "EXP-001", "control"),
            ("e2", "u1", "s1", "not a time", "product_click", "EXP-001", "control"),
        ],
        "event_id string, user_id string, session_id string, event_timestamp string, "
        "event_name string, experiment_id string, variant string",
    )
    landing.write_batch(narrow, 1, folder)
    events = landing.read_events(spark, landing.landing_glob(folder))
    assert events.schema == S.EVENT_SCHEMA
    assert report(events)["invalid_timestamps"] == 1


def test_properties_by_name_or_json(spark):
    struct = spark.sql("SELECT named_struct('idle_before_cart_view_seconds', 7) AS event_properties")
    text = spark.sql("""SELECT '{"persona":"p","query":"q"}' AS event_properties""")
    assert landing.conform(struct).first().event_properties.asDict() == {
        "persona": None,
        "query": None,
        "idle_before_cart_view_seconds": 7,
    }
    assert landing.conform(text).first().event_properties.persona == "p"


def test_gated_load_keeps_the_old_table(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/wh")
    landing.write_batch(make_events(spark, VALID), 1, f"{folder}/good")
    bad = make_events(spark, [(*VALID[0], {"event_name": "nope"})])
    landing.write_batch(bad, 1, f"{folder}/bad")

    result = load_events(warehouse, landing.landing_glob(f"{folder}/good")).first()
    assert result.is_valid and result.total_rows == 2
    with pytest.raises(ValueError, match="quality gate"):
        load_events(warehouse, landing.landing_glob(f"{folder}/bad"))
    assert warehouse.read("events").count() == 2


def test_versions_and_catalog(spark, folder):
    warehouse = Warehouse(spark, folder)
    with pytest.raises(FileNotFoundError):
        warehouse.read("t")
    warehouse.write("t", spark.range(3))
    reader = warehouse.read("t")
    warehouse.write("t", spark.range(5))
    warehouse.write("analytics_x", spark.range(1))
    assert warehouse.read("t").count() == 5
    assert reader.count() == 3  # files of the former version stay
    assert rows(warehouse.table_names("analytics_")) == [("analytics_x",)]
    assert rows(warehouse.missing_tables(["t", "u"])) == [("u",)]
    with pytest.raises(ValueError, match="u"):
        warehouse.require_tables(["t", "u"])


def test_failed_write_is_not_published(spark, folder):
    warehouse = Warehouse(spark, folder)
    warehouse.write("t", spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        warehouse.write("t", broken)
    assert warehouse.read("t").count() == 3


def test_describe(spark):
    assert rows(describe(spark.sql("SELECT 1 AS a, 'x' AS b"))) == [
        (1, "a", "int"),
        (2, "b", "string"),
    ]


class _Session:
    """The two settings shared_folder reads."""

    def __init__(self, master, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, f"app-{id(self)}"


def test_shared_folder():
    assert shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn", None))
    local = _Session("local[8]", None)
    assert shared_folder(local) == shared_folder(local)
