"""Incremental refresh: a landing replaces only the sessions it touches.

A full run computes every session table from all events. Here events are kept by
day and every session table by the home day of its sessions, the day of their
first event. A landing adds events to its days. A refresh then

1. takes the sessions of the events added since the last refresh (the change set),
2. looks up which days those sessions were on before (table ``session_days``),
3. reads the events of those days and computes the tables for these sessions only
   (the first refresh touches every session and takes the events as they lie),
4. rewrites, of each table, the home days these sessions had or now have: the
   other sessions' rows are kept, theirs are replaced.

All other days' files stay as they are. A late event that makes a session start
earlier moves its rows to another home day. The tables equal those of a full run.

Each table's commit names the landing commit it was made from, so a refresh that
ends half way is made up by the next one: every table starts from its own mark.
``session_days`` is read whole (three narrow columns) and committed last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.segments import hot_keys
from clickloom.operators import features, funnel, velocity
from clickloom.operators.quality import report_of_counted, row_counters
from clickloom.session import fresh_folder
from clickloom.sources.dayparts import DayTable, days_between, ddl
from clickloom.sources.landing import read_events

# events and the hot sessions among them -> rows with a session_id
SessionTable = Callable[[DataFrame, list], DataFrame]

SESSION_TABLES: dict[str, SessionTable] = {
    "analytics_session_funnel": lambda events, hot: funnel.session_funnel(events),
    "analytics_velocity_metrics": velocity.velocity_metrics,
    "analytics_churn_feature_dataset": features.churn_features,
}

HOME = "home_day"
_DAYS = f"session_id string, {HOME} date, last_day date"


@dataclass(frozen=True)
class Refreshed:
    """What one refresh did."""

    sessions: int
    event_days: list[str]  # days of older events that were read
    home_days: list[str]  # days of the session tables that were rewritten


def session_days(events: DataFrame) -> DataFrame:
    """First and last day of each session."""
    day = F.to_date("event_timestamp")
    return events.groupBy("session_id").agg(F.min(day).alias(HOME), F.max(day).alias("last_day"))


class IncrementalWarehouse:
    """Events by day and session tables by home day below one shared root."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, SessionTable] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = SESSION_TABLES if tables is None else tables
        self.events = DayTable(spark, f"{self.root}/events")
        self._days = DayTable(spark, f"{self.root}/session_days", _DAYS)

    def table(self, name: str) -> DataFrame:
        """A session table as of its last refresh."""
        return self._part(name).read().drop(HOME)

    def _part(self, name: str) -> DayTable:
        return DayTable(self.spark, f"{self.root}/{name}")

    # ---------------------------------------------------------------- landing
    def land(self, *paths: str) -> DataFrame:
        """Add landed events behind the quality gate; the one-row report.

        Ids are held against each other and against the events of the landing's
        own days: an event that is landed again has its old time. Raises
        ValueError, and adds nothing, when the report is not valid.
        """
        landed = read_events(self.spark, *paths)
        day = "to_date(event_timestamp)"
        path = fresh_folder(self.spark, "landing")
        seen = Observation()
        landed.observe(seen, *row_counters()).write.option("compression", "zstd").parquet(path)
        landed = self.spark.read.schema(landed.schema).parquet(path)
        report = report_of_counted(landed, seen.get)
        result = report.first()
        repeated = 0
        if self.events.log.latest():
            days = [r[0].isoformat() for r in landed.selectExpr(f"{day} AS d").where("d IS NOT NULL").distinct().collect()]
            known = self.events.read(days).select("event_id")
            repeated = landed.select("event_id").join(known, "event_id", "left_semi").distinct().count()
        if not result.is_valid or repeated:
            raise ValueError(f"events failed the quality gate: {result.asDict()}, {repeated} ids are known already")
        self.events.add(self.events.stage(landed, day), ddl(landed))
        return self.spark.createDataFrame([result], report.schema)

    def _added(self, mark: int, upto: int) -> list[str]:
        """Folders of the events landed in commits mark + 1 to upto."""
        landings = (self.events.log.read(n)["added"] for n in range(mark + 1, upto + 1))
        return [f for added in landings for folders in added.values() for f in folders]

    # ---------------------------------------------------------------- refresh
    def refresh(self) -> Refreshed:
        """Bring all session tables up to the events landed so far."""
        upto = self.events.log.latest()
        parts = {name: self._part(name) for name in self.tables}
        marks = {name: part.snapshot().get("events", 0) for name, part in parts.items()}
        known_state = self._days.snapshot()
        mark = min([known_state.get("events", 0), *marks.values()])
        folders = self._added(mark, upto)
        if not folders:
            return Refreshed(0, [], [])
        schema = self.events.snapshot(upto)["schema"]
        added = self.spark.read.schema(schema).parquet(*folders)
        touched = self._stored(added.select("session_id").distinct(), "touched")
        before = self._stored(
            self._days.read(number=known_state["number"]).join(touched, "session_id", "left_semi")
            if known_state["number"] else self.spark.createDataFrame([], _DAYS),
            "before",
        )
        # Days are few; sessions are not, so only days come to the driver.
        spans = before.select(HOME, "last_day").distinct().collect()
        new_days = {f.rpartition("=")[2] for f in folders}
        days = new_days.union(*[days_between(*span) for span in spans])
        if mark:
            events = self._stored(
                self.events.read(days, number=upto).join(touched, "session_id", "left_semi"), "touched-events"
            )
        else:  # all events are added ones, so every session is touched
            events = self.events.read(number=upto).where(F.col("session_id").isNotNull())
        now = self._stored(session_days(events), "session-days")
        homes = {r[0].isoformat() for r in before.select(HOME).union(now.select(HOME)).distinct().collect()}
        if len({known_state.get("events", 0), *marks.values()}) > 1:
            homes |= days  # an earlier refresh ended half way: rows may lie on homes it gave
        hot = hot_keys(events, "session_id")
        home = now.select("session_id", HOME)
        for name, table in self.tables.items():
            computed = table(events, hot)
            self._replace(parts[name], computed.join(home, "session_id"), touched, homes, upto)
        self._replace(self._days, now, touched, homes, upto)
        return Refreshed(now.count(), sorted(days), sorted(homes))

    def _replace(self, part: DayTable, rows: DataFrame, touched: DataFrame, homes: set[str], upto: int) -> None:
        """The touched sessions' rows in place of their old ones."""
        state = part.snapshot()
        if state["number"]:
            old = part.read(homes, number=state["number"])
            rows = old.join(touched, "session_id", "left_anti").unionByName(rows)
        part.replace(homes, part.stage(rows, HOME), ddl(rows), state["number"], events=upto)

    def _stored(self, df: DataFrame, label: str) -> DataFrame:
        path = fresh_folder(self.spark, label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
