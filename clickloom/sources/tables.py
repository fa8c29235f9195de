"""Published tables: every write goes to a path of its own, published last.

Each table has a commit log, ``published/<table>``; a write adds a numbered
commit naming its path, and the highest number counts, whatever the writers'
clocks say. Nothing here knows about rows or other tables: where the cluster has
a catalog, ``ALTER TABLE .. SET LOCATION`` does the same.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.commits import CommitLog

_POINTERS = "published"
DAY = "event_day"  # partition column of tables laid out by day, not part of their rows


class Warehouse:
    """Parquet tables below one shared root.

    A failed write leaves the former version in place, and running readers keep
    the files they planned with. Of two writers the one that commits last wins,
    unless it named the version it builds on; no version is lost before
    ``remove_old_versions`` is called.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ------------------------------------------------------------- catalog
    def log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{_POINTERS}/{name}")

    def versions(self, name: str) -> list[str]:
        """Paths of the table's versions, newest first."""
        log = self.log(name)
        return [log.read(number)["path"] for number in reversed(log.numbers())]

    def current(self, name: str) -> tuple[int, str]:
        """Number and path of the current version."""
        log = self.log(name)
        number = log.latest()
        if not number:
            raise FileNotFoundError(f"table not found in {self.root}: {name}")
        return number, log.read(number)["path"]

    def table_names(self, prefix: str = "") -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{_POINTERS}")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = fs.listStatus(path) if fs.exists(path) else []
        names = sorted(n for n in (s.getPath().getName() for s in found) if n.startswith(prefix))
        return self.spark.createDataFrame([(n,) for n in names], "table_name string").orderBy("table_name")

    def missing_tables(self, required: Iterable[str]) -> DataFrame:
        wanted = self.spark.createDataFrame([(n,) for n in required], "table_name string")
        return wanted.join(self.table_names(), "table_name", "left_anti").orderBy("table_name")

    def require_tables(self, required: Iterable[str]) -> None:
        missing = [row.table_name for row in self.missing_tables(required).collect()]
        if missing:
            raise ValueError(f"missing tables: {', '.join(missing)}")

    # -------------------------------------------------------- read and write
    def _current(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.current(name)[1])

    def read(self, name: str) -> DataFrame:
        return self._current(name).drop(DAY)

    def read_days(self, name: str, first: dt.date, last: dt.date) -> DataFrame:
        """Rows of the days first to last of a table laid out by day; files of
        other days are never opened."""
        return self._current(name).where(F.col(DAY).between(first, last)).drop(DAY)

    def write(self, name: str, df: DataFrame, day: Column | None = None) -> DataFrame:
        """Replace table ``name`` by ``df`` and return the table as written."""
        path = self.stage(name, df, day)
        self.publish(name, path)
        return self.spark.read.parquet(path).drop(DAY)

    def stage(
        self, name: str, df: DataFrame, day: Column | None = None, observed: Sequence | None = None
    ) -> str:
        """Write a version that no reader sees yet; its path.

        With ``day``, rows are laid out by day. Days are gathered before the
        write, large ones in several files. ``observed`` (an Observation and its
        aggregates) sees the rows in the tasks that write them, behind any shuffle:
        Spark counts those once, however often a lost task is run again.
        """
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        laid_out = df if day is None else df.withColumn(DAY, day).hint("rebalance", DAY)
        if observed:
            laid_out = laid_out.observe(*observed)
        writer = laid_out.write.option("compression", "zstd")
        (writer if day is None else writer.partitionBy(DAY)).parquet(path)
        return path

    def publish(self, name: str, path: str, expected: int | None = None) -> int:
        """Make a staged version the current one; its number.

        ``expected`` is the number of the version it was made from (0: none);
        a CommitConflict is raised if another one has been published since.
        """
        return self.log(name).commit({"path": path}, expected)

    def remove_old_versions(self, name: str, keep: int = 1) -> list[str]:
        """Delete all but the newest ``keep`` versions; call it when no reader
        holds them any more. Returns the paths removed."""
        if keep < 1:
            raise ValueError("the current version stays")
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        removed = []
        versions = self.versions(name)
        held = set(versions[:keep])
        for old in dict.fromkeys(v for v in versions[keep:] if v not in held):
            path = jvm.org.apache.hadoop.fs.Path(old)
            if path.getFileSystem(conf).delete(path, True):
                removed.append(old)
        return removed


def describe(df: DataFrame) -> DataFrame:
    """Columns of a table in order, with their types; from the schema, no scan."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal_position int, column_name string, column_type string"
    )
