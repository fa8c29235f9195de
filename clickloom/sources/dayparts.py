"""Tables that change day by day: folders per day, listed in numbered commits.

A commit holds, for each day, the folders whose rows are that day's. Adding rows
to a day adds a folder to its list, replacing a day's rows replaces the list, and
all other days keep theirs: nothing is copied, and readers of older commits still
find their files. A reader names the days it wants and opens no other folder.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.commits import CommitLog

_PART = "part_day"  # folder name; the rows themselves keep their own columns


class DayTable:
    """One table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")
        self._schema = schema  # needed for the first commit only

    def snapshot(self, number: int | None = None) -> dict:
        """Number, schema, folders by day, and what else the commit said."""
        number = self.log.latest() if number is None else number
        if not number:
            return {"number": 0, "schema": self._schema, "days": {}}
        return {"number": number, **self.log.read(number)}

    def days(self) -> list[str]:
        return sorted(self.snapshot()["days"])

    def read(self, days: Iterable[str] | None = None, number: int | None = None) -> DataFrame:
        """Rows of ``days`` (ISO dates; all if None) in commit ``number`` (the last if None)."""
        state = self.snapshot(number)
        if state["schema"] is None:
            raise FileNotFoundError(f"no table in {self.root}")
        wanted = sorted(state["days"]) if days is None else sorted(set(days) & set(state["days"]))
        folders = [f for day in wanted for f in state["days"][day]]
        if not folders:
            return self.spark.createDataFrame([], state["schema"])
        return self.spark.read.schema(state["schema"]).parquet(*folders)

    def stage(self, rows: DataFrame, day: str) -> dict[str, list[str]]:
        """Write ``rows`` by their date column ``day``; folders by day, unseen until committed.

        Rows without a day are refused: no reader could name it.
        """
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        placed = rows.withColumn(_PART, F.date_format(F.expr(f"coalesce({day}, raise_error('row without a day'))"), "yyyy-MM-dd"))
        placed.hint("rebalance", _PART).write.partitionBy(_PART).option("compression", "zstd").parquet(path)
        found = self.spark.read.parquet(path).select(F.col(_PART).cast("string")).distinct() if _has_rows(self.spark, path) else None
        days = [] if found is None else [r[0] for r in found.collect()]
        return {d: [f"{path}/{_PART}={d}"] for d in days}

    def add(self, staged: dict[str, list[str]], schema: str, **more) -> int:
        """Add staged folders to their days; concurrent additions all stay."""

        def content(latest: int) -> dict:
            old = self.snapshot(latest)["days"]
            days = old | {d: old.get(d, []) + folders for d, folders in staged.items()}
            return {"schema": schema, "days": days, "added": staged, **more}

        return self.log.change(content)

    def replace(self, days: Iterable[str], staged: dict[str, list[str]], schema: str, expected: int, **more) -> int:
        """Put staged folders in place of all rows of ``days``; other days stay.

        What was staged was made from commit ``expected``; a CommitConflict is
        raised if the table has changed since.
        """
        days = set(days)
        if set(staged) - days:
            raise ValueError(f"rows of other days: {sorted(set(staged) - days)}")
        kept = {d: f for d, f in self.snapshot(expected)["days"].items() if d not in days}
        return self.log.commit({"schema": schema, "days": kept | staged, **more}, expected)


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned write left any folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(s.isDirectory() for s in fs.listStatus(root))


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def days_between(first: dt.date, last: dt.date) -> list[str]:
    return [(first + dt.timedelta(n)).isoformat() for n in range((last - first).days + 1)]
