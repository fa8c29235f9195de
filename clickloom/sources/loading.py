"""Gated load: write what landed, validate what was written, then publish it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.operators.quality import report_of_counted, row_counters
from clickloom.sources.landing import read_events
from clickloom.sources.tables import Warehouse


def load_events(warehouse: Warehouse, *landing_paths: str) -> DataFrame:
    """Load landed events as table ``events``, by day; returns the one-row report.

    Raises ValueError when the report is not valid, or nothing landed; the events
    table then stays as it was.

    The rows are counted while they are written; after that only their ids are read.
    """
    landed = read_events(warehouse.spark, *landing_paths)
    gate = Observation("gate")
    staged = warehouse.stage("events", landed, F.to_date("event_timestamp"), observed=(gate, *row_counters()))
    if not gate.get["total_rows"]:
        raise ValueError("no events landed")
    report = report_of_counted(warehouse.spark.read.parquet(staged), gate.get)
    result = report.first()
    if not result.is_valid:
        raise ValueError(f"events failed the quality gate: {result.asDict()}")
    warehouse.publish("events", staged)
    return warehouse.spark.createDataFrame([result], report.schema)
