"""What the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.session import fresh_folder

SPACES = r"[\x20\x09-\x0D]+"  # one run of white space between words
SPACE_CHARS = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()  # applications whose workers have the package


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run.

    The archive is made on the driver; Spark sends it to every worker, also to
    executors that join later.
    """
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="clickloom-"), "clickloom"),
            "zip",
            os.path.dirname(package),
            os.path.basename(package),
        )
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once below the shared folder and read back.

    Cuts the lineage: what follows survives lost executors without recomputing
    what came before, and is computed once however often it is used.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Array of the words of a text; null has none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")
