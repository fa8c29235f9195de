"""Event landing: micro-batches of zstd Parquet, read back under one contract."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schema as S


def _properties(dtype: T.DataType) -> Column:
    """event_properties by field name, from a struct or from JSON text."""
    source = F.col("event_properties")
    if isinstance(dtype, T.StringType):
        return F.from_json(source, S.EVENT_PROPERTIES)
    present = {f.name for f in dtype.fields} if isinstance(dtype, T.StructType) else set()
    fields = [
        (source.getField(f.name) if f.name in present else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in S.EVENT_PROPERTIES.fields
    ]
    return F.when(source.isNotNull(), F.struct(*fields))


def conform(df: DataFrame) -> DataFrame:
    """Any event frame in the contract's columns and types.

    A value that cannot be read as its type becomes NULL (``try_cast``), so the
    quality gate counts it instead of the load failing half way.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in S.EVENT_SCHEMA.fields:
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType:
            column = F.col(field.name)
        elif field.name == "event_properties":
            column = _properties(have[field.name])
        else:
            column = F.col(field.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _by_schema(spark: SparkSession, paths: tuple[str, ...]) -> list[list[str]]:
    """Folders of landed files, grouped by equal schema.

    Lists names only; each folder's schema is read from a footer.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(paths))
    groups: dict[str, list[str]] = {}
    for row in listed.select(folder).distinct().orderBy("folder").collect():
        schema = spark.read.option("mergeSchema", "true").parquet(row.folder).schema
        groups.setdefault(schema.simpleString(), []).append(row.folder)
    return list(groups.values())


def read_events(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan landed Parquet (paths or globs) as contract events.

    Batches may differ: columns and struct fields are the union over all files.
    Where batches hold one column in types that do not merge, each kind of batch
    is brought to the contract on its own.
    """
    try:
        return conform(spark.read.option("mergeSchema", "true").parquet(*paths))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    parts = [
        conform(spark.read.option("mergeSchema", "true").parquet(*group))
        for group in _by_schema(spark, paths)
    ]
    return reduce(DataFrame.unionByName, parts)


def write_batch(events: DataFrame, batch_number: int, directory: str) -> str:
    """Land one micro-batch below ``directory`` and return its path.

    Writing the same batch number again replaces that batch only, so a retried
    batch does not double its rows.
    """
    if batch_number < 1:
        raise ValueError("batch_number must be at least 1")
    if events.isEmpty():
        raise ValueError("an event batch must contain events")
    path = f"{directory.rstrip('/')}/batch_{batch_number:06d}"
    events.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def landing_glob(directory: str) -> str:
    return f"{directory.rstrip('/')}/batch_*"
