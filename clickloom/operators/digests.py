"""Reconciliation of two tables by digests of hash ranges, in two levels.

Rows fall into 256 ranges by a hash of their key, and each of these into 256
smaller ones. What a range holds is one order-free digest; the left table's rows
count for it, the right table's against it, so equal contents cancel out. Only
ranges that do not cancel are looked into, and only rows of small ranges that do
not are exchanged, by key. Equal tables exchange at most 256 rows a task and
are each read once.

A digest is the signed number of rows, the xor of 64-bit hashes of their
contents and the signed sum of those hashes (the xor of contents that occur twice
is 0, the sum is not). A range whose contents differ cancels out by chance in about
one of 2**64 cases; what is named
as differing is always exact, up to equal 64-bit hashes of two contents of one key.

Defined results: a NULL key matches nothing, so its rows differ, on both sides;
a repeated key differs if the numbers of rows do; NULL is a value like others in
the further columns; -0.0 is 0.0; columns of maps cannot be compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.columns import tally

RANGES = 256
_BITS = 8  # of a level
_KEY = "_key"  # the key's name within, where no other column of a table is


def _signed(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of both tables: key, side (1, -1), hash of the content, range of each level."""
    content = F.xxhash64(F.lit("content"), key, *columns)
    hashed = F.xxhash64(key)
    sides = [
        table.select(
            F.col(key).alias(_KEY),
            F.lit(side).cast("long").alias("side"),
            content.alias("content"),
            F.shiftrightunsigned(hashed, 64 - _BITS).alias("range"),
            F.shiftrightunsigned(hashed, 64 - 2 * _BITS).alias("part"),
        )
        for table, side in ((left, 1), (right, -1))
    ]
    return sides[0].unionByName(sides[1])


def _digests(rows: DataFrame, by: str) -> DataFrame:
    """The digest of each range, part or key; folded by each task before the shuffle."""
    whole = F.col("content").cast("decimal(20,0)")  # its sum has room for 10**11 rows of a range
    return rows.groupBy(by).agg(
        F.sum(F.when(F.col("side") > 0, 1).otherwise(0)).alias("left_rows"),
        F.sum(F.when(F.col("side") < 0, 1).otherwise(0)).alias("right_rows"),
        F.bit_xor("content").alias("crossed"),
        F.sum(F.when(F.col("side") > 0, whole).otherwise(-whole)).alias("summed"),
        F.count_if(F.col(_KEY).isNull()).alias("without_key"),
    )


def _open() -> Column:
    """What does not cancel out, or has rows without a key."""
    return (
        (F.col("left_rows") != F.col("right_rows"))
        | (F.col("crossed") != 0)
        | (F.col("summed") != 0)
        | (F.col("without_key") > 0)
    )


def open_parts(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = ()) -> list[int]:
    """The small ranges whose contents differ: at most 65,536 numbers.

    The second level is only asked about ranges that differ in the first.
    """
    rows = _signed(left, right, key, columns)
    ranges = [row.range for row in _digests(rows, "range").where(_open()).select("range").collect()]
    if not ranges:
        return []
    within = rows if len(ranges) == RANGES else rows.where(F.col("range").isin(ranges))
    return sorted(row.part for row in _digests(within, "part").where(_open()).select("part").collect())


def differing(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """Keys whose rows differ: key, left_rows, right_rows, status.

    ``status`` is no_key (the rows without one, of both tables), missing_right or
    missing_left (the other table has no such key), row_count, or changed (as many
    rows, other values in ``columns``).
    """
    rows = _signed(left, right, key, columns)
    parts = open_parts(left, right, key, columns)
    if len(parts) < RANGES * RANGES:
        # A bounded list: 65,536 numbers at most.
        wanted = left.sparkSession.createDataFrame([(part,) for part in parts], "part long")
        rows = rows.join(F.broadcast(wanted), "part", "left_semi").select(*rows.columns)
    no_key = F.col(_KEY).isNull()
    status = (
        F.when(no_key, "no_key")
        .when(F.col("right_rows") == 0, "missing_right")
        .when(F.col("left_rows") == 0, "missing_left")
        .when(F.col("left_rows") != F.col("right_rows"), "row_count")
        .otherwise("changed")
    )
    found = _digests(rows, _KEY).where(_open())
    return found.select(F.col(_KEY).alias(key), "left_rows", "right_rows", status.alias("status"))


def reconciliation(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """One row: rows without a partner on each side, keys by kind of difference, a flag."""
    found, no_key = differing(left, right, key, columns), F.col(key).isNull()

    def unmatched(side: str, other: str) -> Column:
        return F.coalesce(F.sum(F.when(no_key | (F.col(other) == 0), F.col(side))), F.lit(0)).cast("long")

    return found.agg(
        unmatched("left_rows", "right_rows").alias("missing_right"),
        unmatched("right_rows", "left_rows").alias("missing_left"),
        tally(F.col("status") == "row_count").alias("repeated_keys"),
        tally(F.col("status") == "changed").alias("changed_keys"),
        (F.count(F.lit(1)) == 0).alias("passed"),
    )
