"""Row numbers and ranks over whole frames.

A window without a partition brings every row to one task. Here rows are dealt out by ranges of
their order and numbered within their range; the counts of the ranges before it are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.session import staged


def _by_range(df: DataFrame, order: Sequence[Column], weight: Column) -> DataFrame:
    """``df`` with the number of its range, ``_range``, and the weight of all ranges before, ``_start``."""
    # Written once, so that the ranges that are counted are the ones that are numbered.
    ranged = staged(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shuffle partition at most, however long the frame is.
    starts = (
        ranged.groupBy(F.col("_range").alias("_of"))
        .agg(F.sum(weight).alias("_total"))
        .select("_of", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    return ranged.join(F.broadcast(starts), F.col("_range") == F.col("_of")).drop("_of")


#: Bits of a row's place in its partition, below those of the partition's number.
PLACE_BITS = 33


def numbered(df: DataFrame, name: str, *order: str, in_ranges: bool = False) -> DataFrame:
    """Number all rows from 0 in the given order; rows that are equal in it come in any order.

    ``in_ranges`` tells that partitions should hold ranges of the first column already: then rows are dealt
    out again only where that proves wrong.
    """

    def in_order(rows: DataFrame) -> DataFrame:
        # Written once, so that the ranges that are counted are the ones that are numbered.
        return staged(rows.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")

    placed = in_order(df) if in_ranges else None
    if placed is None or not _are_ranges(placed, order[0]):
        placed = in_order((df if placed is None else placed.drop("_at")).repartitionByRange(*order))
    before = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition at most, however long the frame is.
    starts = (
        placed.groupBy(F.shiftright("_at", PLACE_BITS).alias("_of"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_of", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    rows = placed.join(F.broadcast(starts), F.shiftright("_at", PLACE_BITS) == F.col("_of"))
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumn(name, (F.col("_start") + place).cast("bigint")).drop("_at", "_of", "_start")


def _are_ranges(placed: DataFrame, first: str) -> bool:
    """Partitions, in their order, hold separate rising ranges of a column without NULL."""
    value = F.col(first)
    ends = placed.groupBy(F.shiftright("_at", PLACE_BITS).alias("_of")).agg(
        F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(value.isNull()).alias("unknown")
    )
    rows = sorted(ends.collect(), key=lambda row: row["_of"])
    return all(row["unknown"] == 0 for row in rows) and all(one["high"] < other["low"] for one, other in zip(rows, rows[1:]))


def with_rank(df: DataFrame, value: str, name: str = "rank_by_price") -> DataFrame:
    """Rank by falling value; equal values share the better rank, NULL has none.

    Distinct values are counted first, so a value that many rows share is one row to the ranking.
    """
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    )
    falling = F.col("_value").desc()
    above = Window.partitionBy("_range").orderBy(falling).rowsBetween(Window.unboundedPreceding, -1)
    rank = F.col("_start") + F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1
    ranks = _by_range(counted, [falling], F.col("_rows")).select("_value", rank.cast("bigint").alias(name))
    return df.join(ranks, F.col(value) == F.col("_value"), "left").drop("_value")
