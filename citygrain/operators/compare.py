"""Do two frames hold the same result?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], atol: float = 1e-6
) -> DataFrame:
    """Keys whose rows differ, or that only one side has. Keys must be unique and not NULL."""
    a = left.select(*keys, *[F.col(name).alias(f"_a_{name}") for name in values], F.lit(True).alias("_in_a"))
    b = right.select(*keys, *[F.col(name).alias(f"_b_{name}") for name in values], F.lit(True).alias("_in_b"))
    same = F.lit(True)
    for name in values:
        x, y = F.col(f"_a_{name}"), F.col(f"_b_{name}")
        close = F.when(x.isNull() | y.isNull(), x.isNull() & y.isNull()).otherwise(F.abs(x - y) <= atol)
        same = same & close
    found = a.join(b, list(keys), "full")
    return found.where(F.col("_in_a").isNull() | F.col("_in_b").isNull() | ~same).select(*keys)


def frames_match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], atol: float = 1e-6
) -> DataFrame:
    """One row: number of differing keys, and whether there are none."""
    return frame_differences(left, right, keys, values, atol).agg(
        F.count(F.lit(1)).alias("differences"), (F.count(F.lit(1)) == 0).alias("same")
    )
