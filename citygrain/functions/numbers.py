"""Numeric expressions. All are native columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what counts as a decimal number in the source files.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once.

    A filter is pushed below the projection that made its column, and the column's expression is
    then repeated for every mention. A lambda variable cannot be taken apart that way.
    """
    return F.transform(F.array(value), use)[0]


def where_once(df: DataFrame, names: Sequence[str], test: Callable[[Column], Column]) -> DataFrame:
    """``df.where(test(row))`` on columns that the same plan works out of others: each is worked out once.

    The row of these columns comes out of a generator, which no filter on it is pushed through.
    """
    row = F.struct(*[F.col(f"`{name}`").alias(name) for name in names])
    return df.withColumn("_once", F.explode(F.array(row))).where(test(F.col("_once"))).drop("_once")


def round_even(c: Column, digits: int) -> Column:
    """Round to ``digits`` decimals the way array libraries do: scale, round half to even, unscale."""
    scale = float(10**digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def to_number(c: Column) -> Column:
    """String to double, NULL when it is not a plain decimal number.

    A bare cast would also take ``12d`` or a hexadecimal float.
    """
    return bound(c, lambda text: F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double")))


def french_to_double(c: Column) -> Column:
    """``1 234,50`` to 1234.5: blanks and non-breaking blanks go, the comma is the decimal sign."""
    return to_number(F.translate(c, ",\u00a0 ", "."))


def finite(c: Column) -> Column:
    """NaN to NULL, so that aggregates skip it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros; never shortens, which a bare ``lpad`` does."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def clip(c: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def price_per_m2(value: Column, surface: Column) -> Column:
    return F.try_divide(value, surface)
