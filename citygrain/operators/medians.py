"""Exact medians and distinct counts per group, also for a group that holds a large part of all rows.

Both need the values of a group side by side. A group of ordinary size is brought to one task,
once, and worked out there with the built-in aggregates. Groups above ``HOT_GROUP_ROWS`` rows are
looked for first by a plain count (combined map-side, over a sample) and take another way:

* distinct counts group by (keys, value) first, which spreads a dominant group over all tasks;
* medians come from an exact distributed search: quantile sketches, which tasks build and merge, bracket the
  middle of every group and measure in one pass, and a second pass counts the values inside the brackets.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.functions.numbers import finite
from citygrain.session import cut_lineage, staged

#: A group above this many rows does not go through one task.
HOT_GROUP_ROWS = 200_000
#: Rows of the sample that a group of that size has.
SAMPLE_HITS = 10_000
#: A sketch is off by one part in so many of a group's rows.
ACCURACY = 10_000
#: Shares of the rows at which a sketch is read: a coarse grid, and close to the middle and to the ends.
SHARES = sorted([i / 32 for i in range(1, 32)] + [0.5 - 3 / ACCURACY, 0.5 + 3 / ACCURACY, 3 / ACCURACY, 1 - 3 / ACCURACY])
#: Rows between two brackets that are counted one value at a time.
FEW = 1_000_000
#: Hot keys are joined by broadcast up to this count; each stands for HOT_GROUP_ROWS rows or more.
BROADCAST_KEYS = 100_000


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.`{key}`").eqNullSafe(F.col(f"{right}.`{key}`"))
    return condition


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys of the groups above ``hot_rows`` rows.

    With a large limit a sample tells them: a group of that size has SAMPLE_HITS rows in it, so
    half as many is a safe sign, and the count shuffles a small part of the keys only. Which way a
    group goes never changes its result, only where the work is done.
    """
    rate = min(1.0, SAMPLE_HITS / hot_rows)
    seen = df if rate == 1.0 else df.sample(rate, seed=17)
    limit = hot_rows if rate == 1.0 else SAMPLE_HITS / 2
    return seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)


def with_medians(
    df: DataFrame,
    keys: Sequence[str],
    medians: dict[str, Column],
    others: Sequence[Column] = (),
    distinct: dict[str, Column] | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
    null_keys: bool = True,
) -> DataFrame:
    """``groupBy(keys)`` with exact medians, distinct counts, and aggregates that combine map-side.

    ``medians`` and ``distinct`` map output names to columns; NULL and NaN are skipped. Runs one
    small count job to find the hot groups. With ``null_keys=False`` groups with a NULL key are
    left out; that is tested on the groups, as a filter on the rows would be pushed below the
    projections that make the keys and repeat their expressions.
    """
    keys, distinct = list(keys), distinct or {}
    hot = hot_groups(df, keys, hot_rows)
    whole = reduce(and_, [F.col(f"`{key}`").isNotNull() for key in keys], F.lit(True))
    if hot.isEmpty():
        result = _cold(df, keys, medians, others, distinct, whole)
    elif not keys:
        return _hot(df, keys, medians, others, distinct, 1)
    else:
        # Found by a sample, so found once: both branches below read the same written list.
        hot = staged(hot, "hot-groups")
        n_hot = hot.count()
        hot_keys = hot.select(*keys)
        wanted = hot_keys if null_keys else hot_keys.where(whole)

        def small(df: DataFrame) -> DataFrame:
            return F.broadcast(df) if n_hot <= BROADCAST_KEYS else df

        condition = _same(keys, "r", "h")
        rest = df.alias("r").join(small(hot_keys).alias("h"), condition, "left_anti")
        large = df.alias("r").join(small(wanted).alias("h"), condition, "left_semi")
        result = _cold(rest, keys, medians, others, distinct, whole).unionByName(
            _hot(large, keys, medians, others, distinct, n_hot).withColumn("_whole", F.lit(True))
        )
    return (result if null_keys else result.where("_whole")).drop("_whole")


def _cold(
    df: DataFrame,
    keys: list[str],
    medians: dict[str, Column],
    others: Sequence[Column],
    distinct: dict[str, Column],
    whole: Column,
) -> DataFrame:
    """Rows travel to their group once; the aggregation buffers, which are larger, never do."""
    if keys:
        df = df.repartition(*keys)
    return df.groupBy(*keys).agg(
        *others,
        F.coalesce(F.bool_and(whole), F.lit(True)).alias("_whole"),
        # At most HOT_GROUP_ROWS values, checked by the caller.
        *[F.size(F.collect_set(c)).cast("bigint").alias(name) for name, c in distinct.items()],
        *[F.percentile(finite(c), F.lit(0.5)).alias(name) for name, c in medians.items()],
    )


def distinct_per_group(df: DataFrame, keys: Sequence[str], c: Column, name: str) -> DataFrame:
    """Exact distinct count of the non-NULL values, in two steps that spread a dominant group."""
    return (
        df.select(*keys, c.alias("_id"))
        .where(F.col("_id").isNotNull())
        .dropDuplicates()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(name))
    )


def _hot(
    df: DataFrame,
    keys: list[str],
    medians: dict[str, Column],
    others: Sequence[Column],
    distinct: dict[str, Column],
    n_hot: int,
) -> DataFrame:
    found = order_statistics(
        df, keys, medians, lambda n: (F.floor((n - 1) / 2), F.floor(n / 2)), n_hot
    )
    wide = found.groupBy(*keys).agg(
        *[F.avg(F.when(F.col("_measure") == name, F.col("value"))).alias(name) for name in medians],
    )
    result = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *others)
    plain = [name for name in result.columns if name not in (*keys, "_rows")]
    sides = [wide, *[distinct_per_group(df, keys, c, name) for name, c in distinct.items()]]
    for side in sides:
        names = [name for name in side.columns if name not in keys]
        result = result.alias("a").join(side.alias("b"), _same(keys, "a", "b"), "left").select(
            "a.*", *[F.col(f"b.`{name}`") for name in names]
        )
    return result.select(
        *keys,
        *plain,
        *[F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name) for name in distinct],
        *medians,
    )


def _sketched(rows: DataFrame, target: list[str]) -> DataFrame:
    """Per target and bracket the values below it, and of those inside the number, ends and approximate quantiles."""
    inner = F.when(F.col("_v").between(F.col("_lo"), F.col("_hi")), F.col("_v"))
    return rows.groupBy(*target, "_lo", "_hi").agg(
        F.count_if(F.col("_v") < F.col("_lo")).alias("_below"),
        F.count(inner).alias("_n"),
        F.min(inner).alias("_least"),
        F.max(inner).alias("_most"),
        F.percentile_approx(inner, F.array(*map(F.lit, SHARES)), ACCURACY).alias("_quantiles"),
        F.first("_ranks").alias("_ranks"),
    )


def _bracketed(sketch: DataFrame, target: list[str]) -> DataFrame:
    """Values _lo and _hi that the values at some ``_ranks`` lie between, and about how many rows are _left there.

    An approximate quantile is off by one part in ACCURACY of the rows; twice that is kept on either side.
    Ranks with the same two values share a bracket.
    """
    ranks = sketch.withColumn("_of", F.explode("_ranks"))
    place, margin = (F.col("_of._rank") - F.col("_below")) / F.col("_n"), F.lit(2.0 / ACCURACY) + F.lit(2.0) / F.col("_n")
    points = F.arrays_zip(F.array(*map(F.lit, SHARES)).alias("share"), F.col("_quantiles").alias("value"))
    low = F.try_element_at(F.filter(points, lambda point: point["share"] <= place - margin), F.lit(-1))
    high = F.try_element_at(F.filter(points, lambda point: point["share"] >= place + margin), F.lit(1))
    width = F.coalesce(high["share"], F.lit(1.0)) - F.coalesce(low["share"], F.lit(0.0))
    ends = ranks.select(
        *target, "_of", F.coalesce(low["value"], F.col("_least")).alias("_lo"), F.coalesce(high["value"], F.col("_most")).alias("_hi"), (width * F.col("_n")).alias("_left")
    )
    left = F.max(F.when(F.col("_lo") < F.col("_hi"), F.col("_left")).otherwise(0.0))
    return ends.groupBy(*target, "_lo", "_hi").agg(left.alias("_left"), F.collect_list("_of").alias("_ranks"))


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column],
    ranks,
    n_groups: int = 1,
) -> DataFrame:
    """Exact values at given ranks: rows (keys, _measure, _which, value).

    ``ranks(n)`` maps the column holding the number of non-NULL values to zero-based rank columns, which
    lie close together. One pass over the values makes sketches of all groups and measures, one more
    counts the few values that the sketches leave open; a further sketch comes between the two only
    where they leave more than FEW rows.
    """
    keys = list(keys)
    # Both passes read the values: they are written once, without the columns nobody needs.
    columns = {f"_v{i}": finite(c).alias(f"_v{i}") for i, c in enumerate(measures.values())}
    values = staged(df.select(*keys, *columns.values()), "ranked-values")
    pairs = [F.struct(F.lit(name).alias("_measure"), F.col(column).alias("_v")) for name, column in zip(measures, columns)]
    long = values.select(*keys, F.explode(F.array(*pairs)).alias("_m")).select(*keys, "_m._measure", "_m._v")
    long = long.where(F.col("_v").isNotNull())
    target = [*keys, "_measure"]
    infinite = F.lit(float("inf"))

    everything = long.withColumns({"_lo": -infinite, "_hi": infinite, "_ranks": F.lit(None).cast("string")})
    sketch = _sketched(everything, target)
    wanted = [F.struct(F.lit(which).alias("_which"), rank.cast("bigint").alias("_rank")) for which, rank in enumerate(ranks(F.col("_n")))]
    state = cut_lineage(_bracketed(sketch.withColumn("_ranks", F.array(*wanted)), target))
    small = n_groups * len(measures) <= BROADCAST_KEYS

    def met(state: DataFrame) -> DataFrame:
        lookup = F.broadcast(state) if small else state
        joined = long.alias("r").join(lookup.alias("s"), _same(target, "r", "s")).where("r._v <= s._hi")
        return joined.select(*[F.col(f"s.`{name}`") for name in target], "_v", "_lo", "_hi", "_ranks")

    left = state.agg(F.max("_left")).first()[0] or 0.0
    while left > FEW:
        state = cut_lineage(_bracketed(_sketched(met(state), target), target))
        before, left = left, state.agg(F.max("_left")).first()[0] or 0.0
        if left >= before:
            break

    # All values below are one row; equal values are one row each, so few rows reach the window.
    bracket = [*target, "_lo", "_hi"]
    value = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    counted = met(state).groupBy(*bracket, "_ranks", value.alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*bracket).orderBy(F.col("_value").asc_nulls_first()))
    placed = counted.withColumn("_upto", upto).select("*", F.explode("_ranks").alias("_of"))
    hit = placed.where("_of._rank >= _upto - _n and _of._rank < _upto")
    return hit.select(*target, F.col("_of._which").alias("_which"), F.col("_value").alias("value"))
