"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a target of words. It is filled by complete epochs over the source first; the rest
is drawn without replacement: each document has the key -ln(u) / weight, with u from a hash of its id
and text, and documents are taken in order of their keys until their words reach the rest.

No source is sorted as a whole. Keys fall into buckets that keep their order; word sums per bucket
show in which one bucket of a source the rest runs out, and only that bucket is sorted.

Defined results: a null text has no words; a null source is a source of its own, the last; sources
are ordered by code point; a source without words has target 0; weights that are null, not finite or
not above 0 count as 1; identical rows are interchangeable; an empty table gives an empty result;
further columns don't matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.columns import plain_names
from citygrain.session import staged

#: Sources in order weigh these, repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times the words of its source.
MOST_EPOCHS = 3
#: Documents per bucket of keys, on average.
BUCKET_ROWS = 2000
MOST_BUCKETS = 1 << 20

WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(row_id: Column, text: Column) -> Column:
    """A number above 0 and below 1 from 52 bits of a digest of id and text, alike in every rerun."""
    joined = F.concat(F.coalesce(row_id.cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.md5(text), F.lit("")))
    digits = F.substring(F.sha2(joined, 256), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Target of every source, from one row (source, source_size, docs) per source.

    A source takes weight * level words, or ``most`` times its size where that is less; the level is
    the one at which all targets add up to the words of all sources. With sources in order of
    size / weight the capped ones come first, so sums over that order give the level.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("source").asc_nulls_last())
    everywhere = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1).cast("int"))
    ranked = sizes.withColumns({"_weight": weight.cast("long"), "_cap": F.col("source_size") * most}).where("source_size > 0")
    level = (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_weight").over(onwards)
    leveled = ranked.withColumn("_level", level)
    # The first source, in that order, whose own share stays within its cap sets the level of all after it.
    free = F.min(F.when(F.col("_weight") * F.col("_level") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), "_level"))).over(everywhere)
    chosen = leveled.withColumn("_free", free["_level"])
    target = F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_free"))
    filled = chosen.select("source", "source_size", "docs", F.coalesce(target, F.col("_cap").cast("double")).alias("target"))
    empty = sizes.where("source_size = 0").select("source", "source_size", "docs", F.lit(0.0).alias("target"))
    return filled.union(empty)


def _keyed(docs: DataFrame, quality: DataFrame | None) -> DataFrame:
    """``docs`` with ``_size`` in words and ``_key``, the smaller the sooner a document is drawn."""
    keyed = docs.withColumns({"_size": word_count(F.col("text")), "_u": uniform(F.col("doc_id"), F.col("text"))})
    if quality is None:
        return keyed.withColumn("_key", -F.log("_u")).drop("_u")
    usable = (F.col("weight") > 0) & (F.col("weight") < F.lit(float("inf")))
    listed = quality.where(usable).select(F.col("doc_id").alias("_id"), F.col("weight").cast("double").alias("_weight"))
    if _few(listed):
        listed = F.broadcast(listed)
    joined = keyed.join(listed, keyed["doc_id"] == F.col("_id"), "left")
    return joined.withColumn("_key", -F.log("_u") / F.coalesce("_weight", F.lit(1.0))).drop("_u", "_id", "_weight")


def _few(frame: DataFrame, most: int = 200_000) -> bool:
    """Whether a list of a few numbers per row, counted here, may be broadcast (under 10 MB)."""
    return frame.limit(most + 1).count() <= most


def _cuts(rows: DataFrame) -> DataFrame:
    """Per source: its size and target, its complete epochs, and the largest key of the last, partial one.

    ``rows`` has (source, size, key). Word sums per bucket of keys tell the bucket in which the rest
    of a source's target runs out; only that bucket is sorted.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    plan = targets(sizes).select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("_epochs"),
        F.least(F.greatest(F.ceil(F.col("docs") / BUCKET_ROWS), F.lit(1)), F.lit(MOST_BUCKETS)).cast("long").alias("_buckets"),
    )
    plan = staged(plan.withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size")), "targets")
    small = F.broadcast(plan) if _few(plan) else plan
    known = rows.join(small, rows["source"].eqNullSafe(F.col("_source")))
    known = known.withColumn("_bucket", F.floor((1 - F.exp(-F.col("key"))) * F.col("_buckets")))
    sums = known.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest"))
    so_far = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_words").over(so_far), F.lit(0)))
    edge = (
        sums.where((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_words") > F.col("_rest")))
        .groupBy("_source")
        .agg(F.max(F.struct("_bucket", "_before")).alias("_edge"))
        .select(F.col("_source").alias("_edge_source"), F.col("_edge._bucket").alias("_edge_bucket"), F.col("_edge._before").alias("_edge_before"))
    )
    edge = staged(edge, "edges")
    at_edge = known.join(
        F.broadcast(edge) if _few(edge) else edge,
        F.col("_source").eqNullSafe(F.col("_edge_source")) & (F.col("_bucket") == F.col("_edge_bucket")),
    )
    in_bucket = Window.partitionBy("_source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.col("_edge_before") + F.coalesce(F.sum("size").over(in_bucket), F.lit(0))
    last = (
        at_edge.withColumn("_prior", prior)
        # the document at the edge comes where that ends nearer to the target
        .where(F.col("_rest") - F.col("_prior") > F.col("size") / 2)
        .groupBy("_source")
        .agg(F.max("key").alias("_last"))
        .select(F.col("_source").alias("_last_source"), "_last")
    )
    # without a document of the edge's bucket, the key where that bucket begins
    begins = -F.log(1 - F.col("_edge_bucket") / F.col("_buckets"))
    return (
        plan.join(edge, plan["_source"].eqNullSafe(F.col("_edge_source")), "left")
        .join(last, plan["_source"].eqNullSafe(F.col("_last_source")), "left")
        .select("_source", "source_size", "target", "_epochs", F.coalesce("_last", begins).alias("_until"))
    )


def _with_copies(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """``keyed`` with its source's size and target, and ``_copies`` of each row."""
    small = F.broadcast(plan) if _few(plan) else plan
    met = keyed.join(small, keyed["source"].cast("string").eqNullSafe(F.col("_source")), "left").drop("_source")
    more = F.when(F.col("_key") <= F.col("_until"), 1).otherwise(0)
    return met.withColumn("_copies", F.when(F.col("_size") > 0, F.coalesce(F.col("_epochs") + more, F.lit(0))).otherwise(0))


def mix(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken (words, repeats counted).

    ``quality`` may give (doc_id, weight), one row per id. A source's taken words differ from its
    target by half of the document at the edge, and by identical rows that share its key.
    """
    rows = _keyed(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")), quality)
    rows = staged(rows.select("doc_id", "source", "_size", "_key"), "mixed")
    plan = staged(_cuts(rows.select("source", F.col("_size").alias("size"), F.col("_key").alias("key"))), "cuts")
    return _with_copies(rows, plan).select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns only.

    Texts are not shuffled: each row learns from its own key, and what holds for its source, how
    often it is taken.
    """
    docs, restored = plain_names(docs, ("doc_id", "text", "source"))
    rows = _keyed(docs.select("doc_id", "text", F.col("source").cast("string").alias("source")), quality)
    plan = staged(_cuts(staged(rows.select("source", F.col("_size").alias("size"), F.col("_key").alias("key")), "mixed")), "cuts")
    kept = _with_copies(_keyed(docs, quality), plan).where("_copies > 0")
    return restored(kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))))
