"""How many sales were placed, by which source and down to which grain."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions.numbers import round_even
from citygrain.operators.lookup import ADDRESS_SOURCE, PARCEL_SOURCE
from citygrain.operators.sales import BUILDING_KEYS, STREET_KEYS

COUNTS = (
    "input_rows",
    "input_transactions",
    "adresses_ban_rows",
    "ban_plus_rows",
    "geocoded_rows",
    "quartier_rows",
    "iris_rows",
    "street_rows",
    "building_rows",
    "street_count",
    "street_year_rows",
    "building_count",
    "building_year_rows",
)
RATES = ("adresses_ban", "ban_plus", "geocoded", "quartier", "iris", "street", "building")


def _whole(columns: list[str]) -> Column:
    return reduce(and_, [F.col(name).isNotNull() for name in columns])


def coverage(geocoded: DataFrame) -> DataFrame:
    """One row with thirteen counts and seven rates, from one pass over the sales.

    Every sale is spread as three tagged keys: its transaction, its street-year and its building-year. They are
    made distinct together, by key first and by id then, so all distinct counts are exact and share one
    scan and one shuffle of keys. The plain counts of rows ride along with the transactions.
    """
    flags = {
        "input_rows": F.lit(True),
        "adresses_ban_rows": F.col("geocode_source") == ADDRESS_SOURCE,
        "ban_plus_rows": F.col("geocode_source") == PARCEL_SOURCE,
        "geocoded_rows": F.col("longitude").isNotNull(),
        "quartier_rows": F.col("quartier_id").isNotNull(),
        "iris_rows": F.col("iris_code").isNotNull(),
        "street_rows": F.col("street_key").isNotNull(),
        "building_rows": F.col("building_id").isNotNull(),
    }
    grains = {"transaction": ["transaction_id"], "street": ["street_key", *STREET_KEYS], "building": ["building_id", *BUILDING_KEYS]}

    def tagged(tag: str, columns: list[str]) -> Column:
        # The id first; a key with a NULL is a row of its grain that counts nowhere.
        texts = [F.col(name).cast("string") for name in columns]
        counts = [(flag.cast("int") if tag == "transaction" else F.lit(None).cast("int")).alias(name) for name, flag in flags.items()]
        return F.struct(F.lit(tag).alias("tag"), texts[0].alias("id"), F.array(*texts).alias("key"), _whole(columns).alias("whole"), *counts)

    keys = geocoded.select(F.explode(F.array(*[tagged(tag, columns) for tag, columns in grains.items()])).alias("k")).select("k.*")
    sums = [F.sum(name).alias(name) for name in flags]
    # A row with a NULL key is left uncounted, not filtered: see ``with_medians``.
    distinct = keys.groupBy("tag", "id", "key", "whole").agg(*sums)
    ids = distinct.groupBy("tag", "id").agg(F.count_if("whole").alias("keys"), *sums)

    def of(tag: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("tag") == tag, value)), F.lit(0)).cast("bigint")

    known = (F.col("keys") > 0).cast("int")
    wide = ids.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in flags],
        of("transaction", known).alias("input_transactions"),
        of("street", known).alias("street_count"),
        of("street", F.col("keys")).alias("street_year_rows"),
        of("building", known).alias("building_count"),
        of("building", F.col("keys")).alias("building_year_rows"),
    )
    base = F.greatest(F.col("input_rows"), F.lit(1))
    return wide.select(
        *COUNTS,
        *[round_even(F.col(f"{name}_rows") / base * 100.0, 2).alias(f"{name}_rate_pct") for name in RATES],
    )
