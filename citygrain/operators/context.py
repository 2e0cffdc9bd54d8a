"""Yearly and per-district facts that surround the sales: income, rents, social housing, noise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import keys as k
from citygrain.functions.numbers import finite, french_to_double, round_even, to_number, zfill
from citygrain.operators.medians import HOT_GROUP_ROWS, distinct_per_group, with_medians

# What a district without any noise layer is given.
NEUTRAL_ENVIRONMENT = {
    "noise_score": 2.0,
    "air_score": 2.0,
    "high_noise_share_pct": 50.0,
}
# Class codes of a cell are ten times the air class plus the noise class.
AIR_FACTOR = 10
HIGH_NOISE_CLASS = 3

INCOME_MEDIANS = ("median_income_eur", "first_quartile_income_eur", "third_quartile_income_eur")
INCOME_MEANS = ("poverty_rate_pct", "share_taxable_pct")
RENTS = ("reference_rent_eur_m2", "reference_rent_majorated_eur_m2", "reference_rent_minorated_eur_m2")
SOCIAL_UNITS = ("social_units_financed", "pla_i_units", "plus_units", "pls_units")


def type_income(raw: DataFrame) -> DataFrame:
    """Census-block income lines to numbers, with the district out of the block code."""
    c = F.col
    return raw.select(
        c("IRIS").alias("iris_code"),
        k.code_to_district(c("IRIS")).alias("arrondissement"),
        french_to_double(c("DEC_MED21")).alias("median_income_eur"),
        french_to_double(c("DEC_TP6021")).alias("poverty_rate_pct"),
        french_to_double(c("DEC_Q121")).alias("first_quartile_income_eur"),
        french_to_double(c("DEC_Q321")).alias("third_quartile_income_eur"),
        french_to_double(c("DEC_PIMP21")).alias("share_taxable_pct"),
    )


def income_metrics(df: DataFrame, district: str = "arrondissement", hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Per district: number of blocks, medians of the quantiles, means of the two shares."""
    rows = df.where(F.col(district).isNotNull())
    others = [F.count("iris_code").alias("iris_count")]
    others += [F.avg(finite(F.col(name))).alias(name) for name in INCOME_MEANS]
    medians = {name: F.col(name) for name in INCOME_MEDIANS}
    result = with_medians(rows, [district], medians, others, hot_rows=hot_rows)
    return result.select(
        district, "iris_count", *[round_even(F.col(name), 2).alias(name) for name in (*INCOME_MEDIANS, *INCOME_MEANS)]
    )


def type_rents(raw: DataFrame) -> DataFrame:
    """Rent reference lines to numbers; the district is inside the seven-digit quartier code."""
    c = F.col
    return raw.select(
        to_number(c("Année")).cast("int").alias("year"),
        k.code_to_district(zfill(c("Numéro INSEE du quartier"), 7)).alias("arrondissement"),
        french_to_double(c("Loyers de référence")).alias(RENTS[0]),
        french_to_double(c("Loyers de référence majorés")).alias(RENTS[1]),
        french_to_double(c("Loyers de référence minorés")).alias(RENTS[2]),
    )


def rent_metrics(df: DataFrame, district: str = "arrondissement", year: str = "year") -> DataFrame:
    keys = [district, year]
    return (
        df.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            *[round_even(F.avg(finite(F.col(name))), 2).alias(name) for name in RENTS],
            F.count(finite(F.col(RENTS[0]))).alias("rent_reference_count"),
        )
    )


def type_social(raw: DataFrame) -> DataFrame:
    """Social housing programme lines to numbers; districts 1 to 20 with a year only."""
    c = F.col
    typed = raw.select(
        to_number(c("Arrondissement")).cast("int").alias("arrondissement"),
        to_number(c("Année du financement - agrément")).cast("int").alias("year"),
        c("Identifiant livraison").alias("program_id"),
        to_number(c("Nombre total de logements financés")).alias("social_units_financed"),
        to_number(c("Dont nombre de logements PLA I")).alias("pla_i_units"),
        to_number(c("Dont nombre de logements PLUS")).alias("plus_units"),
        to_number(c("Dont nombre de logements PLS")).alias("pls_units"),
    )
    return typed.where(c("arrondissement").between(*k.DISTRICTS) & c("year").isNotNull())


def social_metrics(df: DataFrame, district: str = "arrondissement", year: str = "year") -> DataFrame:
    """Per district and year: distinct programmes and unit sums; a sum of nothing is 0."""
    keys = [district, year]
    rows = df.dropna(subset=keys)
    sums = rows.groupBy(*keys).agg(
        *[round_even(F.coalesce(F.sum(finite(F.col(name))), F.lit(0.0)), 0).alias(name) for name in SOCIAL_UNITS]
    )
    programs = distinct_per_group(rows, keys, F.col("program_id"), "program_count")
    return sums.join(programs, keys, "left").select(
        *keys, F.coalesce("program_count", F.lit(0)).cast("bigint").alias("program_count"), *SOCIAL_UNITS
    )


def latest_year(df: DataFrame, year: str = "year") -> Column:
    """The largest year as a scalar subquery: nothing is run until the frame using it is."""
    return df.agg(F.max(year).alias("latest")).scalar()


def sum_last_years(
    df: DataFrame, years: int, value: str, name: str, district: str = "arrondissement", year: str = "year"
) -> DataFrame:
    """Sum over the last calendar years, counted back from the latest year of the whole frame."""
    recent = df.where(F.col(year) >= latest_year(df, year) - (years - 1))
    return recent.where(F.col(district).isNotNull()).groupBy(district).agg(
        F.coalesce(F.sum(value), F.lit(0.0)).alias(name)
    )


def available_years(facts: dict[str, DataFrame], year: str = "year") -> DataFrame:
    """Per fact: its latest year and its sorted list of years."""
    result = None
    for name, df in facts.items():
        # Distinct years first: the list only ever holds calendar years.
        years = df.select(year).where(F.col(year).isNotNull()).dropDuplicates()
        row = years.agg(
            F.lit(name).alias("fact"),
            F.max(year).cast("int").alias("latest_year"),
            F.sort_array(F.collect_set(F.col(year).cast("int"))).alias("years"),
        )
        result = row if result is None else result.unionByName(row)
    return result


def environment_metrics(cells: DataFrame, zones: DataFrame, zone: str = "arrondissement") -> DataFrame:
    """Area-weighted noise and air classes of the cells assigned to each zone.

    A zone without cells scores 0, not NULL: its total area counts as 1.
    """
    area, category = F.col("area"), F.col("category")
    noise_class = category % AIR_FACTOR
    sums = cells.where(F.col(zone).isNotNull()).groupBy(zone).agg(
        F.sum(area).alias("_total"),
        F.sum(noise_class * area).alias("_noise"),
        F.sum(F.floor(category / AIR_FACTOR) * area).alias("_air"),
        F.sum(F.when(noise_class == HIGH_NOISE_CLASS, area)).alias("_high"),
        F.count(F.lit(1)).alias("_count"),
    )
    total = F.coalesce(F.nullif(F.col("_total"), F.lit(0.0)), F.lit(1.0))

    def weighted(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)) / total

    return zones.select(zone).dropDuplicates().join(sums, zone, "left").select(
        zone,
        round_even(weighted("_noise"), 3).alias("noise_score"),
        round_even(weighted("_air"), 3).alias("air_score"),
        round_even(weighted("_high") * 100.0, 2).alias("high_noise_share_pct"),
        F.coalesce("_count", F.lit(0)).cast("bigint").alias("noise_cell_count"),
    )


def neutral_environment(zones: DataFrame, zone: str = "arrondissement") -> DataFrame:
    """The stand-in when no noise layer is used: the same middle scores for every zone."""
    return zones.select(zone).dropDuplicates().select(
        zone,
        *[F.lit(value).alias(name) for name, value in NEUTRAL_ENVIRONMENT.items()],
        F.lit(0).cast("bigint").alias("noise_cell_count"),
    )
