"""District summary: facts joined side by side, gaps filled, indicators added."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citygrain.functions import indicators as ind
from citygrain.functions.numbers import finite, round_even
from citygrain.operators import context
from citygrain.operators.medians import HOT_GROUP_ROWS, order_statistics, with_medians
from citygrain.session import staged

SOCIAL_WINDOW_YEARS = 5
FILL_WITH_MEDIAN = (*context.RENTS, *context.INCOME_MEDIANS, *context.INCOME_MEANS)
FILL_WITH_ZERO = ("social_units_financed", "social_units_financed_5y", "program_count")

CITY_MEDIANS = {
    "median_price_m2": 2,
    "median_income_eur": 2,
    "reference_rent_majorated_eur_m2": 2,
    "quality_of_life_score": 2,
    "months_income_for_1sqm": 2,
    "estimated_50m2_rent_effort_pct": 1,
}
CITY_SUMS = ("social_units_financed", "social_units_financed_5y")


def fill_median(
    df: DataFrame, columns: Iterable[str], default: dict[str, float] | None = None, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Replace NULL by the exact median of the column, or by its default if the column is empty."""
    columns = list(columns)
    default = default or {}
    row = with_medians(df, [], {name: F.col(name) for name in columns}, hot_rows=hot_rows).first()
    fallback = {name: row[name] if row and row[name] is not None else default.get(name) for name in columns}
    return df.withColumns(
        {name: F.coalesce(finite(F.col(name)), F.lit(fallback[name]).cast("double")) for name in columns}
    )


def _latest_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("year") == context.latest_year(df))


def join_facts(
    districts: DataFrame,
    sales_yearly: DataFrame,
    income: DataFrame,
    rents_yearly: DataFrame,
    social_yearly: DataFrame,
    environment: DataFrame,
    key: str = "arrondissement",
) -> DataFrame:
    """All facts beside the districts, each at its own latest year; every side has one row per key."""
    social_recent = context.sum_last_years(
        social_yearly, SOCIAL_WINDOW_YEARS, "social_units_financed", "social_units_financed_5y", key
    )
    sides = [
        _latest_rows(sales_yearly),
        income,
        _latest_rows(rents_yearly).withColumnRenamed("year", "year_rent"),
        _latest_rows(social_yearly).withColumnRenamed("year", "year_social"),
        social_recent,
        environment,
    ]
    for side in sides:
        districts = districts.join(side, key, "left")
    return districts


def fill_gaps(joined: DataFrame) -> DataFrame:
    zeros = {name: F.coalesce(F.col(name), F.lit(0).cast(joined.schema[name].dataType)) for name in FILL_WITH_ZERO}
    environment = context.NEUTRAL_ENVIRONMENT
    return fill_median(joined.withColumns(zeros), [*FILL_WITH_MEDIAN, *environment], environment)


def add_indicators(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumns(
        {
            "months_income_for_1sqm": ind.months_income(c("median_price_m2"), c("median_income_eur")),
            "estimated_50m2_rent_effort_pct": ind.rent_effort(
                c("reference_rent_majorated_eur_m2"), c("median_income_eur")
            ),
            "social_units_per_100_sales": ind.social_per_100_sales(c("social_units_financed"), c("transactions")),
            "environmental_pressure_index": ind.environmental_pressure(c("noise_score"), c("air_score")),
        }
    ).withColumn(
        "quality_of_life_score",
        ind.quality_of_life(
            c("noise_score"), c("air_score"), c("high_noise_share_pct"), c("environmental_pressure_index")
        ),
    )


def build_summary(
    districts: DataFrame,
    sales_yearly: DataFrame,
    income: DataFrame,
    rents_yearly: DataFrame,
    social_yearly: DataFrame,
    environment: DataFrame,
    key: str = "arrondissement",
) -> DataFrame:
    """One row per district with every fact, every indicator and the year of each fact.

    The yearly facts and the joined rows are read several times below; they hold one row per
    district and year, and are written once.
    """
    sales_yearly, rents_yearly, social_yearly = (
        staged(facts, "yearly-facts") for facts in (sales_yearly, rents_yearly, social_yearly)
    )
    joined = staged(join_facts(districts, sales_yearly, income, rents_yearly, social_yearly, environment, key), "joined-facts")
    return add_indicators(fill_gaps(joined)).withColumns(
        {
            "sales_year": context.latest_year(sales_yearly),
            "rent_year": context.latest_year(rents_yearly),
            "social_year": context.latest_year(social_yearly),
        }
    )


def city_summary(
    summary: DataFrame, key: str = "arrondissement", selected_year: str | None = None
) -> DataFrame:
    """One row for the whole city: medians and sums over the districts, and the year they share."""
    year = [] if selected_year is None else [selected_year]
    others = [F.count_distinct(key).alias("arrondissement_count")]
    others += [F.max(name).alias(name) for name in year]
    others += [F.sum(name).cast("bigint").alias(name) for name in CITY_SUMS]
    medians = {name: finite(F.col(name)) for name in CITY_MEDIANS}
    # One row per district: the frame is small by nature, so a single aggregate does.
    row = summary.agg(*others, *[F.percentile(value, F.lit(0.5)).alias(name) for name, value in medians.items()])
    return row.select(
        "arrondissement_count",
        *year,
        *CITY_SUMS,
        *[round_even(F.col(name), digits).alias(name) for name, digits in CITY_MEDIANS.items()],
    )


def color_stops(df: DataFrame, metric: str) -> DataFrame:
    """Smallest, middle and largest value of a map layer as one array.

    The middle is the value at position n div 2 of the sorted list. Equal ends give v, v+1, v+2,
    no value at all gives zeros. A layer of buildings is large, so the ranks are searched for.
    """
    value = F.col(metric)
    # Values that are not finite have no colour.
    rows = df.select(metric).where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))
    found = order_statistics(rows, [], {metric: value}, lambda n: (F.lit(0).cast("bigint"), F.floor(n / 2), n - 1))
    by_place = [F.max(F.when(F.col("_which") == place, F.col("value"))) for place in range(3)]
    first, middle, last = by_place
    stops = (
        F.when(first.isNull(), F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)))
        .when(first == last, F.array(first, first + 1, first + 2))
        .otherwise(F.array(first, middle, last))
    )
    return found.agg(stops.alias("stops"))
