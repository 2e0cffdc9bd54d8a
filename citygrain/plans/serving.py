"""Dashboard queries: published tables in, DataFrames out.

An impossible request (unknown year, zone, metric or level) raises ``LookupError`` or
``ValueError`` when the query is built; the checks read single years or single zones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citygrain.functions import indicators as ind
from citygrain.functions.keys import not_blank
from citygrain.functions.numbers import round_even
from citygrain.functions.records import distinct_options
from citygrain.operators import context
from citygrain.operators.lookup import last_per_key, with_district_name
from citygrain.operators.sales import METRICS
from citygrain.operators.numbering import with_rank
from citygrain.operators.summary import city_summary
from citygrain.session import staged
from citygrain.plans.catalog import (
    COMPARED_DISTRICT_METRICS,
    COMPARED_QUARTIER_METRICS,
    LEVEL_LABELS,
    LEVEL_METRICS,
    METRIC_CATALOG,
)

DISTRICT = "arrondissement"


def resolve_year(sales: DataFrame, year: int | None = None) -> int:
    """The asked year, or the latest one; 0 counts as not given."""
    if not year:
        latest = sales.agg(F.max("year")).first()[0]
        if latest is None:
            raise LookupError("no sales at all")
        return int(latest)
    if sales.where(F.col("year") == year).isEmpty():
        raise LookupError(f"no sales for {year}")
    return int(year)


def of_year(sales: DataFrame, year: int | None = None) -> DataFrame:
    return sales.where(F.col("year") == resolve_year(sales, year))


def overview(summary: DataFrame, sales: DataFrame, year: int | None = None) -> DataFrame:
    """The summary with the sale columns of one year, its price rank and the selected year.

    The other facts stay at their own latest year.
    """
    selected = resolve_year(sales, year)
    yearly = sales.where(F.col("year") == selected).select(DISTRICT, *METRICS)
    rows = summary.drop(*METRICS, "months_income_for_1sqm").join(yearly, DISTRICT, "left")
    rows = rows.withColumn(
        "months_income_for_1sqm", ind.months_income(F.col("median_price_m2"), F.col("median_income_eur"))
    )
    ranked = with_rank(staged(rows, "overview"), "median_price_m2").withColumn("selected_sales_year", F.lit(selected))
    return ranked.orderBy(DISTRICT)


def overview_city(summary: DataFrame, sales: DataFrame, year: int | None = None) -> DataFrame:
    """The city row that goes with :func:`overview`."""
    return city_summary(overview(summary, sales, year), DISTRICT, "selected_sales_year")


def _long(df: DataFrame, keep: list[Column], metrics: list[str]) -> DataFrame:
    """One row per metric: (kept columns, metric, value)."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in metrics]
    )
    return df.select(*keep, F.explode(pairs).alias("_m")).select("*", "_m.metric", "_m.value").drop("_m")


def timeline(
    summary: DataFrame, sales: DataFrame, social: DataFrame, rents: DataFrame, district: int
) -> DataFrame:
    """Every yearly figure of one district: rows (series, year, metric, value)."""
    if summary.where(F.col(DISTRICT) == district).isEmpty():
        raise LookupError(f"unknown district {district}")
    parts = []
    for series, df in {"sales": sales, "social": social, "rents": rents}.items():
        metrics = [name for name in df.columns if name not in (DISTRICT, "year")]
        rows = df.where(F.col(DISTRICT) == district)
        parts.append(_long(rows, [F.lit(series).alias("series"), F.col("year").cast("int").alias("year")], metrics))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("series", "year", "metric")


def _deltas(rows: DataFrame, key: str, left, right, metrics: tuple[str, ...]) -> DataFrame:
    """left - right per metric; a metric that one side lacks is left out."""
    both = staged(rows.where(F.col(key).isin(left, right)).select(key, *metrics), "compared")
    known = {row[0] for row in both.select(key).dropDuplicates().collect()}
    if not {left, right} <= known:
        raise LookupError(f"cannot compare {left} and {right}")
    long = _long(both, [F.col(key)], list(metrics))
    sides = long.groupBy("metric").agg(
        F.max(F.when(F.col(key) == left, F.col("value"))).alias("left_value"),
        F.max(F.when(F.col(key) == right, F.col("value"))).alias("right_value"),
    )
    return sides.where("left_value is not null and right_value is not null").withColumn(
        "delta", round_even(F.col("left_value") - F.col("right_value"), 2)
    )


def _sides(rows: DataFrame, key: str, left, right) -> DataFrame:
    """The two rows that are compared, whole, each with its ``side``."""
    return rows.where(F.col(key) == left).select(F.lit("left").alias("side"), "*").unionByName(
        rows.where(F.col(key) == right).select(F.lit("right").alias("side"), "*")
    )


def compared_districts(
    summary: DataFrame, sales: DataFrame, left: int, right: int, year: int | None = None
) -> DataFrame:
    """The rows that :func:`compare_districts` subtracts; ``selected_sales_year`` is the year of both."""
    return _sides(staged(overview(summary, sales, year), "overview"), DISTRICT, left, right)


def compared_quartiers(
    summary: DataFrame, sales_quartier: DataFrame, left: str, right: str, year: int | None = None
) -> DataFrame:
    """The rows that :func:`compare_quartiers` subtracts, with the names of their districts."""
    rows = _one_row_per_quartier(of_year(sales_quartier, year)).withColumn("quartier_id", F.col("quartier_id").cast("string"))
    both = rows.where(F.col("quartier_id").isin(str(left), str(right)))
    return _sides(staged(with_district_name(both, summary.select(DISTRICT, "name")), "compared"), "quartier_id", str(left), str(right))


def compare_districts(
    summary: DataFrame, sales: DataFrame, left: int, right: int, year: int | None = None
) -> DataFrame:
    return _deltas(overview(summary, sales, year), DISTRICT, left, right, COMPARED_DISTRICT_METRICS)


def _one_row_per_quartier(rows: DataFrame) -> DataFrame:
    """A quartier id met in two districts keeps its last row in key order."""
    return last_per_key(rows, ["quartier_id"], ["quartier_name", DISTRICT])


def quartiers(summary: DataFrame, sales_quartier: DataFrame, year: int | None = None) -> DataFrame:
    """Quartiers that can be chosen in a year; a missing name is replaced by the id."""
    rows = of_year(sales_quartier, year).select(
        F.col("quartier_id").cast("string").alias("quartier_id"),
        F.coalesce("quartier_name", F.col("quartier_id").cast("string")).alias("quartier_name"),
        F.col(DISTRICT).cast("int").alias(DISTRICT),
    )
    named = with_district_name(rows, summary.select(DISTRICT, "name"))
    columns = ["quartier_id", "quartier_name", DISTRICT, "arrondissement_name"]
    return distinct_options(named, columns).orderBy(DISTRICT, "quartier_name")


def compare_quartiers(
    sales_quartier: DataFrame, left: str, right: str, year: int | None = None
) -> DataFrame:
    rows = _one_row_per_quartier(of_year(sales_quartier, year))
    return _deltas(rows, "quartier_id", str(left), str(right), COMPARED_QUARTIER_METRICS)


def _merged(features: DataFrame, rows: DataFrame, key: str, how: str) -> DataFrame:
    """Features with the properties of their row; where there is a row, its value wins even if NULL."""
    f, r = features.alias("f"), rows.withColumn("_found", F.lit(True)).alias("r")
    joined = f.join(r, F.col(f"f.`{key}`") == F.col(f"r.`{key}`"), how)
    found = F.col("r._found").isNotNull()
    columns = []
    for name in features.columns:
        own = F.col(f"f.`{name}`")
        if name in rows.columns and name != key:
            own = F.when(found, F.col(f"r.`{name}`")).otherwise(own)
        columns.append(own.alias(name))
    columns += [F.col(f"r.`{name}`") for name in rows.columns if name not in features.columns]
    return joined.select(*columns)


def _tagged(layer: DataFrame, level: str, metric: str, year: int) -> DataFrame:
    supports_year = METRIC_CATALOG[metric][2]
    return layer.withColumns(
        {
            "map_level": F.lit(level),
            "selected_metric": F.lit(metric),
            "metric_value": F.col(metric),
            "metric_year": F.lit(year if supports_year else None).cast("int"),
        }
    )


def _check(level: str, metric: str) -> None:
    if metric not in METRIC_CATALOG:
        raise LookupError(f"unknown metric {metric}")
    if level not in LEVEL_LABELS:
        raise LookupError(f"unknown level {level}")
    if metric not in LEVEL_METRICS[level]:
        raise ValueError(f"level {level} only knows: {', '.join(LEVEL_METRICS[level])}")


def map_districts(
    features: DataFrame, summary: DataFrame, sales: DataFrame, metric: str, year: int | None = None
) -> DataFrame:
    """Every district outline with its overview row; an outline without a row is an error."""
    _check("arrondissement", metric)
    rows = overview(summary, sales, year)
    if not features.join(rows, DISTRICT, "left_anti").isEmpty():
        raise LookupError("a district outline has no summary row")
    selected = resolve_year(sales, year)
    return _tagged(_merged(features, rows, DISTRICT, "inner"), "arrondissement", metric, selected)


def map_quartiers(
    features: DataFrame, sales_quartier: DataFrame, metric: str, year: int | None = None
) -> DataFrame:
    """Every quartier outline; one without sales keeps its own properties and no value."""
    _check("quartier", metric)
    selected = resolve_year(sales_quartier, year)
    rows = _one_row_per_quartier(sales_quartier.where(F.col("year") == selected))
    layer = _merged(features.withColumn("quartier_id", F.col("quartier_id").cast("string")), rows, "quartier_id", "left")
    return _tagged(layer, "quartier", metric, selected)


def map_streets(
    features: DataFrame, sales_street: DataFrame, metric: str, year: int | None = None
) -> DataFrame:
    """Street lines with sales; several lines may share one street."""
    _check("street", metric)
    selected = resolve_year(sales_street, year)
    rows = last_per_key(
        sales_street.where(F.col("year") == selected), ["street_key"], ["street_name", DISTRICT, "commune_insee"]
    )
    layer = _merged(features, rows, "street_key", "inner")
    name = F.coalesce(not_blank(F.col("display_name")), not_blank(F.col("street_name")), F.col("street_key"))
    return _tagged(layer.withColumn("name", name), "street", metric, selected)


def map_buildings(sales_building: DataFrame, metric: str, year: int | None = None) -> DataFrame:
    """A point per building that has both coordinates."""
    _check("building", metric)
    selected = resolve_year(sales_building, year)
    rows = sales_building.where(F.col("year") == selected).where("longitude is not null and latitude is not null")
    layer = rows.withColumns(
        {
            "name": F.coalesce(not_blank(F.col("building_label")), F.col("building_id")),
            "geometry": F.struct(
                F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
            ),
        }
    )
    return _tagged(layer, "building", metric, selected)


def map_layer(
    tables: dict[str, DataFrame], metric: str, year: int | None = None, level: str = "arrondissement"
) -> DataFrame:
    """A layer of any level out of the published tables and features."""
    _check(level, metric)
    if level == "arrondissement":
        return map_districts(tables["gold_geojson"], tables["gold_summary"], tables["gold_sales"], metric, year)
    if level == "quartier":
        return map_quartiers(tables["gold_quartiers_geojson"], tables["gold_sales_quartier"], metric, year)
    if level == "street":
        return map_streets(tables["gold_streets_geojson"], tables["gold_sales_street"], metric, year)
    return map_buildings(tables["gold_sales_building"], metric, year)


def metric_catalog_column() -> Column:
    """metric -> STRUCT<label, unit, supports_year>."""
    entries: list[Column] = []
    for name, (label, unit, supports_year) in METRIC_CATALOG.items():
        entries += [
            F.lit(name),
            F.struct(
                F.lit(label).alias("label"), F.lit(unit).alias("unit"), F.lit(supports_year).alias("supports_year")
            ),
        ]
    return F.create_map(*entries)


def metadata(sales: DataFrame, social: DataFrame, rents: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row: years per fact, metric catalogue, map levels, geocoding coverage."""
    years = context.available_years({"sales": sales, "social": social, "rents": rents})
    spread = [
        F.max(F.when(F.col("fact") == fact, F.col(column))).alias(name.format(fact))
        for column, name in (("latest_year", "latest_{}_year"), ("years", "available_{}_years"))
        for fact in ("sales", "social", "rents")
    ]
    levels = F.array(
        *[
            F.struct(
                F.lit(level).alias("key"),
                F.lit(label).alias("label"),
                F.array(*[F.lit(metric) for metric in LEVEL_METRICS[level]]).alias("supported_metrics"),
            )
            for level, label in LEVEL_LABELS.items()
        ]
    )
    document = coverage.select(F.struct(*coverage.columns).alias("c")).scalar()
    return years.agg(*spread).withColumnsRenamed(
        {"latest_rents_year": "latest_rent_year", "available_rents_years": "available_rent_years"}
    ).select(
        F.current_timestamp().alias("generated_at"),
        "*",
        document.alias("spatial_sales_coverage"),
        metric_catalog_column().alias("metrics"),
        levels.alias("map_levels"),
    )
