"""Dashboard queries over the tables built from lineitem, orders, customer, supplier and nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.operators import context
from citygrain.operators import sales as sales_ops
from citygrain.operators.coverage import COUNTS, coverage
from citygrain.plans import serving as ops
from citygrain.plans.catalog import COMPARED_DISTRICT_METRICS, COMPARED_QUARTIER_METRICS, LEVEL_LABELS, LEVEL_METRICS, METRIC_CATALOG
from workloads import facts
from workloads.facts import CITY_COLUMNS_SQL, ORDERED_SQL, RENTS_SQL, SOCIAL_SQL, SUMMARY_SQL
from workloads.registry import register, round_sql, table
from workloads.sales import BUILDING_SQL, SALES_SQL, STREET_SQL, grain_sql, sale_rows

c = F.col
YEAR = 1998
METRICS = ", ".join(sales_ops.METRICS)

SALES_YEARLY_SQL = f"sales_yearly AS ({grain_sql(sales_ops.DISTRICT_KEYS)})"
QUARTIER_YEARLY_SQL = f"{SALES_SQL}, quartier_yearly AS ({grain_sql(sales_ops.QUARTIER_KEYS)})"


def sales_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_ops.sales_by_district(sale_rows(spark, sf_dir)).persist()


def summary_and_sales(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sales = sales_yearly(spark, sf_dir)
    return facts.summary(spark, sf_dir, sales), sales


def overview_sql(year: int) -> str:
    return f"""{SUMMARY_SQL},
    merged AS (SELECT s.* EXCLUDE ({METRICS}, months_income_for_1sqm), {', '.join(f'y.{m}' for m in sales_ops.METRICS)},
      {round_sql('y.median_price_m2 / (median_income_eur / 12.0::DOUBLE)', 2)} AS months_income_for_1sqm
      FROM summary s LEFT JOIN (SELECT * FROM sales_yearly WHERE year = {year}) y USING (arrondissement)),
    overview AS (SELECT *, CASE WHEN median_price_m2 IS NOT NULL
      THEN rank() OVER (ORDER BY median_price_m2 DESC NULLS LAST) END AS rank_by_price,
      {year} AS selected_sales_year FROM merged)"""


@register(f"WITH {overview_sql(YEAR)} SELECT * FROM overview")
def overview_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.overview(*summary_and_sales(spark, sf_dir), YEAR)


@register(f"WITH {overview_sql(YEAR)} SELECT {CITY_COLUMNS_SQL}, max(selected_sales_year) AS selected_sales_year FROM overview")
def overview_city_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.overview_city(*summary_and_sales(spark, sf_dir), YEAR)


def series_sql(series: str, source: str, metrics: tuple[str, ...], district: int) -> str:
    parts = [
        f"SELECT '{series}' AS series, year, '{metric}' AS metric, CAST({metric} AS DOUBLE) AS value"
        f" FROM {source} WHERE arrondissement = {district}"
        for metric in metrics
    ]
    return " UNION ALL ".join(parts)


RENT_METRICS = (*context.RENTS, "rent_reference_count")
SOCIAL_METRICS = ("program_count", *context.SOCIAL_UNITS)


@register(
    f"""WITH {SALES_SQL}, {SALES_YEARLY_SQL}, {ORDERED_SQL}, {RENTS_SQL}, {SOCIAL_SQL}
    {series_sql('sales', 'sales_yearly', sales_ops.METRICS, 7)}
    UNION ALL {series_sql('social', 'social', SOCIAL_METRICS, 7)}
    UNION ALL {series_sql('rents', 'rents', RENT_METRICS, 7)}"""
)
def district_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.timeline(
        facts.districts(spark, sf_dir),
        sales_yearly(spark, sf_dir),
        context.social_metrics(facts.social_rows(spark, sf_dir)),
        context.rent_metrics(facts.rent_rows(spark, sf_dir)),
        7,
    )


def delta_sql(source: str, key: str, left: str, right: str, metrics: tuple[str, ...]) -> str:
    parts = [
        f"""SELECT '{metric}' AS metric, CAST(l.{metric} AS DOUBLE) AS left_value, CAST(r.{metric} AS DOUBLE) AS right_value,
        {round_sql(f'CAST(l.{metric} AS DOUBLE) - CAST(r.{metric} AS DOUBLE)', 2)} AS delta
        FROM {source} l, {source} r WHERE l.{key} = {left} AND r.{key} = {right}
        AND l.{metric} IS NOT NULL AND r.{metric} IS NOT NULL"""
        for metric in metrics
    ]
    return " UNION ALL ".join(parts)


@register(f"WITH {overview_sql(YEAR)} {delta_sql('overview', 'arrondissement', '3', '9', COMPARED_DISTRICT_METRICS)}")
def districts_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compare_districts(*summary_and_sales(spark, sf_dir), 3, 9, YEAR)


@register(
    f"""WITH {overview_sql(YEAR)}
    SELECT CASE arrondissement WHEN 3 THEN 'left' ELSE 'right' END AS side, * FROM overview WHERE arrondissement IN (3, 9)"""
)
def districts_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compared_districts(*summary_and_sales(spark, sf_dir), 3, 9, YEAR)


def quartier_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_ops.sales_by_quartier(sale_rows(spark, sf_dir)).persist()


@register(
    f"""WITH {QUARTIER_YEARLY_SQL}
    SELECT DISTINCT quartier_id, coalesce(quartier_name, quartier_id) AS quartier_name, arrondissement,
      n_name AS arrondissement_name FROM quartier_yearly LEFT JOIN nation ON arrondissement = n_nationkey + 1
    WHERE year = (SELECT max(year) FROM quartier_yearly)"""
)
def quartier_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.quartiers(facts.districts(spark, sf_dir), quartier_yearly(spark, sf_dir))


@register(
    f"""WITH {QUARTIER_YEARLY_SQL}, one AS (SELECT * FROM quartier_yearly WHERE year = {YEAR}
      QUALIFY row_number() OVER (PARTITION BY quartier_id ORDER BY quartier_name DESC, arrondissement DESC) = 1)
    {delta_sql('one', 'quartier_id', "'3'", "'5'", COMPARED_QUARTIER_METRICS)}"""
)
def quartiers_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compare_quartiers(quartier_yearly(spark, sf_dir), "3", "5", YEAR)


@register(
    f"""WITH {QUARTIER_YEARLY_SQL}, one AS (SELECT * FROM quartier_yearly WHERE year = {YEAR}
      QUALIFY row_number() OVER (PARTITION BY quartier_id ORDER BY quartier_name DESC, arrondissement DESC) = 1)
    SELECT CASE quartier_id WHEN '3' THEN 'left' ELSE 'right' END AS side, one.*, n_name AS arrondissement_name
    FROM one LEFT JOIN nation ON arrondissement = n_nationkey + 1 WHERE quartier_id IN ('3', '5')"""
)
def quartiers_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.compared_quartiers(facts.districts(spark, sf_dir), quartier_yearly(spark, sf_dir), "3", "5", YEAR)


def district_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        c("n_nationkey").alias("feature_index"),
        (c("n_nationkey") + 1).alias("arrondissement"),
        c("n_name").alias("label"),
        F.lower("n_name").alias("name"),
        F.format_string("POINT(%d 0)", c("n_nationkey")).alias("geometry"),
    )


DISTRICT_FEATURES_SQL = """features AS (SELECT n_nationkey AS feature_index, n_nationkey + 1 AS arrondissement,
    n_name AS label, lower(n_name) AS name, 'POINT(' || n_nationkey || ' 0)' AS geometry FROM nation)"""


@register(
    f"""WITH {overview_sql(YEAR)}, {DISTRICT_FEATURES_SQL}
    SELECT f.feature_index, f.label, f.geometry, o.*, 'arrondissement' AS map_level, 'noise_score' AS selected_metric,
      o.noise_score AS metric_value, CAST(NULL AS INTEGER) AS metric_year
    FROM features f JOIN overview o USING (arrondissement)"""
)
def district_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.map_districts(
        district_features(spark, sf_dir), *summary_and_sales(spark, sf_dir), "noise_score", YEAR
    )


def quartier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice as many outlines as suppliers: half of them have no sales."""
    return table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("feature_index"),
        c("c_custkey").alias("quartier_id"),
        (c("c_nationkey") + 1).alias("arrondissement"),
        c("c_name").alias("name"),
        c("c_mktsegment").alias("quartier_name"),
    )


@register(
    f"""WITH {QUARTIER_YEARLY_SQL}, one AS (SELECT * FROM quartier_yearly WHERE year = {YEAR}
      QUALIFY row_number() OVER (PARTITION BY quartier_id ORDER BY quartier_name DESC, arrondissement DESC) = 1)
    SELECT c_custkey AS feature_index, CAST(c_custkey AS VARCHAR) AS quartier_id,
      CASE WHEN o.quartier_id IS NOT NULL THEN o.arrondissement ELSE c_nationkey + 1 END AS arrondissement, c_name AS name,
      CASE WHEN o.quartier_id IS NOT NULL THEN o.quartier_name ELSE c_mktsegment END AS quartier_name, o.year,
      {', '.join(f'o.{m}' for m in sales_ops.METRICS)}, 'quartier' AS map_level, 'median_price_m2' AS selected_metric,
      o.median_price_m2 AS metric_value, {YEAR} AS metric_year
    FROM customer LEFT JOIN one o ON o.quartier_id = CAST(c_custkey AS VARCHAR)"""
)
def quartier_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.map_quartiers(
        quartier_features(spark, sf_dir), quartier_yearly(spark, sf_dir), "median_price_m2", YEAR
    )


def street_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lines per street met in the sales, and one street that has none."""
    keys = sale_rows(spark, sf_dir).select("street_key").where("street_key is not null").dropDuplicates()
    return keys.select(
        "street_key",
        F.explode(F.array(F.lit("first"), F.lit(""))).alias("display_name"),
    )


@register(
    f"""WITH {SALES_SQL}, street_yearly AS ({STREET_SQL}),
    one AS (SELECT * FROM street_yearly WHERE year = {YEAR}
      QUALIFY row_number() OVER (PARTITION BY street_key
        ORDER BY street_name DESC, arrondissement DESC, commune_insee DESC) = 1),
    features AS (SELECT street_key, unnest(['first', '']) AS display_name
      FROM (SELECT DISTINCT street_key FROM sales WHERE street_key IS NOT NULL))
    SELECT f.display_name, o.*, coalesce(nullif(f.display_name, ''), nullif(o.street_name, ''), street_key) AS name,
      'street' AS map_level, 'transactions' AS selected_metric, o.transactions AS metric_value, {YEAR} AS metric_year
    FROM features f JOIN one o USING (street_key)"""
)
def street_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    streets = sales_ops.sales_by_street(sale_rows(spark, sf_dir)).persist()
    return ops.map_streets(street_features(spark, sf_dir), streets, "transactions", YEAR)


@register(
    f"""WITH {SALES_SQL}, building_yearly AS ({BUILDING_SQL})
    SELECT * , coalesce(nullif(building_label, ''), building_id) AS name,
      {{'type': 'Point', 'coordinates': [longitude, latitude]}} AS geometry, 'building' AS map_level,
      'median_surface_m2' AS selected_metric, median_surface_m2 AS metric_value, {YEAR} AS metric_year
    FROM building_yearly WHERE year = {YEAR} AND longitude IS NOT NULL AND latitude IS NOT NULL"""
)
def building_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the asked year is aggregated: the year is a grouping key, so the filter moves below.
    buildings = sales_ops.sales_by_building(sale_rows(spark, sf_dir).where(c("year") == YEAR))
    return ops.map_buildings(buildings, "median_surface_m2", YEAR)


@register(f"WITH {SALES_SQL} SELECT max(year) AS year, count(*) AS rows FROM sales WHERE year = (SELECT max(year) FROM sales)")
def latest_sales_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ops.of_year(sale_rows(spark, sf_dir))
    return rows.agg(F.max("year").alias("year"), F.count(F.lit(1)).alias("rows"))


def _list_sql(items) -> str:
    return "[" + ", ".join(items) + "]"


METRICS_SQL = _list_sql(
    f"{{'key': '{key}', 'label': '{label.replace(chr(39), chr(39) * 2)}', 'unit': '{unit.replace(chr(39), chr(39) * 2)}', 'supports_year': {str(by_year).lower()}}}"
    for key, (label, unit, by_year) in sorted(METRIC_CATALOG.items())
)
LEVELS_SQL = _list_sql(
    f"{{'key': '{key}', 'label': '{label.replace(chr(39), chr(39) * 2)}', 'supported_metrics': {_list_sql(f"'{metric}'" for metric in LEVEL_METRICS[key])}}}"
    for key, label in LEVEL_LABELS.items()
)


@register(
    f"""WITH {SALES_SQL}, {facts.COVERAGE_SQL}, {ORDERED_SQL}, {RENTS_SQL}, {SOCIAL_SQL},
    covered AS (SELECT {', '.join(COUNTS)}, {facts.RATES_SQL} FROM counts)
    SELECT {', '.join(
        f"(SELECT CAST(max(year) AS INTEGER) FROM {rows}) AS latest_{name}_year,"
        f" (SELECT list_sort(list(DISTINCT CAST(year AS INTEGER))) FROM {rows} WHERE year IS NOT NULL) AS available_{name}_years"
        for name, rows in (('sales', 'sales'), ('social', 'social_rows'), ('rent', 'rent_rows'))
    )},
      covered AS spatial_sales_coverage, {METRICS_SQL} AS metrics, {LEVELS_SQL} AS map_levels FROM covered"""
)
def dashboard_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All but the time it was made; the catalogue as a list in order of its keys."""
    rows = sale_rows(spark, sf_dir)
    document = ops.metadata(
        rows.select("year"),
        facts.social_rows(spark, sf_dir).select("year"),
        facts.rent_rows(spark, sf_dir).select("year"),
        coverage(rows),
    )
    entry = lambda e: F.struct(e.key.alias("key"), e.value.label.alias("label"), e.value.unit.alias("unit"), e.value.supports_year.alias("supports_year"))
    listed = F.sort_array(F.transform(F.map_entries("metrics"), entry))
    return document.drop("generated_at").withColumn("metrics", listed)
