"""Context facts, coverage, summary and indicators, over customer, orders, supplier and nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.operators import compare, context, numbering, spatial
from citygrain.operators import sales as sales_ops
from citygrain.operators import summary as ops
from citygrain.operators.coverage import COUNTS, RATES, coverage
from workloads.registry import register, round_sql, table
from workloads.sales import SALES_SQL, grain_sql, median_sql, sale_rows
from workloads.spatial import CELLS_SQL, nation_zones, prepared

c = F.col


def income_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as census blocks; one nation in eight has no quartiles at all."""
    balance, nation = c("c_acctbal"), c("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        c("c_custkey").cast("string").alias("iris_code"),
        (nation + 1).alias("arrondissement"),
        F.when(c("c_custkey") % 11 != 0, balance + 20000).alias("median_income_eur"),
        F.when(nation % 8 != 3, F.abs(balance) / 100).alias("poverty_rate_pct"),
        F.when(nation % 8 != 3, balance + 10000).alias("first_quartile_income_eur"),
        F.when(nation % 8 != 3, balance + 30000).alias("third_quartile_income_eur"),
        (F.abs(balance) / 150).alias("share_taxable_pct"),
    )


INCOME_SQL = f"""
income_rows AS (
  SELECT CAST(c_custkey AS VARCHAR) AS iris_code, c_nationkey + 1 AS arrondissement,
    CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal + 20000 END AS median_income_eur,
    CASE WHEN c_nationkey % 8 <> 3 THEN abs(c_acctbal) / 100 END AS poverty_rate_pct,
    CASE WHEN c_nationkey % 8 <> 3 THEN c_acctbal + 10000 END AS first_quartile_income_eur,
    CASE WHEN c_nationkey % 8 <> 3 THEN c_acctbal + 30000 END AS third_quartile_income_eur,
    abs(c_acctbal) / 150 AS share_taxable_pct
  FROM customer
),
income AS (
  SELECT arrondissement, count(iris_code) AS iris_count,
    {round_sql(median_sql('median_income_eur'), 2)} AS median_income_eur,
    {round_sql('avg(poverty_rate_pct)', 2)} AS poverty_rate_pct,
    {round_sql(median_sql('first_quartile_income_eur'), 2)} AS first_quartile_income_eur,
    {round_sql(median_sql('third_quartile_income_eur'), 2)} AS third_quartile_income_eur,
    {round_sql('avg(share_taxable_pct)', 2)} AS share_taxable_pct
  FROM income_rows WHERE arrondissement IS NOT NULL GROUP BY arrondissement
)
"""


@register(f"WITH {INCOME_SQL} SELECT * FROM income")
def income_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.income_metrics(income_rows(spark, sf_dir))


def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return table(spark, sf_dir, "orders").join(customers, c("o_custkey") == c("c_custkey"), "left")


def rent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as rent references; nations 20 and up have none."""
    price = F.when(c("o_orderstatus") != "P", c("o_totalprice") / 10000)
    return ordered(spark, sf_dir).select(
        F.when(c("c_nationkey") < 20, c("c_nationkey") + 1).alias("arrondissement"),
        F.year("o_orderdate").alias("year"),
        price.alias("reference_rent_eur_m2"),
        (price * 1.25).alias("reference_rent_majorated_eur_m2"),
        (price * 0.75).alias("reference_rent_minorated_eur_m2"),
    )


ORDERED_SQL = "ordered AS (SELECT * FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"
RENTS_SQL = f"""
rent_rows AS (
  SELECT CASE WHEN c_nationkey < 20 THEN c_nationkey + 1 END AS arrondissement,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 10000 END AS price
  FROM ordered
),
rents AS (
  SELECT arrondissement, year, {round_sql('avg(price)', 2)} AS reference_rent_eur_m2,
    {round_sql('avg(price * 1.25::DOUBLE)', 2)} AS reference_rent_majorated_eur_m2,
    {round_sql('avg(price * 0.75::DOUBLE)', 2)} AS reference_rent_minorated_eur_m2,
    count(price) AS rent_reference_count
  FROM rent_rows WHERE arrondissement IS NOT NULL AND year IS NOT NULL GROUP BY arrondissement, year
)
"""


@register(f"WITH {ORDERED_SQL}, {RENTS_SQL} SELECT * FROM rents")
def rents_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.rent_metrics(rent_rows(spark, sf_dir))


def social_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as social housing programmes; nations 22 and up have none."""
    units = F.floor(c("o_totalprice") / 10000).cast("double")
    return ordered(spark, sf_dir).select(
        F.when(c("c_nationkey") < 22, c("c_nationkey") + 1).alias("arrondissement"),
        F.year("o_orderdate").alias("year"),
        F.when(c("o_custkey") % 5 != 0, c("o_custkey").cast("string")).alias("program_id"),
        units.alias("social_units_financed"),
        F.when(c("o_orderstatus") == "F", units).alias("pla_i_units"),
        F.when(c("o_orderstatus") == "O", units).alias("plus_units"),
        F.lit(None).cast("double").alias("pls_units"),
    )


SOCIAL_SQL = """
social_rows AS (
  SELECT CASE WHEN c_nationkey < 22 THEN c_nationkey + 1 END AS arrondissement,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS program_id,
    CAST(floor(o_totalprice / 10000) AS DOUBLE) AS units, o_orderstatus
  FROM ordered
),
social AS (
  SELECT arrondissement, year, count(DISTINCT program_id) AS program_count,
    coalesce(sum(units), 0.0::DOUBLE) AS social_units_financed,
    coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN units END), 0.0::DOUBLE) AS pla_i_units,
    coalesce(sum(CASE WHEN o_orderstatus = 'O' THEN units END), 0.0::DOUBLE) AS plus_units,
    0.0::DOUBLE AS pls_units
  FROM social_rows WHERE arrondissement IS NOT NULL AND year IS NOT NULL GROUP BY arrondissement, year
),
social_5y AS (
  SELECT arrondissement, coalesce(sum(social_units_financed), 0.0::DOUBLE) AS social_units_financed_5y
  FROM social WHERE year >= (SELECT max(year) FROM social) - 4 GROUP BY arrondissement
)
"""


@register(f"WITH {ORDERED_SQL}, {SOCIAL_SQL} SELECT * FROM social")
def social_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.social_metrics(social_rows(spark, sf_dir))


@register(f"WITH {ORDERED_SQL}, {SOCIAL_SQL} SELECT * FROM social_5y")
def social_last_five_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    social = context.social_metrics(social_rows(spark, sf_dir))
    return context.sum_last_years(social, 5, "social_units_financed", "social_units_financed_5y")


ENVIRONMENT_SQL = f"""
environment AS (
  SELECT n_nationkey AS zone,
    {round_sql('coalesce(sum((category % 10) * area), 0) / coalesce(nullif(sum(area), 0), 1)', 3)} AS noise_score,
    {round_sql('coalesce(sum((category // 10) * area), 0) / coalesce(nullif(sum(area), 0), 1)', 3)} AS air_score,
    {round_sql('coalesce(sum(CASE WHEN category % 10 = 3 THEN area END), 0) / coalesce(nullif(sum(area), 0), 1) * 100', 2)}
      AS high_noise_share_pct,
    count(area) AS noise_cell_count
  FROM nation LEFT JOIN assigned ON zone = n_nationkey AND zone % 6 <> 5 GROUP BY n_nationkey
)
"""


def environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noise and air per nation; one nation in six is left without cells."""
    zones = nation_zones(spark, sf_dir)
    assigned = spatial.assign_cells(prepared(spark, sf_dir), zones, "zone").where("zone % 6 <> 5")
    return context.environment_metrics(assigned, zones, "zone")


@register(f"WITH {CELLS_SQL}, {ENVIRONMENT_SQL} SELECT * FROM environment")
def environment_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return environment(spark, sf_dir)


@register(
    """SELECT DISTINCT c_nationkey AS arrondissement, 2.0::DOUBLE AS noise_score, 2.0::DOUBLE AS air_score,
      50.0::DOUBLE AS high_noise_share_pct, 0 AS noise_cell_count FROM customer"""
)
def neutral_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = table(spark, sf_dir, "customer").select(c("c_nationkey").alias("arrondissement"))
    return context.neutral_environment(zones)


@register(
    """SELECT 'ship' AS fact, max(CAST(year(l_shipdate) AS INTEGER)) AS latest_year,
      list_sort(list(DISTINCT CAST(year(l_shipdate) AS INTEGER))) AS years FROM lineitem
    UNION ALL SELECT 'order', max(CAST(year(o_orderdate) AS INTEGER)),
      list_sort(list(DISTINCT CAST(year(o_orderdate) AS INTEGER))) FROM orders"""
)
def available_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.available_years(
        {
            "ship": table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year")),
            "order": table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")),
        }
    )


STREETS_SQL = f"SELECT DISTINCT {', '.join(sales_ops.STREET_KEYS)} FROM sales WHERE " + " AND ".join(
    f"{key} IS NOT NULL" for key in sales_ops.STREET_KEYS
)
BUILDINGS_SQL = f"SELECT DISTINCT {', '.join(sales_ops.BUILDING_KEYS)} FROM sales WHERE " + " AND ".join(
    f"{key} IS NOT NULL" for key in sales_ops.BUILDING_KEYS
)
COVERAGE_SQL = f"""
streets AS ({STREETS_SQL}), buildings AS ({BUILDINGS_SQL}),
counts AS (
  SELECT count(*) AS input_rows, count(DISTINCT transaction_id) AS input_transactions,
    count(*) FILTER (geocode_source = 'adresses-ban') AS adresses_ban_rows,
    count(*) FILTER (geocode_source = 'ban-plus') AS ban_plus_rows,
    count(longitude) AS geocoded_rows, count(quartier_id) AS quartier_rows, count(iris_code) AS iris_rows,
    count(street_key) AS street_rows, count(building_id) AS building_rows,
    (SELECT count(DISTINCT street_key) FROM streets) AS street_count, (SELECT count(*) FROM streets) AS street_year_rows,
    (SELECT count(DISTINCT building_id) FROM buildings) AS building_count,
    (SELECT count(*) FROM buildings) AS building_year_rows
  FROM sales
)
"""
RATES_SQL = ", ".join(
    f"{round_sql(f'{name}_rows / greatest(input_rows, 1) * 100.0::DOUBLE', 2)} AS {name}_rate_pct" for name in RATES
)


@register(f"WITH {SALES_SQL}, {COVERAGE_SQL} SELECT {', '.join(COUNTS)}, {RATES_SQL} FROM counts")
def geocoding_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(sale_rows(spark, sf_dir))


@register(
    f"""WITH m AS (SELECT {median_sql('c_acctbal')} AS m FROM customer WHERE c_custkey % 3 <> 0)
    SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal ELSE m END AS balance, 7.5::DOUBLE AS nothing
    FROM customer, m"""
)
def filled_with_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(c("c_custkey") % 3 != 0, c("c_acctbal")).alias("balance"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return ops.fill_median(rows, ["balance", "nothing"], {"nothing": 7.5}, hot_rows=500)


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        (c("n_nationkey") + 1).alias("arrondissement"), c("n_name").alias("name"), c("n_regionkey").alias("region")
    )


def summary(spark: SparkSession, sf_dir: str, sales: DataFrame | None = None) -> DataFrame:
    return ops.build_summary(
        districts(spark, sf_dir),
        sales_ops.sales_by_district(sale_rows(spark, sf_dir)) if sales is None else sales,
        context.income_metrics(income_rows(spark, sf_dir)),
        context.rent_metrics(rent_rows(spark, sf_dir)),
        context.social_metrics(social_rows(spark, sf_dir)),
        environment(spark, sf_dir).withColumnRenamed("zone", "arrondissement").withColumn(
            "arrondissement", c("arrondissement") + 1
        ).where("arrondissement % 7 <> 0"),
    )


MEDIAN_FILL_SQL = ", ".join(
    f"coalesce({name}, (SELECT {median_sql(name)} FROM joined)) AS {name}" for name in ops.FILL_WITH_MEDIAN
)
NEUTRAL_FILL_SQL = ", ".join(
    f"coalesce({name}, (SELECT {median_sql(name)} FROM joined), {value}::DOUBLE) AS {name}"
    for name, value in context.NEUTRAL_ENVIRONMENT.items()
)
CLASS = "(({0} - 1.0::DOUBLE) / 2.0::DOUBLE)"
NOISE_CLASS, AIR_CLASS = CLASS.format("noise_score"), CLASS.format("air_score")


def unit_sql(expression: str) -> str:
    return f"least(greatest({expression}, 0.0::DOUBLE), 1.0::DOUBLE)"


PRESSURE_SQL = round_sql(
    f"least(greatest({NOISE_CLASS} * 60.0::DOUBLE + {AIR_CLASS} * 40.0::DOUBLE, 0.0::DOUBLE), 100.0::DOUBLE)", 1
)
QUALITY_SQL = round_sql(
    f"10.0::DOUBLE * (0.30::DOUBLE * {unit_sql('1.0::DOUBLE - ' + NOISE_CLASS)}"
    f" + 0.30::DOUBLE * {unit_sql('1.0::DOUBLE - ' + AIR_CLASS)}"
    f" + 0.25::DOUBLE * {unit_sql('1.0::DOUBLE - high_noise_share_pct / 100.0::DOUBLE')}"
    f" + 0.15::DOUBLE * {unit_sql('1.0::DOUBLE - environmental_pressure_index / 100.0::DOUBLE')})",
    2,
)
INDICATORS_SQL = f"""
with_indicators AS (
  SELECT *,
    {round_sql('median_price_m2 / (median_income_eur / 12.0::DOUBLE)', 2)} AS months_income_for_1sqm,
    {round_sql('reference_rent_majorated_eur_m2 * 50 / (median_income_eur / 12.0::DOUBLE) * 100.0::DOUBLE', 1)}
      AS estimated_50m2_rent_effort_pct,
    {round_sql('coalesce(social_units_financed / nullif(transactions, 0) * 100.0::DOUBLE, 0)', 1)}
      AS social_units_per_100_sales,
    {PRESSURE_SQL} AS environmental_pressure_index
  FROM filled
),
scored AS (SELECT *, {QUALITY_SQL} AS quality_of_life_score FROM with_indicators)
"""
SUMMARY_SQL = f"""
{SALES_SQL}, sales_yearly AS ({grain_sql(sales_ops.DISTRICT_KEYS)}),
{INCOME_SQL}, {ORDERED_SQL}, {RENTS_SQL}, {SOCIAL_SQL}, {CELLS_SQL}, {ENVIRONMENT_SQL},
joined AS (
  SELECT n_nationkey + 1 AS arrondissement, n_name AS name, n_regionkey AS region,
    s.* EXCLUDE (arrondissement), i.* EXCLUDE (arrondissement),
    r.* EXCLUDE (arrondissement, year), r.year AS year_rent, o.* EXCLUDE (arrondissement, year), o.year AS year_social,
    f.social_units_financed_5y, e.* EXCLUDE (zone)
  FROM nation
  LEFT JOIN (SELECT * FROM sales_yearly WHERE year = (SELECT max(year) FROM sales_yearly)) s ON s.arrondissement = n_nationkey + 1
  LEFT JOIN income i ON i.arrondissement = n_nationkey + 1
  LEFT JOIN (SELECT * FROM rents WHERE year = (SELECT max(year) FROM rents)) r ON r.arrondissement = n_nationkey + 1
  LEFT JOIN (SELECT * FROM social WHERE year = (SELECT max(year) FROM social)) o ON o.arrondissement = n_nationkey + 1
  LEFT JOIN social_5y f ON f.arrondissement = n_nationkey + 1
  LEFT JOIN environment e ON e.zone = n_nationkey AND (n_nationkey + 1) % 7 <> 0
),
filled AS (
  SELECT * REPLACE (
    coalesce(social_units_financed, 0) AS social_units_financed,
    coalesce(social_units_financed_5y, 0) AS social_units_financed_5y, coalesce(program_count, 0) AS program_count,
    {MEDIAN_FILL_SQL}, {NEUTRAL_FILL_SQL})
  FROM joined
),
{INDICATORS_SQL},
summary AS (
  SELECT *, (SELECT max(year) FROM sales_yearly) AS sales_year, (SELECT max(year) FROM rents) AS rent_year,
    (SELECT max(year) FROM social) AS social_year FROM scored
)
"""


@register(f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def district_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(spark, sf_dir)


CITY_COLUMNS_SQL = ", ".join(
    [
        "count(DISTINCT arrondissement) AS arrondissement_count",
        *[f"CAST(sum({name}) AS BIGINT) AS {name}" for name in ops.CITY_SUMS],
        *[f"{round_sql(median_sql(name), digits)} AS {name}" for name, digits in ops.CITY_MEDIANS.items()],
    ]
)


@register(f"WITH {SUMMARY_SQL} SELECT {CITY_COLUMNS_SQL} FROM summary")
def city_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.city_summary(summary(spark, sf_dir))


@register(
    f"""WITH filled AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS median_price_m2,
      l_extendedprice AS median_income_eur, l_quantity AS reference_rent_majorated_eur_m2,
      l_quantity AS social_units_financed, l_linenumber - 1 AS transactions, l_discount * 40 AS noise_score,
      l_tax * 50 AS air_score, l_quantity * 3 AS high_noise_share_pct FROM lineitem),
    {INDICATORS_SQL} SELECT * FROM scored"""
)
def indicators_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (c("l_extendedprice") / c("l_quantity")).alias("median_price_m2"),
        c("l_extendedprice").alias("median_income_eur"),
        c("l_quantity").alias("reference_rent_majorated_eur_m2"),
        c("l_quantity").alias("social_units_financed"),
        (c("l_linenumber") - 1).alias("transactions"),
        (c("l_discount") * 40).alias("noise_score"),
        (c("l_tax") * 50).alias("air_score"),
        (c("l_quantity") * 3).alias("high_noise_share_pct"),
    )
    return ops.add_indicators(rows)


def stops_sql(value: str, source: str) -> str:
    ordered = f"list_sort(list({value}))"
    return f"""SELECT CASE WHEN count({value}) = 0 THEN [0.0, 0.0, 0.0]
      WHEN min({value}) = max({value}) THEN [min({value}), min({value}) + 1, min({value}) + 2]
      ELSE [min({value}), {ordered}[CAST(count({value}) // 2 AS INTEGER) + 1], max({value})] END::DOUBLE[] AS stops
      FROM {source}"""


@register(stops_sql("l_extendedprice", "lineitem"))
def color_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.color_stops(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@register(
    """SELECT s_suppkey, s_acctbal, CASE WHEN s_acctbal IS NOT NULL
      THEN rank() OVER (ORDER BY s_acctbal DESC NULLS LAST) END AS rank_by_price
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 10 <> 0 THEN s_acctbal END AS s_acctbal FROM supplier)"""
)
def ranked_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(c("s_suppkey") % 10 != 0, c("s_acctbal")).alias("s_acctbal")
    )
    return numbering.with_rank(zones, "s_acctbal")


@register(
    """WITH a AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey),
    b AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem WHERE l_linenumber < 7 GROUP BY l_partkey)
    SELECT count(*) FILTER (a.l_partkey IS NULL OR b.l_partkey IS NULL OR abs(a.q - b.q) > 1e-6) AS differences,
      count(*) FILTER (a.l_partkey IS NULL OR b.l_partkey IS NULL OR abs(a.q - b.q) > 1e-6) = 0 AS same
    FROM a FULL JOIN b ON a.l_partkey = b.l_partkey"""
)
def frames_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    whole = rows.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    part = rows.where("l_linenumber < 7").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return compare.frames_match(whole, part, ["l_partkey"], ["q"])
