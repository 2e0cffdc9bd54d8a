"""Sale rows out of lineitem, and the sales aggregate at every grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import keys as k
from citygrain.functions.numbers import price_per_m2, round_even
from citygrain.operators import sales as ops
from citygrain.operators.medians import with_medians
from citygrain.operators.sales import QualityRules, clean_sales, sales_metrics
from workloads.registry import register, round_sql, table


def sale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as sales: districts are nations, quartiers suppliers, streets brands, parcels parts."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type")
    c = F.col
    district = c("s_nationkey") + 1
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey, "left")
        .join(parts, lines.l_partkey == parts.p_partkey, "left")
        .select(
            c("l_orderkey").cast("string").alias("transaction_id"),
            price_per_m2(c("l_extendedprice"), c("l_quantity")).alias("price_per_m2"),
            c("l_extendedprice").alias("sale_value_eur"),
            c("l_quantity").alias("built_surface_m2"),
            c("l_linenumber").cast("double").alias("rooms"),
            F.when(c("l_returnflag") == "A", "Appartement")
            .when(c("l_returnflag") == "N", "Maison")
            .otherwise("Local")
            .alias("Type local"),
            F.when(c("l_linestatus") == "F", "Vente").otherwise("Echange").alias("Nature mutation"),
            district.alias("arrondissement"),
            F.year("l_shipdate").alias("year"),
            F.when(c("l_linenumber") < 6, c("l_suppkey").cast("string")).alias("quartier_id"),
            F.when(c("l_linenumber") < 6, c("s_name")).alias("quartier_name"),
            F.when(c("l_linenumber") < 5, F.concat(c("l_suppkey").cast("string"), c("p_brand"))).alias("iris_code"),
            F.when(c("l_linenumber") < 5, c("p_brand")).alias("iris_name"),
            F.when(c("l_linenumber") < 5, c("p_type")).alias("iris_type"),
            k.district_postal(100 + district).alias("commune_insee"),
            F.when(c("l_linenumber") < 7, c("p_brand")).otherwise("").alias("street_name"),
            c("p_size").cast("string").alias("house_number"),
            F.when(c("l_linestatus") == "F", "BIS").otherwise("").alias("house_suffix"),
            F.when(c("l_linenumber") < 7, c("l_quantity")).alias("longitude"),
            F.when(c("l_linenumber") < 7, c("l_discount") * 100 + c("l_tax") * 100).alias("latitude"),
            F.when(c("l_linenumber") < 4, c("l_suppkey").cast("string")).otherwise("").alias("matched_cle_interop"),
            F.when(c("l_linenumber") != 5, c("l_partkey").cast("string")).alias("parcel_id"),
            F.when(c("l_linenumber") < 4, "adresses-ban")
            .when(c("l_linenumber") == 4, "ban-plus")
            .alias("geocode_source"),
        )
        .withColumn(
            "address_key",
            k.address_key(c("commune_insee"), c("house_number"), c("house_suffix"), c("street_name")),
        )
        .withColumn("street_key", k.street_key(c("commune_insee"), c("street_name")))
        .withColumn("building_id", k.building_id(c("matched_cle_interop"), c("parcel_id"), c("address_key")))
        .withColumn(
            "building_id_source",
            k.building_id_source(c("matched_cle_interop"), c("parcel_id"), c("address_key")),
        )
        .withColumn(
            "building_label",
            k.building_label(c("house_number"), c("house_suffix"), c("street_name"), c("building_id")),
        )
    )


SALES_SQL = """
sale_parts AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
    CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END AS price_per_m2,
    l_extendedprice AS sale_value_eur, l_quantity AS built_surface_m2,
    CAST(l_linenumber AS DOUBLE) AS rooms,
    CASE l_returnflag WHEN 'A' THEN 'Appartement' WHEN 'N' THEN 'Maison' ELSE 'Local' END AS "Type local",
    CASE WHEN l_linestatus = 'F' THEN 'Vente' ELSE 'Echange' END AS "Nature mutation",
    s_nationkey + 1 AS arrondissement, CAST(year(l_shipdate) AS INTEGER) AS year,
    CASE WHEN l_linenumber < 6 THEN CAST(l_suppkey AS VARCHAR) END AS quartier_id,
    CASE WHEN l_linenumber < 6 THEN s_name END AS quartier_name,
    CASE WHEN l_linenumber < 5 THEN CAST(l_suppkey AS VARCHAR) || p_brand END AS iris_code,
    CASE WHEN l_linenumber < 5 THEN p_brand END AS iris_name,
    CASE WHEN l_linenumber < 5 THEN p_type END AS iris_type,
    '75' || lpad(CAST(101 + s_nationkey AS VARCHAR), 3, '0') AS commune_insee,
    CASE WHEN l_linenumber < 7 THEN p_brand ELSE '' END AS street_name,
    CAST(p_size AS VARCHAR) AS house_number,
    CASE WHEN l_linestatus = 'F' THEN 'BIS' ELSE '' END AS house_suffix,
    CASE WHEN l_linenumber < 7 THEN l_quantity END AS longitude,
    CASE WHEN l_linenumber < 7 THEN l_discount * 100 + l_tax * 100 END AS latitude,
    CASE WHEN l_linenumber < 4 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS matched_cle_interop,
    CASE WHEN l_linenumber <> 5 THEN CAST(l_partkey AS VARCHAR) END AS parcel_id,
    CASE WHEN l_linenumber < 4 THEN 'adresses-ban' WHEN l_linenumber = 4 THEN 'ban-plus' END AS geocode_source
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey
),
sale_keys AS (
  SELECT *,
    coalesce(commune_insee, '') || '|' || coalesce(house_number, '') || '|' || house_suffix || '|' || street_name
      AS address_key,
    CASE WHEN street_name <> '' THEN coalesce(commune_insee, '') || '|' || street_name END AS street_key
  FROM sale_parts
),
sale_buildings AS (
  SELECT *,
    coalesce(nullif(matched_cle_interop, ''), nullif(parcel_id, ''), nullif(address_key, '')) AS building_id,
    CASE WHEN matched_cle_interop <> '' THEN 'ban_address' WHEN parcel_id <> '' THEN 'parcel'
      WHEN address_key <> '' THEN 'address_key' END AS building_id_source
  FROM sale_keys
),
sales AS (
  SELECT *,
    coalesce(nullif(trim(regexp_replace(
      coalesce(house_number, '') || ' ' || house_suffix || ' ' || street_name, '\\s+', ' ', 'g')), ''),
      building_id) AS building_label
  FROM sale_buildings
)
"""


def median_sql(column: str) -> str:
    """Mean of the two middle values, spelled out so that the last bit agrees."""
    return f"(quantile_disc({column}, 0.5) + (-quantile_disc(-{column}, 0.5))) / 2"


METRICS_SQL = f"""
    count(DISTINCT transaction_id) AS transactions,
    {round_sql(median_sql('price_per_m2'), 2)} AS median_price_m2,
    {round_sql(median_sql('sale_value_eur'), 2)} AS median_sale_value_eur,
    {round_sql(median_sql('built_surface_m2'), 2)} AS median_surface_m2,
    {round_sql(median_sql('rooms'), 2)} AS median_rooms,
    {round_sql("avg(CASE WHEN \"Type local\" = 'Appartement' THEN 1.0::DOUBLE ELSE 0.0 END) * 100.0::DOUBLE", 1)} AS apartment_share_pct,
    {round_sql("avg(CASE WHEN \"Type local\" = 'Maison' THEN 1.0::DOUBLE ELSE 0.0 END) * 100.0::DOUBLE", 1)} AS house_share_pct
"""


def grain_sql(keys: tuple[str, ...], extra: str = "", source: str = "sales") -> str:
    names = ", ".join(keys)
    present = " AND ".join(f"{key} IS NOT NULL" for key in keys)
    return f"SELECT {names}, {extra} {METRICS_SQL} FROM {source} WHERE {present} GROUP BY {names}"


POSITION_SQL = f"""
    count(DISTINCT CASE WHEN longitude IS NOT NULL THEN transaction_id END) AS geocoded_transactions,
    {median_sql('longitude')} AS longitude, {median_sql('latitude')} AS latitude,
"""
STREET_SQL = grain_sql(ops.STREET_KEYS, "count(DISTINCT building_id) AS buildings," + POSITION_SQL)
BUILDING_SQL = grain_sql(ops.BUILDING_KEYS, "count(DISTINCT parcel_id) AS parcel_count," + POSITION_SQL)


@register(f"WITH {SALES_SQL} {grain_sql(ops.DISTRICT_KEYS)}")
def sales_by_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_by_district(sale_rows(spark, sf_dir))


@register(f"WITH {SALES_SQL} {grain_sql(ops.QUARTIER_KEYS)}")
def sales_by_quartier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_by_quartier(sale_rows(spark, sf_dir))


@register(f"WITH {SALES_SQL} {grain_sql(ops.IRIS_KEYS)}")
def sales_by_iris(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_by_iris(sale_rows(spark, sf_dir))


@register(f"WITH {SALES_SQL} {STREET_SQL}")
def sales_by_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_by_street(sale_rows(spark, sf_dir))


@register(f"WITH {SALES_SQL} {BUILDING_SQL}")
def sales_by_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.sales_by_building(sale_rows(spark, sf_dir))


@register(f"WITH {SALES_SQL} {grain_sql(('quartier_id', 'year'))}")
def sales_metrics_any_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_metrics(sale_rows(spark, sf_dir), ["quartier_id", "year"])


@register(f"WITH {SALES_SQL} {grain_sql(('arrondissement',))}")
def sales_metrics_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same aggregate with every larger group sent through the distributed rank search."""
    return sales_metrics(sale_rows(spark, sf_dir), ["arrondissement"], hot_rows=1_000)


RULES = QualityRules(districts=(1, 20), min_surface=10.0, min_value=10_000.0, price_range=(500.0, 20_000.0))


@register(
    f"""WITH {SALES_SQL}
    SELECT transaction_id, arrondissement, "Type local" AS kind, built_surface_m2, sale_value_eur, price_per_m2
    FROM sales WHERE "Nature mutation" = 'Vente' AND arrondissement BETWEEN 1 AND 20
      AND "Type local" IN ('Appartement', 'Maison') AND built_surface_m2 > 10 AND sale_value_eur > 10000
      AND price_per_m2 BETWEEN 500 AND 20000"""
)
def clean_sale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sales(sale_rows(spark, sf_dir).drop("price_per_m2"), RULES).select(
        "transaction_id",
        "arrondissement",
        F.col("Type local").alias("kind"),
        "built_surface_m2",
        "sale_value_eur",
        "price_per_m2",
    )


@register(
    f"""WITH {SALES_SQL}
    SELECT transaction_id, year, sale_value_eur FROM sales WHERE year < 1998
    UNION ALL SELECT transaction_id, year, sale_value_eur FROM sales WHERE year >= 1998"""
)
def union_yearly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sale_rows(spark, sf_dir).select("transaction_id", "year", "sale_value_eur")
    return ops.union_sales(sales.where("year < 1998"), sales.where("year >= 1998"))


EXTREME_SQL = """CASE l_orderkey % 50 WHEN 0 THEN 'Infinity'::DOUBLE WHEN 1 THEN '-Infinity'::DOUBLE
    WHEN 2 THEN 1.7e308::DOUBLE WHEN 3 THEN -1.7e308::DOUBLE WHEN 4 THEN NULL ELSE l_extendedprice END"""
#: Above the size at which hot groups are told from a sample, below that of the largest group.
SAMPLED_HOT_ROWS = 12_000


@register(f"SELECT l_returnflag, {round_sql(f'median({EXTREME_SQL})', 4)} AS middle FROM lineitem GROUP BY l_returnflag")
def medians_of_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot groups, found by sampling, whose values take the whole range of a double and both infinities."""
    key = F.col("l_orderkey") % 50
    value = (
        F.when(key == 0, F.lit(float("inf")))
        .when(key == 1, F.lit(float("-inf")))
        .when(key == 2, F.lit(1.7e308))
        .when(key == 3, F.lit(-1.7e308))
        .when(key != 4, F.col("l_extendedprice"))
    )
    found = with_medians(table(spark, sf_dir, "lineitem"), ["l_returnflag"], {"middle": value}, hot_rows=SAMPLED_HOT_ROWS)
    return found.select("l_returnflag", round_even(F.col("middle"), 4).alias("middle"))
