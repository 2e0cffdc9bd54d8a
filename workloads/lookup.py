"""Lookups and the geocoding cascade, over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.operators import lookup as ops
from workloads.registry import register, table
from workloads.sales import median_sql

c = F.col


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an address reference: customers are buildings, priorities suffixes."""
    customer = c("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.when(c("o_orderkey") % 10 != 0, c("o_orderkey").cast("string")).alias("cle_interop"),
        F.concat(customer, F.lit("|"), c("o_orderpriority")).alias("address_key"),
        customer.alias("address_key_no_suffix"),
        F.floor(c("o_totalprice") / 100000).cast("double").alias("certification_commune"),
        c("o_totalprice").alias("long"),
        (c("o_totalprice") / 2).alias("lat"),
    )


ADDRESSES_SQL = """
addresses AS (
  SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS cle_interop,
    CAST(o_custkey AS VARCHAR) || '|' || o_orderpriority AS address_key,
    CAST(o_custkey AS VARCHAR) AS address_key_no_suffix,
    CAST(floor(o_totalprice / 100000) AS DOUBLE) AS certification_commune,
    o_totalprice AS long, o_totalprice / 2 AS lat
  FROM orders
)
"""


def deduped_sql(key: str) -> str:
    return f"""
      SELECT {key} AS lookup_key,
        first(cle_interop ORDER BY certification_commune DESC, cle_interop) FILTER (cle_interop IS NOT NULL) AS cle_interop,
        {median_sql('long')} AS long, {median_sql('lat')} AS lat
      FROM addresses WHERE {key} IS NOT NULL GROUP BY {key}"""


@register(f"WITH {ADDRESSES_SQL} {deduped_sql('address_key')}")
def address_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.dedupe_reference(addresses(spark, sf_dir), "address_key")


@register(f"WITH {ADDRESSES_SQL} {deduped_sql('address_key_no_suffix')}")
def address_reference_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the larger keys sent through the distributed rank search."""
    return ops.dedupe_reference(addresses(spark, sf_dir), "address_key_no_suffix", hot_rows=20)


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as parcel links: parts are parcels, suppliers addresses."""
    return table(spark, sf_dir, "lineitem").select(
        c("l_partkey").cast("string").alias("idu"),
        F.when(c("l_suppkey") % 9 == 0, "")
        .when(c("l_suppkey") % 9 != 1, c("l_orderkey").cast("string"))
        .alias("id_adr"),
        F.when(c("l_returnflag") == "A", "GEO")
        .when(c("l_returnflag") == "N", "BAN")
        .when(c("l_linenumber") < 4, "X")
        .alias("type_lien"),
        F.when(c("l_linenumber") == 5, "n/a").otherwise(c("l_quantity").cast("int").cast("string")).alias("nb_adr"),
        c("l_linenumber").cast("string").alias("nb_parc"),
    )


LINKS_SQL = """
links AS (
  SELECT CAST(l_partkey AS VARCHAR) AS idu,
    CASE WHEN l_suppkey % 9 = 0 THEN '' WHEN l_suppkey % 9 <> 1 THEN CAST(l_orderkey AS VARCHAR) END AS id_adr,
    CASE WHEN l_returnflag = 'A' THEN 'GEO' WHEN l_returnflag = 'N' THEN 'BAN' WHEN l_linenumber < 4 THEN 'X' END
      AS type_lien,
    CASE WHEN l_linenumber = 5 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS nb_adr,
    CAST(l_linenumber AS VARCHAR) AS nb_parc
  FROM lineitem
),
ranked_links AS (
  SELECT *, CASE type_lien WHEN 'GEO' THEN 0 WHEN 'BAN' THEN 1 ELSE 9 END AS rank,
    coalesce(TRY_CAST(nb_adr AS DOUBLE), 999999) AS addresses
  FROM links WHERE id_adr IS NOT NULL AND id_adr <> ''
),
best AS (
  SELECT idu, first(id_adr ORDER BY rank, addresses, id_adr) AS id_adr,
    first(type_lien ORDER BY rank, addresses, id_adr, type_lien) FILTER (type_lien IS NOT NULL) AS type_lien
  FROM ranked_links GROUP BY idu
)
"""


@register(f"WITH {LINKS_SQL} SELECT * FROM best")
def best_parcel_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.best_link(links(spark, sf_dir))


def sales_to_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with address keys, some of which only match without suffix or only by parcel."""
    customer = F.when(c("l_linenumber") < 6, c("l_orderkey") % 2000).otherwise(-c("l_orderkey")).cast("string")
    priority = F.when(c("l_linenumber") < 3, "1-URGENT").otherwise("none")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.concat(customer, F.lit("|"), priority).alias("address_key"),
        customer.alias("address_key_no_suffix"),
        F.when(c("l_linenumber") < 7, c("l_partkey").cast("string")).alias("parcel_id"),
    )


GEOCODE_SQL = f"""
WITH {ADDRESSES_SQL}, {LINKS_SQL},
with_suffix AS ({deduped_sql('address_key')}),
without_suffix AS ({deduped_sql('address_key_no_suffix')}),
by_id AS ({deduped_sql('cle_interop')}),
rows AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
    CAST(CASE WHEN l_linenumber < 6 THEN l_orderkey % 2000 ELSE -l_orderkey END AS VARCHAR) AS address_key_no_suffix,
    CAST(CASE WHEN l_linenumber < 6 THEN l_orderkey % 2000 ELSE -l_orderkey END AS VARCHAR) || '|'
      || CASE WHEN l_linenumber < 3 THEN '1-URGENT' ELSE 'none' END AS address_key,
    CASE WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS parcel_id
  FROM lineitem
),
first_two AS (
  SELECT r.*,
    CASE WHEN a.long IS NULL THEN b.cle_interop ELSE a.cle_interop END AS id2,
    CASE WHEN a.long IS NULL THEN b.long ELSE a.long END AS lon2,
    CASE WHEN a.long IS NULL THEN b.lat ELSE a.lat END AS lat2,
    CASE WHEN a.cle_interop IS NOT NULL OR (a.long IS NULL AND b.cle_interop IS NOT NULL) THEN 'adresses-ban' END AS src2
  FROM rows r LEFT JOIN with_suffix a ON r.address_key = a.lookup_key
    LEFT JOIN without_suffix b ON r.address_key_no_suffix = b.lookup_key
),
third AS (
  SELECT f.*, l.id_adr, i.long AS lon3, i.lat AS lat3, f.lon2 IS NULL AND f.parcel_id IS NOT NULL AS retry
  FROM first_two f LEFT JOIN best l ON f.parcel_id = l.idu LEFT JOIN by_id i ON l.id_adr = i.lookup_key
)
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, address_key, address_key_no_suffix, parcel_id,
  CASE WHEN retry THEN id_adr ELSE id2 END AS matched_cle_interop,
  CASE WHEN retry THEN lon3 ELSE lon2 END AS longitude,
  CASE WHEN retry THEN lat3 ELSE lat2 END AS latitude,
  CASE WHEN retry AND lon3 IS NOT NULL THEN 'ban-plus' ELSE src2 END AS geocode_source
FROM third
"""


def geocoded(spark: SparkSession, sf_dir: str, by_keys: bool | None) -> DataFrame:
    reference = addresses(spark, sf_dir)
    return ops.geocode(
        sales_to_place(spark, sf_dir),
        ops.dedupe_reference(reference, "address_key"),
        ops.dedupe_reference(reference, "address_key_no_suffix"),
        ops.dedupe_reference(reference, "cle_interop"),
        ops.best_link(links(spark, sf_dir)),
        by_keys,
    )


@register(GEOCODE_SQL)
def geocode_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geocoded(spark, sf_dir, None)


@register(GEOCODE_SQL)
def geocode_cascade_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for references too large to broadcast."""
    return geocoded(spark, sf_dir, True)


@register(
    """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS idu FROM orders
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)"""
)
def unknown_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "orders").select(c("o_orderkey").cast("string").alias("idu"))
    known = table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    return ops.unknown_ids(requested, known.select(c("l_orderkey").cast("string").alias("idu")))


LINK_ROW_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS idu, l_returnflag AS id_adr, l_linestatus AS type_lien,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS nb_adr, CAST(l_linenumber AS VARCHAR) AS nb_parc,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS seq FROM lineitem"""


@register(
    f"""WITH l AS ({LINK_ROW_SQL}),
    cache AS (SELECT *, 0 AS batch FROM l WHERE nb_parc IN ('1', '2', '5')),
    missing AS (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS idu FROM orders
      WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT idu FROM cache)),
    new AS (SELECT *, 1 AS batch FROM l WHERE nb_parc NOT IN ('1', '2', '5') AND idu IN (SELECT idu FROM missing)),
    blank AS (SELECT idu, '' AS id_adr, '' AS type_lien, '' AS nb_adr, '' AS nb_parc, 0 AS seq, 1 AS batch
      FROM missing WHERE idu NOT IN (SELECT idu FROM new)),
    everything AS (SELECT * FROM cache UNION ALL SELECT * FROM new UNION ALL SELECT * FROM blank)
    SELECT idu, id_adr, type_lien, nb_adr, nb_parc FROM everything
    QUALIFY row_number() OVER (PARTITION BY idu, id_adr, type_lien ORDER BY batch DESC, seq DESC) = 1"""
)
def merged_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").cast("string").alias("idu"),
        c("l_returnflag").alias("id_adr"),
        c("l_linestatus").alias("type_lien"),
        c("l_quantity").cast("int").cast("string").alias("nb_adr"),
        c("l_linenumber").cast("string").alias("nb_parc"),
        F.round(c("l_extendedprice") * 100).cast("bigint").alias("seq"),
    )
    requested = table(spark, sf_dir, "orders").select(c("o_orderkey").cast("string").alias("idu"))
    cached = c("nb_parc").isin("1", "2", "5")
    return ops.merge_links(rows.where(cached), rows.where(~cached), requested)


@register(
    """SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1"""
)
def last_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return ops.last_per_key(rows, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber", "l_extendedprice"])


@register(
    """SELECT s_suppkey, s_nationkey AS arrondissement, n_name AS arrondissement_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""
)
def district_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select(c("n_nationkey").alias("arrondissement"), c("n_name").alias("name"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", c("s_nationkey").alias("arrondissement"))
    return ops.with_district_name(rows, names)
