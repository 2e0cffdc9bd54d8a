"""File sources: the tables are written in the layout of each open-data file and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions.numbers import round_even
from citygrain.operators import sales as sales_ops
from citygrain.session import shared_folder
from citygrain.sources import files as ops
from workloads.pipeline import RAW_SALES_SQL, raw_sales
from workloads.registry import register, table

c = F.col


def written(df: DataFrame, name: str, sep: str = ";") -> str:
    folder = f"{shared_folder(df.sparkSession, 'files')}/{name}"
    df.write.csv(folder, header=True, sep=sep, quote='"', escape='"')
    return folder


def french(value: Column) -> Column:
    """The shortest text of the number, with a decimal comma: reading it gives the same number."""
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


@register(
    """SELECT CAST(l_orderkey AS VARCHAR) AS document, CAST(l_partkey AS VARCHAR) AS plan, '75' AS department
    FROM lineitem WHERE l_linenumber % 3 = 0"""
)
def national_sales_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national file holds all departments; only the exact code is kept."""
    rooms = c("Nombre pieces principales").cast("int")
    code = F.when(rooms % 3 == 0, "75").when(rooms % 3 == 1, "92").otherwise("075")
    folder = written(raw_sales(spark, sf_dir).drop("year").withColumn("Code departement", code), "national", "|")
    return ops.read_national_sales(spark, folder).select(
        c("Identifiant de document").alias("document"), c("No plan").alias("plan"), c("Code departement").alias("department")
    )


@register(
    f"""WITH {RAW_SALES_SQL}
    SELECT CAST(2022 + year(l_shipdate) % 3 AS INTEGER) AS year, s_nationkey + 1 AS arrondissement, price AS sale_value_eur,
      parcel_id, commune || '|' || number || '|' || suffix || '|' || street_name AS address_key FROM usable"""
)
def yearly_sales_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three yearly files, landed one by one; the year is read off their names.

    A second file of each year has its columns the other way round.
    """
    raw = raw_sales(spark, sf_dir)
    folder = shared_folder(spark, "dvf")
    swapped = c("No plan").cast("int") % 2 == 0
    for year in (2022, 2023, 2024):
        sales = raw.where(2022 + c("year") % 3 == year).drop("year")
        ops.land_sales(sales.where(~swapped), folder, year)
        other = sales.where(swapped).select(*[c(f"`{name}`") for name in reversed(sales.columns)])
        other.write.csv(f"{folder}/complement-{year}-paris.csv", header=True, quote='"', escape='"')
    sales = sales_ops.sales_from_raw(ops.read_sales(spark, f"{folder}/*.csv"))
    return sales.select("year", "arrondissement", "sale_value_eur", "parcel_id", "address_key")


@register(
    """SELECT CAST(c_custkey AS VARCHAR) AS cle_interop,
      '75' || CAST(100 + c_nationkey AS VARCHAR) || '|' || CASE WHEN c_custkey % 300 = 0 THEN '0000'
        ELSE CAST(c_custkey % 300 AS VARCHAR) END || '|' || CASE WHEN c_custkey % 5 = 0 THEN 'BIS' ELSE '' END
        || '|AVENUE ' || c_mktsegment AS address_key,
      c_acctbal AS long, c_acctbal / 4 AS lat,
      CASE WHEN c_custkey % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS certification_commune
    FROM customer WHERE c_custkey % 7 <> 0"""
)
def address_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = c("c_custkey"), c("c_nationkey")
    raw = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("cle_interop"),
        F.concat(F.lit("75"), (nation + 100).cast("string")).alias("commune_insee"),
        F.concat(F.lit("Av. "), F.lower("c_mktsegment")).alias("voie_nom"),
        F.format_string("%04d", key % 300).alias("numero"),
        F.when(key % 5 == 0, "b").alias("suffixe"),
        F.when(key % 7 != 0, c("c_acctbal").cast("string")).alias("long"),
        (c("c_acctbal") / 4).cast("string").alias("lat"),
        F.when(key % 3 == 0, "1").otherwise("n/a").alias("certification_commune"),
        F.lit("more").alias("unused"),
    )
    return ops.read_addresses(spark, written(raw, "addresses")).select(
        "cle_interop", "address_key", "long", "lat", "certification_commune"
    )


@register(
    """SELECT '751' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || CAST(c_custkey AS VARCHAR) AS iris_code,
      c_nationkey + 1 AS arrondissement, c_acctbal + 20000 AS median_income_eur,
      CASE WHEN c_custkey % 6 <> 0 THEN abs(c_acctbal) / 100 END AS poverty_rate_pct,
      c_acctbal + 10000 AS first_quartile_income_eur,
      c_acctbal + 30000 AS third_quartile_income_eur, NULL::DOUBLE AS share_taxable_pct
    FROM customer WHERE c_custkey % 4 <> 0"""
)
def income_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = c("c_custkey"), c("c_acctbal")
    raw = table(spark, sf_dir, "customer").select(
        F.concat(
            F.when(key % 4 != 0, "751").otherwise("920"),
            F.lpad((c("c_nationkey") + 1).cast("string"), 2, "0"),
            key.cast("string"),
        ).alias("IRIS"),
        french(balance + 20000).alias("DEC_MED21"),
        F.when(key % 6 != 0, french(F.abs(balance) / 100)).otherwise("ns").alias("DEC_TP6021"),
        french(balance + 10000).alias("DEC_Q121"),
        french(balance + 30000).alias("DEC_Q321"),
        F.lit(None).cast("string").alias("DEC_PIMP21"),
    )
    return ops.read_income(spark, written(raw, "income"))


@register(
    """SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
      CAST(o_custkey % 20 + 1 AS INTEGER) AS arrondissement, o_totalprice / 1000 AS reference_rent_eur_m2,
      o_totalprice / 800 AS reference_rent_majorated_eur_m2, NULL::DOUBLE AS reference_rent_minorated_eur_m2
    FROM orders"""
)
def rent_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A code written as a number has lost its leading zero.
    code = F.format_string("51%02d01", c("o_custkey") % 20 + 1)
    raw = table(spark, sf_dir, "orders").select(
        F.when(c("o_orderstatus") != "P", F.year("o_orderdate").cast("string")).otherwise("en cours").alias("Année"),
        french(c("o_totalprice") / 1000).alias("Loyers de référence"),
        french(c("o_totalprice") / 800).alias("Loyers de référence majorés"),
        F.lit("?").alias("Loyers de référence minorés"),
        code.alias("Numéro INSEE du quartier"),
    )
    return ops.read_rents(spark, written(raw, "rents"))


@register(
    """SELECT CAST(o_custkey % 25 + 1 AS INTEGER) AS arrondissement, CAST(year(o_orderdate) AS INTEGER) AS year,
      CAST(o_orderkey AS VARCHAR) AS program_id, floor(o_totalprice / 1000) AS social_units_financed,
      CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice / 2000) END AS pla_i_units, NULL::DOUBLE AS plus_units,
      0.0::DOUBLE AS pls_units
    FROM orders WHERE o_custkey % 25 < 20 AND o_orderstatus <> 'P'"""
)
def social_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, status = c("o_totalprice"), c("o_orderstatus")
    raw = table(spark, sf_dir, "orders").select(
        (c("o_custkey") % 25 + 1).cast("string").alias("Arrondissement"),
        F.when(status != "P", F.year("o_orderdate").cast("string")).alias("Année du financement - agrément"),
        F.floor(price / 1000).cast("string").alias("Nombre total de logements financés"),
        F.when(status == "F", F.floor(price / 2000).cast("string")).alias("Dont nombre de logements PLA I"),
        F.lit("x").alias("Dont nombre de logements PLUS"),
        F.lit("0").alias("Dont nombre de logements PLS"),
        c("o_orderkey").cast("string").alias("Identifiant livraison"),
    )
    return ops.read_social(spark, written(raw, "social"))


def square(x: Column, y: Column, side: float = 1.0) -> Column:
    """One closed ring as coordinate pairs."""
    corners = ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    return F.array(*[F.array(x + dx * side, y + dy * side) for dx, dy in corners])


def geojson(features: DataFrame, properties: list[str], name: str, lines: bool = True) -> str:
    """One feature per line over several part files, or one document, which is for the few nations."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*properties).alias("properties"),
        F.struct("type", "coordinates").alias("geometry"),
    )
    folder = f"{shared_folder(features.sparkSession, 'files')}/{name}"
    if lines:
        features.repartition(4).select(F.to_json(feature).alias("value")).write.text(folder)
        return folder
    document = features.agg(F.collect_list(feature).alias("features")).select(
        F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")
    )
    document.write.text(folder)
    return folder


def outline(parts: Column) -> list[Column]:
    """What the SQL can tell about a geometry as well: parts, vertices and box."""
    box = geo.bounds(parts)
    return [F.size(parts).alias("parts"), F.size(F.flatten(parts)).alias("vertices"), box["minx"].alias("minx"), box["maxy"].alias("maxy")]


@register(
    """SELECT n_nationkey AS feature_index, n_nationkey + 1 AS arrondissement, 75101 + n_nationkey AS insee_code,
      n_name AS name, '75' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS postal_code,
      round_even(n_nationkey * 1.125 * 100, 0) / 100 AS surface_m2, 1 AS parts, 5 AS vertices,
      n_nationkey / 2.0::DOUBLE AS minx, n_regionkey + 1.0::DOUBLE AS maxy FROM nation"""
)
def district_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("n_nationkey")
    features = table(spark, sf_dir, "nation").select(
        (key + 1).alias("c_ar"),
        (key + 75101).alias("c_arinsee"),
        c("n_name").alias("l_aroff"),
        c("n_name").alias("l_ar"),
        (key * 1.125).alias("surface"),
        (key * 1.0).alias("perimetre"),
        F.lit("Polygon").alias("type"),
        F.array(square(key / 2, c("n_regionkey") * 1.0)).alias("coordinates"),
    )
    path = geojson(features, ["c_ar", "c_arinsee", "l_aroff", "l_ar", "surface", "perimetre"], "districts", lines=False)
    return ops.read_districts(spark, path).select(
        "feature_index", "arrondissement", "insee_code", "name", "postal_code", "surface_m2", *outline(c("rings"))
    )


@register(
    """SELECT s_suppkey AS feature_index, CAST(7510000 + s_suppkey AS VARCHAR) AS quartier_id, s_nationkey AS arrondissement,
      s_name AS name, 2 AS parts, 10 AS vertices, s_suppkey / 4.0::DOUBLE AS minx, s_nationkey + 4.0::DOUBLE AS maxy
    FROM supplier"""
)
def quartier_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = c("s_suppkey"), c("s_nationkey")
    features = table(spark, sf_dir, "supplier").select(
        (key + 7510000).alias("c_quinsee"),
        key.alias("c_qu"),
        nation.alias("c_ar"),
        c("s_name").alias("l_qu"),
        F.lit(1.0).alias("surface"),
        F.lit(1.0).alias("perimetre"),
        F.lit("MultiPolygon").alias("type"),
        F.array(F.array(square(key / 4, nation * 1.0)), F.array(square(key / 4, nation + 3.0))).alias("coordinates"),
    )
    path = geojson(features, ["c_quinsee", "c_qu", "c_ar", "l_qu", "surface", "perimetre"], "quartiers")
    return ops.read_quartiers(spark, path, lines=True).select(
        "feature_index", "quartier_id", "arrondissement", "name", *outline(c("rings"))
    )


@register(
    """SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS feature_index,
      '75' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS iris_code, s_name AS iris_name,
      CAST(substr('75' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0'), 4, 2) AS INTEGER) AS arrondissement,
      1 AS parts, 5 AS vertices, s_suppkey * 1.0::DOUBLE AS minx, 3.0::DOUBLE AS maxy
    FROM supplier WHERE s_nationkey <> 7"""
)
def iris_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("s_suppkey")
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(square(key * 1.0, F.lit(2.0))).alias("coordinates")))
    raw = table(spark, sf_dir, "supplier").select(
        F.when(c("s_nationkey") != 7, "75").otherwise("92").alias("DEP"),
        F.format_string("75%07d", key).alias("CODE_IRIS"),
        c("s_name").alias("NOM_IRIS"),
        F.lit("H").alias("TYP_IRIS"),
        F.lit("75101").alias("INSEE_COM"),
        shape.alias("Geo Shape"),
    )
    return ops.read_iris(spark, written(raw, "iris")).select(
        "feature_index", "iris_code", "iris_name", "arrondissement", *outline(c("rings"))
    )


STREET_FILE_SQL = """SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'sq' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS street_ref_id,
      'BOULEVARD DE ' || upper(replace(s_name, '#', ' ')) AS street_name,
      CASE WHEN s_suppkey % 5 = 0 THEN 'long ' || s_name ELSE 'bd de ' || s_name END AS display_name,
      round_even((s_nationkey + 1) * 5.0::DOUBLE * 100, 0) / 100 AS length
    FROM supplier WHERE s_suppkey % 9 <> 0 AND s_suppkey % 11 <> 0"""


def streets_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("s_suppkey")
    away = (c("s_nationkey") + 1).cast("double")
    line = F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(away * 3, away * 4))
    return table(spark, sf_dir, "supplier").select(
        F.when(key % 9 != 0, "bd").alias("c_desi"),
        F.when(key % 9 != 0, "de ").alias("c_liaison"),
        F.when(key % 9 != 0, c("s_name")).otherwise(" ").alias("l_voie"),
        F.when(key % 2 == 0, F.concat(F.lit("sq"), key.cast("string"))).otherwise("").alias("n_sq_vo"),
        F.lit(None).cast("string").alias("c_voie_vp"),
        F.lit("").alias("c_voie"),
        key.alias("objectid"),
        F.when(key % 5 == 0, F.concat(F.lit("long "), c("s_name"))).alias("l_longmin"),
        F.lit("LineString").alias("type"),
        F.when(key % 11 != 0, line).otherwise(F.array()).alias("coordinates"),
    )


STREET_NAMES = ["c_desi", "c_liaison", "l_voie", "n_sq_vo", "c_voie_vp", "c_voie", "objectid", "l_longmin"]


@register(STREET_FILE_SQL)
def street_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nameless streets and streets without a line are dropped."""
    folder = geojson(streets_of_suppliers(spark, sf_dir), STREET_NAMES, "streets")
    return _streets(ops.read_streets(spark, folder, lines=True))


def _streets(read: DataFrame) -> DataFrame:
    return read.select("street_ref_id", "street_name", "display_name", round_even(geo.length(c("parts")), 2).alias("length"))


@register(STREET_FILE_SQL)
def street_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same streets as whole documents, a part file each, which are cut wherever the pieces of a file end."""
    folder = f"{shared_folder(spark, 'files')}/streets"
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*STREET_NAMES).alias("properties"), F.struct("type", "coordinates").alias("geometry"))
    number = F.pmod(F.xxhash64("objectid"), F.lit(4))
    features = streets_of_suppliers(spark, sf_dir).select(number.alias("part"), F.lit(1).alias("place"), c("objectid").cast("string").alias("at"), F.to_json(feature).alias("value"))
    ends = spark.range(4).select(c("id").alias("part"), F.explode(F.array(F.lit(0), F.lit(2))).alias("place"), F.lit("").alias("at"))
    ends = ends.withColumn("value", F.when(c("place") == 0, '{"type": "FeatureCollection", "note": "a } b", "features": [{"type": "none"}').otherwise("]}"))
    lines = features.unionByName(ends).repartitionById(4, c("part").cast("int")).sortWithinPartitions("part", "place", "at")
    lines.select(F.when(c("place") == 1, F.concat(F.lit(","), c("value"))).otherwise(c("value")).alias("value")).write.text(folder)
    # Pieces of 16 KB, so that the documents of these small tables are cut too.
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name, size in zip(before, ("16k", "1k"), strict=True):
        spark.conf.set(name, size)
    try:
        read = ops.read_streets(spark, folder, split=True)
        read = read.where(c("street_ref_id").isNotNull())
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)
    return _streets(read)
