"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions import keys as k
from citygrain.functions import numbers as n
from citygrain.functions import records as r
from citygrain.functions import text as t
from workloads.registry import register, round_sql, table

c = F.col

PRICE_TEXT_SQL = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
    CASE l_linenumber
      WHEN 1 THEN replace(printf('%.2f', l_extendedprice), '.', ',')
      WHEN 2 THEN CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR) || chr(160) || '500,25'
      WHEN 3 THEN ' ' || CAST(l_suppkey AS VARCHAR) || ' 000 '
      WHEN 4 THEN CAST(l_suppkey AS VARCHAR) || 'd'
      WHEN 5 THEN ''
      WHEN 6 THEN NULL
      ELSE '-' || CAST(l_suppkey AS VARCHAR) || ',5e2' END AS price_text
  FROM lineitem
"""


def price_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French number texts, good and bad, out of the prices of lineitem."""
    line = c("l_linenumber")
    supplier = c("l_suppkey").cast("string")
    text = (
        F.when(line == 1, F.replace(F.format_string("%.2f", c("l_extendedprice")), F.lit("."), F.lit(",")))
        .when(line == 2, F.concat(F.floor(c("l_extendedprice") / 1000).cast("string"), F.lit("\u00a0500,25")))
        .when(line == 3, F.concat(F.lit(" "), supplier, F.lit(" 000 ")))
        .when(line == 4, F.concat(supplier, F.lit("d")))
        .when(line == 5, "")
        .when(line == 6, F.lit(None))
        .otherwise(F.concat(F.lit("-"), supplier, F.lit(",5e2")))
    )
    return table(spark, sf_dir, "lineitem").withColumn("price_text", text)


@register(
    f"""WITH p AS ({PRICE_TEXT_SQL}),
    q AS (SELECT *, replace(replace(replace(price_text, chr(160), ''), ' ', ''), ',', '.') AS plain FROM p)
    SELECT l_orderkey, l_linenumber, price_text,
      CASE WHEN regexp_matches(plain, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$')
        THEN CAST(plain AS DOUBLE) END AS price FROM q"""
)
def french_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_texts(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "price_text", n.french_to_double(c("price_text")).alias("price")
    )


POSTAL_SQL = """
  SELECT o_orderkey, o_custkey,
    CASE o_custkey % 5
      WHEN 0 THEN '75116'
      WHEN 1 THEN '750' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0')
      WHEN 2 THEN CAST(o_custkey AS VARCHAR)
      WHEN 3 THEN 'F-75 0' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0')
      ELSE NULL END AS postal
  FROM orders
"""


@register(
    f"""WITH p AS ({POSTAL_SQL}), d AS (SELECT *, regexp_replace(coalesce(postal, ''), '[^0-9]', '', 'g') AS digits FROM p)
    SELECT o_orderkey, postal, digits,
      CASE WHEN digits = '75116' THEN 16
        WHEN digits LIKE '75%' AND length(digits) >= 5 AND CAST(right(digits, 2) AS INTEGER) BETWEEN 1 AND 20
        THEN CAST(right(digits, 2) AS INTEGER) END AS district,
      '75' || lpad(CAST(o_custkey % 20 + 1 AS VARCHAR), 3, '0') AS back
    FROM d"""
)
def postal_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = c("o_custkey")
    two = F.lpad((customer % 25).cast("string"), 2, "0")
    postal = (
        F.when(customer % 5 == 0, "75116")
        .when(customer % 5 == 1, F.concat(F.lit("750"), two))
        .when(customer % 5 == 2, customer.cast("string"))
        .when(customer % 5 == 3, F.concat(F.lit("F-75 0"), two))
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("postal", postal)
        .select(
            "o_orderkey",
            "postal",
            t.extract_digits(c("postal")).alias("digits"),
            k.postal_to_district(c("postal")).alias("district"),
            k.district_postal(customer % 20 + 1).alias("back"),
        )
    )


@register("SELECT doc_id, regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') AS digits FROM documents")
def document_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", t.extract_digits(c("text")).alias("digits"))


NORMAL_SQL = """trim(regexp_replace(
    upper(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '[^A-Z0-9]+', ' ', 'g'))"""


@register(f"SELECT doc_id, lang, {NORMAL_SQL} AS normalized FROM documents")
def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", t.normalize_text(c("text")).alias("normalized")
    )


ALIAS_SQL = "MAP {" + ", ".join(f"'{short}': '{long}'" for short, long in t.STREET_ALIASES.items()) + "}"


@register(
    f"""WITH w AS (SELECT doc_id, {NORMAL_SQL} AS normalized FROM documents),
    s AS (SELECT doc_id, string_split(normalized, ' ') AS words FROM w)
    SELECT doc_id, array_to_string(list_transform(words, lambda x: coalesce({ALIAS_SQL}[x], x)), ' ') AS street
    FROM s"""
)
def normalized_streets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", t.normalize_street(c("text")).alias("street"))


HOUSE_SQL = """
  SELECT o_orderkey, o_custkey,
    CASE o_custkey % 4 WHEN 0 THEN '000' WHEN 1 THEN '00' || CAST(o_custkey AS VARCHAR)
      WHEN 2 THEN CAST(o_custkey AS VARCHAR) || 'bis' ELSE NULL END AS number,
    CASE o_custkey % 7 WHEN 0 THEN 'b' WHEN 1 THEN 'ter' WHEN 2 THEN ' Q ' WHEN 3 THEN 'C' WHEN 4 THEN 'É-b'
      WHEN 5 THEN '' ELSE NULL END AS suffix
  FROM orders
"""


def houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = c("o_custkey")
    text = customer.cast("string")
    number = (
        F.when(customer % 4 == 0, "000")
        .when(customer % 4 == 1, F.concat(F.lit("00"), text))
        .when(customer % 4 == 2, F.concat(text, F.lit("bis")))
    )
    suffix = F.element_at(
        F.array(*[F.lit(value) for value in ("b", "ter", " Q ", "C", "É-b", "", None)]),
        (customer % 7 + 1).cast("int"),
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", number.alias("number"), suffix.alias("suffix")
    )


HOUSE_NUMBER_SQL = """CASE WHEN ltrim(regexp_replace(coalesce(number, ''), '[^0-9]', '', 'g'), '0') = ''
    THEN regexp_replace(coalesce(number, ''), '[^0-9]', '', 'g')
    ELSE ltrim(regexp_replace(coalesce(number, ''), '[^0-9]', '', 'g'), '0') END"""
SUFFIX_SQL = """CASE coalesce(upper(trim(suffix)), '') WHEN 'B' THEN 'BIS' WHEN 'TER' THEN 'TER' WHEN 'Q' THEN 'QUATER'
    WHEN 'É-B' THEN 'E B' ELSE coalesce(upper(trim(suffix)), '') END"""


@register(
    f"""WITH h AS ({HOUSE_SQL})
    SELECT o_orderkey, number, suffix, {HOUSE_NUMBER_SQL} AS house_number, {SUFFIX_SQL} AS house_suffix FROM h"""
)
def house_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return houses(spark, sf_dir).select(
        "o_orderkey",
        "number",
        "suffix",
        t.normalize_house_number(c("number")).alias("house_number"),
        t.normalize_suffix(c("suffix")).alias("house_suffix"),
    )


@register(
    f"""WITH h AS ({HOUSE_SQL}),
    a AS (SELECT o_orderkey, o_custkey, {HOUSE_NUMBER_SQL} AS num, {SUFFIX_SQL} AS suf,
      CASE WHEN length(CAST(o_custkey % 1300 AS VARCHAR)) >= 3 THEN CAST(o_custkey % 1300 AS VARCHAR)
        ELSE lpad(CAST(o_custkey % 1300 AS VARCHAR), 3, '0') END AS padded,
      CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'PLACE ' || CAST(o_custkey % 11 AS VARCHAR) END AS street FROM h)
    SELECT o_orderkey, padded, '75' || padded AS commune,
      '75' || padded || '|' || num || '|' || suf || '|' || coalesce(street, '') AS address_key,
      '75' || padded || '|' || num || '|' || coalesce(street, '') AS address_key_no_suffix,
      CASE WHEN street IS NOT NULL THEN '75' || padded || '|' || street END AS street_key
    FROM a"""
)
def address_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = c("o_custkey")
    number, suffix = t.normalize_house_number(c("number")), t.normalize_suffix(c("suffix"))
    street = F.when(customer % 3 != 0, F.concat(F.lit("Place "), (customer % 11).cast("string")))
    commune = k.commune_code(F.lit("75"), (customer % 1300).cast("string"))
    return (
        houses(spark, sf_dir)
        .withColumns({"commune": commune, "street": F.when(street.isNotNull(), t.normalize_street(street))})
        .select(
            "o_orderkey",
            "commune",
            n.zfill((customer % 1300).cast("string"), 3).alias("padded"),
            k.address_key(c("commune"), number, suffix, c("street")).alias("address_key"),
            k.address_key_no_suffix(c("commune"), number, c("street")).alias("address_key_no_suffix"),
            k.street_key(c("commune"), c("street")).alias("street_key"),
        )
    )


@register(
    """WITH p AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
        CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE 'B ' || lower(l_returnflag) END AS section,
        CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS plan,
        CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS VARCHAR) END AS prefix FROM lineitem),
    q AS (SELECT *, CASE WHEN section <> '' AND plan IS NOT NULL THEN
        '75' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || lpad(coalesce(prefix, ''), 3, '0')
        || upper(replace(section, ' ', '')) || CASE WHEN length(plan) >= 4 THEN plan ELSE lpad(plan, 4, '0') END
        END AS parcel FROM p)
    SELECT l_orderkey, l_linenumber, parcel,
      CAST(l_quantity AS INTEGER) || '|' || coalesce(plan, '') || '|' || coalesce(parcel, '') || '|'
        || CAST(l_suppkey AS VARCHAR) || '|' || section || '||x' AS transaction_id FROM q"""
)
def parcel_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    section = F.when(c("l_suppkey") % 10 == 0, "").otherwise(F.concat(F.lit("B "), F.lower("l_returnflag")))
    plan = F.when(c("l_partkey") % 13 != 0, c("l_partkey").cast("string"))
    prefix = F.when(c("l_linenumber") % 2 == 0, c("l_linenumber").cast("string"))
    parcel = k.parcel_id(F.lit("75"), c("l_linenumber").cast("string"), prefix, section, plan)
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("parcel", parcel)
        .select(
            "l_orderkey",
            "l_linenumber",
            "parcel",
            k.transaction_id(
                c("l_quantity").cast("int"), plan, c("parcel"), c("l_suppkey"), section, F.lit(None), F.lit("x")
            ).alias("transaction_id"),
        )
    )


@register(
    """WITH b AS (
      SELECT l_orderkey, l_linenumber,
        CASE WHEN l_linenumber < 3 THEN 'A' || l_suppkey ELSE '' END AS matched,
        CASE WHEN l_linenumber < 5 THEN CAST(l_partkey AS VARCHAR) END AS parcel,
        CASE WHEN l_linenumber < 7 THEN 'K' || l_suppkey ELSE '' END AS address,
        CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END AS number,
        CASE WHEN l_linenumber % 3 = 0 THEN '  BIS ' END AS suffix,
        CASE WHEN l_linenumber % 5 < 2 THEN 'RUE  X' ELSE '' END AS street FROM lineitem),
    d AS (SELECT *, coalesce(nullif(matched, ''), nullif(parcel, ''), nullif(address, '')) AS building_id FROM b)
    SELECT l_orderkey, l_linenumber, building_id,
      CASE WHEN matched <> '' THEN 'ban_address' WHEN parcel <> '' THEN 'parcel' WHEN address <> '' THEN 'address_key' END
        AS building_id_source,
      coalesce(nullif(trim(regexp_replace(number || ' ' || coalesce(suffix, '') || ' ' || street, '\\s+', ' ', 'g')), ''),
        building_id) AS building_label FROM d"""
)
def building_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, supplier = c("l_linenumber"), c("l_suppkey").cast("string")
    matched = F.when(line < 3, F.concat(F.lit("A"), supplier)).otherwise("")
    parcel = F.when(line < 5, c("l_partkey").cast("string"))
    address = F.when(line < 7, F.concat(F.lit("K"), supplier)).otherwise("")
    number = F.when(line % 2 == 0, supplier).otherwise("")
    suffix = F.when(line % 3 == 0, "  BIS ")
    street = F.when(line % 5 < 2, "RUE  X").otherwise("")
    building = k.building_id(matched, parcel, address)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        building.alias("building_id"),
        k.building_id_source(matched, parcel, address).alias("building_id_source"),
        k.building_label(number, suffix, street, building).alias("building_label"),
    )


@register(
    """WITH s AS (
      SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN ' rue ' ELSE '' END AS kind,
        CASE WHEN p_partkey % 2 = 0 THEN 'de la' END AS link, p_name AS name,
        CASE WHEN p_partkey % 4 = 0 THEN '' ELSE upper(p_name) END AS long_name FROM part),
    r AS (SELECT *, trim(concat_ws(' ', nullif(trim(coalesce(kind, '')), ''), nullif(trim(coalesce(link, '')), ''),
        nullif(trim(name), ''))) AS raw_name FROM s)
    SELECT p_partkey, raw_name, coalesce(nullif(long_name, ''), raw_name) AS display_name FROM r"""
)
def street_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = c("p_partkey")
    kind = F.when(part % 3 == 1, " rue ").when(part % 3 == 2, "")
    link = F.when(part % 2 == 0, "de la")
    raw = k.street_raw_name(kind, link, c("p_name"))
    long_name = F.when(part % 4 == 0, "").otherwise(F.upper("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        raw.alias("raw_name"),
        k.street_display_name(long_name, raw, t.normalize_street(raw)).alias("display_name"),
    )


@register(
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN l_quantity - 1 <> 0 THEN l_extendedprice / (l_quantity - 1) END AS price_m2,
      TRY_CAST(substr(lpad(CAST(l_partkey * 97 AS VARCHAR), 9, '0'), 4, 2) AS INTEGER) AS district,
      TRY_CAST(substr('AB' || l_returnflag || l_linestatus || '1', 4, 2) AS INTEGER) AS not_a_district
    FROM lineitem"""
)
def prices_and_code_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.lpad((c("l_partkey") * 97).cast("string"), 9, "0")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        n.price_per_m2(c("l_extendedprice"), c("l_quantity") - 1).alias("price_m2"),
        k.code_to_district(code).alias("district"),
        k.code_to_district(F.concat(F.lit("AB"), "l_returnflag", "l_linestatus", F.lit("1"))).alias("not_a_district"),
    )


@register(
    f"""SELECT l_orderkey, l_linenumber, {round_sql('l_extendedprice * (1 - l_discount)', 2)} AS net,
      {round_sql('l_extendedprice / l_quantity', 1)} AS unit,
      CASE WHEN l_linenumber <> 7 THEN least(greatest(l_quantity, 10.0::DOUBLE), 40.0::DOUBLE) END AS clipped
    FROM lineitem"""
)
def rounded_and_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        n.round_even(c("l_extendedprice") * (1 - c("l_discount")), 2).alias("net"),
        n.round_even(c("l_extendedprice") / c("l_quantity"), 1).alias("unit"),
        n.clip(F.when(c("l_linenumber") != 7, c("l_quantity")), 10.0, 40.0).alias("clipped"),
    )


K = geo.lambert93_constants()
LON_SQL = "(2.2 + l_quantity / 200)"
LAT_SQL = "(48.8 + l_discount + l_tax)"
ISOMETRIC_SQL = f"""(ln(tan(pi() / 4 + radians({LAT_SQL}) / 2))
    + {K['ecc']!r} / 2 * ln((1 - {K['ecc']!r} * sin(radians({LAT_SQL}))) / (1 + {K['ecc']!r} * sin(radians({LAT_SQL})))))"""
RADIUS_SQL = f"({K['scale']!r}::DOUBLE * exp(-({K['cone']!r}::DOUBLE) * {ISOMETRIC_SQL}))"
ANGLE_SQL = f"({K['cone']!r}::DOUBLE * radians({LON_SQL} - 3.0))"


@register(
    f"""SELECT l_orderkey, l_linenumber,
      {round_sql(f"{geo.FALSE_EASTING!r}::DOUBLE + {RADIUS_SQL} * sin({ANGLE_SQL})", 3)} AS easting,
      {round_sql(f"{K['north']!r}::DOUBLE - {RADIUS_SQL} * cos({ANGLE_SQL})", 3)} AS northing FROM lineitem"""
)
def lambert93_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geo.to_lambert93(F.lit(2.2) + c("l_quantity") / 200, F.lit(48.8) + c("l_discount") + c("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", n.round_even(x, 3).alias("easting"), n.round_even(y, 3).alias("northing")
    )


@register(
    f"""WITH p AS ({PRICE_TEXT_SQL})
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_linenumber,
      CASE WHEN l_linenumber = 3 THEN NULL ELSE TRY_CAST(CASE WHEN regexp_matches(price_text, '^\\s*[0-9]+(\\.[0-9]+)?\\s*$')
        THEN price_text END AS DOUBLE) END AS price_text FROM p"""
)
def normalized_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = price_texts(spark, sf_dir).select("l_orderkey", "l_linenumber", "price_text")
    return r.normalize_types(frame, strings=["l_orderkey", "absent"], numbers=["price_text"])


@register(
    """SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","rank":'
      || CASE WHEN n_regionkey = 0 THEN 'null' ELSE CAST(n_regionkey AS VARCHAR) || '.5' END || '}' AS record
    FROM nation"""
)
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.when(c("n_regionkey") == 0, F.lit(float("nan"))).otherwise(c("n_regionkey") + 0.5)
    frame = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", rank.alias("rank"))
    return r.to_records_json(frame)


@register("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '1%'")
def code_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.project_existing(
        r.where_prefix(table(spark, sf_dir, "orders"), "o_orderpriority", "1"),
        ["o_orderkey", "o_missing", "o_orderpriority"],
    )


@register("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def option_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.distinct_options(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"])
