"""Raw sale lines, the event stream, published tables and the whole build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions.records import distinct_options
from citygrain.operators import context
from citygrain.operators import sales as sales_ops
from citygrain.plans import gold
from citygrain.plans.catalog import DOCUMENTS, FEATURE_COLLECTIONS, TABLES
from citygrain.plans.validation import REQUIRED_COLUMNS, REQUIRED_DOCUMENTS, validate
from citygrain.operators.lookup import type_addresses
from citygrain.session import shared_folder
from citygrain.sources.store import Store, publish_all
from citygrain.streaming import events as ev
from workloads import facts
from workloads.registry import register, table
from workloads.sales import SALES_SQL, STREET_SQL, grain_sql, sale_rows
from workloads.spatial import cells, lines, nation_zones

c = F.col


def _padded(number: Column, width: int) -> Column:
    """``format_string("%0{width}d")``, which takes ten times as long, for numbers that are not too long for it."""
    short = number.between(0, 10**width - 1)
    return F.when(short, F.lpad(number.cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", number))


def _shown(number: Column) -> Column:
    """``format_string("%d")``."""
    return F.coalesce(number.cast("string"), F.lit("null"))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as raw text lines of a sales file."""
    lines_ = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation, part, number = c("s_nationkey"), c("l_partkey"), c("l_linenumber")
    price = F.format_string("%.2f", c("l_extendedprice") * 10)
    return lines_.join(suppliers, c("l_suppkey") == c("s_suppkey"), "left").select(
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Date mutation"),
        F.when(number < 7, "Vente").otherwise("Echange").alias("Nature mutation"),
        F.when(c("l_orderkey") % 97 != 0, F.replace(price, F.lit("."), F.lit(","))).alias("Valeur fonciere"),
        _padded(part % 90 + 1, 4).alias("No voie"),
        F.when(part % 4 == 0, "B").alias("B/T/Q"),
        F.lit("AV").alias("Type de voie"),
        F.concat(F.lit("de l'Été "), _shown(part % 40)).alias("Voie"),
        F.concat(F.lit("750"), _padded(nation + 1, 2)).alias("Code postal"),
        F.lit("75").alias("Code departement"),
        (nation + 101).cast("string").alias("Code commune"),
        F.lit(None).cast("string").alias("Prefixe de section"),
        F.when(part % 10 != 0, "a k").alias("Section"),
        part.cast("string").alias("No plan"),
        F.lit(None).cast("string").alias("Reference document"),
        c("l_orderkey").cast("string").alias("Identifiant de document"),
        F.when(c("l_returnflag") == "A", "Appartement")
        .when(c("l_returnflag") == "N", "Maison")
        .otherwise("Dépendance")
        .alias("Type local"),
        (c("l_quantity") * 2).cast("int").cast("string").alias("Surface reelle bati"),
        number.cast("string").alias("Nombre pieces principales"),
        F.year("l_shipdate").alias("year"),
    )


RAW_SALES_SQL = """
lines AS (
  SELECT *, l_partkey % 90 + 1 AS number, printf('%.2f', l_extendedprice * 10) AS price_text,
    CAST(printf('%.2f', l_extendedprice * 10) AS DOUBLE) AS price, CAST(l_quantity * 2 AS INTEGER) AS surface
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
),
usable AS (
  SELECT *, CASE WHEN l_partkey % 10 <> 0 THEN '75' || CAST(101 + s_nationkey AS VARCHAR) || '000AK'
      || CASE WHEN l_partkey >= 1000 THEN CAST(l_partkey AS VARCHAR) ELSE lpad(CAST(l_partkey AS VARCHAR), 4, '0') END
    END AS parcel_id,
    'AVENUE DE L ETE ' || CAST(l_partkey % 40 AS VARCHAR) AS street_name, '75' || CAST(101 + s_nationkey AS VARCHAR) AS commune,
    CASE WHEN l_partkey % 4 = 0 THEN 'BIS' ELSE '' END AS suffix,
    CASE l_returnflag WHEN 'A' THEN 'Appartement' ELSE 'Maison' END AS kind
  FROM lines
  WHERE l_linenumber < 7 AND l_orderkey % 97 <> 0 AND s_nationkey < 20 AND l_returnflag IN ('A', 'N')
    AND surface > 10 AND price > 10000 AND price / surface BETWEEN 1000 AND 50000
)
"""


@register(
    f"""WITH {RAW_SALES_SQL}
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_nationkey + 1 AS arrondissement, price AS sale_value_eur,
      price / surface AS price_per_m2, parcel_id,
      commune || '|' || number || '|' || suffix || '|' || street_name AS address_key,
      commune || '|' || number || '|' || street_name AS address_key_no_suffix,
      strftime(l_shipdate, '%d/%m/%Y') || '|' || replace(price_text, '.', ',') || '|' || coalesce(parcel_id, '') || '|'
        || number || '|' || street_name || '|' || kind || '|' || surface AS transaction_id FROM usable"""
)
def cleaned_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_ops.sales_from_raw(raw_sales(spark, sf_dir)).select(
        "year",
        "arrondissement",
        "sale_value_eur",
        "price_per_m2",
        "parcel_id",
        "address_key",
        "address_key_no_suffix",
        "transaction_id",
    )


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as sales; ids are unique."""
    event = c("event_id")
    return table(spark, sf_dir, "events").select(
        (c("user_id") % 20 + 1).cast("int").alias("arrondissement"),
        (F.lit(2023) + F.dayofmonth("ts") % 3).alias("year"),
        event.cast("string").alias("transaction_id"),
        c("value").alias("price_per_m2"),
        (c("value") * 50).alias("sale_value_eur"),
        (event % 60 + 10).cast("double").alias("built_surface_m2"),
        F.when(event % 9 != 0, (event % 5 + 1).cast("double")).alias("rooms"),
        F.when(c("event_type") == "click", "Maison").otherwise("Appartement").alias("Type local"),
    )


EVENTS_SQL = """
sales AS (
  SELECT CAST(user_id % 20 + 1 AS INTEGER) AS arrondissement, CAST(2023 + day(ts) % 3 AS INTEGER) AS year,
    CAST(event_id AS VARCHAR) AS transaction_id, value AS price_per_m2, value * 50 AS sale_value_eur,
    CAST(event_id % 60 + 10 AS DOUBLE) AS built_surface_m2,
    CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % 5 + 1 AS DOUBLE) END AS rooms,
    CASE WHEN event_type = 'click' THEN 'Maison' ELSE 'Appartement' END AS "Type local"
  FROM events
)
"""
RECORD_SQL = """CAST(arrondissement AS VARCHAR) AS key, '{"arrondissement":' || arrondissement || ',"year":' || year
    || ',"transaction_id":"' || transaction_id || '","price_per_m2":' || CAST(price_per_m2 AS VARCHAR) || ',"rooms":'
    || coalesce(CAST(rooms AS VARCHAR), 'null') || '}' AS value"""
FIRST_EVENTS = 100


@register(f"WITH {EVENTS_SQL} SELECT {RECORD_SQL} FROM sales")
def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream records; the fields are read back out of the JSON text and put in order."""
    return _fields(ev.to_event_records(event_sales(spark, sf_dir)))


@register(f"WITH {EVENTS_SQL} SELECT {RECORD_SQL} FROM (SELECT * FROM sales ORDER BY transaction_id LIMIT {FIRST_EVENTS})")
def first_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(ev.to_event_records(event_sales(spark, sf_dir), FIRST_EVENTS))


def _fields(records: DataFrame) -> DataFrame:
    fields = ("arrondissement", "year", "transaction_id", "price_per_m2", "rooms")
    parsed = records.select("key", F.from_json("value", ev.EVENT_SCHEMA).alias("e"))
    return parsed.select(
        "key", F.to_json(F.struct(*[f"e.{name}" for name in fields]), {"ignoreNullFields": "false"}).alias("value")
    )


def streamed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once, every tenth a second time, and broken copies of every seventh."""
    records = ev.to_event_records(event_sales(spark, sf_dir)).select("value")
    number = F.get_json_object("value", "$.transaction_id").cast("bigint")
    again = records.where(number % 10 == 0)
    broken = records.where(number % 7 == 0).select(
        F.replace("value", F.lit('"rooms"'), F.lit('"room"')).alias("value")
    )
    return records.unionByName(again).unionByName(broken)


@register(f"WITH {EVENTS_SQL} {grain_sql(sales_ops.DISTRICT_KEYS)}")
def streamed_sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stream: JSON files in, checks, first arrival wins, published after every batch."""
    root = shared_folder(spark, "stream")
    streamed_records(spark, sf_dir).repartition(8).write.text(f"{root}/in")
    source = ev.read_event_stream(spark, "text", path=f"{root}/in", maxFilesPerTrigger="4")
    store = Store(spark, root=f"{root}/tables")
    if not ev.run_bounded(ev.accept(source), store, f"{root}/accepted", f"{root}/checkpoint"):
        raise TimeoutError("the stream did not end")
    return store.read(ev.STREAM_TABLE)


@register(f"WITH {EVENTS_SQL} {grain_sql(sales_ops.DISTRICT_KEYS)}")
def streamed_first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event three times in one micro-batch, line after line; the copies differ in their figures."""
    root = shared_folder(spark, "stream")
    copies = None
    for number, factor in enumerate((1.0, 0.5, 2.0)):
        sales = event_sales(spark, sf_dir).withColumn("price_per_m2", c("price_per_m2") * factor)
        records = ev.to_event_records(sales).select(F.lit(number).alias("copy"), "value")
        copies = records if copies is None else copies.unionByName(records)
    number = F.get_json_object("value", "$.transaction_id").cast("bigint")
    dealt = copies.withColumn("id", number).repartition(8, "id").sortWithinPartitions("copy", "id")
    dealt.select("value").write.text(f"{root}/in")
    store = Store(spark, root=f"{root}/tables")
    source = ev.read_event_stream(spark, "text", path=f"{root}/in")
    if not ev.run_bounded(ev.accept(source), store, f"{root}/accepted", f"{root}/checkpoint"):
        raise TimeoutError("the stream did not end")
    return store.read(ev.STREAM_TABLE)


@register(f"WITH {SALES_SQL} {grain_sql(sales_ops.DISTRICT_KEYS)}")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a published table and read back."""
    store = Store(spark, root=shared_folder(spark, "published"))
    store.write(TABLES["gold_sales"], sales_ops.sales_by_district(sale_rows(spark, sf_dir)))
    return store.read(TABLES["gold_sales"])


@register("SELECT o_orderkey AS feature_index, o_orderstatus AS geometry, o_custkey, o_orderpriority FROM orders")
def published_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, root=shared_folder(spark, "published"))
    features = table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("feature_index"), c("o_orderstatus").alias("geometry"), "o_custkey", "o_orderpriority"
    )
    store.write_features(FEATURE_COLLECTIONS["gold_streets_geojson"], features)
    return store.read_features(FEATURE_COLLECTIONS["gold_streets_geojson"])


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the streets in :func:`raw_sales`, half of them without position."""
    parts = distinct_options(
        raw_sales(spark, sf_dir), ["Code commune", "No voie", "B/T/Q", "Voie"]
    )
    number = c("No voie").cast("int")
    commune = c("Code commune").cast("int")
    return type_addresses(
        parts.select(
            F.concat_ws("_", "Code commune", "No voie", "B/T/Q", "Voie").alias("cle_interop"),
            F.concat(F.lit("75"), "Code commune").alias("commune_insee"),
            F.concat(F.lit("avenue "), "Voie").alias("voie_nom"),
            c("No voie").alias("numero"),
            c("B/T/Q").alias("suffixe"),
            F.when(number % 2 == 0, ((commune % 5) * 12 + number / 8).cast("string")).alias("long"),
            F.when(number % 2 == 0, (F.floor((commune - 101) / 5) * 4 + number / 32).cast("string")).alias("lat"),
            F.lit("1").alias("certification_commune"),
        )
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = sales_ops.sales_from_raw(raw_sales(spark, sf_dir)).where("parcel_id is not null")
    return sales.select(
        c("parcel_id").alias("idu"),
        F.concat_ws(
            "_", c("Code commune"), F.lit("0002"), F.concat(F.lit("de l'Été "), (c("No plan").cast("int") % 40).cast("string"))
        ).alias("id_adr"),
        F.lit("GEO").alias("type_lien"),
        F.lit("1").alias("nb_adr"),
        F.lit("1").alias("nb_parc"),
    ).dropDuplicates()


def metric_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The noise and air cells of the map, in metres as the build takes them."""
    low, high = geo.to_lambert93(c("minx"), c("miny")), geo.to_lambert93(c("maxx"), c("maxy"))
    return cells(spark, sf_dir).select(
        "category",
        F.least(low[0], high[0]).alias("minx"),
        F.least(low[1], high[1]).alias("miny"),
        F.greatest(low[0], high[0]).alias("maxx"),
        F.greatest(low[1], high[1]).alias("maxy"),
    )


def gold_inputs(spark: SparkSession, sf_dir: str) -> gold.Inputs:
    zones = nation_zones(spark, sf_dir)
    number = c("zone") + 1
    outline = F.to_json(F.col("rings"))
    districts = zones.select(
        "feature_index",
        number.alias("arrondissement"),
        (75100 + number).alias("insee_code"),
        c("zone_name").alias("name"),
        c("zone_name").alias("label"),
        F.lit("75000").alias("postal_code"),
        F.lit(1.0).alias("surface_m2"),
        F.lit(1.0).alias("perimeter_m"),
        outline.alias("geometry"),
        "rings",
    )
    quartiers = zones.select(
        "feature_index",
        c("zone").cast("string").alias("quartier_id"),
        c("zone").alias("quartier_code"),
        number.alias("arrondissement"),
        c("zone_name").alias("name"),
        outline.alias("geometry"),
        "rings",
    )
    iris = zones.select(
        "feature_index",
        F.format_string("75%07d", c("zone")).alias("iris_code"),
        c("zone_name").alias("iris_name"),
        F.lit("H").alias("iris_type"),
        number.alias("arrondissement"),
        (75100 + number).cast("string").alias("commune_insee"),
        outline.alias("geometry"),
        "rings",
    )
    streets = lines(spark, sf_dir).select(
        c("street").alias("line_index"),
        c("street").cast("string").alias("street_ref_id"),
        F.format_string("AVENUE DE L ETE %d", c("street") % 40).alias("street_name"),
        F.format_string("avenue %d", c("street")).alias("display_name"),
        "parts",
    )
    return gold.Inputs(
        sales=sales_ops.sales_from_raw(raw_sales(spark, sf_dir)),
        addresses=addresses(spark, sf_dir),
        districts=districts,
        quartiers=quartiers,
        iris=iris,
        streets=streets,
        income=facts.income_rows(spark, sf_dir),
        rents=facts.rent_rows(spark, sf_dir),
        social=facts.social_rows(spark, sf_dir),
        links=links(spark, sf_dir),
        cells=metric_cells(spark, sf_dir),
    )


@register(
    f"""WITH {SALES_SQL}, streets AS ({STREET_SQL})
    SELECT {', '.join(sales_ops.STREET_KEYS)}, transactions, row_number() OVER (ORDER BY {', '.join(sales_ops.STREET_KEYS)}) - 1 AS position FROM streets"""
)
def published_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published sales by street, each with its place in the files that they were written to."""
    store = Store(spark, root=shared_folder(spark, "ordered"))
    store.write_ordered("streets", sales_ops.sales_by_street(sale_rows(spark, sf_dir)), *sales_ops.STREET_KEYS)
    return store.read_ordered("streets").select(*sales_ops.STREET_KEYS, "transactions", "position")


LOST_COLUMNS = ("median_price_m2", "transactions")


def _issues_sql() -> str:
    """All requirements of datasets that aren't written, and the columns that the written one lost."""
    gone = [(name, "missing table", TABLES[name]) for name in REQUIRED_COLUMNS if name != "gold_sales"]
    gone += [(name, "missing document", (FEATURE_COLLECTIONS | DOCUMENTS)[name]) for name in REQUIRED_DOCUMENTS]
    gone += [("gold_sales", "missing column", column) for column in REQUIRED_COLUMNS["gold_sales"] if column in LOST_COLUMNS]
    rows = ", ".join(f"('{dataset}', '{problem}', '{item}')" for dataset, problem, item in gone)
    # The lost columns are asked of the one table that is there, which the given sales fill.
    return f"WITH {SALES_SQL} SELECT issues.* FROM (VALUES {rows}) issues(dataset, problem, item) WHERE EXISTS (SELECT 1 FROM sales)"


@register(_issues_sql())
def issues_of_a_broken_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table is published, without two of its columns; nothing else is."""
    store = Store(spark, root=shared_folder(spark, "broken"))
    store.write(TABLES["gold_sales"], sales_ops.sales_by_district(sale_rows(spark, sf_dir)).drop(*LOST_COLUMNS))
    return validate(store)


BUILT_SALES_SQL = """sales AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, s_nationkey + 1 AS arrondissement, price AS sale_value_eur,
      price / surface AS price_per_m2, CAST(surface AS DOUBLE) AS built_surface_m2, CAST(l_linenumber AS DOUBLE) AS rooms, kind AS "Type local",
      strftime(l_shipdate, '%d/%m/%Y') || '|' || replace(price_text, '.', ',') || '|' || coalesce(parcel_id, '') || '|'
        || number || '|' || street_name || '|' || kind || '|' || surface AS transaction_id FROM usable)"""
#: Built datasets with their metrics and the SQL tables that must hold the same; income has no year.
BUILT = {
    "gold_sales": ("sales_yearly", sales_ops.METRICS),
    "silver_sales": ("sales_yearly", sales_ops.METRICS),
    "gold_income": ("income", ("median_income_eur", "first_quartile_income_eur", "third_quartile_income_eur", "share_taxable_pct")),
    "gold_rents": ("rents", (*context.RENTS, "rent_reference_count")),
    "silver_rents": ("rents", (*context.RENTS, "rent_reference_count")),
    "gold_social": ("social", ("program_count", *context.SOCIAL_UNITS)),
}


def _built_sql() -> str:
    parts = [
        f"SELECT '{dataset}' AS dataset, CAST(arrondissement AS INTEGER) AS arrondissement, {'NULL' if source == 'income' else 'CAST(year AS INTEGER)'} AS year,"
        f" '{metric}' AS metric, CAST({metric} AS DOUBLE) AS value FROM {source}"
        for dataset, (source, metrics) in BUILT.items()
        for metric in metrics
    ]
    tables = f"{RAW_SALES_SQL}, {BUILT_SALES_SQL}, sales_yearly AS ({grain_sql(sales_ops.DISTRICT_KEYS)}), {facts.INCOME_SQL}"
    return f"WITH {tables}, {facts.ORDERED_SQL}, {facts.RENTS_SQL}, {facts.SOCIAL_SQL} {' UNION ALL '.join(parts)}"


@register(_built_sql())
def gold_build_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the yearly facts that a whole build has published, read back from the store."""
    store = Store(spark, root=shared_folder(spark, "gold"))
    publish_all(store, gold.build_gold(gold_inputs(spark, sf_dir)))
    values = None
    for dataset, (_, metrics) in BUILT.items():
        rows = store.read(TABLES[dataset])
        year = c("year").cast("int") if "year" in rows.columns else F.lit(None).cast("int")
        pairs = F.array(*[F.struct(F.lit(name).alias("metric"), c(name).cast("double").alias("value")) for name in metrics])
        rows = rows.select(F.lit(dataset).alias("dataset"), c("arrondissement").cast("int").alias("arrondissement"), year.alias("year"), F.explode(pairs).alias("m"))
        rows = rows.select("dataset", "arrondissement", "year", "m.*")
        values = rows if values is None else values.unionByName(rows)
    return values


@register()
def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything built, published and validated: rows per dataset, and the issues found.

    No equal SQL: every part has its own query above; the tests compare the whole on a fixture.
    """
    store = Store(spark, root=shared_folder(spark, "gold"))
    publish_all(store, gold.build_gold(gold_inputs(spark, sf_dir)))
    counted = None
    for name, target in (TABLES | FEATURE_COLLECTIONS | DOCUMENTS).items():
        row = store.read(target).agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"))
        counted = row if counted is None else counted.unionByName(row)
    return counted.withColumn("problem", F.lit(None).cast("string")).unionByName(
        validate(store).select("dataset", F.lit(None).cast("bigint").alias("rows"), "problem")
    )
