"""Open-data files to DataFrames. Everything is read as text and typed by column expressions."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citygrain.functions import keys as k
from citygrain.functions.numbers import round_even, to_number
from citygrain.functions.records import where_prefix
from citygrain.functions.text import normalize_street
from citygrain.operators import context
from citygrain.operators.lookup import type_addresses
from citygrain.operators.numbering import numbered
from citygrain.sources.documents import feature_texts

# Cell texts that the source files use for "missing".
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Columns of the yearly sales files.
SALES_COLUMNS = (
    "Date mutation",
    "Nature mutation",
    "Valeur fonciere",
    "No voie",
    "B/T/Q",
    "Type de voie",
    "Voie",
    "Code postal",
    "Code departement",
    "Code commune",
    "Prefixe de section",
    "Section",
    "No plan",
    "Reference document",
    "Identifiant de document",
    "Type local",
    "Surface reelle bati",
    "Nombre pieces principales",
)
# Fixed value: a year in a file name.
YEAR_PATTERN = re.compile(r"(20\d{2})")
CITY_PREFIX = "751"


def _delimited(spark: SparkSession, paths: str | list[str], sep: str, multiline: bool, names: list[str] | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names]) if names else None
    return spark.read.csv(
        paths, schema=schema, sep=sep, header=True, inferSchema=False, quote='"', escape='"', encoding="UTF-8", multiLine=multiline
    )


def read_text_table(
    spark: SparkSession, paths: str | list[str], sep: str = ",", multiline: bool = False, names: list[str] | None = None
) -> DataFrame:
    """Delimited text with a header, every column a string, missing marks as NULL.

    ``multiline`` accepts line breaks inside quotes; a file is then read by one task, so landed part
    files, which have none, are read without it. ``names`` are the header's, if it is known already.
    """
    raw = _delimited(spark, paths, sep, multiline, names)
    return raw.select(
        *[
            F.when(~F.col(f"`{name}`").isin(*MISSING_MARKS), F.col(f"`{name}`")).alias(name)
            for name in raw.columns
        ]
    )


def _pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in names])


def read_national_sales(
    spark: SparkSession, path: str, department: str = k.DEPARTMENT, multiline: bool = False
) -> DataFrame:
    """The national ``|``-delimited file, one department only. The code is compared as text."""
    raw = _delimited(spark, path, "|", multiline)
    return raw.where(F.col("`Code departement`") == department)


def land_sales(sales: DataFrame, folder: str, year: int) -> str:
    """Write one department-year as delimited text under a name that holds the year."""
    target = f"{folder.rstrip('/')}/valeursfoncieres-{year}-paris.csv"
    sales.write.mode("overwrite").csv(target, header=True, quote='"', escape='"')
    return target


def _first_lines(spark: SparkSession, glob: str) -> dict[str, str]:
    """Path to first line that isn't empty, for all files, by one job."""
    lines = spark.read.option("recursiveFileLookup", "true").text(glob)
    lines = lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("line")
    )
    first = lines.where((F.col("at") == 0) & (F.trim("value") != "")).groupBy("path").agg(F.min_by("value", "line").alias("header"))
    return {unquote(row["path"]): row["header"] for row in first.collect()}  # one row per file


def read_sales(spark: SparkSession, glob: str, multiline: bool = False) -> DataFrame:
    """Yearly sales files; the year comes from the file name, files without one are skipped.

    Columns are found by each file's own header: files of one year with one header are one scan, and the
    scans are united by name. The headers are gathered by one job however many files there are.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(glob)
    headers = _first_lines(spark, glob)
    scans: dict[tuple[int, str], list[str]] = {}
    for row in listed.select("path").orderBy("path").collect():
        *_, folder, name = row["path"].split("/")
        # A landed table is a folder of part files whose names mean nothing: the folder's counts.
        found = YEAR_PATTERN.search(folder if folder.endswith(".csv") else name)
        header = headers.get(row["path"]) or headers.get(re.sub("^file:/+", "file:///", row["path"]))
        if found and header:
            scans.setdefault((int(found.group(1)), header), []).append(row["path"])
    if not scans:
        raise FileNotFoundError(f"no yearly sales file under {glob}")
    years = []
    for (year, header), paths in sorted(scans.items()):
        (names,) = csv.reader([header], quotechar='"')
        # With the names given, Spark has no need to read a file for them.
        known = names if len(set(names)) == len(names) and all(names) else None
        years.append(_pick(read_text_table(spark, sorted(paths), multiline=multiline, names=known), SALES_COLUMNS).withColumn("year", F.lit(year)))
    result = years[0]
    for frame in years[1:]:
        result = result.unionByName(frame)
    return result


def read_addresses(spark: SparkSession, path: str) -> DataFrame:
    """Address reference of the city, keyed and typed."""
    columns = (
        "cle_interop", "commune_insee", "voie_nom", "numero", "suffixe", "long", "lat", "certification_commune",
    )
    raw = _pick(read_text_table(spark, path, ";"), columns)
    return type_addresses(where_prefix(raw, "commune_insee", CITY_PREFIX))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return _pick(read_text_table(spark, path), ("idu", "id_adr", "type_lien", "nb_adr", "nb_parc"))


def read_income(spark: SparkSession, path: str) -> DataFrame:
    return context.type_income(where_prefix(read_text_table(spark, path, ";"), "IRIS", CITY_PREFIX))


def read_rents(spark: SparkSession, path: str) -> DataFrame:
    return context.type_rents(read_text_table(spark, path, ";"))


def read_social(spark: SparkSession, path: str) -> DataFrame:
    return context.type_social(read_text_table(spark, path, ";"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Noise and air cells landed as a table."""
    columns = ("category", "minx", "miny", "maxx", "maxy")
    return spark.read.parquet(path).select(F.col("category").cast("int"), *columns[1:])


def _points(text: Column, depth: int) -> Column:
    """Coordinate text of the given nesting depth to parts of points."""
    schema = "array<" * depth + "array<double>" + ">" * depth
    parsed = F.from_json(text, schema)
    if depth == 1:
        parsed = F.array(parsed)
    if depth == 3:
        parsed = F.flatten(parsed)
    return F.transform(
        parsed,
        lambda part: F.transform(part, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y"))),
    )


def parse_geometry(kind: Column, coordinates: Column) -> Column:
    """Polygon rings or line parts; any other geometry, or an empty one, gives NULL."""
    parts = (
        F.when(kind == "Polygon", _points(coordinates, 2))
        .when(kind == "MultiPolygon", _points(coordinates, 3))
        .when(kind == "LineString", _points(coordinates, 1))
        .when(kind == "MultiLineString", _points(coordinates, 2))
    )
    whole = F.filter(parts, lambda part: F.size(part) > 1)
    return F.when(F.size(whole) > 0, whole)


def geometry_text(kind: Column, coordinates: Column) -> Column:
    return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}"))


def read_features(
    spark: SparkSession, path: str, properties: Iterable[str], lines: bool = False, split: bool = False
) -> DataFrame:
    """Features of GeoJSON files: origin, text properties, geometry text and ``parts``.

    A file is one document, which one task reads, or, with ``split``, any number of tasks; or, with ``lines``,
    one feature per line, which any number of tasks read. ``origin`` puts the features of all files in order.
    With ``split`` the geometry text has no white space.
    """
    fields = ", ".join(f"`{name}`: string" for name in properties)
    shape = "struct<type: string, coordinates: string>"
    if lines:
        raw = spark.read.schema(f"properties struct<{fields}>, geometry {shape}").json(path)
        place, feature = F.monotonically_increasing_id(), F.struct("properties", "geometry")
        found = raw.select("_metadata", place.alias("place"), feature.alias("feature"))
    elif split:
        parsed = F.from_json("text", f"properties struct<{fields}>, geometry {shape}")
        metadata = F.struct(F.col("file").alias("file_path"), F.lit(0).cast("bigint").alias("file_block_start"))
        found = feature_texts(spark, path).select(metadata.alias("_metadata"), "place", parsed.alias("feature"))
    else:
        raw = spark.read.schema(f"features array<struct<properties: struct<{fields}>, geometry: {shape}>>")
        found = raw.json(path, multiLine=True).select("_metadata", F.posexplode("features").alias("place", "feature"))
    kind, coordinates = F.col("feature.geometry.type"), F.col("feature.geometry.coordinates")
    # Within a piece of a file, places rise from line to line.
    origin = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("place").cast("bigint").alias("place"),
    )
    return found.select(
        origin.alias("origin"),
        "feature.properties.*",
        geometry_text(kind, coordinates).alias("geometry"),
        parse_geometry(kind, coordinates).alias("parts"),
    )


def read_districts(spark: SparkSession, path: str, lines: bool = False, split: bool = False) -> DataFrame:
    """District outlines in the order of their number."""
    c = F.col
    raw = read_features(spark, path, ("c_ar", "c_arinsee", "l_aroff", "l_ar", "surface", "perimetre"), lines, split)
    typed = raw.select(
        "origin",
        c("c_ar").cast("int").alias("arrondissement"),
        c("c_arinsee").cast("int").alias("insee_code"),
        c("l_aroff").alias("name"),
        c("l_ar").alias("label"),
        k.district_postal(c("c_ar").cast("int")).alias("postal_code"),
        round_even(to_number(c("surface")), 2).alias("surface_m2"),
        round_even(to_number(c("perimetre")), 2).alias("perimeter_m"),
        "geometry",
        c("parts").alias("rings"),
    )
    return numbered(typed, "feature_index", "arrondissement", "origin").drop("origin")


def read_quartiers(spark: SparkSession, path: str, lines: bool = False, split: bool = False) -> DataFrame:
    """Quartier outlines in the order of their numeric id."""
    c = F.col
    raw = read_features(spark, path, ("c_quinsee", "c_qu", "c_ar", "l_qu", "surface", "perimetre"), lines, split)
    typed = raw.select(
        "origin",
        c("c_quinsee").alias("quartier_id"),
        c("c_quinsee").cast("bigint").alias("quartier_number"),
        c("c_qu").cast("int").alias("quartier_code"),
        c("c_ar").cast("int").alias("arrondissement"),
        c("l_qu").alias("name"),
        round_even(to_number(c("surface")), 2).alias("surface_m2"),
        round_even(to_number(c("perimetre")), 2).alias("perimeter_m"),
        "geometry",
        c("parts").alias("rings"),
    )
    return numbered(typed, "feature_index", "quartier_number", "origin").drop("origin", "quartier_number")


def read_iris(spark: SparkSession, path: str, department: str = k.DEPARTMENT) -> DataFrame:
    """Census blocks out of a delimited file with a GeoJSON column."""
    c = F.col
    raw = read_text_table(spark, path, ";").where(c("DEP") == department)
    shape = F.from_json(c("`Geo Shape`"), "type string, coordinates string")
    typed = raw.select(
        c("CODE_IRIS").alias("iris_code"),
        c("NOM_IRIS").alias("iris_name"),
        c("TYP_IRIS").alias("iris_type"),
        k.code_to_district(c("CODE_IRIS")).alias("arrondissement"),
        c("INSEE_COM").alias("commune_insee"),
        c("`Geo Shape`").alias("geometry"),
        parse_geometry(shape["type"], shape["coordinates"]).alias("rings"),
    )
    return numbered(typed, "feature_index", "iris_code", "geometry")


def read_streets(spark: SparkSession, path: str, lines: bool = False, split: bool = False) -> DataFrame:
    """Street lines with normalised name, display name and reference id; nameless ones are dropped."""
    c = F.col
    names = ("c_desi", "c_liaison", "l_voie", "n_sq_vo", "c_voie_vp", "c_voie", "objectid", "l_longmin")
    # A line's number is its place among all lines of all files.
    raw = numbered(read_features(spark, path, names, lines, split).drop("geometry"), "line_index", "origin")
    raw = raw.withColumn("raw_name", k.street_raw_name(c("c_desi"), c("c_liaison"), c("l_voie")))
    named = raw.withColumn("street_name", normalize_street(c("raw_name")))
    return named.where((c("street_name") != "") & c("parts").isNotNull()).select(
        "line_index",
        k.first_given(c("n_sq_vo"), c("c_voie_vp"), c("c_voie"), c("objectid")).alias("street_ref_id"),
        "street_name",
        k.street_display_name(c("l_longmin"), c("raw_name"), c("street_name")).alias("display_name"),
        "parts",
    )
