"""From typed inputs to every published output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citygrain.functions import geo
from citygrain.functions.keys import street_key
from citygrain.functions.records import project_existing
from citygrain.operators import context, lookup
from citygrain.operators import sales as sales_ops
from citygrain.operators.coverage import coverage
from citygrain.operators.numbering import numbered
from citygrain.operators.spatial import assign_cells, clip_lines, layer_extent, prepare_cells, spatial_join
from citygrain.operators.summary import build_summary, city_summary
from citygrain.plans.serving import metric_catalog_column
from citygrain.session import staged
from citygrain.sources import files

# Published columns of a geocoded sale.
GEOCODED_COLUMNS = (
    "year",
    "Date mutation",
    "Reference document",
    "Identifiant de document",
    "arrondissement",
    "commune_insee",
    "house_number",
    "house_suffix",
    "street_key",
    "street_name",
    "sale_value_eur",
    "built_surface_m2",
    "price_per_m2",
    "Type local",
    "parcel_id",
    "building_id",
    "building_id_source",
    "building_label",
    "matched_cle_interop",
    "geocode_source",
    "longitude",
    "latitude",
    "quartier_id",
    "quartier_name",
    "iris_code",
    "iris_name",
    "iris_type",
)

# What placing and aggregating sales reads besides, and nothing else of a sale is carried along.
SALE_COLUMNS = (*GEOCODED_COLUMNS, "rooms", "transaction_id", "address_key", "address_key_no_suffix")


@dataclass(frozen=True)
class Inputs:
    """Typed frames. ``cells`` is in metres, all outlines in degrees; ``links`` may be missing."""

    sales: DataFrame
    addresses: DataFrame
    districts: DataFrame
    quartiers: DataFrame
    iris: DataFrame
    streets: DataFrame
    income: DataFrame
    rents: DataFrame
    social: DataFrame
    links: DataFrame | None = None
    cells: DataFrame | None = None
    #: Rows fetched for parcels that ``links`` lacks; only those of parcels that need them are taken.
    fetched_links: DataFrame | None = None


def read_inputs(spark: SparkSession, paths: dict[str, str]) -> Inputs:
    """Every input from its file; ``links`` and ``cells`` only where a path is given."""
    optional = {
        "links": files.read_links(spark, paths["links"]) if "links" in paths else None,
        "cells": files.read_cells(spark, paths["cells"]) if "cells" in paths else None,
    }
    return Inputs(
        sales=sales_ops.sales_from_raw(files.read_sales(spark, paths["sales"])),
        addresses=files.read_addresses(spark, paths["addresses"]),
        districts=files.read_districts(spark, paths["districts"]),
        quartiers=files.read_quartiers(spark, paths["quartiers"]),
        iris=files.read_iris(spark, paths["iris"]),
        streets=files.read_streets(spark, paths["streets"]),
        income=files.read_income(spark, paths["income"]),
        rents=files.read_rents(spark, paths["rents"]),
        social=files.read_social(spark, paths["social"]),
        **optional,
    )


LINK_FIELDS = ("idu", "id_adr", "type_lien", "nb_adr", "nb_parc")


def refreshed_links(sales: DataFrame, references: list[DataFrame], links: DataFrame | None, fetched: DataFrame) -> DataFrame:
    """The link cache with the fetched rows of the parcels that no address places and the cache lacks."""

    def numbered_rows(rows: DataFrame) -> DataFrame:
        return rows if "seq" in rows.columns else rows.select(*LINK_FIELDS, F.monotonically_increasing_id().alias("seq"))

    unplaced = lookup.geocode(sales, *references, None).where("longitude is null")
    known = numbered_rows(links) if links is not None else numbered_rows(fetched).where("false")
    return staged(lookup.merge_links(known, numbered_rows(fetched), unplaced.select(F.col("parcel_id").alias("idu"))), "links")


def place_sales(
    sales: DataFrame,
    addresses: DataFrame,
    links: DataFrame | None,
    quartiers: DataFrame,
    iris: DataFrame,
    fetched_links: DataFrame | None = None,
) -> DataFrame:
    """Geocode sales, attach quartier and census block, add street and building keys.

    Sales and addresses are read by several steps, so they are staged: their texts are parsed once.
    """
    sales, addresses = staged(sales, "clean-sales"), staged(addresses, "addresses")
    references = [lookup.dedupe_reference(addresses, key) for key in ("address_key", "address_key_no_suffix", "cle_interop")]
    if fetched_links is not None:
        links = refreshed_links(sales, references, links, fetched_links)
    best = None if links is None else lookup.best_link(links)
    placed = lookup.geocode(sales, *references, best)
    placed = spatial_join(placed, quartiers, {"quartier_id": "quartier_id", "name": "quartier_name"})
    placed = spatial_join(
        placed,
        iris,
        {
            "iris_code": "iris_code",
            "iris_name": "iris_name",
            "iris_type": "iris_type",
            "arrondissement": "iris_arrondissement",
        },
    )
    return lookup.add_micro_keys(placed)


def sales_outputs(placed: DataFrame) -> dict[str, DataFrame]:
    """The sales at every grain below the district, the published sales and their coverage."""
    return {
        "gold_sales_geocoded": project_existing(placed, GEOCODED_COLUMNS),
        "gold_sales_quartier": sales_ops.sales_by_quartier(placed),
        "gold_sales_iris": sales_ops.sales_by_iris(placed),
        "gold_sales_street": sales_ops.sales_by_street(placed),
        "gold_sales_building": sales_ops.sales_by_building(placed),
        "gold_spatial_coverage": coverage(placed),
    }


def line_text(parts: Column) -> Column:
    """GeoJSON text of a line with one or more parts."""
    pairs = F.transform(parts, lambda part: F.transform(part, lambda p: F.array(p["x"], p["y"])))
    one = F.concat(F.lit('{"type":"LineString","coordinates":'), F.to_json(pairs[0]), F.lit("}"))
    many = F.concat(F.lit('{"type":"MultiLineString","coordinates":'), F.to_json(pairs), F.lit("}"))
    return F.when(F.size(parts) == 1, one).otherwise(many)


def street_features(streets: DataFrame, districts: DataFrame) -> DataFrame:
    """Every street cut at the district borders: one feature per street and district."""
    zones = districts.withColumn("commune_insee", F.col("insee_code").cast("string"))
    names = ["street_ref_id", "street_name", "display_name"]
    cut = clip_lines(streets, zones, "line_index", ["arrondissement", "commune_insee"], carried=names, in_ranges=True)
    features = cut.select(
        "line_index",
        "street_ref_id",
        street_key(F.col("commune_insee"), F.col("street_name")).alias("street_key"),
        "street_name",
        "display_name",
        "arrondissement",
        "commune_insee",
        line_text(F.col("parts")).alias("geometry"),
    )
    placed = numbered(features, "feature_index", "line_index", "arrondissement", in_ranges=True)
    return placed.select("feature_index", *[name for name in features.columns if name != "line_index"])


def environment(cells: DataFrame, districts: DataFrame) -> DataFrame:
    """Noise and air per district; outlines are projected to the metres of the cells."""
    zones = districts.withColumn("rings", geo.project_lambert93(F.col("rings")))
    inside = prepare_cells(cells, layer_extent(zones), parsed=True)
    return context.environment_metrics(assign_cells(inside, zones, "arrondissement"), zones)


def dashboard_document(
    summary: DataFrame, sales: DataFrame, social: DataFrame, rents: DataFrame, covered: DataFrame
) -> DataFrame:
    """One row with everything the dashboard starts from. The record list has one entry per district."""
    years = context.available_years({"sales": sales, "social": social, "rent": rents})
    city = city_summary(summary)
    records = summary.select(F.struct(*summary.columns).alias("record"))

    def of(fact: str, column: str) -> Column:
        return F.max(F.when(F.col("fact") == fact, F.col(column)))

    facts = ("sales", "social", "rent")
    return years.agg(
        *[of(fact, "latest_year").alias(f"latest_{fact}_year") for fact in facts],
        *[of(fact, "years").alias(f"available_{fact}_years") for fact in facts],
    ).select(
        F.current_timestamp().alias("generated_at"),
        "*",
        city.select(F.struct(*city.columns).alias("c")).scalar().alias("city_summary"),
        records.agg(F.sort_array(F.collect_list("record")).alias("a")).scalar().alias("arrondissements"),
        covered.select(F.struct(*covered.columns).alias("c")).scalar().alias("spatial_sales_coverage"),
        metric_catalog_column().alias("metrics"),
    )


def build_gold(inputs: Inputs, include_noise: bool = True) -> dict[str, DataFrame]:
    """Every published output, keyed by gold name.

    The placed sales and the small tables that later steps read again are staged once.
    """
    sales = project_existing(inputs.sales, SALE_COLUMNS)
    placed = staged(
        place_sales(sales, inputs.addresses, inputs.links, inputs.quartiers, inputs.iris, inputs.fetched_links), "placed-sales"
    )
    outputs = sales_outputs(placed)
    outputs["gold_spatial_coverage"] = staged(outputs["gold_spatial_coverage"], "coverage")
    sales = staged(sales_ops.sales_by_district(placed), "sales")
    rents = staged(context.rent_metrics(inputs.rents), "rents")
    social = staged(context.social_metrics(inputs.social), "social")
    income = staged(context.income_metrics(inputs.income), "income")
    if include_noise:
        if inputs.cells is None:
            raise FileNotFoundError("the noise layer is missing; build with include_noise=False to go without")
        noise = staged(environment(inputs.cells, inputs.districts), "noise")
    else:
        noise = context.neutral_environment(inputs.districts)
    table = inputs.districts.select("arrondissement", "name", "label", "insee_code", "postal_code", "surface_m2")
    summary = staged(build_summary(table, sales, income, rents, social, noise), "summary")
    return outputs | {
        "gold_sales": sales,
        "gold_rents": rents,
        "gold_social": social,
        "gold_income": income,
        "gold_noise": noise,
        "gold_summary": summary,
        "gold_geojson": inputs.districts.drop("postal_code"),
        "gold_quartiers_geojson": inputs.quartiers,
        "gold_iris_geojson": inputs.iris,
        "gold_streets_geojson": street_features(inputs.streets, inputs.districts),
        "gold_dashboard": dashboard_document(summary, sales, social, rents, outputs["gold_spatial_coverage"]),
    }
