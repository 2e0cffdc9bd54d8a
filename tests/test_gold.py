from __future__ import annotations

import dataclasses
import json
import os

import pytest
from pyspark.sql import functions as F

from citygrain.plans import gold, serving
from citygrain.plans.catalog import DOCUMENTS, FEATURE_COLLECTIONS, METRIC_CATALOG, TABLES
from citygrain.plans.validation import validate
from citygrain.session import scratch, staged
from citygrain.sources.store import Store, publish_all
from tests import files
from tests.conftest import values


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    paths = files.all_inputs(str(tmp_path_factory.mktemp("raw")))
    # Cells in projected metres: one square kilometre in the middle of either district.
    cells = spark.createDataFrame(
        [(23, 662000.0, 6825000.0, 664000.0, 6826000.0), (11, 664000.0, 6825000.0, 665000.0, 6826000.0)],
        "category int, minx double, miny double, maxx double, maxy double",
    )
    inputs = dataclasses.replace(gold.read_inputs(spark, paths), cells=cells)
    target = Store(spark, root=str(tmp_path_factory.mktemp("published")))
    written = publish_all(target, gold.build_gold(inputs))
    assert len(written) == 27
    return target


@pytest.fixture(scope="module")
def tables(store):
    names = {**TABLES, **DOCUMENTS}
    out = {name: store.read(target) for name, target in names.items()}
    return out | {name: store.read_features(target) for name, target in FEATURE_COLLECTIONS.items()}


def test_fetched_links_are_taken_for_parcels_that_need_them(spark, tmp_path, store):
    """A parcel that no address places and the cache lacks takes its fetched rows; others are ignored."""
    inputs = gold.read_inputs(spark, files.all_inputs(str(tmp_path)))
    sold = store.read(TABLES["gold_sales_geocoded"]).select("house_number", "parcel_id").collect()
    parcels = {row["house_number"]: row["parcel_id"] for row in sold if row["parcel_id"]}
    cached = {row["idu"] for row in inputs.links.collect()}
    fetched = [(parcels["98"], "75101_L", "CAD", "1", "1"), (parcels["99"], "75101_R1", "CAD", "1", "1"), ("751010000X0001", "75101_R1", "CAD", "1", "1")]
    columns = "idu string, id_adr string, type_lien string, nb_adr string, nb_parc string"
    found = {}
    for name, links in (("all", inputs.links), ("some", inputs.links.where(F.col("idu") != parcels["98"]))):
        placed = gold.place_sales(inputs.sales, inputs.addresses, links, inputs.quartiers, inputs.iris, spark.createDataFrame(fetched, columns))
        found[name] = {row["house_number"]: row["matched_cle_interop"] for row in placed.where("house_number in ('98', '99')").collect()}
    assert parcels["98"] in cached and parcels["99"] in cached  # what the cache has is not replaced
    assert found == {"all": {"98": None, "99": "75101_L"}, "some": {"98": "75101_L", "99": "75101_L"}}
    references = [gold.lookup.dedupe_reference(inputs.addresses, key) for key in ("address_key", "address_key_no_suffix", "cle_interop")]
    alone = gold.refreshed_links(inputs.sales, references, None, spark.createDataFrame(fetched, columns))
    assert {row["idu"] for row in alone.where("id_adr <> ''").collect()} == {parcels["98"], parcels["99"]}


def test_staged_folders_go_with_their_block(spark, tmp_path):
    with scratch(spark):
        kept = staged(spark.range(5), "block")
        folder = os.path.dirname(kept.inputFiles()[0].removeprefix("file://"))
        assert os.path.isdir(folder) and kept.count() == 5
    assert not os.path.exists(folder)


def test_everything_is_valid(store):
    assert validate(store).count() == 0


def test_silver_tables_hold_the_rows_of_their_twins(tables):
    assert tables["silver_sales_building"].count() == tables["gold_sales_building"].count() > 0


def test_geocoding(tables):
    rows = tables["gold_sales_geocoded"].orderBy("year", "Date mutation", "house_number").collect()
    assert [(r["house_number"], r["matched_cle_interop"], r["geocode_source"], r["quartier_name"], r["iris_name"]) for r in rows] == [
        ("1", "75101_R1", "adresses-ban", "Halles", "Un"),
        ("1", "75101_R1", "adresses-ban", "Halles", "Un"),
        ("7", "75101_R7", "adresses-ban", "Halles", None),
        ("98", None, None, None, None),
        ("99", "75101_L", "ban-plus", "Halles", None),
        ("2", "75102_P2", "adresses-ban", "Gaillon", None),
        ("1", "75101_R1", "adresses-ban", "Halles", "Un"),
    ]


def test_coverage(tables):
    row = tables["gold_spatial_coverage"].first().asDict()
    assert (row["input_rows"], row["input_transactions"], row["geocoded_rows"]) == (7, 6, 6)
    assert (row["adresses_ban_rows"], row["ban_plus_rows"], row["iris_rows"]) == (5, 1, 3)
    assert (row["street_count"], row["street_year_rows"], row["building_count"], row["building_year_rows"]) == (2, 3, 5, 6)
    assert row["geocoded_rate_pct"] == 85.71


def test_grains(tables):
    found = tables["gold_sales"].orderBy("arrondissement", "year")
    assert values(found, "arrondissement", "year", "transactions", "median_price_m2", "house_share_pct") == [
        (1, 2024, 4, 8000.0, 0.0), (1, 2025, 1, 10000.0, 0.0), (2, 2024, 1, 6000.0, 100.0),
    ]
    street = tables["gold_sales_street"].where("street_key = '75101|RUE RIVOLI' and year = 2024").first()
    assert (street["buildings"], street["geocoded_transactions"], street["transactions"]) == (4, 3, 4)


def test_street_features_are_cut_at_the_border(tables):
    found = tables["gold_streets_geojson"].collect()
    shapes = {(row["street_key"]): json.loads(row["geometry"]) for row in found}
    assert shapes == {
        "75101|RUE RIVOLI": {"type": "LineString", "coordinates": [[2.5, 48.5], [3.0, 48.5]]},
        "75102|RUE RIVOLI": {"type": "LineString", "coordinates": [[3.0, 48.5], [3.5, 48.5]]},
        "75102|RUE PAIX": {
            "type": "MultiLineString",
            "coordinates": [[[3.25, 48.25], [3.5, 48.25]], [[3.75, 48.75], [4.0, 48.75]]],
        },
    }


def test_summary(tables):
    rows = {row["arrondissement"]: row.asDict() for row in tables["gold_summary"].collect()}
    one, two = rows[1], rows[2]
    assert (one["sales_year"], one["rent_year"], one["social_year"]) == (2025, 2025, 2024)
    assert (one["median_price_m2"], two["median_price_m2"]) == (10000.0, None)
    assert (two["reference_rent_eur_m2"], two["social_units_financed"], two["share_taxable_pct"]) == (27.0, 0.0, 65.0)
    assert one["months_income_for_1sqm"] == 3.87 and one["social_units_financed_5y"] == 34.0
    assert (one["noise_score"], one["air_score"], one["high_noise_share_pct"], one["noise_cell_count"]) == (2.333, 1.667, 66.67, 2)
    assert (two["noise_score"], two["noise_cell_count"]) == (0.0, 0)


def test_dashboard_document(tables):
    row = tables["gold_dashboard"].first()
    assert row["available_sales_years"] == [2024, 2025] and row["latest_rent_year"] == 2025
    assert set(row["metrics"]) == set(METRIC_CATALOG)
    assert [item["arrondissement"] for item in row["arrondissements"]] == [1, 2]
    assert row["city_summary"]["arrondissement_count"] == 2 and row["spatial_sales_coverage"]["input_rows"] == 7


def test_serving_the_published_tables(tables):
    overview = serving.overview(tables["gold_summary"], tables["gold_sales"], 2024)
    assert sorted(values(overview, "arrondissement", "median_price_m2", "rank_by_price")) == [(1, 8000.0, 1), (2, 6000.0, 2)]
    assert serving.overview_city(tables["gold_summary"], tables["gold_sales"], 2024).first()["median_price_m2"] == 7000.0
    delta = serving.compare_districts(tables["gold_summary"], tables["gold_sales"], 1, 2, 2024)
    assert dict(values(delta, "metric", "delta"))["median_price_m2"] == 2000.0
    # In 2025 district 2 has no sales: its price is left out.
    late = serving.compare_districts(tables["gold_summary"], tables["gold_sales"], 1, 2)
    assert "median_price_m2" not in dict(values(late, "metric", "delta"))
    options = serving.quartiers(tables["gold_summary"], tables["gold_sales_quartier"], 2024)
    assert values(options, "quartier_id", "arrondissement_name") == [("7510101", "Louvre"), ("7510201", "Bourse")]
    line = serving.timeline(tables["gold_summary"], tables["gold_sales"], tables["gold_social"], tables["gold_rents"], 1)
    assert line.where("series = 'sales' and metric = 'transactions'").orderBy("year").select("value").collect() == [(4.0,), (1.0,)]


@pytest.mark.parametrize(
    "level, metric, year, count",
    [("arrondissement", "noise_score", None, 2), ("quartier", "transactions", 2025, 2), ("street", "transactions", 2024, 2), ("building", "median_rooms", 2024, 4)],
)
def test_map_layers(tables, level, metric, year, count):
    layer = serving.map_layer(tables, metric, year, level)
    rows = layer.collect()
    assert len(rows) == count and {row["map_level"] for row in rows} == {level}
    assert {row["metric_year"] for row in rows} == {None if metric == "noise_score" else year}
    for row in rows:
        assert row["metric_value"] == row[metric]


def test_quartier_without_sales_keeps_its_outline(tables):
    layer = serving.map_layer(tables, "transactions", 2025, "quartier")
    assert dict(values(layer, "name", "metric_value")) == {"Halles": 1, "Gaillon": None}


def test_impossible_requests(tables):
    summary, sales, quartiers = tables["gold_summary"], tables["gold_sales"], tables["gold_sales_quartier"]
    with pytest.raises(LookupError):
        serving.overview(summary, sales, 1999)
    with pytest.raises(LookupError):
        serving.timeline(summary, sales, tables["gold_social"], tables["gold_rents"], 20)
    with pytest.raises(LookupError):
        serving.compare_districts(summary, sales, 1, 20)
    with pytest.raises(LookupError):
        serving.compare_quartiers(quartiers, "7510101", "none")
    with pytest.raises(LookupError):
        serving.map_layer(tables, "no_such_metric")
    with pytest.raises(LookupError):
        serving.map_layer(tables, "transactions", None, "planet")
    with pytest.raises(ValueError):
        serving.map_layer(tables, "noise_score", None, "street")
    with pytest.raises(LookupError):
        serving.map_districts(tables["gold_geojson"].withColumn("arrondissement", F.lit(9)), summary, sales, "transactions")


def test_a_quartier_met_in_two_districts_keeps_the_last(spark):
    columns = "quartier_id string, quartier_name string, arrondissement int, year int, " + ", ".join(
        f"{name} double" for name in serving.METRICS
    )
    rows = [("q", "a", 2, 2024, *[1.0] * 7), ("q", "a", 3, 2024, *[5.0] * 7), ("r", "b", 3, 2024, *[1.0] * 6, None)]
    delta = serving.compare_quartiers(spark.createDataFrame(rows, columns), "q", "r")
    assert sorted(values(delta, "metric", "delta")) == sorted((name, 4.0) for name in serving.METRICS[:-1])


def test_noise_layer_can_be_left_out(spark, tables):
    districts = tables["gold_geojson"]
    from citygrain.operators.context import neutral_environment

    assert values(neutral_environment(districts).orderBy("arrondissement"), "arrondissement", "noise_score") == [(1, 2.0), (2, 2.0)]


def test_validation_names_what_is_missing(spark, tmp_path, store):
    empty = Store(spark, root=str(tmp_path))
    assert validate(empty).count() == 10
    broken = Store(spark, root=str(tmp_path / "broken"))
    for name, target in (TABLES | FEATURE_COLLECTIONS | DOCUMENTS).items():
        frame = store.read(target)
        broken.write(target, frame.drop("median_price_m2") if name == "gold_sales_street" else frame)
    assert [tuple(row) for row in validate(broken).collect()] == [("gold_sales_street", "missing column", "median_price_m2")]
    broken.write(TABLES["gold_sales_street"], store.read(TABLES["gold_sales_street"]))
    dashboard = store.read(DOCUMENTS["gold_dashboard"]).withColumn("metrics", F.map_filter("metrics", lambda key, _: key != "air_score"))
    broken.write(DOCUMENTS["gold_dashboard"], dashboard.drop("generated_at"))
    assert sorted(tuple(row) for row in validate(broken).collect()) == [
        ("gold_dashboard", "missing key", "generated_at"), ("gold_dashboard", "missing metric", "air_score"),
    ]


def test_numbers_go_by_ranges_that_are_there(spark):
    from citygrain.operators.numbering import numbered

    rows = spark.range(400).select((F.col("id") * 7 % 400).alias("a"), (F.col("id") % 3).alias("b"))
    want = [(a, i) for i, a in enumerate(range(400))]
    for dealt in (rows.repartitionByRange(5, "a"), rows.repartition(5, "b"), rows.repartition(5, "a")):
        assert sorted(values(numbered(dealt, "n", "a", "b", in_ranges=True), "a", "n")) == want
        assert sorted(values(numbered(dealt, "n", "a", "b"), "a", "n")) == want
    unknown = rows.withColumn("a", F.when(F.col("a") > 10, F.col("a"))).repartitionByRange(5, "a")
    found = sorted(row["n"] for row in numbered(unknown, "n", "a", in_ranges=True).collect())
    assert found == list(range(400))


def test_numbering_takes_no_window_over_the_rows(spark):
    from citygrain.operators.numbering import numbered

    plan = numbered(spark.range(100), "n", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_one_large_tier_leaves_the_sales_their_keys(spark, monkeypatch):
    """Sales are shuffled for the parcels alone, and meet their own keys again only where two tiers are large."""
    from citygrain.operators import lookup

    schema = "lookup_key string, cle_interop string, long double, lat double"
    one = spark.createDataFrame([("k1", "a1", 1.0, 2.0)], schema)
    by_id = spark.createDataFrame([("a2", "a2", 3.0, 4.0)], schema)
    links = spark.createDataFrame([("p2", "a2", "GEO")], "idu string, id_adr string, type_lien string")
    sales = spark.createDataFrame([("k1", "n1", "p1"), ("k2", "n2", "p2"), (None, None, None)], "address_key string, address_key_no_suffix string, parcel_id string")
    found = {}
    for large in ([links], [one, links], []):
        monkeypatch.setattr(lookup, "estimated_bytes", lambda side: 10**12 if any(side is own for own in large) else 1)
        placed = lookup.geocode(sales, one, by_id, by_id, links)
        found[len(large)] = placed._jdf.queryExecution().optimizedPlan().toString().count("Join"), sorted(values(placed, "parcel_id", "longitude"), key=str)
    assert found[0] == found[1] and found[1][0] < found[2][0] and found[1][1] == found[2][1]
