from __future__ import annotations

import json

import pytest

from citygrain.operators import context, numbering
from citygrain.operators.sales import sales_from_raw
from citygrain.sources import files as ops
from citygrain.sources.store import Store
from tests import files
from tests.conftest import values


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return files.all_inputs(str(tmp_path_factory.mktemp("raw")))


def test_national_file_is_cut_to_one_department(spark, tmp_path):
    header = files.SALES_HEADER.replace(",", "|")
    line = "d|Vente|1|1||RUE|X|75001|{}|101||AB|1|||Maison|50|2"
    path = files.write(str(tmp_path / "national.txt"), header, *[line.format(dep) for dep in ("75", "92", "075", "")])
    kept = ops.read_national_sales(spark, path)
    assert values(kept, "Code departement", "Voie") == [("75", "X")]
    landed = ops.land_sales(kept, str(tmp_path / "dvf"), 2024)
    again = ops.read_sales(spark, str(tmp_path / "dvf" / "*.csv"))
    assert landed.endswith("valeursfoncieres-2024-paris.csv")
    assert values(again, "Code departement", "Prefixe de section", "year") == [("75", None, 2024)]


def test_sales_files(spark, paths):
    raw = ops.read_sales(spark, paths["sales"])
    assert raw.columns == [*ops.SALES_COLUMNS, "year"]
    assert sorted(row["year"] for row in raw.collect()) == [2024] * 8 + [2025]
    sales = sales_from_raw(raw)
    assert sales.count() == 7
    row = sales.where("year = 2025").first()
    assert row["transaction_id"] == "06/02/2025|700000|75101000AB0012|1|RUE RIVOLI|Appartement|70"
    assert (row["address_key"], row["address_key_no_suffix"]) == ("75101|1||RUE RIVOLI", "75101|1|RUE RIVOLI")


def test_no_sales_file_is_an_error(spark, tmp_path):
    files.write(str(tmp_path / "valeurs-paris.csv"), "a,b", "1,2")
    with pytest.raises(FileNotFoundError):
        ops.read_sales(spark, str(tmp_path / "*.csv"))


def test_missing_marks(spark, tmp_path):
    path = files.write(str(tmp_path / "t.csv"), "a;b", "NA;1", "x;null", '"q ""q""";')
    assert values(ops.read_text_table(spark, path, ";"), "a", "b") == [(None, "1"), ("x", None), ('q "q"', None)]


def test_addresses(spark, paths):
    found = ops.read_addresses(spark, paths["addresses"])
    assert sorted(row["address_key"] for row in found.collect()) == [
        "75101|1||RUE DE RIVOLI", "75101|1||RUE RIVOLI", "75101|5||RUE AUTRE", "75101|7||RUE RIVOLI", "75102|2||RUE PAIX",
    ]


def test_income(spark, paths):
    found = context.income_metrics(ops.read_income(spark, paths["income"]))
    names = ("arrondissement", "iris_count", "median_income_eur", "poverty_rate_pct", "share_taxable_pct")
    assert sorted(values(found, *names)) == [(1, 2, 31000.0, 10.5, 65.0), (2, 1, 28000.0, 12.0, None)]


def test_rents(spark, paths):
    found = context.rent_metrics(ops.read_rents(spark, paths["rents"]))
    assert sorted(values(found, "arrondissement", "year", "reference_rent_eur_m2", "rent_reference_count")) == [
        (1, 2024, 25.5, 1), (1, 2025, 27.0, 2),
    ]


def test_social(spark, paths):
    social = context.social_metrics(ops.read_social(spark, paths["social"]))
    names = ("arrondissement", "year", "program_count", "social_units_financed", "pls_units")
    assert sorted(values(social, *names)) == [(1, 2019, 1, 100.0, 1.0), (1, 2020, 1, 10.0, 2.0), (1, 2024, 1, 24.0, 2.0)]
    recent = context.sum_last_years(social, 5, "social_units_financed", "n")
    assert values(recent, "arrondissement", "n") == [(1, 34.0)]


def test_outlines(spark, paths):
    districts = ops.read_districts(spark, paths["districts"]).orderBy("feature_index").collect()
    assert [(row["feature_index"], row["arrondissement"], row["surface_m2"], row["postal_code"]) for row in districts] == [
        (0, 1, 1824.62, "75001"), (1, 2, 991.13, "75002"),
    ]
    assert [len(row["rings"][0]) for row in districts] == [5, 5]
    assert json.loads(districts[1]["geometry"])["type"] == "MultiPolygon"
    quartiers = ops.read_quartiers(spark, paths["quartiers"]).orderBy("feature_index")
    assert values(quartiers, "quartier_id", "quartier_code", "name") == [("7510101", 1, "Halles"), ("7510201", 5, "Gaillon")]
    iris = ops.read_iris(spark, paths["iris"]).collect()
    assert [(row["iris_code"], row["arrondissement"], len(row["rings"][0])) for row in iris] == [("751010101", 1, 5)]


def test_streets(spark, paths):
    found = ops.read_streets(spark, paths["streets"]).orderBy("line_index").collect()
    assert [(row["street_ref_id"], row["street_name"], row["display_name"], len(row["parts"])) for row in found] == [
        ("s1", "RUE RIVOLI", "rue de Rivoli", 1), ("7", "RUE PAIX", "RUE PAIX", 2),
    ]


@pytest.mark.parametrize("kind", ["path", "catalog"])
def test_store_round_trip(spark, tmp_path, kind):
    store = Store(spark, root=str(tmp_path / "store")) if kind == "path" else Store(spark, database="default")
    name = f"round_trip_{kind}"
    assert not store.exists(name)
    store.write(name, spark.range(10))
    store.write(name, spark.range(3))
    assert store.exists(name) and store.read(name).count() == 3


def test_features_come_back_in_order(spark, tmp_path):
    store = Store(spark, root=str(tmp_path))
    rows = [(i, f"g{i}", f"n{i}") for i in (5, 1, 9, 0, 3)]
    store.write_features("f", spark.createDataFrame(rows, "feature_index bigint, geometry string, name string"))
    found = store.read_features("f")
    assert [tuple(row) for row in found.collect()] == sorted(rows)
    assert "updated_at" in store.read("f").columns


def test_files_of_one_year_may_order_their_columns_differently(spark, tmp_path):
    names = list(ops.SALES_COLUMNS)
    for part, order in enumerate((names, names[::-1])):
        row = {name: f"{name}-{part}" for name in names}
        lines = [",".join(f'"{item}"' for item in line) for line in (order, [row[name] for name in order])]
        (tmp_path / f"valeursfoncieres-2023-{part}.csv").write_text("\n".join(lines) + "\n")
    found = ops.read_sales(spark, str(tmp_path)).collect()
    assert len(found) == 2
    for row in found:
        part = row[names[0]][-1]
        assert row["year"] == 2023 and all(row[name] == f"{name}-{part}" for name in names)


def test_lines_of_several_files_have_numbers_of_their_own(spark, tmp_path):
    def street(name):
        shape = {"type": "LineString", "coordinates": [[0, 0], [3, 4]]}
        return {"type": "Feature", "properties": {"l_voie": name, "objectid": name}, "geometry": shape}

    for file, names in (("a", ["one", "two"]), ("b", ["three", "one"])):
        (tmp_path / "docs").mkdir(exist_ok=True)
        (tmp_path / "lines").mkdir(exist_ok=True)
        features = [street(name) for name in names]
        (tmp_path / "docs" / f"{file}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
        (tmp_path / "lines" / f"{file}.geojson").write_text("\n".join(map(json.dumps, features)) + "\n")
    for folder, lines in (("docs", False), ("lines", True)):
        found = ops.read_streets(spark, str(tmp_path / folder), lines).orderBy("line_index").collect()
        assert [(row["line_index"], row["street_ref_id"]) for row in found] == [(0, "one"), (1, "two"), (2, "three"), (3, "one")]


def test_quoted_line_breaks_are_an_option(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    assert ops.read_text_table(spark, str(tmp_path / "t.csv"), multiline=True).count() == 2


def test_numbers_and_ranks_of_whole_frames(spark):
    rows = [(n, None if n % 7 == 0 else float(n % 5)) for n in range(200)]
    frame = spark.createDataFrame(rows, "id int, value double").repartition(5)
    found = numbering.numbered(frame, "place", "value", "id").orderBy("place").collect()
    assert [(row["place"], row["id"]) for row in found] == list(
        enumerate(row[0] for row in sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0.0, row[0])))
    )
    plain = [value for _, value in rows if value is not None]
    for row in numbering.with_rank(frame, "value").collect():
        expected = None if row["value"] is None else 1 + sum(value > row["value"] for value in plain)
        assert row["rank_by_price"] == expected
    assert numbering.numbered(frame.where("id < 0"), "place", "id").count() == 0
    assert numbering.with_rank(frame.where("id < 0"), "value").count() == 0


def test_headers_of_many_files_take_as_many_jobs_as_of_few(spark, tmp_path):
    names = list(ops.SALES_COLUMNS)
    context = spark.sparkContext

    def jobs(count):
        folder = tmp_path / f"of {count} 20%25"
        folder.mkdir()
        for part in range(count):
            order = names if part % 2 else names[::-1]
            lines = ["", ",".join(f'"{name}"' for name in order), ",".join(str(part) for _ in order)]
            (folder / f"sales {2020 + part % 3} part {part}.csv").write_text("\n".join(lines) + "\n")
        (folder / "valeurs-2024-empty.csv").write_text("")
        context.setJobGroup(f"headers-{count}", "headers")
        found = ops.read_sales(spark, str(folder))
        context.setJobGroup("", "")
        rows = {(row["year"], int(row["Section"]), int(row["Voie"])) for row in found.collect()}
        assert rows == {(2020 + part % 3, part, part) for part in range(count)}
        return len(context.statusTracker().getJobIdsForGroup(f"headers-{count}"))

    assert jobs(6) == jobs(40) <= 5


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    """Braces, brackets and quotes in strings, nested values, members before and behind the list; the rows of the whole reader."""
    awkward = ['plain', 'a } b', 'a { [ ] }', 'say \\"hi\\" } {', 'back\\\\', 'tail \\\\\\"}', '"features": [ {', 'é } 雪', '', '}}}}', 'x' * 300]
    rows = []
    for i in range(400):
        name = awkward[i % len(awkward)].replace("\\\\", "\\").replace('\\"', '"')
        shape = [[[i, 0.5], [i + 1, 0.5], [i + 1, 2], [i, 0.5]]]
        rows.append({"type": "Feature", "properties": {"name": name, "number": str(i), "more": {"deep": [{"a": "}"}, [1, {}]]}}, "geometry": {"type": "Polygon", "coordinates": shape}})
    head = '{"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn } x"}},\n "features" : [ '
    (tmp_path / "a.json").write_text(head + ",\n".join(json.dumps(row, ensure_ascii=i % 2 == 0) for i, row in enumerate(rows)) + ' ], "bbox": [0, {"x": {}}]}\n', encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps({"features": rows[:3], "type": "FeatureCollection"}), encoding="utf-8")
    (tmp_path / "c.json").write_text('{"type": "FeatureCollection", "features": []}')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        cut = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert cut.rdd.getNumPartitions() > 5
        found = ops.read_features(spark, str(tmp_path), ("name", "number"), split=True).orderBy("origin").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    whole = ops.read_features(spark, str(tmp_path), ("name", "number")).orderBy("origin").collect()

    def read(rows):
        return [(row["name"], row["number"], json.loads(row["geometry"]), row["parts"]) for row in rows]

    assert len(found) == 403 and read(found) == read(whole)
