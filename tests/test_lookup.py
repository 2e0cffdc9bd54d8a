from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from citygrain.operators import lookup as ops
from tests.conftest import values

REFERENCE = "cle_interop string, address_key string, certification_commune double, long double, lat double"


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_dedupe_takes_the_best_id_and_the_median_position(spark, hot_rows):
    rows = [
        ("b", "k", 1.0, 1.0, 10.0),
        ("a", "k", 1.0, 3.0, 20.0),
        ("0", "k", 0.0, 9.0, 60.0),
        (None, "k", 9.0, 5.0, 30.0),
        (None, "only", 0.0, 4.0, 4.0),
        ("x", None, 0.0, 4.0, 4.0),
    ]
    found = ops.dedupe_reference(spark.createDataFrame(rows, REFERENCE), "address_key", hot_rows=hot_rows)
    assert sorted(values(found, "lookup_key", "cle_interop", "long", "lat")) == [
        ("k", "a", 4.0, 25.0),
        ("only", None, 4.0, 4.0),
    ]


def test_best_link(spark):
    rows = [
        ("p", "z", "GEO", "2", ""),
        ("p", "y", "GEO", "bad", ""),
        ("p", "a", "BAN", "1", ""),
        ("p", "", "GEO", "1", ""),
        ("p", None, "GEO", "1", ""),
        ("q", "c", None, "1", ""),
        ("q", "b", "X", "1", ""),
        ("q", "d", "X", None, ""),
        ("r", "", "GEO", "1", ""),
        (None, "a", "GEO", "1", ""),
    ]
    links = spark.createDataFrame(rows, "idu string, id_adr string, type_lien string, nb_adr string, nb_parc string")
    assert sorted(values(ops.best_link(links), "idu", "id_adr", "type_lien")) == [("p", "z", "GEO"), ("q", "b", "X")]


SALES = "id int, address_key string, address_key_no_suffix string, parcel_id string"
LOOKUP = "lookup_key string, cle_interop string, long double, lat double"


def cascade(spark, with_links=True, by_keys=None):
    sales = spark.createDataFrame(
        [
            (1, "k1", "n1", "p1"),  # exact address
            (2, "k?", "n1", "p1"),  # without suffix
            (3, "k?", "n?", "p1"),  # by parcel
            (4, "k?", "n?", "p2"),  # the parcel's address has no position
            (5, "k?", "n?", None),  # no parcel
            (6, "k?", "n?", "p?"),  # unknown parcel
            (7, "noid", "n1", "p1"),  # a position without an id
        ],
        SALES,
    )
    exact = spark.createDataFrame([("k1", "A", 1.0, 2.0), ("noid", None, 8.0, 9.0)], LOOKUP)
    loose = spark.createDataFrame([("n1", "B", 3.0, 4.0)], LOOKUP)
    by_id = spark.createDataFrame([("C", "C", 5.0, 6.0)], LOOKUP)
    links = spark.createDataFrame([("p1", "C", "GEO"), ("p2", "D", "GEO")], "idu string, id_adr string, type_lien string")
    found = ops.geocode(sales, exact, loose, by_id, links if with_links else None, by_keys)
    names = ("id", "matched_cle_interop", "longitude", "latitude", "geocode_source")
    return sorted(values(found, *names))


@pytest.mark.parametrize("by_keys", [None, True, False])
def test_geocode_cascade(spark, by_keys):
    assert cascade(spark, by_keys=by_keys) == [
        (1, "A", 1.0, 2.0, "adresses-ban"),
        (2, "B", 3.0, 4.0, "adresses-ban"),
        (3, "C", 5.0, 6.0, "ban-plus"),
        (4, "D", None, None, None),
        (5, None, None, None, None),
        (6, None, None, None, None),
        (7, None, 8.0, 9.0, None),
    ]


def test_geocode_without_links(spark):
    assert [row[1:] for row in cascade(spark, False)[2:6]] == [(None, None, None, None)] * 4


def test_merge_links(spark):
    columns = "idu string, id_adr string, type_lien string, nb_adr string, nb_parc string, seq int"
    cache = spark.createDataFrame(
        [("a", "1", "G", "old", "", 1), ("a", "1", "G", "new", "", 2), ("b", None, None, "x", "", 3)], columns
    )
    fetched = spark.createDataFrame([("c", "2", "G", "1", "", 1), ("a", "9", "G", "1", "", 2)], columns)
    requested = spark.createDataFrame([("a",), ("c",), ("d",), ("",), (None,), ("d",)], "idu string")
    found = ops.merge_links(cache, fetched, requested)
    assert sorted(values(found, "idu", "id_adr", "nb_adr"), key=str) == sorted(
        [("a", "1", "new"), ("b", None, "x"), ("c", "2", "1"), ("d", "", "")], key=str
    )


def test_last_per_key_keeps_null_keys_apart(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 5), ("a", None)], "k string, v int")
    assert sorted(values(ops.last_per_key(df, ["k"], ["v"]), "k", "v"), key=str) == [("a", 5), (None, 2)]


def test_micro_keys(spark):
    df = spark.createDataFrame(
        [("75101", "RUE X", "1", "BIS", None, "P", "75101|1|BIS|RUE X"), ("75101", "", "", "", None, None, "75101|||")],
        "commune_insee string, street_name string, house_number string, house_suffix string,"
        " matched_cle_interop string, parcel_id string, address_key string",
    )
    found = values(ops.add_micro_keys(df), "street_key", "building_id", "building_id_source", "building_label")
    assert found == [
        ("75101|RUE X", "P", "parcel", "1 BIS RUE X"),
        (None, "75101|||", "address_key", "75101|||"),
    ]


def test_a_dominant_address_keeps_every_row(spark):
    sales = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("address_key"),
        F.lit("x").alias("address_key_no_suffix"),
        F.lit(None).cast("string").alias("parcel_id"),
    )
    reference = spark.createDataFrame([("hot", "H", 1.0, 1.0)], LOOKUP)
    none = spark.createDataFrame([], LOOKUP)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ops.geocode(sales, reference, none, none)
        assert found.count() == 20_000
        assert found.where("longitude = 1").count() == 6_667
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
