from __future__ import annotations

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from citygrain.functions import geo, indicators
from citygrain.functions import keys as k
from citygrain.functions import numbers as n
from citygrain.functions import records as r
from citygrain.functions import text as t


def apply(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(inputs)], f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()
    return [row["out"] for row in rows]


@pytest.mark.parametrize(
    "expression, cases",
    [
        (
            k.postal_to_district,
            {"75116": 16, "75001": 1, "75020": 20, "75021": None, "7501": None, "92100": None, "": None, None: None},
        ),
        (t.normalize_house_number, {"0012": "12", "000": "000", "12B": "12", None: ""}),
        (t.normalize_suffix, {"b": "BIS", "ter": "TER", "Q": "QUATER", "C": "C", None: ""}),
        (
            t.normalize_street,
            {
                "Bd Saint-Michel": "BOULEVARD SAINT MICHEL",
                "Rue de l’Élysée": "RUE DE LELYSEE",
                "R. du Sœur": "R DU SUR",
                "l'Hôtel": "L HOTEL",
                None: "",
            },
        ),
        (
            n.french_to_double,
            {
                "1 234,50": 1234.5,
                "1 234,50": 1234.5,
                "12d": None,
                "0x1p3": None,
                "": None,
                "-3,5e2": -350.0,
                ".5": 0.5,
                "nan": None,
                None: None,
            },
        ),
        (lambda c: n.zfill(c, 3), {"12345": "12345", "": "000", "7": "007"}),
        (k.code_to_district, {"751165": 16, "75": None, "ABC7": 7}),
    ],
)
def test_text_cases(spark, expression, cases):
    assert apply(spark, expression, list(cases)) == list(cases.values())


def test_normalize_text_agrees_with_unicode_decomposition(spark):
    texts = ["½ mille ﬁn ™ ℡", "日本 12", "ĳsselmeer Ŀ ŉ", "𝐀𝐁c", "a b\tc\nd", "…", "ß œ Æ", "ǅ"]
    texts += [f"a{chr(code)}b" for code in range(0x80, 0x600)]

    def expected(value):
        ascii_text = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
        return " ".join(re.findall("[A-Z0-9]+", ascii_text.upper()))

    assert apply(spark, t.normalize_text, texts) == [expected(value) for value in texts]


def test_rounding_is_half_even_on_the_scaled_value(spark):
    assert apply(spark, lambda c: n.round_even(c, 2), [1.005, 2.675, 0.125, 0.375, None], "double") == [
        1.0, 2.68, 0.12, 0.38, None,
    ]
    assert apply(spark, lambda c: n.round_even(c, 1), [0.25, 0.35], "double") == [0.2, 0.4]


def test_clip_keeps_null(spark):
    assert apply(spark, lambda c: n.clip(c, 0.0, 1.0), [-1.0, 0.5, 2.0, None], "double") == [0.0, 0.5, 1.0, None]


def test_price_of_no_surface_is_null(spark):
    assert apply(spark, lambda c: n.price_per_m2(F.lit(10.0), c), [0.0, 2.0, None], "double") == [None, 5.0, None]


def test_keys_keep_the_slot_of_a_missing_part(spark):
    df = spark.createDataFrame([("75101", None, "BIS", None)], "c string, n string, s string, v string")
    row = df.select(
        k.address_key(df.c, df.n, df.s, df.v), k.street_key(df.c, df.v), k.joined(df.n, df.v)
    ).first()
    assert tuple(row) == ("75101||BIS|", None, "|")


def test_parcel_id(spark):
    rows = [
        ("75", "1", None, "a b", "12"),
        ("75", None, "7", "AB", "12345"),
        ("75", "116", "", "", "1"),
        ("", "116", "", "AB", "1"),
        ("75", "116", "", "AB", "x"),
    ]
    df = spark.createDataFrame(rows, "d string, c string, p string, s string, n string")
    found = [row[0] for row in df.select(k.parcel_id(df.d, df.c, df.p, df.s, df.n)).collect()]
    assert found == ["75001000AB0012", "75000007AB12345", None, None, None]


def test_building_cascade(spark):
    rows = [("a", "p", "k"), ("", "p", "k"), (None, None, "k"), ("", "", ""), (None, "", None)]
    df = spark.createDataFrame(rows, "a string, p string, k string")
    found = df.select(k.building_id(df.a, df.p, df.k), k.building_id_source(df.a, df.p, df.k)).collect()
    assert [tuple(row) for row in found] == [
        ("a", "ban_address"), ("p", "parcel"), ("k", "address_key"), (None, None), (None, None),
    ]


def test_street_labels(spark):
    rows = [(" rue ", None, "X", None, None, 5), ("", "", "", "", "a", None), ("rue", "de", "Y", "Long", "", 7)]
    df = spark.createDataFrame(rows, "a string, b string, c string, l string, i string, j int")
    raw = k.street_raw_name(df.a, df.b, df.c)
    found = df.select(
        raw, k.street_display_name(df.l, raw, t.normalize_street(raw)), k.first_given(df.i, df.j)
    ).collect()
    assert [tuple(row) for row in found] == [("rue X", "rue X", "5"), ("", "", "a"), ("rue de Y", "Long", "7")]


def test_lambert93_known_point(spark):
    df = spark.createDataFrame([(2.3522, 48.8566), (3.0, 46.5)], "lon double, lat double")
    x, y = geo.to_lambert93(df.lon, df.lat)
    first, origin = df.select(n.round_even(x, 2), n.round_even(y, 2)).collect()
    assert tuple(first) == (652469.02, 6862035.26)
    assert tuple(origin) == (700000.0, 6600000.0)


def test_quality_of_life_extremes(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, 0.0, 0.0), (3.0, 3.0, 100.0, 100.0), (9.0, 9.0, 900.0, 900.0)],
        "n double, a double, h double, p double",
    )
    found = df.select(indicators.quality_of_life(df.n, df.a, df.h, df.p)).collect()
    assert [row[0] for row in found] == [10.0, 0.0, 0.0]


def test_indicators(spark):
    df = spark.createDataFrame([(10000.0, 24000.0, 30.0, 10.0, 0)], "p double, i double, r double, u double, t long")
    row = df.select(
        indicators.months_income(df.p, df.i),
        indicators.rent_effort(df.r, df.i),
        indicators.social_per_100_sales(df.u, df.t),
        indicators.social_per_100_sales(df.u, F.lit(40)),
        indicators.environmental_pressure(F.lit(2.0), F.lit(3.0)),
    ).first()
    assert tuple(row) == (5.0, 75.0, 0.0, 25.0, 70.0)


def test_records_write_missing_values(spark):
    df = spark.createDataFrame([(1, float("nan"), None)], "a int, b double, c string")
    assert r.to_records_json(df).first()[0] == '{"a":1,"b":null,"c":null}'


def test_project_existing_and_types(spark):
    df = spark.createDataFrame([(1, "2.5"), (None, "x")], "a int, b string")
    out = r.normalize_types(r.project_existing(df, ["b", "zz", "a"]), ["a", "q"], ["b"])
    assert out.columns == ["b", "a"]
    assert [tuple(row) for row in out.collect()] == [(2.5, "1"), (None, None)]


def test_abbreviations_beside_each_other_are_written_out(spark):
    names = {"AV AV": "AVENUE AVENUE", "bd. BD-bd": "BOULEVARD BOULEVARD BOULEVARD", "ALL": "ALLEE", "ALLS": "ALLS", "AV de l'Été": "AVENUE DE L ETE", "": "", "½ RTE": "12 ROUTE"}
    rows = spark.createDataFrame([(name,) for name in names], "name string").select("name", t.normalize_street(F.col("name")).alias("key"))
    assert dict(map(tuple, rows.collect())) == names
    # No word is walked to by itself.
    assert "transform(split(trim" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert not set(t.STREET_ALIASES) & set(t.STREET_ALIASES.values())
