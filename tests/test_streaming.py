from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from citygrain.operators.compare import frames_match
from citygrain.operators.sales import METRICS, sales_by_district
from citygrain.session import staged
from citygrain.sources.store import Store
from citygrain.streaming import events as ev
from tests.conftest import values
from tests.test_sales import COLUMNS, random_sales

EVENT = {
    "arrondissement": 1, "year": 2025, "transaction_id": "a", "price_per_m2": 10000.0, "sale_value_eur": 200000.0,
    "built_surface_m2": 20.0, "rooms": 1.0, "Type local": "Appartement",
}


def feed(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(records) + "\n", encoding="utf-8")


def run(spark, tmp_path, per_batch=1, **options):
    source = ev.read_event_stream(spark, "text", path=str(tmp_path / "in"), maxFilesPerTrigger=str(per_batch))
    store = Store(spark, root=str(tmp_path / "tables"))
    assert ev.run_bounded(ev.accept(source), store, str(tmp_path / "accepted"), str(tmp_path / "checkpoint"), **options)
    return store


def test_stream_equals_batch(spark, tmp_path):
    frame = random_sales(4_000, 9)
    frame["transaction_id"] = [f"t{i}" for i in range(len(frame))]
    sales = spark.createDataFrame(frame, COLUMNS)
    lines = [row["value"] for row in ev.to_event_records(sales).collect()]
    for part in range(3):
        feed(tmp_path / "in", f"{part}.json", lines[part::3])
    store = run(spark, tmp_path)
    check = frames_match(store.read(ev.STREAM_TABLE), sales_by_district(sales), ["arrondissement", "year"], list(METRICS))
    assert check.first()["same"]


def test_copies_and_broken_events_change_nothing_and_a_restart_goes_on(spark, tmp_path):
    first = [json.dumps(EVENT | {"transaction_id": f"t{i}"}) for i in range(200)]
    broken = [json.dumps({"arrondissement": 1, "year": 2025}), "not json", "[1]", "", '"text"']
    feed(tmp_path / "in", "0.json", first + first[:50] + broken)
    store = run(spark, tmp_path)
    assert values(store.read(ev.STREAM_TABLE), "arrondissement", "transactions") == [(1, 200)]
    feed(tmp_path / "in", "1.json", first[:20] + [json.dumps(EVENT | {"transaction_id": "new", "rooms": None})])
    store = run(spark, tmp_path)
    assert values(store.read(ev.STREAM_TABLE), "arrondissement", "transactions") == [(1, 201)]
    accepted = ev.accepted_events(spark, str(tmp_path / "accepted"))
    assert accepted.count() == 201 and accepted.where("rooms is null").count() == 1


def test_the_first_arrival_wins(spark, tmp_path):
    feed(tmp_path / "in", "0.json", [json.dumps(EVENT)])
    run(spark, tmp_path)
    feed(tmp_path / "in", "1.json", [json.dumps(EVENT | {"price_per_m2": 1.0})])
    store = run(spark, tmp_path)
    assert values(store.read(ev.STREAM_TABLE), "median_price_m2") == [(10000.0,)]


def test_the_first_arrival_wins_inside_a_batch(spark, tmp_path):
    dearer = [json.dumps(EVENT | {"price_per_m2": price}) for price in (30_000.0, 20_000.0, 40_000.0)]
    feed(tmp_path / "in", "b.json", dearer)
    other = [json.dumps(EVENT | {"price_per_m2": price, "transaction_id": "b"}) for price in (9.0, 8.0)]
    feed(tmp_path / "in", "a.json", [json.dumps(EVENT)] + other)
    os.utime(tmp_path / "in" / "b.json", (1_000_000, 1_000_000))  # older, though later by name
    store = run(spark, tmp_path, per_batch=2)
    accepted = ev.accepted_events(spark, str(tmp_path / "accepted"))
    assert values(accepted.orderBy("transaction_id"), "transaction_id", "price_per_m2") == [("a", 30_000.0), ("b", 9.0)]
    assert values(store.read(ev.STREAM_TABLE), "transactions") == [(2,)]


@pytest.mark.parametrize("listed", [0, 2000])
def test_only_touched_groups_are_worked_out_again(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(ev, "LISTED_GROUPS", listed)
    feed(tmp_path / "in", "0.json", [json.dumps(EVENT | {"transaction_id": f"t{n}", "arrondissement": n % 3 + 1}) for n in range(30)])
    store = run(spark, tmp_path)
    # A mark in the published table shows which rows are kept as they are.
    marked = staged(store.read(ev.STREAM_TABLE).withColumn("median_rooms", F.lit(99.0)), "marked")
    store.replace(ev.STREAM_TABLE, marked)
    feed(tmp_path / "in", "1.json", [json.dumps(EVENT | {"transaction_id": "new", "arrondissement": 2})])
    store = run(spark, tmp_path)
    found = values(store.read(ev.STREAM_TABLE).orderBy("arrondissement"), "arrondissement", "transactions", "median_rooms")
    assert found == [(1, 10, 99.0), (2, 11, 1.0), (3, 10, 99.0)]


def test_many_batches_leave_few_files_and_a_reader_always_finds_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ev, "MOST_BATCHES", 4)
    folder, store = str(tmp_path / "accepted"), Store(spark, root=str(tmp_path / "tables"))
    replaced, seen = Store.replace, []

    def looked_at(self, name, df):
        before = store.read(name).agg(F.sum("transactions")).first()[0] if store.exists(name) else 0
        target = replaced(self, name, df)
        after = store.read(name).agg(F.sum("transactions")).first()[0]
        os.remove(f"{target}/_SUCCESS")  # as if it were not complete yet
        assert not before or store.read(name).agg(F.sum("transactions")).first()[0] == before
        open(f"{target}/_SUCCESS", "w").close()
        seen.append((before, after))
        return target

    monkeypatch.setattr(Store, "replace", looked_at)
    schema = spark.createDataFrame([], ev.EVENT_SCHEMA).schema
    most = 0
    for number in range(20):
        rows = [tuple({**EVENT, "transaction_id": f"t{number}-{i}", "arrondissement": i % 2 + 1, "rooms": float(number)}.values()) for i in range(4)]
        batch = spark.createDataFrame(rows, schema)
        ev._update(store, folder, batch, number)
        if number % 6 == 5:
            ev._update(store, folder, batch, number)  # run again after a failure
        most = max(most, sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names))
    assert [after for _, after in seen if after][-1] == 80 and all(after >= before for before, after in seen)
    assert most <= 2 * (2 * 4 + 2) + 4 and len(os.listdir(f"{store.root}/{ev.STREAM_TABLE}")) <= 2
    assert frames_match(store.read(ev.STREAM_TABLE), ev.stream_metrics(spark, folder), ["arrondissement", "year"], list(METRICS)).first()["same"]


def test_bounded_number_of_events(spark, tmp_path):
    feed(tmp_path / "in", "0.json", [json.dumps(EVENT | {"transaction_id": f"t{i}"}) for i in range(30)])
    store = run(spark, tmp_path, max_events=12)
    assert values(store.read(ev.STREAM_TABLE), "transactions") == [(12,)]


def test_nothing_accepted_publishes_nothing(spark, tmp_path):
    feed(tmp_path / "in", "0.json", ['{"arrondissement": 1}'])
    store = run(spark, tmp_path)
    assert not store.exists(ev.STREAM_TABLE)


def test_records(spark):
    sales = spark.createDataFrame([(2, 2025, "b", 1.0, 2.0, 3.0, None, "Maison"), (1, 2025, "a", 1.0, 2.0, 3.0, 4.0, "Maison")], COLUMNS)
    found = values(ev.to_event_records(sales, 1), "key", "value")
    assert [(key, json.loads(value)) for key, value in found] == [
        ("1", {**EVENT, "price_per_m2": 1.0, "sale_value_eur": 2.0, "built_surface_m2": 3.0, "rooms": 4.0, "Type local": "Maison"})
    ]


def test_key_presence_not_value_decides(spark):
    rows = [(json.dumps(EVENT | {"rooms": None, "transaction_id": 7}),), (json.dumps({**EVENT, "rooms": 1} | {"x": 1}),), ("{}",)]
    found = ev.parse_events(spark.createDataFrame(rows, "value string"))
    assert values(found, "transaction_id", "rooms") == [("7", None), ("a", 1.0)]


def test_watermark_variant_bounds_the_state(spark, tmp_path):
    feed(tmp_path / "in", "0.json", [json.dumps(EVENT), json.dumps(EVENT)])
    source = ev.read_event_stream(spark, "text", path=str(tmp_path / "in")).withColumn("timestamp", F.current_timestamp())
    store = Store(spark, root=str(tmp_path / "tables"))
    events = ev.accept(source, "timestamp", "1 day")
    assert ev.run_bounded(events, store, str(tmp_path / "accepted"), str(tmp_path / "checkpoint"))
    assert values(store.read(ev.STREAM_TABLE), "transactions") == [(1,)]


def test_kafka_is_asked_for_the_earliest_offset(spark):
    # The connector is not part of this installation; the reader must get as far as looking for it.
    with pytest.raises(Exception, match="(?i)kafka"):
        ev.read_event_stream(spark, "kafka", subscribe="sales", **{"kafka.bootstrap.servers": "localhost:9"})
