"""Tables that change by commits."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cardloom.operators import merge
from cardloom.plans import jobs
from cardloom.sources.storage import Conflict, Snapshots, Store


def upsert(store, part):
    return store.rewrite("t", ["k"], part, lambda held: part if held is None else merge.upsert(held, part, ["k"], ["v"]))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_an_update_rewrites_the_buckets_of_its_keys(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s", buckets=64)
    upsert(store, spark.range(10_000).select(F.col("id").alias("k"), F.lit(0).alias("v")))
    before = set(store.files("t"))
    part = spark.range(20, 25).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    upsert(store, part)
    assert len(set(store.files("t")) - before) <= 5 and len(store.files("t")) == 64
    assert rows(store.current("t")) == [(i, int(20 <= i < 25)) for i in range(10_000)]
    read = store.rows_of("t", part)
    assert read.count() < 1500 and read.filter("k between 20 and 24").count() == 5
    assert rows(upsert(store, part.limit(0))) == rows(store.current("t"))


def test_a_run_is_one_commit_and_a_failed_one_leaves_nothing(spark, tmp_path):
    store, part = Store(spark, f"{tmp_path}/s", buckets=4), spark.range(6).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    with store.run():
        upsert(store, part)
        store.append("h", part, "a", "v")
        assert Store(spark, f"{tmp_path}/s").names() == [] and store.names() == ["h", "t"]
    with pytest.raises(KeyError), store.run():
        upsert(store, part.withColumn("v", F.lit(9)))
        store.append("h", part, "b", "v")
        raise KeyError
    assert rows(store.current("t")) == [(i, 0) for i in range(6)] and store.current("h").count() == 6
    # a manifest that is cut off counts for nothing, and its number is not used again
    (number,) = [int(f.split(".")[0]) for f in os.listdir(tmp_path / "s/manifests") if f.endswith(".json") and not f.startswith(".")]
    (tmp_path / f"s/manifests/{number + 1}.json").write_text('{"tables": {"t"')
    assert store.current("t").count() == 6
    upsert(store, part.withColumn("v", F.lit(1)))
    assert store.current("t").filter("v = 1").count() == 6


def test_of_two_runs_from_one_state_one_fails(spark, tmp_path):
    one, two = Store(spark, f"{tmp_path}/s"), Store(spark, f"{tmp_path}/s")
    part = spark.range(3).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    upsert(one, part)
    with pytest.raises(Conflict), one.run():
        upsert(one, part.withColumn("v", F.lit(1)))
        upsert(two, part.withColumn("v", F.lit(2)))
    assert rows(two.current("t")) == [(i, 2) for i in range(3)]


def test_what_no_manifest_names_goes(spark, tmp_path):
    held = Snapshots(spark, f"{tmp_path}/s")
    for i in range(4):
        held.replace(spark.range(i + 1))
    with pytest.raises(KeyError), held.store.run():
        held.replace(spark.range(99))
        raise KeyError
    assert held.store.clean(keep=1, older_than_s=3600) == 0 and len(os.listdir(tmp_path / "s/rows")) == 5
    assert held.store.clean(keep=1, older_than_s=0) == 4
    assert held.current().count() == 4 and len(os.listdir(tmp_path / "s/rows")) == 1


def test_histories_keep_their_schema_and_take_an_append_once(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    schema = "a int, day string, b decimal(12,4)"
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    from decimal import Decimal

    assert store.append("h", frame(), "none", "day").count() == 0
    assert store.current("h").schema.simpleString() == "struct<a:int,day:string,b:decimal(12,4)>"
    store.append("h", frame((1, "20240101", Decimal(1)), (2, None, None)), "x", "day")
    store.append("h", frame((3, "a/b=c", None)), "y", "day")
    store.append("h", frame((1, "20240101", Decimal(1)), (2, None, None)), "x", "day")
    assert [(r.a, r.day) for r in store.current("h").orderBy("a").collect()] == [(1, "20240101"), (2, None), (3, "a/b=c")]
    assert [r.a for r in store.without_append("h", "x").collect()] == [3]
    assert store.current("missing") is None


def test_a_repeated_price_guide_adds_nothing_twice(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"priceGuides": [{"idProduct": 1, "low": 2}, {"idProduct": 2, "avg": "123456789.5"}, {"idProduct": 3, "trend": "1,5"}]}))
    (tmp_path / "products.json").write_text(json.dumps([{"idProduct": 1, "enName": "A"}]))
    store, run = jobs.Store(spark, f"{tmp_path}/store"), datetime(2024, 1, 2)
    jobs.import_products(spark, str(tmp_path / "products.json"), store.load(), run)
    for number in (1, 1, 2):
        held = jobs.import_price_guide(spark, str(tmp_path / "p.json"), store.load(), run, number)
        assert held.counters == {"rows": 3, "errors": 1}
    assert [r.reason for r in held.quarantine.collect()] == ["avg_price does not fit decimal(12,4)"]
    entries = store.load().entries
    assert sorted((r.import_file_id, r.id_product or 0) for r in entries.collect()) == [(1, 0), (1, 0), (1, 1), (2, 0), (2, 0), (2, 1)]
    assert entries.select("id").distinct().count() == 6
    left = jobs.delete(store.load(), {"products": spark.createDataFrame([(1,)], "id_product long"), "entries": entries.filter("import_file_id = 2").select("import_file_id").distinct()})
    assert left.counters == {"products": 1, "entries": 3}
    kept = store.load()
    assert kept.products.count() == 0 and [r.id_product for r in kept.entries.collect()] == [None] * 3


def test_cards_are_deleted_with_what_refers_to_them(spark, tmp_path):
    card = lambda i, o, **m: {"id": i, "oracle_id": o, "name": m.pop("name", "N"), "set": "s", "collector_number": "1", **m}
    records = [card("p1", "o1", prices={"eur": "1"}, card_faces=[{"name": "a"}, {"name": "b" * 256}]), card("p2", "o1", cardmarket_id=7), card("p3", "o2"), card("p4", "o3", name="x" * 256), card("p5", "o2", lang="a language too long")]
    (tmp_path / "c.json").write_text(json.dumps(records))
    (tmp_path / "sets.json").write_text(json.dumps({"data": [{"code": "s", "name": "S"}, {"code": "t" * 17, "name": "T"}]}))
    store, run = jobs.Store(spark, f"{tmp_path}/store", buckets=4), datetime(2024, 1, 2)
    assert jobs.import_sets(spark, str(tmp_path / "sets.json"), store.load(), run).counters == {"rows": 1, "errors": 1}
    held = jobs.import_cards(spark, str(tmp_path / "c.json"), store.load(), run, run.date())
    assert sorted(r.reason for r in held.quarantine.collect()) == ["card: name is longer than 255; normalized_name is longer than 255", "face: face_name is longer than 255", "no card o3", "printing: lang is longer than 10"]
    assert held.counters == {"cards": 2, "printings": 3, "prices": 1, "errors": 4}
    assert {r.scryfall_id: r.cardmarket_id for r in held.printings.collect()} == {"p1": 7, "p2": 7, "p3": None}
    jobs.delete(store.load(), {"cards": spark.createDataFrame([("o1",)], "oracle_id string"), "sets": spark.createDataFrame([("s",)], "code string")})
    kept = store.load()
    assert [(r.scryfall_id, r.set_code) for r in kept.printings.collect()] == [("p3", None)]
    assert (kept.cards.count(), kept.faces.count(), kept.prices.count(), kept.sets.count()) == (1, 0, 0, 0)
