"""The workloads end to end on landed files."""

import json
from datetime import date, datetime

import pytest

from cardloom.operators import ledger, quality
from cardloom.plans import jobs
from cardloom.sources import json_files, storage

RUN, DAY = datetime(2024, 1, 2), date(2024, 1, 2)


def card(key, oracle, **more):
    return {"id": key, "oracle_id": oracle, "name": more.pop("name", "N"), "set": "s", "collector_number": "1", **more}


@pytest.fixture
def dump(tmp_path):
    records = [
        card("p1", "o1", name="Æther Dûl", mana_cost="", card_faces=[{"name": "f1", "mana_cost": "{R}", "image_uris": {"small": "fs"}}, {"name": "f2", "printed_name": "zwei"}], prices={"eur": "1.005", "usd": "", "tix": "0.00", "eur_foil": "abc"}),
        card("p2", "o1", name="Second", cardmarket_id=77, image_uris={"small": "own"}, released_at="2024-13-01"),
        card("p3", "", name="none"),
        card("p4", "o2", legalities={"commander": "legal"}, released_at="2024-01-05", digital=True),
    ]
    path = tmp_path / "cards.json"
    path.write_text("[\n" + ",\n".join(json.dumps(r) for r in records) + ",\n{broken\n]\n")
    return str(path)


def test_card_import(spark, dump):
    held = jobs.import_cards(spark, dump, jobs.Catalogue(), RUN, DAY)
    assert held.counters == {"cards": 2, "printings": 3, "prices": 2, "errors": 1}
    cards = {r.oracle_id: r for r in held.cards.collect()}
    assert cards["o1"].name == "Second" and cards["o2"].legal_commander and not cards["o1"].game_changer
    printings = {r.scryfall_id: r for r in held.printings.collect()}
    assert printings["p1"].cardmarket_id == 77 and printings["p1"].image_small == "fs" and printings["p1"].printed_name == "zwei"
    assert printings["p2"].released_at is None and printings["p4"].released_at == date(2024, 1, 5) and printings["p4"].digital
    assert sorted(r.face_name for r in held.faces.collect()) == ["f1", "f2"]
    assert sorted((r.currency, str(r.price)) for r in held.prices.collect()) == [("eur", "1.01"), ("tix", "0.00")]
    again = jobs.import_cards(spark, dump, held, datetime(2024, 1, 3), DAY)
    assert again.counters["prices"] == 0 and again.prices.count() == 2
    assert {r.oracle_id: (r.id, r.created_at) for r in again.cards.collect()} == {k: (r.id, r.created_at) for k, r in cards.items()}
    assert again.faces.count() == 2 and again.printings.count() == 3
    assert json_files.count_records(spark, dump) == 5


def test_market_import_and_view(spark, dump, tmp_path):
    held = jobs.import_cards(spark, dump, jobs.Catalogue(), RUN, DAY)
    (tmp_path / "products.json").write_text(json.dumps({"product": "no list", "data": [{"idProduct": 77, "enName": "A", "number": " "}, {"idProduct": 0}, {"id_product": "x"}]}))
    (tmp_path / "prices.json").write_text(json.dumps({"priceGuides": [{"idProduct": 77, "low": "1,5", "avg": 0}, {"idProduct": 5, "trend": 2.5}, {"idProduct": 6}]}))
    held = jobs.import_products(spark, str(tmp_path / "products.json"), held, RUN)
    assert held.products.first().en_name == "A" and held.products.first().number is None
    held = jobs.import_price_guide(spark, str(tmp_path / "prices.json"), held, RUN, 1)
    assert sorted(str(r.id_product) for r in held.entries.collect()) == ["77", "None", "None"]
    view = jobs.latest_price_view(held).collect()
    assert {(r.scryfall_id, str(r.low_price)) for r in view} == {("p1", "1.5000"), ("p2", "1.5000")}
    assert jobs.import_price_guide(spark, str(tmp_path / "prices.json"), held, RUN, 2).entries.count() == 6
    names = spark.createDataFrame([("Second",), ("missing",), ("absent",), ("absent",)], "name string")
    responses = spark.createDataFrame([("s", "1", "Second", [{"tag": {"name": "t", "type": "ORACLE_CARD_TAG"}}, {"tag": {"name": "u", "type": "ART"}}])], "set_code string, collector_number string, name string, taggings array<struct<tag: struct<name: string, type: string>>>")
    held, missed = jobs.enrich(held, responses, names)
    asked = held.printings.filter("not digital").first().card_id
    assert held.cards.filter("game_changer").count() == 1 and held.counters == {"flagged": 1}
    assert held.tags.collect() == [(asked, "t")] and missed.collect() == [("absent",), ("missing",)]


def test_small_readers(spark, tmp_path):
    (tmp_path / "sets.json").write_text(json.dumps({"data": [{"code": "a", "name": "A", "released_at": "2020-02-30"}, {"code": "b"}]}))
    from cardloom.operators.cards import set_rows

    assert [(r.code, r.released_at) for r in set_rows(json_files.read_sets(spark, str(tmp_path / "sets.json")))[0].collect()] == [("a", None)]
    assert [r.reason for r in set_rows(json_files.read_sets(spark, str(tmp_path / "sets.json")))[1].collect()] == ["name is missing"]
    (tmp_path / "names").mkdir()
    (tmp_path / "names/1.json").write_text(json.dumps({"data": [{"name": "x"}, {"name": "y"}], "has_more": True}))
    (tmp_path / "names/2.json").write_text(json.dumps({"data": [{"name": "z"}]}))
    assert [r.name for r in json_files.read_names(spark, str(tmp_path / "names")).orderBy("file", "place").collect()] == ["x", "y", "z"]
    (tmp_path / "tags.json").write_text('{"data": {"card": null}}\n{"data": {"card": {"name": "c", "taggings": []}}}\n')
    assert [r.name for r in json_files.read_tag_responses(spark, str(tmp_path / "tags.json")).collect()] == ["c"]


def test_snapshots_switch(spark, tmp_path):
    held = storage.Snapshots(spark, str(tmp_path / "t"))
    assert held.current() is None
    held.replace(spark.range(3))
    assert held.replace(held.current().filter("id > 0")).count() == 2


def test_ledger_and_quality(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"abc")
    files = ledger.landed_files(spark.read.format("binaryFile").load(str(tmp_path)))
    log = files.selectExpr("1 as id", "sha256", "'success' as status", "'p' as file_type", "timestamp '2024-01-01' as started_at")
    assert ledger.changed_files(files, log, "p").count() == 0 and ledger.changed_files(files, log, "q").count() == 1
    assert ledger.last_successes(log).count() == 1
    df, seen = ledger.counted(spark.range(5), "n", rows=__import__("pyspark.sql.functions").sql.functions.count("*"))
    storage.written(df, "n")
    assert seen.get == {"rows": 5}
    good, bad = quality.quarantine(spark.createDataFrame([(None, "abc"), (1, "ab")], "a int, b string"), ["a"], {"b": 2})
    assert good.count() == 1 and bad.first().reason == "a is missing; b is longer than 2"


def test_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    json_files.write_database(spark.range(3), url, "numbers", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert json_files.read_database(spark, url, "numbers", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").count() == 3


def elements_of(spark, path):
    good, bad = json_files.good_and_bad(json_files.read_array(spark, str(path), "id string, n array<struct<a: int>>"), required=("id",))
    return [r.id for r in good.orderBy("ord").collect()], sorted((r.raw, r.reason) for r in bad.collect())


def test_arrays_of_any_layout_are_read_whole(spark, tmp_path):
    records = [{"id": f"r{i}", "n": [{"a": i}, {"a": 1}]} for i in range(7)]
    ids = [r["id"] for r in records]
    lines = [json.dumps(r) for r in records]
    layouts = {
        "one_line": json.dumps(records),
        "spaced": " [ " + " , ".join(lines) + " ] \n",
        "a_line_each": "[\n" + ",\n".join(lines) + "\n]",
        "closed_at_once": "[" + ",\n".join(lines) + "]",
        "commas_before": "[\n" + "\n,".join(lines) + "\n]\n",
        "two_a_line": "[\n" + ",".join(lines[:2]) + ",\n" + ",".join(lines[2:]) + "\n]",
        "indented": json.dumps(records, indent=2),
        "deep": "[\n" + ",\n".join("{\n" + f'"id": "{r["id"]}",\n"n": [\n' + '{"a": 1},\n{"a": 2}\n]\n}' for r in records) + "\n]",
    }
    for name, text in layouts.items():
        (tmp_path / f"{name}.json").write_text(text)
        assert elements_of(spark, tmp_path / f"{name}.json") == (ids, []), name
    (tmp_path / "empty.json").write_text("[]\n")
    (tmp_path / "nothing.json").write_text("")
    assert elements_of(spark, tmp_path / "empty.json") == elements_of(spark, tmp_path / "nothing.json") == ([], [])
    assert json_files.count_records(spark, str(tmp_path)) == 7 * len(layouts)


def test_what_cannot_be_read_is_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"id": "1"},\n{"id": "2",\n{"id": "3"}, 7, null, "x",\n{"n": []},\n{"id": ""}\n]')
    good, bad = elements_of(spark, tmp_path / "a.json")
    assert good == ["1", "3"] and len(bad) == 6
    (tmp_path / "b.json").write_text('[\n  {\n    "id": "1"\n  },\n  {\n    "id": oops,\n    "n": [\n      {"a": 1}\n    ]\n  },\n  {\n    "id": "3"\n  },\n  {\n    "id": "4')
    good, bad = elements_of(spark, tmp_path / "b.json")
    assert good == ["1", "3"] and len(bad) == 2


def test_truncated_documents_are_set_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"priceGuides": [{"idProduct": 1}, {"idPro')
    (tmp_path / "b.json").write_text('{"priceGuides": [{"idProduct": 1}, 5]}')
    good, bad = json_files.read_wrapped(spark, str(tmp_path), ("priceGuides",))
    assert good.count() == 1 and sorted(r.reason for r in bad.collect()) == ["no object", "not readable as JSON"]


def test_a_store_keeps_tables_between_runs(spark, dump, tmp_path):
    (tmp_path / "sets").mkdir()
    (tmp_path / "sets/1.json").write_text(json.dumps({"data": [{"code": "s", "name": "S", "card_count": 3}, {"code": "t"}]}))
    store = jobs.Store(spark, f"{tmp_path}/store")
    held = jobs.import_sets(spark, str(tmp_path / "sets"), store.load(), RUN)
    assert held.counters == {"rows": 1, "errors": 1}
    more = [card("q1", "o9", set="nowhere"), card("q2", "o9"), {"name": "no id", "oracle_id": "o9"}, card("q3", "o9", set=None, prices={"eur": "123456789.5"})]
    (tmp_path / "more.json").write_text(json.dumps(more))
    job = lambda path, x: jobs.import_cards(spark, path, x, RUN, DAY)
    held = jobs.run_if_changed(spark, "cards", str(tmp_path / "more.json"), store.load(), RUN, job)
    assert held.counters == {"cards": 1, "printings": 2, "prices": 0, "errors": 3}
    assert sorted(r.reason for r in held.quarantine.collect()) == ["id is missing", "no set nowhere", "price: text does not fit decimal(10,2)"]
    held = jobs.run_if_changed(spark, "cards", dump, store.load(), RUN, job)
    again = jobs.run_if_changed(spark, "cards", dump, store.load(), RUN, job)
    kept = store.load()
    assert [r.status for r in kept.ledger.orderBy("id").collect()] == ["success", "success", "skipped_not_modified"] and again.printings.count() == 5
    assert (kept.cards.count(), kept.printings.count(), kept.prices.count(), kept.sets.count()) == (3, 5, 2, 1)
    assert kept.cards.select("id").distinct().count() == 3 and kept.printings.select("id").distinct().count() == 5
    listed = spark.createDataFrame([("d1", "A", "x"), ("d1", "A", "y"), ("d2", "B", "x")], "deck_id string, commander string, card_name string")
    jobs.import_decks(kept, listed)
    jobs.import_decks(store.load(), listed.filter("deck_id = 'd2'"))
    assert [(r.card_name, r.decks_count, r.total_decks) for r in store.load().deck_cards.collect()] == [("x", 1, 1)]
    assert store.load().deck_commanders.count() == 1


def test_a_failed_import_is_in_the_ledger(spark, dump, tmp_path):
    store = jobs.Store(spark, f"{tmp_path}/store")

    def job(path, held):
        raise ValueError("no")

    with pytest.raises(ValueError):
        jobs.run_if_changed(spark, "cards", dump, store.load(), RUN, job)
    assert [r.status for r in store.load().ledger.collect()] == ["failed"]


def test_ids_of_entries_differ_between_files(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"idProduct": i} for i in range(1, 30)]))
    held = jobs.import_price_guide(spark, str(tmp_path / "p.json"), jobs.Catalogue(), RUN, 1)
    held = jobs.import_price_guide(spark, str(tmp_path / "p.json"), held, RUN, 2)
    assert held.entries.select("id").distinct().count() == 58 and held.entries.filter("import_file_id = 2").agg({"id": "min"}).first()[0] > held.entries.filter("import_file_id = 1").agg({"id": "max"}).first()[0]


def test_files_of_odd_kinds(spark, tmp_path):
    import gzip

    line = [json.dumps({"id": f"r{i}", "n": [{"a": i}]}) for i in range(5)]
    ids = [f"r{i}" for i in range(5)]
    whole = {
        "packed.json.gz": gzip.compress(("[" + ",".join(line) + "]").encode()),
        "packed_lines.json.gz": gzip.compress("\n".join(line).encode()),
        "lines.json": "\n".join(line).encode(),
        "windows.json": ("﻿[\r\n" + ",\r\n".join(line) + "\r\n]\r\n").encode(),
        "latin.json": ("[" + ",".join(line) + "]").encode() + b" ",
    }
    for name, data in whole.items():
        (tmp_path / name).write_bytes(data)
        assert elements_of(spark, tmp_path / name) == (ids, []), name
    cut = {"cut_lines.json": ("\n".join(line) + '\n{"id": "r5').encode(), "cut_brace.json": "\n".join(line).encode() + b'\n{"id": "r5", "n": [{"a": 5}', "stray.json": ("[" + ",".join(line) + "] {} 5").encode()}
    for name, data in cut.items():
        (tmp_path / name).write_bytes(data)
        good, bad = elements_of(spark, tmp_path / name)
        assert good == ids and bad, name
    (tmp_path / "bytes.json").write_bytes(b'[{"id": "r\xff\xfe"}, {"id": "r1"}]')
    good, bad = elements_of(spark, tmp_path / "bytes.json")
    assert "r1" in good and len(good) + len(bad) == 2
