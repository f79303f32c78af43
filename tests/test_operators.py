"""Cascades, pages, look-ups, digests and databases."""

import hashlib
import json
import os
import resource

import pytest
from pyspark.sql import functions as F

from cardloom.operators import cascades, constraints, links
from cardloom.sources import databases, files, json_files

KEY = cascades.ForeignKey


def test_deletions_go_down_all_levels(spark):
    frame = lambda schema, *r: spark.createDataFrame(list(r), schema)
    tables = {
        "a": frame("id int", (1,), (2,)),
        "b": frame("id int, a int", (10, 1), (11, 2), (12, None)),
        "c": frame("id int, b int, a int, clash int", (100, 10, 2, 0), (101, 11, 1, 0), (102, 12, None, 0), (103, None, 1, 0)),
        "d": frame("c int, b int", (100, 11), (101, 10), (101, 11), (102, None)),
        "e": frame("id int", (1,)),
    }
    keys = [KEY("b", "a", "a", "id"), KEY("c", "b", "b", "id"), KEY("c", "a", "a", "id", "set null"), KEY("d", "c", "c", "id"), KEY("d", "b", "b", "id")]
    left, gone = cascades.delete(tables, {"a": frame("id int", (1,), (1,), (None,))}, keys)
    rows = lambda t: sorted(map(str, map(tuple, t.collect())))
    assert rows(left["a"]) == ["(2,)"] and rows(left["b"]) == ["(11, 2)", "(12, None)"]
    assert rows(left["c"]) == ["(101, 11, None, 0)", "(102, 12, None, 0)", "(103, None, None, 0)"]
    assert rows(left["d"]) == ["(101, 11)", "(102, None)"] and rows(gone["d"]) == ["(100, 11)", "(101, 10)"]
    assert left["e"] is tables["e"] and "e" not in gone
    left, gone = cascades.delete(tables, {"e": frame("id int", (1,)), "d": frame("b int", (11,))}, keys)
    assert left["e"].count() == 0 and rows(left["d"]) == ["(101, 10)", "(102, None)"] and left["a"] is tables["a"]
    assert cascades.delete(tables, {}, keys)[0] == tables
    with pytest.raises(ValueError, match="circle"):
        cascades.in_order([KEY("a", "x", "b", "id"), KEY("b", "y", "a", "id")])
    with pytest.raises(ValueError, match="unknown"):
        cascades.in_order([KEY("a", "x", "b", "id", "restrict")])


def test_rules_of_a_table(spark):
    rules = constraints.Rules(required=("a",), longest={"b": 2}, decimals={"p": "decimal(4,2)"})
    df = spark.createDataFrame([(1, "ab", "1,5"), (None, "abc", "x"), (2, None, "100"), (3, "", None)], "a int, b string, p string")
    good, bad = constraints.split(df, rules)
    assert sorted(r.a for r in good.collect()) == [1, 3]
    assert {r.a: r.reason for r in bad.collect()} == {None: "a is missing; b is longer than 2", 2: "p does not fit decimal(4,2)"}
    assert {r.reason: r.n for r in constraints.tally(bad).collect()} == {"a is missing": 1, "b is longer than 2": 1, "p does not fit decimal(4,2)": 1}
    assert constraints.split(df, constraints.Rules())[1].count() == 0


def test_pages_of_children(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    children = spark.range(3000).select(F.lit(1).alias("k"), (F.col("id") % 1000).alias("n"), F.lit("x").alias("t")).unionByName(spark.createDataFrame([(2, 5, "y" * 900), (2, 6, "z"), (None, 1, "w")], "k int, n long, t string"))
    got = links.nested_pages(parents, children, "k", ["n", "t"], "list", page_bytes=400).collect()
    of = lambda k: sorted((r for r in got if r.k == k), key=lambda r: r.page)
    assert [r.page for r in of(1)] == list(range(of(1)[0].pages)) and of(1)[0].pages > 100
    assert [x.n for r in of(1) for x in r.list] == sorted(i % 1000 for i in range(3000))
    assert max(len(r.list) for r in of(1)) <= 27
    assert [[x.n for x in r.list] for r in of(2)] == [[5], [6]] and [(r.page, r.pages, r.list) for r in of(3)] == [(0, 1, [])]


def rows_scanned(df):
    """Rows that the scans of a query have given out once it has run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
    return sum(found)


def test_look_ups_skip_most_rows(spark):
    df = spark.range(40_000).select(F.concat(F.lit("name "), (F.col("id") % 5000).cast("string")).alias("name"), F.xxhash64("id").cast("string").alias("code"), "id")
    kept = links.for_look_ups(df, ["name", "code"], rows_per_group=1000)
    assert kept.count() == 40_000
    assert sorted(r.id for r in links.look_up(kept, "name", "name 7").collect()) == list(range(7, 40_000, 5000))
    assert rows_scanned(links.look_up(kept, "name", "name 7")) <= 2000
    one = df.filter("id = 1234").first()
    assert [r.id for r in links.look_up(kept, "code", one.code).collect()] == [1234]
    # codes stand anywhere, so only the filters can tell which groups hold one
    assert rows_scanned(links.look_up(kept, "code", one.code)) <= 8000


def test_digests_of_files_of_any_size(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/deep/a b.txt").write_bytes(b"abc" * 50_000)
    (tmp_path / "in/empty").write_bytes(b"")
    (tmp_path / "in/_hidden").write_bytes(b"x")
    with open(tmp_path / "in/large", "wb") as f:
        f.truncate((1 << 31) + 5)
    got = {os.path.basename(r.path): (r.content_length, r.sha256) for r in files.digests(spark, str(tmp_path / "in")).collect()}
    assert got["a b.txt"] == (150_000, hashlib.sha256(b"abc" * 50_000).hexdigest()) and got["empty"] == (0, hashlib.sha256(b"").hexdigest())
    large, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range(1 << 11):
        large.update(zeros)
    large.update(bytes(5))
    assert set(got) == {"a b.txt", "empty", "large"} and got["large"] == ((1 << 31) + 5, large.hexdigest())
    assert files.digests(spark, str(tmp_path / "nothing*")).count() == 0
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < 2_000_000  # kB; the file was never held


def test_databases_in_ranges(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("place"))
    for rows in (df.limit(7), df):
        databases.replace_in_database(rows, url, "numbers", driver=driver)
    read = databases.read_database(spark, url, "numbers", by="place", parts=5, driver=driver)
    assert read.rdd.getNumPartitions() == 5 and sorted(r[0] for r in read.collect()) == list(range(100))
    databases.replace_in_database(df.limit(0), url, "numbers", driver=driver)
    assert databases.read_database(spark, url, "numbers", by="place", driver=driver).count() == 0


@pytest.mark.parametrize("indent", [None, 1])
def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, indent):
    records = [{"id": f"r{i}", "n": [{"a": i}], "text": 'x "y" {z} ' * 20} for i in range(12_000)]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=indent))
    (tmp_path / "w.json").write_text(json.dumps({"singles": "none", "data": [{"idProduct": i, "x": "}" * 40} for i in range(20_000)], "singles ": []}, indent=indent))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600k")
    try:
        chunks, states = json_files.landed_text(spark, str(tmp_path / "a.json"), False, chunk_bytes=100_000)
        assert chunks.select("block").distinct().count() >= 4 and chunks.agg(F.max(F.length("data"))).first()[0] < 200_000
        assert states.filter("whole").count() == chunks.count()
        good, bad = json_files.good_and_bad(json_files.read_array(spark, str(tmp_path / "a.json"), "id string, text string"), required=("id",))
        assert [r.id for r in good.orderBy("ord").collect()] == [r["id"] for r in records] and bad.count() == 0
        assert good.filter(F.length("text") != 200).count() == 0
        read, bad = json_files.read_wrapped(spark, str(tmp_path / "w.json"), ("singles", "data"))
        assert sorted(int(r[0]) for r in read.select(F.element_at("record", F.lit("idProduct"))).collect()) == list(range(20_000)) and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
