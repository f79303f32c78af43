import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardloom.operators import latest, links, merge, tags


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_last_and_first_of_each(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), (None, 1, "n"), (None, 2, "m")], "k string, ord int, v string")
    assert rows(merge.last_of_each(df, ["k"], ["ord"])) == [("a", 3, "z"), (None, 2, "m")]
    assert rows(merge.first_of_each(df, ["k"], ["ord"])) == [("a", 1, "x"), (None, 1, "n")]


def test_null_keys_never_conflict(spark):
    target = spark.createDataFrame([(1, None, 0)], "f int, p int, ord int")
    stage = spark.createDataFrame([(1, None, 1), (1, None, 2), (1, 5, 3), (1, 5, 4)], "f int, p int, ord int")
    assert rows(merge.insert_absent(target, stage, ["f", "p"], ["ord"])) == [(1, 5, 3), (1, None, 1), (1, None, 2)]


def test_upsert_overwrites_with_null_and_keeps_the_rest(spark):
    target = spark.createDataFrame([("a", "old", True, "2020")], "k string, v string, flag boolean, created string")
    stage = spark.createDataFrame([("a", None), ("b", "new")], "k string, v string")
    out = merge.upsert(target, stage, ["k"], ["v"], {"flag": F.lit(False), "created": F.lit("2024")})
    assert rows(out) == [("a", None, True, "2020"), ("b", "new", False, "2024")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=20), st.integers(1, 7))
def test_merging_again_changes_nothing(spark, pairs, parts):
    stage = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(pairs)], "k int, ord int, v int")
    last = merge.last_of_each(stage.repartition(parts), ["k"], ["ord"])
    want = {k: (i, v) for i, (k, v) in enumerate(pairs)}
    assert {r.k: (r.ord, r.v) for r in last.collect()} == want
    once = merge.upsert(last.limit(0), last, ["k"], ["ord", "v"])
    twice = merge.upsert(once, last, ["k"], ["ord", "v"])
    assert rows(once) == rows(twice)
    assert merge.insert_absent(once, last, ["k"], ["ord"]).count() == 0


def test_replace_children_keeps_parents_without_new_ones(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "p int, f string")
    new = spark.createDataFrame([(1, "z")], "p int, f string")
    assert rows(merge.replace_children(old, new, "p")) == [(1, "z"), (2, "c")]
    assert rows(merge.replace_children(old, new.limit(0), "p")) == rows(old)


def test_tags(spark):
    held = spark.createDataFrame([(1, "x"), (2, "y")], "card_id int, tag_name string")
    new = spark.createDataFrame([(1, "x"), (1, "n"), (1, "n")], "card_id int, tag_name string")
    assert rows(tags.merge_tags(held, new, "card_id")) == [(1, "n"), (1, "x"), (2, "y")]
    assert rows(tags.merge_tags(held, new.limit(0), "card_id", replace=True)) == rows(held)
    assert rows(tags.merge_tags(held, new.filter("tag_name = 'n'"), "card_id", replace=True)) == [(1, "n"), (2, "y")]


def test_numbers_are_consecutive_in_key_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(5)
    got = merge.numbered(df, "k", "n", start=11, rows_per_part=150).orderBy("k").collect()
    assert [r.n for r in got] == list(range(11, 1011))
    assert merge.numbered(df.limit(0), "k", "n").count() == 0


def test_cascade_and_set_null(spark):
    children = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, p int")
    gone = spark.createDataFrame([(10,)], "p int")
    assert rows(merge.cascade(children, gone, "p")) == [(2, 20), (3, None)]
    assert rows(merge.set_null(children, gone, "p", "p")) == [(1, None), (2, 20), (3, None)]


def test_propagate(spark):
    df = spark.createDataFrame([(1, "s", 7), (1, "s", 5), (1, "s", None), (1, None, 9), (1, None, None)], "c int, s string, m int")
    assert rows(links.propagate(df, ["c", "s"], "m")) == rows(spark.createDataFrame([(1, "s", 7), (1, "s", 5), (1, "s", 5), (1, None, 9), (1, None, None)], df.schema))


def test_flag_by_name(spark):
    cards = spark.createDataFrame([(1, "Fire", "fire"), (2, "Fire", "fire"), (3, "FIRE", "fire"), (4, "Dûl", "dul"), (5, None, None)], "id int, name string, normalized_name string")
    names = spark.createDataFrame([("Fire",), ("DUL",), ("Ice",), (None,)], "name string")
    flagged, missed = links.flag_by_name(cards, names)
    assert {r.id for r in flagged.filter("flag").collect()} == {1, 2, 4}
    assert [r.name for r in missed.collect()] == ["Ice"]


@pytest.mark.parametrize("lang, wanted", [("en", 2), (None, 3)])
def test_printing_for_tags(spark, lang, wanted):
    data = [(1, 1, "fr", "2020", "a", False), (2, 1, "en", "2019", "a", False), (3, 1, lang, None, "a", False), (4, 1, "en", "2030", "sld", False), (5, 1, "en", "2030", None, False), (6, 1, "en", "2030", "a", True)]
    df = spark.createDataFrame(data, "id int, card_id int, lang string, released_at string, set_code string, digital boolean")
    # an unknown date comes first among English ones, an unknown language before English
    assert latest.printing_for_tags(df).first().id == 3
    assert latest.printing_for_tags(df.filter("id <> 3")).first().id == 2


def test_latest_ties(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9)], "p int, at int, id int")
    assert rows(latest.latest_of_each(df, ["p"], "at", "id")) == [(1, 5, 2)]
