"""Deck statistics in tasks of a bounded number of rows."""

from pyspark.sql import functions as F

from cardloom.operators import decks


def test_tasks_grow_in_number_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(decks, "ROWS", 300)
    listed = spark.range(6000).select((F.col("id") % 900).alias("deck_id"), (F.col("id") % 900 % 7).alias("commander"), F.concat(F.lit("card"), (F.col("id") % 11).cast("string")).alias("card_name"))
    parts = decks.dealt(listed).groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.collect_set("deck_id").alias("decks")).collect()
    assert len(parts) > 10 and max(r["n"] for r in parts) < 900
    assert sum(len(r["decks"]) for r in parts) == 900
    pairs = {(i % 900, i % 11) for i in range(6000)}
    of_card = {r["card_name"]: (r["decks_count"], r["total_decks"], r["commanders_count"]) for r in decks.card_statistics(listed).collect()}
    assert of_card == {f"card{c}": (len({d for d, x in pairs if x == c}), 900, len({d % 7 for d, x in pairs if x == c})) for c in range(11)}
    of_commander = {(r["commander"], r["card_name"]): r["decks_with_card"] for r in decks.commander_statistics(listed).collect()}
    assert of_commander == {(m, f"card{c}"): sum(d % 7 == m and x == c for d, x in pairs) for m in range(7) for c in range(11)}
