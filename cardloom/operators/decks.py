"""Deck statistics from (deck, commander, card).

Pairs are made distinct once and then only counted, so that a card that nearly
all decks play is a count that is combined before the shuffle.  The list is written first,
so that what made it runs once, and is then dealt by deck into tasks of a bounded
number of rows: nearly all pairs of deck and card differ, and are all held by a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.sources.storage import written

#: Rows that a task makes distinct.
ROWS = 500_000


def dealt(decks: DataFrame) -> DataFrame:
    """(deck_id, commander, card_name), all of a deck in one task of about ``ROWS`` rows."""
    kept = written(decks.select("deck_id", "commander", "card_name"), "decks")
    return kept.repartition(kept.count() // ROWS + 1, "deck_id")


def card_statistics(decks: DataFrame) -> DataFrame:
    """For each card: decks with it, all decks, their ratio in percent, commanders with
    it, and the logarithm of all commanders over those."""
    decks = dealt(decks)
    in_decks = decks.select("deck_id", "card_name").distinct().groupBy("card_name").agg(F.count("*").alias("decks_count"))
    under = decks.select("commander", "card_name").distinct().groupBy("card_name").agg(F.count("commander").alias("commanders_count"))
    totals = decks.select("deck_id").distinct().agg(F.count("*").alias("total_decks")).join(decks.select("commander").distinct().agg(F.count("commander").alias("total_commanders")), F.lit(True))
    joined = in_decks.join(under, "card_name").join(F.broadcast(totals), F.lit(True))  # totals are one row
    rate = F.col("decks_count") / F.col("total_decks") * 100
    return joined.select("card_name", "decks_count", "total_decks", rate.alias("global_frequency"), "commanders_count", F.log(F.col("total_commanders") / F.col("commanders_count")).alias("idf"))


def commander_statistics(decks: DataFrame) -> DataFrame:
    """For each commander and card: decks with both, the commander's decks, percent."""
    decks = dealt(decks)
    pairs = decks.select("deck_id", "commander").distinct().groupBy("commander").agg(F.count("*").alias("total_decks"))
    cards = decks.select("deck_id", "commander", "card_name").distinct().groupBy("commander", "card_name").agg(F.count("*").alias("decks_with_card"))
    return cards.join(pairs, "commander").withColumn("inclusion_rate", F.col("decks_with_card") / F.col("total_decks") * 100)
