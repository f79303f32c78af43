"""The best or the latest row of each group, and the latest price of each printing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nulls_greatest(column: Column) -> list[Column]:
    """Sort terms under which null comes after every value."""
    return [column.isNull(), column]


def best_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest sort terms of each key; a map-side reduction, so a
    key with very many rows is no single task's work."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    terms = F.struct(*[c.alias(f"t{i}") for i, c in enumerate(order)])
    return df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(whole, terms).alias("_row")).select("_row.*")


def latest_of_each(entries: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """The newest row of each key; of equal times the one with the greater ``tie``."""
    return best_of_each(entries, keys, [F.col(time), F.col(tie)])


def printing_for_tags(printings: DataFrame, limit: int | None = None) -> DataFrame:
    """One eligible printing of each card: English first, then the newest, where an
    unknown language or date comes before all others; in the order of the cards."""
    eligible = printings.filter(~F.col("digital") & ~F.col("set_code").isin("sld", "ptc", "plist"))
    best = best_of_each(eligible, ["card_id"], [*nulls_greatest(F.col("lang") == "en"), *nulls_greatest(F.col("released_at")), -F.col("id")])
    return best.orderBy("card_id").limit(limit) if limit else best


def latest_prices(printings: DataFrame, cards: DataFrame, products: DataFrame, entries: DataFrame, reference: str = "cardmarket_id") -> DataFrame:
    """The view of the newest price entry for each printing that has one.

    Entries become one row a product before anything is joined.
    """
    newest = latest_of_each(entries.filter("id_product is not null"), ["id_product"], "captured_at", "id").drop("id")
    linked = printings.filter(F.col(reference).isNotNull()).withColumnRenamed(reference, "id_product")
    return linked.join(cards, "card_id").join(products, "id_product").join(newest, "id_product")
