"""What a row must hold to be taken into a table: one declared table of rules, compiled
into one projection that gives each row its reasons for being refused."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.values import overflows


@dataclass(frozen=True)
class Rules:
    """Columns that must have a value, the most characters of text columns, and the decimal
    type that a column of numbers as text must fit."""

    required: tuple[str, ...] = ()
    longest: Mapping[str, int] = field(default_factory=dict)
    decimals: Mapping[str, str] = field(default_factory=dict)


# The widths and required columns of the catalogue's tables.
RULES = {
    "sets": Rules(
        required=("code", "name"),
        longest={"code": 16, "name": 255, "set_type": 50, "block": 100, "parent_set_code": 16},
    ),
    "cards": Rules(
        required=("oracle_id", "name", "normalized_name"),
        longest={"oracle_id": 36, "name": 255, "normalized_name": 255, "mana_cost": 100, "type_line": 255, "power": 10, "toughness": 10, "loyalty": 10, "defense": 10},
    ),
    "faces": Rules(
        required=("face_name",),
        longest={"face_name": 255, "mana_cost": 100, "type_line": 255, "power": 10, "toughness": 10, "loyalty": 10, "defense": 10},
    ),
    "printings": Rules(
        required=("scryfall_id", "oracle_id"),
        longest={"scryfall_id": 36, "oracle_id": 36, "set_code": 16, "collector_number": 20, "lang": 10, "rarity": 20, "artist": 255, "border_color": 20, "frame": 20},
    ),
    "prices": Rules(
        required=("source", "currency", "price_type", "date"),
        longest={"source": 50, "currency": 3, "price_type": 20},
        decimals={"text": "decimal(10,2)"},
    ),
    "tags": Rules(required=("card_id", "tag_name"), longest={"tag_name": 100}),
    "products": Rules(required=("id_product", "en_name", "raw_json")),
    "deck_commanders": Rules(required=("commander", "card_name"), longest={"commander": 255}),
}


def reasons(rules: Rules) -> Column:
    """The rules that a row breaks, as texts in the order of the table; empty if none."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in rules.required]
    broken += [F.when(F.length(c) > n, F.lit(f"{c} is longer than {n}")) for c, n in rules.longest.items()]
    broken += [F.when(overflows(F.col(c), kind), F.lit(f"{c} does not fit {kind}")) for c, kind in rules.decimals.items()]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def split(df: DataFrame, rules: Rules | str) -> tuple[DataFrame, DataFrame]:
    """Rows that hold the rules (of a table, if it is a name), and the others with ``reason``.

    Widths and types are asked of the columns that are there; required columns must be.
    """
    rules = RULES[rules] if isinstance(rules, str) else rules
    there = lambda of: {c: x for c, x in of.items() if c in df.columns}
    judged = df.withColumn("reason", F.array_join(reasons(replace(rules, longest=there(rules.longest), decimals=there(rules.decimals))), "; "))
    return judged.filter("reason = ''").drop("reason"), judged.filter("reason <> ''")


def tally(bad: DataFrame) -> DataFrame:
    """(reason, n): how often each rule was broken; a row that breaks several counts for each."""
    return bad.select(F.explode(F.split("reason", "; ")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
