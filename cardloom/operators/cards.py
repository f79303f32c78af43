"""Rows of the card tables from records of the bulk dump (see ``schemas.CARD``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.text import normalize_name
from cardloom.functions.values import date_or_null, empty_to_null, overflows
from cardloom.operators.constraints import split

_PASSED = ("type_line", "oracle_text", "power", "toughness", "loyalty", "defense")
_LISTS = ("colors", "color_identity", "keywords")
#: (currency, kind, field of prices)
PRICE_FIELDS = (("eur", "regular", "eur"), ("eur", "foil", "eur_foil"), ("usd", "regular", "usd"), ("usd", "foil", "usd_foil"), ("tix", "regular", "tix"))


def _list_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.array().cast("array<string>"))


def first_face() -> Column:
    return F.get(F.col("card_faces"), 0)


def mana_cost() -> Column:
    """The record's cost, or its first face's if it has none."""
    return F.coalesce(empty_to_null(F.col("mana_cost")), empty_to_null(first_face()["mana_cost"]))


def card_rows(records: DataFrame, *more: str) -> DataFrame:
    """Records as cards; those without a card key are left out.  ``more`` names
    columns to carry along, such as the place in the file."""
    kept = records.filter("oracle_id is not null and oracle_id <> ''")
    name = F.coalesce("name", F.lit(""))
    return kept.select(
        "oracle_id",
        name.alias("name"),
        normalize_name(name).alias("normalized_name"),
        mana_cost().alias("mana_cost"),
        F.col("cmc").alias("mana_value"),
        *_PASSED,
        *[_list_or_empty(F.col(c)).alias(c) for c in _LISTS],
        F.coalesce(F.try_element_at("legalities", F.lit("commander")) == "legal", F.lit(False)).alias("legal_commander"),
        "edhrec_rank",
        *more,
    )


def face_rows(records: DataFrame, *keys: str) -> DataFrame:
    """One row for each face, with its number and the record's ``keys``."""
    faces = records.select(*keys, F.posexplode("card_faces").alias("face_index", "face"))
    images = [F.col(f"face.image_uris.{size}").alias(f"image_{size}") for size in ("small", "normal", "large")]
    return faces.select(
        *keys,
        "face_index",
        F.coalesce("face.name", F.lit("")).alias("face_name"),
        empty_to_null(F.col("face.mana_cost")).alias("mana_cost"),
        *[F.col(f"face.{c}").alias(c) for c in _PASSED],
        _list_or_empty(F.col("face.colors")).alias("colors"),
        *images,
    )


def printed_name() -> Column:
    """The printed name, or the faces' printed names joined."""
    faces = F.filter(F.transform("card_faces", lambda f: f["printed_name"]), lambda n: n != "")
    return F.coalesce(empty_to_null(F.col("printed_name")), empty_to_null(F.array_join(faces, " // ")))


def printing_rows(records: DataFrame, *more: str) -> DataFrame:
    """Records as printings.  Images come as a whole from the record, or from the first
    face if the record has none at all."""
    own, face = F.col("image_uris"), first_face()["image_uris"]
    has_own = F.coalesce(own["small"], own["normal"], own["large"]).isNotNull()
    image = lambda size: F.when(has_own, own[size]).otherwise(face[size]).alias(f"image_{size}")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("full_art", "promo", "reprint", "digital")]
    return records.select(
        F.col("id").alias("scryfall_id"),
        F.coalesce("oracle_id", F.lit("")).alias("oracle_id"),
        F.col("set").alias("set_code"),
        "collector_number",
        "lang",
        "rarity",
        date_or_null(F.col("released_at")).alias("released_at"),
        "artist",
        "border_color",
        "frame",
        *flags,
        *map(image, ("small", "normal", "large")),
        "scryfall_uri",
        "cardmarket_id",
        printed_name().alias("printed_name"),
        *more,
    )


def price_texts(records: DataFrame, date: Column, source: str, *keys: str) -> DataFrame:
    """A row (keys, source, currency, price_type, text, date) for each price of a record that is
    given at all, whatever its text."""
    all_prices = F.array(*[F.struct(F.lit(c).alias("currency"), F.lit(k).alias("price_type"), F.col(f"prices.{f}").alias("text")) for c, k, f in PRICE_FIELDS])
    rows = records.select(*keys, F.explode(F.filter(all_prices, lambda p: p["text"].isNotNull())).alias("p"))
    return rows.select(*keys, F.lit(source).alias("source"), "p.currency", "p.price_type", "p.text", date.alias("date"))


def priced(texts: DataFrame) -> DataFrame:
    """Rows of ``price_texts`` with the price as a number; texts that are none are left out,
    a price of 0 is one."""
    read = texts.withColumn("text", F.col("text").try_cast("decimal(10,2)")).withColumnRenamed("text", "price")
    return read.filter("price is not null")


def price_rows(records: DataFrame, date: Column, source: str, *keys: str) -> DataFrame:
    """Up to five prices of a record as rows; an empty text is none."""
    return priced(price_texts(records, date, source, *keys)).select(*keys, "source", "currency", "price_type", "price", "date")


def overflowing(records: DataFrame, *keys: str) -> DataFrame:
    """(keys, currency, price_type, text) for prices that are numbers but too large to be kept."""
    texts = price_texts(records, F.lit(None).cast("date"), "", *keys)
    return texts.filter(overflows(F.col("text"), "decimal(10,2)")).select(*keys, "currency", "price_type", "text")


def set_rows(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets with code and name, their dates read, and a quarantine of those that break the rules of the table."""
    good, bad = split(sets, "sets")
    return good.withColumn("released_at", date_or_null(F.col("released_at"))), bad
