"""Rows of the market tables from records that are maps of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.functions.plans import once, where_computed
from cardloom.functions.text import text_or_null
from cardloom.functions.values import first_present, integer_or_null, overflows, plain_number
from cardloom.sources import schemas


def product_id(record: Column) -> Column:
    """The product id; 0 is none, whether it is written as a number or as text."""
    return F.nullif(integer_or_null(first_present(record, schemas.PRODUCT_ID)), F.lit(0))


def _split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    known = records.withColumn("id_product", product_id(F.col("record")))
    good, bad = where_computed(known, "id_product is not null"), where_computed(known, "id_product is null")
    return good, bad.drop("id_product").withColumn("reason", F.lit("no product id"))


def product_rows(records: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """Products, and a quarantine of records without a usable id."""
    good, bad = _split(records)
    record = F.col("record")
    numbers = [integer_or_null(first_present(record, keys)).alias(c) for c, keys in schemas.PRODUCT_NUMBERS.items()]
    texts = [text_or_null(first_present(record, keys)).alias(c) for c, keys in schemas.PRODUCT_TEXTS.items()]
    name = F.coalesce(first_present(record, schemas.PRODUCT_NAME), F.lit("")).alias("en_name")
    return good.select("id_product", *numbers, name, *texts, F.to_json("record").alias("raw_json"), *more), bad


def price_entries(records: DataFrame, *more: str, overflow: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Price entries with their 15 prices, and a quarantine.  ``overflow`` names a further
    column for the names of prices that are numbers but don't fit.

    The keys are data and not code: spelled out, the look-ups of all spellings would be
    more code than the JVM compiles.
    """
    good, bad = _split(records)
    read = with_price_texts(good).withColumn("_plain", F.transform("_texts", plain_number))
    number = lambda i: F.get("_plain", i).try_cast("decimal(38,18)")
    columns = [F.when(number(i) != 0, number(i).try_cast("decimal(12,4)")).alias(c) for i, c in enumerate(schemas.PRICES)]
    if overflow:
        names = F.array(*map(F.lit, schemas.PRICES))
        over = F.filter(names, lambda n, i: overflows(F.get("_texts", i), "decimal(12,4)"))
        columns.append(over.alias(overflow))
    return read.select("id_product", *columns, F.to_json("record").alias("raw_json"), *more), bad


def with_price_texts(records: DataFrame) -> DataFrame:
    """Adds ``_texts``: for each price the value of the first of its keys that the record
    has, even if that value is null.

    The record's entries are sorted by the place of their key among all spellings, eight
    places for each price, and of each price the first is taken.
    """
    places = F.create_map(*[x for i, keys in enumerate(schemas.PRICES.values()) for j, k in enumerate(keys) for x in (F.lit(k), F.lit(8 * i + j))])
    price = lambda e: F.shiftright(e["place"], 3)
    sorted_ = F.sort_array(F.transform(F.map_entries("record"), lambda e: F.struct(F.try_element_at(places, e["key"]).alias("place"), e["value"].alias("text"))))
    first_of = lambda s: F.filter(s, lambda e, i: (i == 0) | ~price(F.get(s, i - 1)).eqNullSafe(price(e)))
    turns = F.sequence(F.lit(0), F.lit(len(schemas.PRICES) - 1))
    picked = lambda first, numbers: F.transform(turns, lambda i: F.get(first, F.array_position(numbers, i).cast("int") - 1)["text"])
    texts = once(sorted_, lambda s: once(first_of(s), lambda first: once(F.transform(first, price), lambda numbers: picked(first, numbers))))
    return records.withColumn("_texts", texts)


def overflowing_prices(records: DataFrame) -> DataFrame:
    """(id_product, price, text) for prices that are numbers but too large to be kept."""
    good, _ = _split(records)
    texts = F.map_from_arrays(F.array(*map(F.lit, schemas.PRICES)), F.col("_texts"))
    return with_price_texts(good).select("id_product", F.explode(texts).alias("price", "text")).filter(overflows(F.col("text"), "decimal(12,4)"))


def localizations(records: DataFrame) -> DataFrame:
    """Names of products by language; only with a language id and a name."""
    good, _ = _split(records)
    listed = F.from_json(first_present(F.col("record"), schemas.LOCALIZATIONS), "array<map<string,string>>")
    rows = good.select("id_product", F.explode(listed).alias("l"))
    l = F.col("l")  # noqa: E741
    read = rows.select("id_product", integer_or_null(first_present(l, schemas.LANGUAGE_ID)).alias("id_language"), text_or_null(first_present(l, schemas.LANGUAGE_NAME)).alias("language_name"), text_or_null(first_present(l, schemas.LOCAL_NAME)).alias("product_name"))
    return read.filter("id_language is not null and product_name is not null")
