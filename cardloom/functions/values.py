"""Tolerant conversions: a value that can't be read is null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardloom.functions.text import strip_blank


def date_or_null(text: Column) -> Column:
    """An ISO date, with or without hyphens; anything looser is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date")).when(text.rlike(r"^\d{8}\z"), F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)).try_cast("date"))


def integer_or_null(text: Column) -> Column:
    """A whole number, blanks around it allowed; ``12.0`` is none."""
    stripped = strip_blank(text)
    return F.when(stripped.rlike(r"^[+-]?\d+\z"), stripped.try_cast("bigint"))


def plain_number(text: Column) -> Column:
    """A number's text with a point for a comma and no blanks around it."""
    return F.replace(strip_blank(text), F.lit(","), F.lit("."))


def decimal_or_null(text: Column) -> Column:
    """A decimal with point or comma, blanks around it allowed."""
    return plain_number(text).try_cast("decimal(38,18)")


def price_or_null(text: Column) -> Column:
    """A decimal of four digits; 0 stands for no data and is null.

    Whether it is 0 is seen before rounding to four digits.
    """
    number = decimal_or_null(text)
    return F.when(number != 0, number.try_cast("decimal(12,4)"))


def overflows(text: Column, kind: str) -> Column:
    """Whether a text is a number that the decimal type ``kind`` can't hold."""
    plain = plain_number(text)
    return F.coalesce(plain.try_cast("double").isNotNull() & plain.try_cast(kind).isNull(), F.lit(False))


def time_or_null(text: Column) -> Column:
    """An ISO time with ``Z`` or an offset; anything else is null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})\z"), text.try_cast("timestamp"))


def stamped_name(name: Column, time: Column) -> Column:
    """The last part of a path, with a time before its suffix."""
    last = F.substring_index(name, "/", -1)
    return F.concat(F.regexp_replace(last, r"\.[^.]*\z", ""), F.lit("_"), F.date_format(time, "yyyyMMdd_HHmmss"), F.regexp_extract(last, r"(\.[^.]*)\z", 1))


def first_present(record: Column, keys: Sequence[str]) -> Column:
    """The value of the first key that a map has, even if that value is null."""
    out = None
    for key in keys:
        has, value = F.map_contains_key(record, key), F.try_element_at(record, F.lit(key))
        out = F.when(has, value) if out is None else out.when(has, value)
    return out


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
