"""Checks and profiles of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: percent of rows with a value, column by column, and of rows with none."""
    percent = lambda c: F.avg(c.cast("double")) * 100
    rates = [percent(F.col(c).isNotNull()).alias(f"{c}_filled") for c in columns]
    return df.agg(*rates, percent(F.coalesce(*columns).isNull()).alias("all_null"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several rows have; a key with a null in it is never one."""
    keyed = df
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    return keyed.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def quarantine(df: DataFrame, required: Sequence[str] = (), longest: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that hold the rules, and the others with the rules they break."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required]
    broken += [F.when(F.length(c) > n, F.lit(f"{c} is longer than {n}")) for c, n in (longest or {}).items()]
    judged = df.withColumn("reason", F.concat_ws("; ", *broken))
    return judged.filter("reason = ''").drop("reason"), judged.filter("reason <> ''")


def first_and_last_seen(entries: DataFrame, key: str, time: str) -> DataFrame:
    return entries.groupBy(key).agg(F.min(time).alias("first_seen_at"), F.max(time).alias("last_seen_at"))
