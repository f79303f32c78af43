"""Ledgers of imports: what was run, what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cardloom.operators.latest import latest_of_each


def last_successes(ledger: DataFrame) -> DataFrame:
    """The newest successful import of each kind of file."""
    return latest_of_each(ledger.filter("status = 'success'"), ["file_type"], "started_at", "id")


def landed_files(files: DataFrame) -> DataFrame:
    """Files read as ``binaryFile`` with their digest; the content itself is dropped."""
    return files.select("path", F.col("length").alias("content_length"), F.sha2("content", 256).alias("sha256"))


def changed_files(files: DataFrame, ledger: DataFrame, file_type: str) -> DataFrame:
    """Files whose digest no successful import of that kind has."""
    done = ledger.filter((F.col("status") == "success") & (F.col("file_type") == file_type)).select("sha256").distinct()
    return files.join(done, "sha256", "left_anti")


def counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters that are there once it has been written."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counters.items()]), seen
