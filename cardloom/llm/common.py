"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.sources.storage import shared_folder, table, written  # noqa: F401

#: The white space that separates words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character as it is.

    Where every character is one byte, ``lower`` does just that, and faster.
    """
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(slow)


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of the windows of ``size`` words of a column of words, repeats and
    all; of a shorter text, one hash of all its words; of none, none."""
    windows = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))
    return F.when(F.size(words) >= size, F.slice(windows, 1, F.greatest(F.size(words) - (size - 1), F.lit(0)))).when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<long>"))


def text_keys(text: Column) -> list[Column]:
    """Two hashes that stand for a text in joins."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b")]


def small_if_checked(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df``, to be broadcast only if it is counted to have at most that many rows
    (of a few numbers each); any other join strategy is left to Spark."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def most_frequent(counted: DataFrame, key: str, most: int) -> tuple[list[str], int]:
    """Of a table (key, n) at most ``most`` keys with the largest n, largest first, and
    the least n among them; found by levels, so that only these keys reach the driver.

    Of keys that are about as frequent as the last ones, some are taken by their hash.
    """
    level = (F.floor(F.log2("n") * 16) * 64 + F.pmod(F.xxhash64(key), F.lit(64))).cast("int")
    levels = counted.select(level.alias("level")).groupBy("level").count().collect()  # at most 64 * 16 * 64 rows
    taken, least = 0, None
    for r in sorted(levels, key=lambda r: -r["level"]):
        taken += r["count"]
        if taken > most:
            break
        least = r["level"]
    if least is None:
        return [], 0
    rows = counted.filter(level >= least).select(key, "n").collect()
    rows.sort(key=lambda r: (-r["n"], r[key]))
    return [r[key] for r in rows], rows[-1]["n"]


def removed(df: DataFrame) -> None:
    """Removes the files of a ``written`` table that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def where_computed(df: DataFrame, condition: str) -> DataFrame:
    """Filters after the columns are made.

    Moved below the projections, a condition on a column that comes from lambdas
    over arrays would be evaluated again, arrays included, for every element; the
    optimizer moves nothing below a column that isn't deterministic.
    """
    return df.withColumn("_at", F.monotonically_increasing_id()).filter(f"({condition}) and _at >= 0").drop("_at")


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, unless their Python path has it already."""
    package = Path(__file__).resolve().parents[1]
    context = spark.sparkContext
    on_path = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(":") if p]
    name = f"{package.name}.zip"
    if str(package.parent) in on_path or any(f.endswith(name) for f in context._python_includes):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
