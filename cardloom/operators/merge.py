"""De-duplication and merging by business key.

All functions take and return DataFrames; writing the result as a new snapshot is
the caller's step.  Where one key may hold very many rows the reduction is an
aggregate, which combines before the shuffle, and not a window over the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.sources.storage import written


def _whole(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _keyed(keys: Sequence[str]) -> Column:
    """True where no key is null."""
    out = F.lit(True)
    for key in keys:
        out = out & F.col(f"`{key}`").isNotNull()
    return out


def last_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of a key the last by ``order``; a null is a key of its own."""
    picked = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(_whole(df), F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of a key the first by ``order``; a null is a key of its own."""
    picked = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min_by(_whole(df), F.struct(*order)).alias("_row"))
    return picked.select("_row.*")


def insert_absent(target: DataFrame, stage: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of ``stage`` to append: the first of each key that ``target`` lacks.

    A key with a null in it conflicts with nothing, so such rows all come through;
    they are set apart first and so never meet in one partition.
    """
    known = target.filter(_keyed(keys)).select(*keys).distinct()
    new = first_of_each(stage.filter(_keyed(keys)), keys, order).join(known, list(keys), "left_anti").select(*stage.columns)
    return new.unionByName(stage.filter(~_keyed(keys)))


def upsert(target: DataFrame, stage: DataFrame, keys: Sequence[str], update: Mapping[str, Column] | Sequence[str], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """``target`` with the rows of ``stage`` (one for each key) merged in.

    Columns in ``update`` take the stage's value, nulls included; a mapping gives an
    expression over the stage's columns.  Other columns keep the target's value and
    get their default, or else the stage's value, in rows that are new.
    """
    update = update if isinstance(update, Mapping) else {c: F.col(c) for c in update}
    defaults = defaults or {}
    named = [F.col(f"`{k}`") for k in keys]
    old = target.select(*named, _whole(target).alias("_old"))
    values = {c: update.get(c, defaults.get(c, F.col(f"`{c}`") if c in stage.columns else F.lit(None))) for c in target.columns if c not in keys}
    new = stage.select(*named, F.struct(*[v.alias(c) for c, v in values.items()]).alias("_new"))
    both = old.join(new, list(keys), "full_outer")

    def column(c: str) -> Column:
        if c in keys:
            return F.col(f"`{c}`")
        fresh, kept = F.col("_new")[c], F.col("_old")[c]
        if c in update:
            return F.when(F.col("_new").isNotNull(), fresh).otherwise(kept).alias(c)
        return F.when(F.col("_old").isNotNull(), kept).otherwise(fresh).alias(c)

    return both.select(*[column(c) for c in target.columns])


def replace_children(target: DataFrame, stage: DataFrame, parent: str | Sequence[str]) -> DataFrame:
    """All children of the parents in ``stage`` give way to those of ``stage``; the
    children of other parents stay."""
    parent = [parent] if isinstance(parent, str) else list(parent)
    kept = target.join(stage.select(*parent).distinct(), parent, "left_anti").select(*target.columns)
    return kept.unionByName(stage.select(*target.columns))


def numbered(df: DataFrame, key: str, out: str, start: int = 1, rows_per_part: int | None = None) -> DataFrame:
    """Adds consecutive numbers in the order of ``key``, nulls first.

    Rows are dealt out by ranges of the key, sorted within, and written with their place in
    their range; the rows before a range are a sum over the ranges' sizes, a row each.  No
    key passes through the driver, and no task sorts all.  The number of ranges is the
    session's, or follows from ``rows_per_part``.
    """
    ranges = [-(-df.count() // rows_per_part) or 1] if rows_per_part else []
    # the place is the number of the range in the high bits and that of the row in the low 33
    ranged = df.repartitionByRange(*ranges, key).sortWithinPartitions(key).withColumn("_place", F.monotonically_increasing_id())
    ranged = written(ranged, "numbered")
    part = F.shiftrightunsigned("_place", 33)
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row for each task
    return placed.select(*df.columns, (own + F.col("_before") + start).alias(out))


def surrogate_ids(known: DataFrame, keys: DataFrame, key: str, out: str, largest: int | None = None) -> DataFrame:
    """(key, id) for the known keys as they are and for new ones after the largest id, which
    is to be given if ``known`` are not all."""
    if largest is None:
        largest = known.agg(F.coalesce(F.max(out), F.lit(0)).alias("n")).first()["n"]
    new = keys.select(key).filter(F.col(key).isNotNull()).distinct().join(known, key, "left_anti")
    return known.select(key, out).unionByName(numbered(new, key, out, start=largest + 1).select(key, out))


def cascade(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Children of deleted parents go."""
    return children.join(deleted.select(key).distinct(), key, "left_anti").select(*children.columns)


def set_null(children: DataFrame, deleted: DataFrame, column: str, key: str) -> DataFrame:
    """Children of deleted parents stay and lose the reference."""
    gone = deleted.select(F.col(key).alias(column)).distinct().withColumn("_gone", F.lit(True))
    has = F.col(column).isNotNull()
    # those without a reference have nothing to lose, and would meet in one partition
    joined = children.filter(has).join(gone, column, "left")
    return joined.withColumn(column, F.when(F.col("_gone").isNull(), F.col(column))).select(*children.columns).unionByName(children.filter(~has))
