"""Deletions along declared foreign keys, through any number of levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.operators.links import keyed
from cardloom.sources.storage import written


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to ``parent.key``; when the parent's row goes, the child's row
    goes too ("cascade") or loses the reference ("set null")."""

    child: str
    column: str
    parent: str
    key: str
    action: str = "cascade"


# The references between the catalogue's tables.
CATALOGUE = (
    ForeignKey("printings", "card_id", "cards", "id", "cascade"),
    ForeignKey("printings", "set_code", "sets", "code", "set null"),
    ForeignKey("tags", "card_id", "cards", "id", "cascade"),
    ForeignKey("faces", "card_id", "cards", "id", "cascade"),
    ForeignKey("prices", "printing_id", "printings", "id", "cascade"),
    ForeignKey("entries", "id_product", "products", "id_product", "set null"),
    ForeignKey("entries", "import_file_id", "ledger", "id", "cascade"),
)


def in_order(keys: Sequence[ForeignKey]) -> list[str]:
    """Tables with parents before children; references in a circle are refused."""
    of: dict[str, set[str]] = {}
    for k in keys:
        if k.action not in ("cascade", "set null"):
            raise ValueError(f"unknown action {k.action}")
        of.setdefault(k.parent, set())
        of.setdefault(k.child, set()).add(k.parent)
    try:
        return list(TopologicalSorter(of).static_order())
    except CycleError as error:
        raise ValueError(f"references in a circle: {' -> '.join(error.args[1])}") from error


def _marked(df: DataFrame, column: str, gone: DataFrame, key: str, mark: str) -> DataFrame:
    """Adds whether the row refers to a key that is gone; rows without a reference are
    apart, as they would meet in one partition."""
    keys = gone.select(F.col(key).alias(column)).filter(F.col(column).isNotNull()).distinct().withColumn(mark, F.lit(True))
    referring, others = keyed(df, [column])
    joined = referring.join(keys, column, "left").select(*df.columns, F.coalesce(mark, F.lit(False)).alias(mark))
    return joined.unionByName(others.withColumn(mark, F.lit(False)))


def delete(tables: Mapping[str, DataFrame], deleted: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = CATALOGUE) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """What is left of the tables, and their rows that go, when the rows that match
    ``deleted`` (for a table, rows of some of its columns) are deleted.

    Tables are done parents first, so each is done once, with all deletions above it known;
    a row that several parents take goes once, and one that goes loses no reference.  Tables
    that no deletion reaches come back as they are and are not read.
    """
    left, gone = dict(tables), {}
    for name in [*in_order(keys), *(t for t in tables if not any(t in (k.child, k.parent) for k in keys))]:
        own = [k for k in keys if k.child == name and k.parent in gone]
        if name not in tables or not (own or name in deleted):
            continue
        df = tables[name]
        marks = [f"_m{i}" for i in range(len(own))]
        judged = df
        for k, mark in zip(own, marks, strict=True):
            judged = _marked(judged, k.column, gone[k.parent], k.key, mark)
        goes = F.lit(False)
        for k, mark in zip(own, marks, strict=True):
            if k.action == "cascade":
                goes = goes | F.col(mark)
        if name in deleted:
            wanted = deleted[name].distinct().withColumn("_deleted", F.lit(True))
            judged = judged.join(wanted, deleted[name].columns, "left").select(*df.columns, *marks, "_deleted")
            goes = goes | F.coalesce("_deleted", F.lit(False))
        judged = written(judged.withColumn("_goes", goes), "cascade")
        nulled = {k.column: mark for k, mark in zip(own, marks, strict=True) if k.action == "set null"}
        left[name] = judged.filter("not _goes").select(*[F.when(~F.col(nulled[c]), F.col(f"`{c}`")).alias(c) if c in nulled else F.col(f"`{c}`") for c in df.columns])
        gone[name] = judged.filter("_goes").select(*[f"`{c}`" for c in df.columns])
    return left, gone
