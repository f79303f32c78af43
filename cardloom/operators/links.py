"""Joins between tables: repair, checks and reports of references."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.text import compatible_name
from cardloom.sources.storage import shared_folder, written


def attach(children: DataFrame, parents: DataFrame, key: str, id_column: str) -> DataFrame:
    """Children with their parent's id; those without a parent are left out."""
    return children.filter(F.col(key).isNotNull()).join(parents.select(key, id_column), key)


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys all have values, and the others: they match nothing, and would
    meet in one partition of a join."""
    has = F.lit(True)
    for key in keys:
        has = has & F.col(f"`{key}`").isNotNull()
    return df.filter(has), df.filter(~has)


def propagate(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Fills nulls of ``column`` from rows with the same keys, the least value of
    several; a null key matches nothing.  Sources are one row a key before the join."""
    known, others = keyed(df, keys)
    sources = known.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(column).alias("_source"))
    filled = known.join(sources, list(keys), "left").withColumn(column, F.coalesce(column, "_source")).select(*df.columns)
    return filled.unionByName(others)


def null_out_unknown(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Keeps every row; a reference that ``known`` lacks becomes null."""
    ids = known.select(F.col(key).alias(column)).distinct().withColumn("_known", F.lit(True))
    referring, others = keyed(df, [column])
    joined = referring.join(ids, column, "left").withColumn(column, F.when(F.col("_known"), F.col(column))).select(*df.columns)
    return joined.unionByName(others)


def split_by_reference(df: DataFrame, column: str, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose reference is there or null, and a quarantine of the rest."""
    ids = known.select(F.col(key).alias(column)).distinct()
    referring, others = keyed(df, [column])
    return referring.join(ids, column, "left_semi").select(*df.columns).unionByName(others), referring.join(ids, column, "left_anti").select(*df.columns)


def without_children(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> DataFrame:
    """Parents that no child refers to."""
    return parents.join(children.select(F.col(child_key).alias(key)).distinct(), key, "left_anti").select(*parents.columns)


def link_report(printings: DataFrame, reference: str, products: DataFrame, key: str) -> DataFrame:
    """One row: products, printings with a reference, those that match, the difference."""
    n = products.agg(F.count("*").alias("total_products"))
    linked = printings.filter(F.col(reference).isNotNull()).groupBy(F.col(reference).alias(key)).agg(F.count("*").alias("n"))
    matches = linked.join(products.groupBy(key).agg(F.count("*").alias("m")), key, "left")
    counts = matches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("with_reference"), F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("matched"))
    return n.join(counts, F.lit(True)).withColumn("unlinked", F.col("with_reference") - F.col("matched"))


def flag_by_name(cards: DataFrame, names: DataFrame, flag: str = "flag", name: str = "name", normalized: str = "normalized_name") -> tuple[DataFrame, DataFrame]:
    """Cards with a flag, and the listed names that flagged nothing.

    A listed name flags the cards of exactly that name; only one that no card has is
    looked up by its folded form.  All flags are set anew.
    """
    listed = names.select(F.col("name").alias("_name")).filter("_name is not null").distinct()
    exact = listed.join(cards.select(F.col(name).alias("_name")).distinct(), "_name", "left_semi")
    others = listed.join(exact, "_name", "left_anti").withColumn("_folded", compatible_name("_name"))
    folded = others.select("_folded").distinct()
    hit = cards.join(exact.select(F.col("_name").alias(name), F.lit(True).alias("_exact")), name, "left").join(folded.select(F.col("_folded").alias(normalized), F.lit(True).alias("_loose")), normalized, "left")
    flagged = hit.withColumn(flag, F.coalesce("_exact", "_loose", F.lit(False))).select(*[c for c in cards.columns if c != flag], flag)
    missed = others.join(cards.select(F.col(normalized).alias("_folded")).distinct(), "_folded", "left_anti")
    return flagged, missed.select(F.col("_name").alias("name"))


def flag_totals(cards: DataFrame, flag: str = "flag") -> DataFrame:
    """One row: cards, and cards with the flag."""
    return cards.agg(F.count("*").alias("cards"), F.count_if(flag).alias("flagged"))


def name_report(names: DataFrame, name: str = "name") -> DataFrame:
    """Different names in order."""
    return names.select(name).filter(F.col(name).isNotNull()).distinct().orderBy(name)


def for_look_ups(df: DataFrame, columns: Sequence[str], rows_per_group: int = 100_000) -> DataFrame:
    """``df`` written so that equality look-ups on ``columns`` skip most of it: in order of the
    first column, so that statistics of files and of row groups tell where its values are,
    and with Bloom filters for the others, which may stand anywhere."""
    path = f"{shared_folder(df.sparkSession)}/cardloom-look-ups-{uuid.uuid4().hex}"
    writer = df.repartitionByRange(*columns[:1]).sortWithinPartitions(*columns).write
    for c in columns[1:]:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(rows_per_group))
    writer.option("parquet.block.row.count.limit", str(rows_per_group)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def look_up(df: DataFrame, column: str, value: str, **others: object) -> DataFrame:
    """Rows whose ``column`` is ``value`` and whose other columns have the values given:
    plain comparisons, which reach a scan sorted or partitioned by these columns."""
    out = df.filter(F.col(column) == value)
    for key, wanted in others.items():
        out = out.filter(F.col(key) == wanted)
    return out


def nested_pages(parents: DataFrame, children: DataFrame, key: str, columns: Sequence[str], out: str, page_bytes: int = 1 << 20) -> DataFrame:
    """Parents with their children in pages: arrays in the order of ``columns`` of about
    ``page_bytes`` at most each (of their text as JSON), with ``page`` and ``pages``.

    A parent without children has one empty page.  Children are dealt out by ranges of
    (key, columns), so those of one parent may be in many tasks; the bytes before
    a range's first child are a sum over the few ranges that the parent has.
    """
    item = F.struct(*columns)
    ranged = children.filter(F.col(key).isNotNull()).select(F.col(key), item.alias("_item"), F.length(F.to_json(item)).cast("long").alias("_bytes"))
    ranged = ranged.repartitionByRange(key, "_item").sortWithinPartitions(key, "_item").withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "children")
    sizes = ranged.groupBy(key, "_part").agg(F.sum("_bytes").alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(key, "_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    own = F.sum("_bytes").over(Window.partitionBy(key, "_part").orderBy("_item").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("_own", F.coalesce(own, F.lit(0))).join(offsets, [key, "_part"])
    page = F.floor((F.col("_own") + F.col("_before")) / page_bytes)
    lists = placed.groupBy(key, page.alias("_page")).agg(F.array_sort(F.collect_list("_item")).alias(out))
    # an item that is longer than a page leaves numbers out
    numbers = Window.partitionBy(key)
    lists = lists.select(key, out, (F.row_number().over(numbers.orderBy("_page")) - 1).alias("page"), F.count("*").over(numbers).alias("pages"))
    joined = parents.join(lists, key, "left")
    return joined.withColumns({out: F.coalesce(F.col(out), F.array().cast(lists.schema[out].dataType)), "page": F.coalesce("page", F.lit(0)), "pages": F.coalesce("pages", F.lit(1))})


def nested(parents: DataFrame, children: DataFrame, key: str, columns: Sequence[str], out: str) -> DataFrame:
    """Parents with their children as a sorted array, empty if there are none."""
    lists = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(out))
    return parents.join(lists, key, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast(lists.schema[out].dataType)))
