"""Readers of the landed JSON files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.sources import databases, json_scan, schemas
from cardloom.sources.storage import ship, written


def landed_text(spark: SparkSession, path: str, wrapped: bool, chunk_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """The chunks (file, block, seq, data) of JSON files, written, and their states (file,
    block, seq, state, whole); see ``json_scan``.

    Files are split wherever a brace closes, so a file of one line is read by many tasks
    too.  Whether the last piece of a file ends with a brace tells the file's size, or else,
    for a compressed file, that the brackets add up.
    """
    ship(spark)
    pieces = spark.read.option("lineSep", "}").text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"))
    schema = pa.schema([("file", pa.string()), ("size", pa.int64()), ("block", pa.int64()), ("seq", pa.int64()), ("data", pa.binary()), ("summary", pa.string()), ("shorter", pa.string())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n, seq = None, [], 0, 0

        def chunk(last: bool) -> pa.RecordBatch:
            data = b"".join(held)
            return pa.RecordBatch.from_pylist([{"file": at[0], "size": at[1], "block": at[2], "seq": seq, "data": data, "summary": json_scan.summary(data), "shorter": json_scan.summary(data[:-1]) if last else None}], schema=schema)

        for batch in batches:
            for value, *of in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "size", "block")), strict=True):
                if of != at:
                    if held:
                        yield chunk(True)
                    at, held, n, seq = of, [], 0, 0
                elif n >= chunk_bytes:
                    yield chunk(False)
                    held, n, seq = [], 0, seq + 1
                held += (value, b"}")
                n += len(value) + 1
        if held:
            yield chunk(True)

    chunks = written(pieces.mapInArrow(gather, "file string, size long, block long, seq long, data binary, summary string, shorter string"), "chunks")

    def composed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "seq"])
        added = rows["n"].sum() - rows["size"].iloc[0]
        with_brace, without = list(rows["summary"]), [*rows["summary"].iloc[:-1], rows["shorter"].iloc[-1]]
        states, whole = json_scan.compose(with_brace if added == 0 else without, wrapped)
        if added not in (0, 1):  # a compressed file
            states, whole = json_scan.compose(with_brace, wrapped)
            if not whole:
                states, whole = json_scan.compose(without, wrapped)
                added = 1
        short = [False] * (len(rows) - 1) + [added == 1]
        return pd.DataFrame({"file": rows["file"], "block": rows["block"], "seq": rows["seq"], "state": [s.to_json() for s in states], "number": range(len(rows)), "short": short, "whole": whole})

    small = chunks.select("file", "size", "block", "seq", "summary", "shorter", F.octet_length("data").alias("n"))
    states = small.groupBy("file").applyInPandas(composed, "file string, block long, seq long, state string, number long, short boolean, whole boolean")
    return chunks.select("file", "block", "seq", "data"), written(states, "states")


def elements(spark: SparkSession, path: str, wrapped: bool = False) -> tuple[DataFrame, DataFrame]:
    """The elements of JSON files as (file, number, place, list, raw), where ``number`` and
    ``place`` give their order in the file and ``list`` the name of the wrapped list that
    holds them; and the states of the files' chunks.

    Outside of wrapped lists nothing is given out.  A list without elements gives one row
    whose ``raw`` is null.
    """
    chunks, states = landed_text(spark, path, wrapped)
    schema = pa.schema([("file", pa.string()), ("number", pa.int64()), ("since", pa.int64()), ("place", pa.int64()), ("list", pa.string()), ("part", pa.binary()), ("whole", pa.bool_())])

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, number, data, text, short in zip(*(batch.column(c).to_pylist() for c in ("file", "number", "data", "state", "short")), strict=True):
                state, out, seen = json_scan.State.from_json(text), [], set()
                for place, (part, from_before, goes_on, name) in enumerate(json_scan.split(data[:-1] if short else data, state)):
                    if state.base == 2 and name is None:
                        continue
                    whole = not (from_before or goes_on)
                    if whole and not part.strip(b" \t\r\n"):
                        if state.base != 2 or name in seen:
                            continue
                        part = None  # tells that there is a list of this name
                    seen.add(name)
                    out.append((file, number, state.since if from_before else number, -1 if from_before else place, name, part, whole))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    placed = chunks.join(states, ["file", "block", "seq"]).select("file", "number", "data", "state", "short")
    parts = written(placed.mapInArrow(divide, "file string, number long, since long, place long, list string, part binary, whole boolean"), "parts")
    across = parts.filter("not whole").groupBy("file", "since").agg(F.max("place").alias("place"), F.max("list").alias("list"), F.sort_array(F.collect_list(F.struct("number", "place", "part"))).alias("parts"))
    joined = across.select("file", F.col("since").alias("number"), "place", "list", F.aggregate("parts", F.lit("").cast("binary"), lambda a, p: F.concat(a, p["part"])).alias("part"))
    found = parts.filter("whole").select("file", "number", "place", "list", "part").unionByName(joined)
    raw = F.btrim(F.col("part").cast("string"), F.lit(" \t\r\n,\ufeff"))
    return found.select("file", "number", "place", "list", F.nullif(raw, F.lit("")).alias("raw")), states


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of top-level JSON arrays of any layout, and of files of records without
    brackets around them.

    Columns: ``record``, ``raw`` (its text) and ``ord`` (its place).  What is no JSON object
    gives a null record and is not lost.
    """
    found = elements(spark, path)[0].filter("raw is not null")
    record = F.from_json("raw", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return found.select(F.when(F.col("raw").startswith("{"), record).alias("record"), "raw", F.struct("file", "number", "place").alias("ord"))


def good_and_bad(read: DataFrame, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Records that could be read and have the required fields, as columns with ``raw``
    and ``ord``, and a quarantine of all others with the reason."""
    unreadable = F.col("record").isNull() | F.col("record._bad").isNotNull()
    reason = F.when(unreadable, F.lit("not readable as JSON"))
    for name in required:
        reason = reason.when(F.coalesce(F.col(f"record.{name}") == "", F.lit(True)), F.lit(f"{name} is missing"))
    judged = read.withColumn("reason", reason)
    return judged.filter("reason is null").select("record.*", "raw", "ord").drop("_bad"), judged.filter("reason is not null").select("raw", "ord", "reason")


def unwrap(text: Column, keys: Sequence[str]) -> Column:
    """The list in a JSON text, its elements as texts: the text itself, or the value of
    the first key whose value is a list; else an empty list."""
    listed = lambda x: F.when(x.rlike(r"^\s*\["), F.from_json(x, "array<string>"))
    tries = [listed(text), *[listed(F.get_json_object(text, f"$['{k}']")) for k in keys]]
    return F.coalesce(*tries, F.array().cast("array<string>"))


def as_map(element: Column) -> Column:
    """An element as a map of text; null if it is no object."""
    return F.when(element.rlike(r"^\s*\{"), F.from_json(element, "map<string,string>"))


def split_wrapped(texts: DataFrame, keys: Sequence[str], *names: str) -> tuple[DataFrame, DataFrame]:
    """For texts (column value, and those named) of wrapped documents one row (names, ord,
    record) for each element, and a quarantine (names, ord, reason): a text that isn't
    JSON, and elements that are no objects."""
    readable = F.try_parse_json("value").isNotNull()
    found = texts.filter(readable).select(*names, F.posexplode(unwrap(F.col("value"), keys)).alias("ord", "element"))
    found = found.select(*names, "ord", as_map(F.col("element")).alias("record"))
    bad = texts.filter(~readable).select(*names, F.lit(None).cast("int").alias("ord"), F.lit("not readable as JSON").alias("reason"))
    return found.filter("record is not null"), bad.unionByName(found.filter("record is null").select(*names, "ord", F.lit("no object").alias("reason")))


def read_wrapped(spark: SparkSession, path: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """One row (file, ord, record) for each element of wrapped documents, and a quarantine
    (file, ord, reason): files whose brackets don't add up, elements that can't be read and
    elements that are no objects.

    The list of a file is the file itself, or the value of the first of ``keys`` that is a
    list.  Files are split as those of arrays are; no row holds more than an element.
    """
    found, states = elements(spark, path, wrapped=True)
    files = states.groupBy("file").agg(F.bool_and("whole").alias("whole"))
    turn = F.coalesce(F.array_position(F.array(*map(F.lit, keys)), F.col("list")), F.lit(0))
    listed = found.withColumn("turn", turn).filter("list is null or turn > 0")
    chosen = listed.groupBy("file").agg(F.min("turn").alias("turn"))
    kept = listed.filter("raw is not null").join(chosen, ["file", "turn"], "left_semi").join(files.filter("whole"), "file", "left_semi")
    ord_ = F.struct("number", "place").alias("ord")
    readable = F.try_parse_json("raw").isNotNull()
    read = kept.select("file", ord_, "raw", F.when(~readable, "not readable as JSON").when(~F.col("raw").startswith("{"), "no object").alias("reason"))
    cut = files.filter("not whole").select("file", F.lit(None).cast("struct<number: bigint, place: bigint>").alias("ord"), F.lit("not readable as JSON").alias("reason"))
    return read.filter("reason is null").select("file", "ord", as_map(F.col("raw")).alias("record")), cut.unionByName(read.filter("reason is not null").select("file", "ord", "reason"))


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    pages = spark.read.schema(schemas.SET_PAGE).json(path, multiLine=True)
    return pages.select(F.explode("data").alias("s")).select("s.*")


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """The names of all pages of a list, with their order."""
    pages = spark.read.schema(schemas.NAME_PAGE).json(path, multiLine=True).select("data", F.col("_metadata.file_path").alias("file"))
    return pages.select("file", F.posexplode("data").alias("place", "d")).select(F.col("d.name").alias("name"), "file", "place")


def read_tag_responses(spark: SparkSession, path: str) -> DataFrame:
    """(set code, collector number, card name, taggings) of saved responses, one a line,
    with the request they answer; responses without a card give no row."""
    read = spark.read.schema(schemas.TAG_RESPONSE).json(path)
    return read.filter("data.card is not null").select("set_code", "collector_number", "data.card.name", "data.card.taggings")


def count_records(spark: SparkSession, path: str) -> int:
    """The number of elements, for a run that writes nothing; no record is parsed."""
    return elements(spark, path)[0].filter("raw is not null").count()


def read_database(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of a database; see ``databases`` for reading by ranges."""
    return databases.read_database(spark, url, name, **options)


def write_database(df: DataFrame, url: str, name: str, mode: str = "append", **options: str) -> None:
    databases.write_database(df, url, name, mode, **options)
