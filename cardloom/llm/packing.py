"""Packing by the histogram of lengths, shortest pack first.

A document's ids (with the end id) are cut into full sequences and one rest.
Only the histogram of piece lengths, at most ``size`` rows, reaches the driver,
where lengths are placed longest first into the emptiest packs that still have
room.  That gives *patterns* with counts instead of packs.  Each piece finds its
place by its rank among the pieces of its length: ranks are made in salted
groups, so that a length that a third of all pieces share is no single task.  Full
pieces fill a sequence alone and need no rank: their sequences have numbers of their own
after all others, with gaps between those of different tasks.

Defined results: a null or empty text is the end id alone; very long texts are cut into
as many pieces as they need; pieces of one length are ranked by salt, id, start and
checksum, and those alike in all have the ranks in any order, which shows in no column;
repeated rows are packed one by one; an empty input gives an empty result; only the two
named columns are read, whatever others are called.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import ship, written
from cardloom.llm.pretokens import for_worker, texts

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Pieces of one length that are ranked in one group.
GROUP = 400


def pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """One row for each piece of each document (columns doc_id, text)."""
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = for_worker(tokenizer)
        end = cache.packed([end_id])
        for batch in batches:
            out: list[list[int]] = [[] for _ in schema]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                ids = cache.ids(text) + end
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    for column, value in zip(out, (doc_id, start, len(part) // 4, zlib.crc32(part), total), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], schema=schema)

    return docs.mapInArrow(cut, PIECES)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(number of packs, [(length, times)]) for each pattern.

    Lengths come longest first; each goes to the packs with the most room, and
    opens new ones only where none has room.
    """
    open_packs: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    rooms: list[int] = []
    done = []

    def put(room: int, count: int, pattern: list[tuple[int, int]]) -> None:
        if room == 0:
            done.append((count, pattern))
        elif count:
            if not open_packs[room]:
                heapq.heappush(rooms, -room)
            open_packs[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                count, pattern = open_packs[room].pop()
                if not open_packs[room]:
                    heapq.heappop(rooms)
                used = min(count, left)
                grown = [*pattern[:-1], (length, pattern[-1][1] + 1)] if pattern[-1][0] == length else [*pattern, (length, 1)]
                put(room, count - used, pattern)
                put(room - length, used, grown)
                left -= used
            else:
                times = min(size // length, left)
                packs = left // times
                put(size - times * length, packs, [(length, times)])
                left -= packs * times
    return done + [p for held in open_packs.values() for p in held]


def places(found: list[tuple[int, list[tuple[int, int]]]], ranks_per_length: int = 1 << 40) -> dict[str, np.ndarray]:
    """The patterns as sorted intervals of (length, rank): where each begins, the
    first sequence, the offset there and how often the length is repeated in it."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, pattern in found:
        offset = 0
        for length, times in pattern:
            rows.append((length, used[length], sequence, offset, times))
            used[length] += count * times
            offset += length * times
        sequence += count
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return {"key": columns[0] * ranks_per_length + columns[1], "rank": columns[1], "sequence": columns[2], "offset": columns[3], "times": columns[4]}


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece with its sequence and the offset there."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cut = written(pieces(docs, tokenizer, end_id, size), "pieces")
    full, cut = cut.filter(F.col("length") == size), cut.filter(F.col("length") < size)
    counts = cut.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in counts.collect()}  # at most `size` rows
    spark = docs.sparkSession
    found = patterns(histogram, size)
    at = spark.sparkContext.broadcast(places(found))

    groups = F.broadcast(spark.createDataFrame([(k, -(-n // GROUP)) for k, n in histogram.items()], "length long, groups long"))
    dealt = cut.join(groups, "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("groups"))).drop("groups")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = dealt.withColumn("own", F.row_number().over(own) - 1).join(first, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("own"))
    kept = [c.split()[0] for c in PIECES.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = at.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = np.searchsorted(to["key"], length * (1 << 40) + rank, side="right") - 1
            pack_no, turn = np.divmod(rank - to["rank"][row], to["times"][row])
            new = [pa.array(to["sequence"][row] + pack_no), pa.array(to["offset"][row] + turn * length)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *new], names=[*kept, "sequence_id", "offset"])

    placed = ranked.select(*kept, "rank").mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
    after = F.lit(sum(n for n, _ in found)) + F.monotonically_increasing_id()
    alone = full.select(*kept, after.alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(alone).withColumnRenamed("doc_id", id_column)
