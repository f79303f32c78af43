"""Stretches of consecutive words that repeat with a period, at least four times over.

Word i of a document *matches* under period p if it is word i + p too.  A run of
period p is a stretch of matches that nothing extends, of at least three periods, whose
first p words aren't a repetition themselves.

For each octave of periods [H, 2H) a document is exploded into tiles that overlap: a tile
has boundaries H words apart, and reaches 2H words before the first and 4H words past
the last one.  Tiles are solved independently.  Around a boundary two Z-functions, of the
words after it and of the reversed words before it, tell for all periods of the
octave at once how far matches go to both sides.  A run holds at least three boundaries,
and at each of them at least 2H matches are seen, so that shorter ones are dropped, and
what neighbouring boundaries see overlaps.  The fragments of all tiles are shuffled by
document and period and stitched.

Two exact tests save work.  A boundary is left out unless, at it or at the one before, the
next H words come again within the octave (compared by hashes of windows, for all
documents of a batch at once).  A tile inside a stretch whose smaller period is known is
left out: any longer period there is a multiple of it.

Defined results: a null or empty text has no words and no runs, and the digests of an
empty string; very long texts are split in tiles of bounded size in each octave; ties for
the longest run go to the smaller start, then the smaller period; each row is a document
of its own, also where ids repeat or are null; an empty table gives an empty result; only
the two columns named are read, whatever others are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.functions.plans import once
from cardloom.llm.common import WORD, ship, words_of, written

#: Boundaries of a tile.
TILE = 16
FRAGMENT = pa.struct([("period", pa.int64()), ("first", pa.int64()), ("end", pa.int64())])
FOUND = "row long, doc_id long, n_words long, collapsed_sha256 string, text string, fragments array<struct<period: bigint, first: bigint, end: bigint>>"


def z_function(s: list[int]) -> list[int]:
    """For each place how many items from there equal those from the beginning."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def prime_factors(n: int) -> list[int]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return [*out, n] if n > 1 else out


def at_boundary(codes: np.ndarray, low: int, high: int, at: int, step: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, end) of the matches around one boundary of a document [low, high),
    for periods of ``step`` to 2 * ``step`` - 1 that aren't repetitions of shorter ones."""
    after = codes[at : min(at + 4 * step, high)].tolist()
    from_ = max(low, at - 2 * step)
    before = codes[from_:at].tolist()[::-1]
    right = z_function(after)
    # the words up to 2 * step past the boundary, reversed: each suffix of them against those before it
    reach = min(2 * step, len(after))
    left = z_function([*before, -1, *after[:reach][::-1], *before])
    for p in range(step, min(2 * step, len(after) + 1)):
        ahead = min(right[p], 2 * step) if p < len(after) else 0
        behind = min(left[len(before) + 1 + reach - p], len(before)) if p <= reach else 0
        if ahead + behind < 2 * step:
            continue
        if any(right[p // f] >= p - p // f for f in prime_factors(p)):
            continue  # its words repeat a shorter period
        yield p, at - behind, at + ahead


def fragments(codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, period, first, end) of matches as seen by the tiles, for documents
    that stand one after another in ``codes``, from ``starts`` to the next one's start.

    ``codes`` of different documents are different.
    """
    n = len(codes)
    longest = int(np.diff(starts, append=n).max(initial=0))
    windows = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    windows ^= windows >> np.uint64(29)
    known = np.zeros(n, np.int64)  # to where a stretch with a known period goes on
    step = 1
    while 4 * step <= longest:
        # the H words from each place on, against those from the boundary one octave before
        heads = np.repeat(windows[::step], step)[: len(windows)]
        again = np.flatnonzero(windows[step:] == heads[: max(len(windows) - step, 0)]) // step
        seen = np.unique(np.concatenate([again, again + 1]))
        found: dict[tuple[int, int], list[list[int]]] = {}
        for tile in np.split(seen, np.flatnonzero(np.diff(seen // TILE)) + 1) if len(seen) else []:
            held: dict[tuple[int, int], list[int]] = {}
            for at in (tile * step).tolist():
                if at >= n:
                    continue
                document = int(np.searchsorted(starts, at, side="right")) - 1
                low = int(starts[document])
                high = int(starts[document + 1]) if document + 1 < len(starts) else n
                if known[max(low, at - 2 * step)] >= min(at + 4 * step, high):
                    continue
                for p, first, end in at_boundary(codes, low, high, at, step):
                    last = held.get((document, p))
                    if last is None or first > last[1]:
                        if last:
                            yield document, p, last[0] - low, last[1] - low
                        held[document, p] = [first, end]
                    else:
                        last[1] = end
                    runs = found.setdefault((document, p), [])
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = end
                    else:
                        runs.append([first, end])
            for (document, p), (first, end) in held.items():
                low = int(starts[document])
                yield document, p, first - low, end - low
        for (_, p), runs in found.items():
            for first, end in runs:
                np.maximum(known[first : end + p], end + p, out=known[first : end + p])
        # windows of twice the size
        windows = (windows[: max(len(windows) - step, 0)] * np.uint64(0xD6E8FEB86659FD93)) ^ (windows[step:] + (windows[step:] >> np.uint64(31)))
        step *= 2


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, str | None]]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True)


def find_fragments(docs: DataFrame, batch_words: int = 1_000_000) -> DataFrame:
    """A row for each document (row, doc_id, text): its number of words, and its fragments
    with the text where it has any, else the digest of its words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, codes, starts, total, base = [], [], [], 0, 0

        def solved() -> pa.RecordBatch:
            of: list[list[tuple[int, int, int]]] = [[] for _ in held]
            for document, *fragment in fragments(np.concatenate([np.zeros(0, np.int64), *codes]), np.array([s for s, _ in starts], np.int64)):
                of[starts[document][1]].append(tuple(fragment))
            columns = list(zip(*[(row, doc_id, n, None if f else digest, text if f else None, [dict(zip(("period", "first", "end"), x, strict=True)) for x in f]) for (row, doc_id, n, digest, text), f in zip(held, of, strict=True)], strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(FRAGMENT))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["row", "doc_id", "n_words", "collapsed_sha256", "text", "fragments"])

        for row, doc_id, text in _rows(batches):
            words = (text or "").encode().split()
            if words:
                numbers: dict[bytes, int] = {}
                codes.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)) + base)
                starts.append((total, len(held)))
                base += len(numbers)
            held.append((row, doc_id, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), text))
            total += len(words)
            if total >= batch_words or len(held) >= 10_000:
                yield solved()
                held, codes, starts, total, base = [], [], [], 0, 0
        if held:
            yield solved()

    return docs.select("row", "doc_id", "text").mapInArrow(find, FOUND)


def stitched(fragments_: DataFrame) -> DataFrame:
    """Runs (row, start, length, period) from fragments (row, period, first, end) that
    touch or overlap."""
    own = Window.partitionBy("row", "period").orderBy("first", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(F.col("first") > F.col("_before"), 1).otherwise(0)
    islands = fragments_.withColumn("_before", before).withColumn("_island", F.sum(begins).over(own))
    joined = islands.groupBy("row", "period", "_island").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    runs = joined.select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.filter(F.col("length") >= F.greatest(F.lit(6), 4 * F.col("period")))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of what runs (start, length, period) repeat, joined."""
    edges = [0] * (len(words) + 1)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    depth, kept = 0, []
    for word, edge in zip(words, edges, strict=False):
        depth += edge
        if not depth:
            kept.append(word)
    return b" ".join(kept)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, n, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "n_words", "runs")), strict=True):
            runs = sorted(((r["start"], r["length"], r["period"]) for r in runs or ()), key=lambda r: (r[0], r[2]))
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
            listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()
            left = collapse(text.encode().split(), runs)
            out.append((doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(left).hexdigest(), n))
        names = [c.split()[0] for c in REPORT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha256" in name else pa.int64()) for c, name in zip(list(zip(*out, strict=True)) or [()] * len(names), names, strict=True)], names=names)


REPORT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long"


def found_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents as ``find_fragments`` gives them, written, and their runs (row, start,
    length, period)."""
    ship(docs.sparkSession)
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = written(find_fragments(docs), "fragments")
    return found, stitched(found.select("row", F.inline("fragments")))


def report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its longest run, and digests of all runs and of the words
    that are left when each run keeps its first period only.

    Only texts with fragments are joined with runs; a document's runs are fewer than its words.
    """
    found, runs = found_runs(docs, id_column, text)
    own = runs.groupBy("row").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    some = found.filter("text is not null").drop("fragments", "collapsed_sha256").join(own, "row", "left")
    read = some.select("doc_id", "text", "n_words", "runs").mapInArrow(_digested, REPORT)
    nothing = F.lit(None).cast("long")
    without = found.filter("text is null").select("doc_id", F.lit(0).cast("long").alias("n_runs"), *[nothing.alias(c) for c in ("start", "length", "period", "exponent_milli")], F.sha2(F.lit("").cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256", "n_words")
    return read.unionByName(without).withColumnRenamed("doc_id", id_column)


def with_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text) of documents of which about a tenth, by the checksum of the id, repeat
    their words from some place on; a changed text's words are joined by spaces.

    A row without an id, and a text without words, stay as they are.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    plain = F.col(text)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i))), " ")

    chosen = (h % 10 == 0) & plain.rlike(WORD)
    return docs.select(id_column, F.when(chosen, once(words_of(plain), repeated)).otherwise(plain).alias(text))
