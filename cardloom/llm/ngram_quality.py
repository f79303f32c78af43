"""Perplexity under a modified Kneser-Ney trigram model of trusted text.

The vocabulary are the words that the training text has at least ``LEAST`` times (the
least count is raised if more than ``MOST_WORDS`` words are left), the end of a text
and the unknown word.  An unknown word has the probability of the unknown word,
divided by the number of different rare words in the training text and one more: so
no word is likely for being unknown.

Words have ids of 21 bits, and n-grams of orders two and three are one number of the
ids side by side, without collisions.  Each order has its own discounts for counts of 1,
2 and more, estimated from how many of its n-grams were seen 1 to 4 times; n-grams of
every count are kept.  With g the back-off weight of a context, the probability of a
word is

    log p(w | u v) = log g(u v) + log g(v) + log p(w) + second(v w) + third(u v w)

where the last two, the corrections of orders two and three, are 0 for n-grams that
were never seen, as is the log of the weight of such a context.  What single words are
worth is known to every task.  The numbers of longer n-grams live in shards: batches
of documents send each shard their distinct n-grams with the documents that have
them, and get back one sum for each document.  A group of this join is one shard and
a bounded number of batches, whatever the n-gram; shards grow in number with the model.  A
bit field of bounded size keeps most n-grams at home that the model lacks; it changes the
traffic and no result.

Training reads all trusted documents but a fifth, which is never trained on; the
perplexities of that fifth, language by language, give the thresholds.  Counts are
folded twice, by hash of a trigram's first two words and then of its last two, in
buckets that grow in number with the text: no word is a task.

Defined results: a null or empty text, or one without a word, has no perplexity and
isn't kept; very long texts are read whole (a batch is bounded by bytes and rows, so
one that is larger is a batch alone); a document without language is judged by the
quantile of all languages, as is a language that has no trusted document held out;
repeated rows are judged one by one; a repeated id is trusted if any of its labels
is; documents with the same perplexity are judged alike, and one at the threshold is
kept; without trusted text nothing is kept; an empty table gives an empty result;
only the columns named are read, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.llm.common import removed, ship, small_if_checked, written

#: Ids begin at 1, so that a pair is never mistaken for a trigram.
BEGIN, END, UNKNOWN, FIRST_WORD = 1, 2, 3, 4
BITS = 21
ID = (1 << BITS) - 1
MOST_WORDS = (1 << BITS) - FIRST_WORD
#: Words of the training text seen less often are unknown words.
LEAST = 2
#: N-grams of a shard of the model, and the least number of shards.
SHARD, SHARDS = 1 << 18, 64
#: Documents and bytes of a batch, and batches of a group of the join.
BATCH, BATCH_BYTES, GROUP = 8192, 1 << 23, 64
#: Characters of training text for each bucket in which trigrams are folded, and the least number of buckets.
BUCKET, BUCKETS = 1 << 20, 64
#: Entries of the model that a task packs at a time.
PACKED = 1_000_000
#: The least and the largest number of bits in the field of the model's n-grams, as powers of two.
FIELD, LARGEST_FIELD = 26, 29


class Ids(dict):
    """Ids of words from the sorted hashes of the vocabulary; ids that were looked up
    are remembered up to a bound."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes

    def __missing__(self, word: bytes) -> int:
        key = np.uint64(xxhash.xxh64_intdigest(word))
        at = int(self.hashes.searchsorted(key))
        found = at + FIRST_WORD if at < len(self.hashes) and self.hashes[at] == key else UNKNOWN
        if len(self) < 300_000:
            self[word] = found
        return found

    def __reduce__(self) -> tuple:
        return Ids, (self.hashes,)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().split()


def ids_of(text: str | None, ids: Ids) -> np.ndarray:
    """Word ids with two begins before and an end behind."""
    return np.array([BEGIN, BEGIN, *map(ids.__getitem__, words_of(text)), END], np.int64)


def ngrams(parts: list[np.ndarray], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams within each row of ids, and the place of the row of each."""
    sizes = np.array([len(x) for x in parts])
    flat, owners = np.concatenate(parts), np.repeat(np.arange(len(parts)), sizes)
    keys = np.zeros(max(len(flat) - order + 1, 0), np.int64)
    for k in range(order):
        keys = keys << BITS | flat[k : k + len(keys)]
    inside = owners[: len(keys)] == owners[order - 1 :]
    return keys[inside], owners[: len(keys)][inside]


def discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and 3 or more, given how many n-grams
    were counted once, twice, three and four times."""
    n = [max(int(x), 1) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) for k in range(1, 4)])


#: Kinds of folded rows: how many words come before a word (``n``); what comes after a word and after a pair;
#: pairs and trigrams with their counts; how many pairs (key 2) and trigrams (key 3) were seen 1 to 4 times.
WORD, AFTER_WORD, AFTER_PAIR, PAIR, TRIGRAM, TIMES = range(6)
#: ``total`` and ``t1`` to ``t3``: the sum of the counts after a context, and how many of them are 1, 2 and more;
#: ``pairs``: the count of a trigram's last two words.
COUNTS = ("n", "total", "t1", "t2", "t3", "pairs")
#: Kinds of which many keys are packed in a row, whose ``n`` is their number, with the counts they have.
PACKED_COUNTS = {AFTER_PAIR: COUNTS[1:5], PAIR: COUNTS[:1], TRIGRAM: COUNTS}
FOLDED = "kind tinyint, key long, " + ", ".join(f"{c} int" for c in COUNTS) + ", packed array<binary>"
COUNTED = "bucket int, kind tinyint, packed array<binary>"
COUNTED_TYPES = {"bucket": pa.int32(), "kind": pa.int8(), "packed": pa.list_(pa.binary())}
LAST_TWO = (1 << 2 * BITS) - 1


def packed_with(keys: np.ndarray, *numbers: np.ndarray) -> list[bytes]:
    """Ascending keys with numbers of each."""
    return [pack_sorted(keys), *[pack(x.astype("<u4")) for x in numbers]]


def unpacked_with(rows: list[list[bytes]], width: int) -> list[np.ndarray]:
    """The keys and ``width`` numbers of each, of all rows."""
    none = np.zeros(0, np.int64)
    return [np.concatenate([none, *[unpack(r[i], "<u4").astype(np.int64) if i else sorted_of(r[0]) for r in rows]]) for i in range(width + 1)]


def counted_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(COUNTED_TYPES)
    return pa.table([pa.array(c, t) for c, t in zip(columns, COUNTED_TYPES.values(), strict=True)], names=list(COUNTED_TYPES))


def starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def sums_of(first: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Of each run of counts the sum, and how many are 1, 2 and more."""
    return [np.add.reduceat(x.astype(np.int64), first) if len(first) else x.astype(np.int64) for x in (counts, counts == 1, counts == 2, counts > 2)]


def fold_contexts(table: pa.Table, buckets: int) -> pa.Table:
    """All trigrams whose first two words are of one bucket, with what comes after these two,
    dealt by their last two words."""
    key, n = unpacked_with(table.column("packed").to_pylist(), 1)
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = starts(key)
    key, n = key[first], np.add.reduceat(n, first)
    first = starts(key >> BITS)
    total = sums_of(first, n)
    of_context = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    context = key[first] >> BITS
    rows = [(b, TRIGRAM, packed_with(key[at], n[at], *[x[of_context[at]] for x in total])) for b, at in parts_of(shard_of(key & LAST_TWO, buckets))]
    rows += [(b, AFTER_PAIR, packed_with(context[at], *[x[at] for x in total])) for b, at in parts_of(shard_of(context, buckets))]
    return counted_table(rows)


def fold_pairs(table: pa.Table) -> pa.Table:
    """All counts of the trigrams whose last two words are of one bucket, and the contexts that
    came with them; counts of single words are to be added up over the buckets."""

    def rows(kind: int, key: np.ndarray, **columns: np.ndarray) -> pa.Table:
        none = np.zeros(len(key), np.int32)
        out = {"kind": np.full(len(key), kind, np.int8), "key": np.asarray(key, np.int64)} | {c: columns[c].astype(np.int32) if c in columns else none for c in COUNTS}
        return pa.table(out | {"packed": pa.nulls(len(key), COUNTED_TYPES["packed"])})

    def packed(kind: int, key: np.ndarray, *counts: np.ndarray) -> pa.Table:
        row = rows(kind, np.zeros(1), n=np.array([len(key)]))
        return row.set_column(row.num_columns - 1, "packed", pa.array([packed_with(key, *counts)], COUNTED_TYPES["packed"]))

    of_kind = lambda kind: [p for k, p in zip(table.column("kind").to_pylist(), table.column("packed").to_pylist(), strict=True) if k == kind]
    context, *after_context = unpacked_with(of_kind(AFTER_PAIR), 4)
    order = np.argsort(context)
    out = [packed(AFTER_PAIR, context[order], *[x[order] for x in after_context])] if len(context) else []
    key, n, *total = unpacked_with(of_kind(TRIGRAM), 5)
    if not len(key):
        return pa.concat_tables(out)
    last_two = key & LAST_TWO
    order = np.argsort(last_two, kind="stable")
    first = starts(last_two[order])
    pair, pairs = last_two[order][first], np.diff(np.append(first, len(key)))
    of_pair = np.empty(len(key), np.int64)
    of_pair[order] = np.repeat(np.arange(len(first)), pairs)
    first = starts(pair >> BITS)
    after = sums_of(first, pairs)
    words, before_word = np.unique(pair & ID, return_counts=True)
    four = np.array([[(x == k).sum() for k in range(1, 5)] for x in (pairs, n)])
    order = np.argsort(key)
    return pa.concat_tables([
        *out,
        rows(WORD, words, n=before_word),
        rows(AFTER_WORD, (pair >> BITS)[first], **dict(zip(COUNTS[1:5], after, strict=True))),
        packed(PAIR, pair, pairs),
        packed(TRIGRAM, key[order], n[order], *[x[order] for x in total], pairs[of_pair][order]),
        rows(TIMES, np.array([2, 3]), **dict(zip(COUNTS[1:5], four.T, strict=True))),
    ])


def weight_left(cut: np.ndarray, total: np.ndarray, t1: np.ndarray, t2: np.ndarray, t3: np.ndarray) -> np.ndarray:
    """What a context leaves to the order below; all, where nothing came after it."""
    return np.where(total > 0, (cut[1] * t1 + cut[2] * t2 + cut[3] * t3) / np.maximum(total, 1), 1.0)


def kept_part(cut: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.maximum(n - cut[np.minimum(n, 3)], 0)


class Model:
    """What every task knows: the words' ids, and by id the probability of a word and
    the weight and the total of a word as context; the discounts of the longer orders;
    the number of words that share the unknown word's probability; the bit field."""

    def __init__(self, hashes: np.ndarray, one: np.ndarray, weight: np.ndarray, total: np.ndarray, second: np.ndarray, third: np.ndarray, rare: int):
        self.ids, self.one, self.weight, self.total, self.second, self.third = Ids(hashes), one, weight, total, second, third
        self.field, self.shards = np.zeros(0, np.uint64), SHARDS
        worth = np.log(one)
        worth[UNKNOWN] -= np.log(rare + 1)
        self.word, self.context = worth, np.log(weight)

    def base(self, ids: np.ndarray) -> float:
        """The log-probability of a row of ids without what longer n-grams add."""
        return float(self.word[ids[2:]].sum() + self.context[ids[1:-1]].sum())

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        """Whether n-grams can be of the model."""
        at = place_of(keys, len(self.field) * 64)
        return (self.field[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def keys(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The longer n-grams of a batch that can be of the model, and their rows."""
        found = []
        for order in (2, 3):
            keys, owners = ngrams(parts, order)
            held = self.may_have(keys)
            found.append((keys[held], owners[held]))
        return np.concatenate([k for k, _ in found]), np.concatenate([o for _, o in found])

    def values(self, c: dict[str, np.ndarray]) -> np.ndarray:
        """What folded rows of pairs, trigrams and pairs as contexts are worth."""
        v, w = c["key"] >> BITS & ID, c["key"] & ID
        pairs = np.where(c["kind"] == PAIR, c["n"], c["pairs"])
        below = self.weight[v] * self.one[w]
        two = kept_part(self.second, pairs) / np.maximum(self.total[v], 1)
        left = weight_left(self.third, c["total"], c["t1"], c["t2"], c["t3"])
        three = kept_part(self.third, c["n"]) / np.maximum(c["total"], 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.select([c["kind"] == AFTER_PAIR, c["kind"] == PAIR], [np.log(left), np.log1p(two / below)], np.log1p(three / (left * (two + below)))).astype(np.float32)


def scattered(keys: np.ndarray) -> np.ndarray:
    x = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def place_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The place in a field of ``bits`` bits, a power of two."""
    return scattered(keys) >> np.uint64(65 - bits.bit_length())


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (scattered(keys) % np.uint64(shards)).astype(np.int32)


def vocabulary(texts: DataFrame, least: int) -> tuple[np.ndarray, int]:
    """The sorted hashes of the words seen ``least`` times or more often (so many times
    more that they are at most ``MOST_WORDS``), and the number of other words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, int] = {}
            for text in batch.column("text").to_pylist():
                for word in words_of(text):
                    seen[word] = seen.get(word, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(np.array([xxhash.xxh64_intdigest(w) for w in seen], np.uint64).view(np.int64)), pa.array(list(seen.values()), pa.int32())], names=["word", "n"])

    counted = written(texts.select("text").mapInArrow(count, "word long, n int").groupBy("word").agg(F.sum("n").alias("n")), "words")
    often = {r["n"]: r["words"] for r in counted.groupBy(F.least("n", F.lit(10_000)).alias("n")).agg(F.count("*").alias("words")).collect()}  # at most 10,000 rows
    while sum(x for n, x in often.items() if n >= least) > MOST_WORDS and least < 10_000:
        least += 1
    kept = counted.filter(F.col("n") >= least).select("word").toArrow().column("word").to_numpy()  # at most MOST_WORDS rows
    return np.sort(kept.view(np.uint64)), sum(x for n, x in often.items() if n < least)


def by_id(rows: pa.Table, column: str, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    out[rows.column("key").to_numpy()] = rows.column(column).to_numpy()
    return out


def train(texts: DataFrame, least: int = LEAST) -> tuple[Model, DataFrame]:
    """What every task knows, and the shards: rows of (shard, ngrams, worths), packed."""
    spark = texts.sparkSession
    hashes, rare = vocabulary(texts, least)
    known = spark.sparkContext.broadcast(Ids(hashes))

    buckets = max(BUCKETS, (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // BUCKET)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, n = np.unique(ngrams([ids_of(t, known.value) for t in batch.column("text").to_pylist()], 3)[0], return_counts=True)
                yield from counted_table([(b, TRIGRAM, packed_with(keys[at], n[at])) for b, at in parts_of(shard_of(keys >> BITS, buckets))]).to_batches()

    counted = texts.select("text").mapInArrow(count, COUNTED).groupBy("bucket").applyInArrow(lambda t: fold_contexts(t, buckets), COUNTED)
    folded = written(counted.groupBy("bucket").applyInArrow(fold_pairs, FOLDED), "folded")
    of_kind = lambda kind: folded.filter(F.col("kind") == kind)
    sums = [F.sum(c).alias(c) for c in COUNTS]
    size = len(hashes) + FIRST_WORD
    # the tables of single words have at most `size` rows, and of `times` there are two
    before = by_id(of_kind(WORD).groupBy("key").agg(*sums).select("key", "n").toArrow(), "n", size)
    after = of_kind(AFTER_WORD).groupBy("key").agg(*sums).toArrow()
    times = {r["key"]: [r["total"], r["t1"], r["t2"], r["t3"]] for r in of_kind(TIMES).groupBy("key").agg(*sums).collect()}
    cut = discounts([int((before == k).sum()) for k in range(1, 5)])
    taken, seen = cut[np.minimum(before, 3)], max(before.sum(), 1)
    one = kept_part(cut, before) / seen + (taken.sum() / seen if before.any() else 1.0) / (size - END)
    one[:END] = 1.0  # no text goes on with a begin, and 0 is no id
    second, third = (discounts(times.get(k, [0] * 4)) for k in (2, 3))
    contexts = [by_id(after, c, size) for c in ("total", "t1", "t2", "t3")]
    model = Model(hashes, one, weight_left(second, *contexts), contexts[0], second, third, rare)
    many = folded.filter(F.col("kind").isin(*PACKED_COUNTS))
    n_keys = many.agg(F.sum("n")).first()[0] or 0
    model.shards = max(SHARDS, n_keys // SHARD)
    light = spark.sparkContext.broadcast(model)

    def worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def packed() -> pa.RecordBatch:
            keys, values = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
            rows = [(shard, pack_sorted(keys[at]), pack(values[at].astype("<f4"))) for shard, at in parts_of(shard_of(keys, light.value.shards))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 3, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["shard", "ngrams", "worths"])

        for batch in batches:
            for kind, row in zip(batch.column("kind").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                names = PACKED_COUNTS[kind]
                key, *counts = unpacked_with([row], len(names))
                columns = dict.fromkeys(COUNTS, np.zeros(len(key), np.int64)) | dict(zip(names, counts, strict=True))
                held.append((key, light.value.values(columns | {"key": key, "kind": np.full(len(key), kind)})))
                n += len(key)
                if n >= PACKED:
                    yield packed()
                    held, n = [], 0
        if n:
            yield packed()

    shards = written(many.select("kind", "packed").mapInArrow(worth, "shard int, ngrams binary, worths binary"), "shards")
    removed(folded)
    model.field = field(shards, n_keys)
    return model, shards


def field(shards: DataFrame, n_keys: int) -> np.ndarray:
    """The bit field of all n-grams of the model, of four bits or more for each up to its largest size."""
    size = 1 << min(max(FIELD, (4 * n_keys).bit_length()), LARGEST_FIELD)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(place_of(np.concatenate([np.zeros(0, np.int64), *map(sorted_of, batch.column("ngrams").to_pylist())]), size))
            cell, first = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(bits.view(np.int64))], names=["cell", "bits"])

    # at most size / 64 rows, and as many from each task
    rows = shards.select("ngrams").coalesce(max(4, n_keys >> 22)).mapInArrow(mark, "cell int, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size >> 6, np.uint64)
    out[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def pack(numbers: np.ndarray) -> bytes:
    """Integers, compressed byte by byte of equal weight, behind their number."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, dtype: str) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).ravel()


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending integers: neighbours are near each other, so differences take fewer bytes."""
    return pack(np.diff(numbers, prepend=np.int64(0)).astype("<i8"))


def sorted_of(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<i8"))


def parts_of(groups: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its places in order) for each group."""
    order = np.argsort(groups, kind="stable")
    found, first = np.unique(groups[order], return_index=True)
    for group, at in zip(found.tolist(), np.split(order, first[1:]), strict=True) if len(found) else ():
        yield group, at


POSTINGS = "batch long, shard int, doc_ids array<long>, langs array<string>, n_words array<int>, base array<double>, keys binary, counts binary, owners binary"


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Cuts a batch so that a part has few documents and few bytes, or one document."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (held + size > BATCH_BYTES or i - start == BATCH):
            yield start, i
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield start, len(texts)


def posted(docs: DataFrame, model: Model) -> DataFrame:
    """For each batch of documents a row of its ids and base sums (shard -1), and for
    each shard a row of the distinct n-grams with the places of their documents."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = [c.split()[0] for c in POSTINGS.split(", ")]
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = known.value
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for start, stop in slices(texts):
                batch = whole.slice(start, stop - start)
                ids = [ids_of(t, model.ids) for t in texts[start:stop]]
                number = batch.column("row").to_pylist()[0]  # row numbers are unique, so the first one names the batch
                rows = [(number, -1, batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), [len(x) - 3 for x in ids], [model.base(x) for x in ids], None, None, None)]
                keys, owners = model.keys(ids)
                shards = shard_of(keys, model.shards)
                order = np.lexsort((keys, shards))  # stable, so rows stay in order
                keys, owners = keys[order], owners[order]
                cuts = np.searchsorted(shards[order], np.arange(model.shards + 1))
                for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if b > a:
                        first = np.flatnonzero(np.append(True, keys[a + 1 : b] != keys[a : b - 1]))
                        # neighbours are near each other, so their differences take fewer bytes
                        rows.append((number, shard, None, None, None, None, pack(np.diff(keys[a:b][first], prepend=0).astype("<i8")), pack(np.diff(np.append(first, b - a)).astype("<u4")), pack(np.diff(owners[a:b].astype("<u2"), prepend=np.uint16(0)))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.mapInArrow(post, POSTINGS)


def score(docs: DataFrame, model: Model, shards: DataFrame) -> DataFrame:
    """(doc_id, lang, text) as (doc_id, lang, n_words, log_probability)."""
    rows = posted(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "lang", "text"), model)
    # a batch's number is spread over groups so that a group holds few batches of one shard; the more
    # shards there are, the less each batch has for one
    groups = max(1, docs.count() * SHARDS // (BATCH * GROUP * model.shards))
    # and the rows of ids, which only pass through, over as many groups as all shards have
    rows = rows.withColumn("turn", F.pmod(F.xxhash64("batch"), F.when(F.col("shard") < 0, groups * model.shards).otherwise(groups)).cast("int"))
    held = shards.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.zeros(0, np.int64), *map(sorted_of, right["ngrams"])])
        worths = np.concatenate([np.zeros(0), *[unpack(x, "<f4").astype(float) for x in right["worths"]]])
        order = np.argsort(keys, kind="stable")
        # what a pair is worth as a prediction and as a context are two entries
        known, first = np.unique(keys[order], return_index=True)
        values = np.append(np.add.reduceat(worths[order], first) if len(first) else [], 0)
        out = []
        for r in left.itertuples(index=False):
            if r.shard < 0:
                out.append((r.batch, r.doc_ids, r.langs, r.n_words, r.base))
                continue
            keys, counts, owners = np.cumsum(unpack(r.keys, "<i8")), unpack(r.counts, "<u4"), np.cumsum(unpack(r.owners, "<u2"), dtype=np.uint16)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            hit = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            out.append((r.batch, None, None, None, np.bincount(owners, np.repeat(np.where(hit, values[at], 0), counts))))
        return pd.DataFrame(out, columns=["batch", "doc_ids", "langs", "n_words", "part"])

    parts = rows.groupBy("shard", "turn").cogroup(held.groupBy("shard", "turn")).applyInPandas(add, "batch long, doc_ids array<long>, langs array<string>, n_words array<int>, part array<double>")

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["n_words"].notna()].iloc[0]
        total = np.zeros(len(head["n_words"]))
        for part in group["part"]:
            total[: len(part)] += part
        return pd.DataFrame({"doc_id": pd.array(head["doc_ids"], dtype="Int64"), "lang": head["langs"], "n_words": head["n_words"], "log_probability": total})

    return parts.groupBy("batch").applyInPandas(whole, "doc_id long, lang string, n_words int, log_probability double")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99) -> DataFrame:
    """(doc_id, text, lang) judged with labels (doc_id, quality): doc_id, lang, n_words,
    perplexity, threshold and kept."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    model = train(docs.join(small_if_checked(trusted.filter(~apart), 2_000_000), "doc_id", "left_semi"))
    scored = score(docs, *model).withColumn("perplexity", F.when(F.col("n_words") > 0, F.exp(-F.col("log_probability") / (F.col("n_words") + 1))))

    scored = written(scored.select("doc_id", "lang", "n_words", "perplexity"), "scored")
    measured = scored.filter("perplexity is not null").join(trusted.filter(apart), "doc_id", "left_semi")
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    overall = measured.agg(cut.alias("t")).first()["t"]
    by_language = measured.filter("lang is not null").groupBy("lang").agg(cut.alias("threshold"))
    by_language = small_if_checked(written(by_language, "thresholds"))
    out = scored.join(by_language, "lang", "left").withColumn("threshold", F.coalesce("threshold", F.lit(overall).cast("double")))
    return out.select("doc_id", "lang", F.col("n_words").cast("long").alias("n_words"), "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
