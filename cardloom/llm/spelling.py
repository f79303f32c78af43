"""Words of a corpus grouped with the spelling they are probably a variant of.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.
A word's form is its most frequent near word (of several the first in the order of code
points) if that is ``times`` as frequent as the word; its root is where forms lead to.

Words are counted in the map tasks and added up.  The vocabulary is then searched by
*generated edits*: every deletion of a letter and every replacement by a later letter
of the alphabet (insertions and earlier letters are the same pairs seen from the other
word).  Edits are probed against Bloom filters of the vocabulary, sharded by word length and
blocked: a word sets four bits in each of two 64-bit blocks.  Hashes of edits come from
the word's own polynomial hash, so that no edit is spelled out unless a filter has it.
Only these go into a shuffle: a join with the vocabulary, which removes what the filters
pass wrongly.

Filters are built by an aggregate over (block, bits), have 32 bits a word and are broadcast.
A pass holds at most ``most_blocks`` blocks (16 MB); a larger vocabulary takes several
passes by length, and a length that is larger alone is divided by a hash.  Words are
probed in the passes of their own length and of that below, so passes divide the work.

Defined results: a null or empty text has no words; ``word`` is what is left after
deletions, each maximal run of letters once for each time it stands there; a row without an
id has no deletions; repeated rows count each; runs of any length are taken whole; an empty
table gives an empty result; only the two columns named are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import ship, written

#: Letters of words, lower-cased, in the order of code points.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
BITS_PER_WORD = 32
#: Edits that are probed at a time.
CHUNK = 1 << 13


def count_words(docs: DataFrame, least_length: int = 6, least_n: int = 5, typo_every: int | None = None, most_held: int = 300_000) -> DataFrame:
    """(word, n) of the words of documents (doc_id, text).

    With ``typo_every``, a run whose checksum with the document's id is divisible by
    it loses the letter that the checksum points to.
    """
    pattern = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(pattern.findall(text or "")).items():
                    word = run.lower() if run.isascii() else run.translate(_LOWER)
                    if typo_every and doc_id is not None:
                        h = zlib.crc32(word.encode(), start)
                        if h % typo_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    held[word] += n
                if len(held) > most_held:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _scaled(x: np.ndarray, n: int) -> np.ndarray:
    """The high half of a hash as a number below ``n``."""
    return ((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _bits(x: np.ndarray) -> np.ndarray:
    one, six = np.uint64(1), np.uint64(63)
    return (one << (x & six)) | (one << ((x >> np.uint64(6)) & six)) | (one << ((x >> np.uint64(12)) & six)) | (one << ((x >> np.uint64(18)) & six))


@dataclass(frozen=True)
class Shard:
    """The words of one length, or a part of them by hash: its blocks begin at ``offset``."""

    length: int
    part: int
    parts: int
    offset: int
    blocks: int

    def places(self, polynomial: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether hashes are of this part, and twice (block, bits)."""
        first = mixed(polynomial)
        second = mixed(first ^ np.uint64(0x2545F4914F6CDD1D))
        mine = _scaled(mixed(second), self.parts) == self.part if self.parts > 1 else np.ones(len(first), bool)
        offset = np.uint64(self.offset)
        return mine, _scaled(first, self.blocks) + offset, _bits(first), _scaled(second, self.blocks) + offset, _bits(second)


def shards(words_by_length: dict[int, int], most_blocks: int) -> list[list[Shard]]:
    """The passes, each a list of shards with at most ``most_blocks`` blocks together."""
    passes: list[list[Shard]] = [[]]
    used = 0
    for length, n in sorted(words_by_length.items()):
        blocks = -(-n * BITS_PER_WORD // 64)
        parts = -(-blocks // most_blocks)
        each = -(-blocks // parts)
        for part in range(parts):
            if used + each > most_blocks:
                passes.append([])
                used = 0
            passes[-1].append(Shard(length, part, parts, used, each))
            used += each
    return [p for p in passes if p]


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _BASE, np.uint64)]))[:n]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str], list[int], np.ndarray]]:
    """Words of each length, their counts and their code points as rows."""
    of: dict[int, list[tuple[str, int]]] = {}
    for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
        of.setdefault(len(word), []).append((word, n))
    for length, found in of.items():
        words, n = [w for w, _ in found], [n for _, n in found]
        yield length, words, n, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(len(words), length)


def _marked(words: DataFrame, shards_: list[Shard]) -> DataFrame:
    """(block, bits) of the filters of one pass."""
    of: dict[int, list[Shard]] = {}
    for s in shards_:
        of.setdefault(s.length, []).append(s)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, _, letters in _by_length(batch):
                polynomial = (letters * _powers(length)).sum(axis=1, dtype=np.uint64)
                for shard in of.get(length, ()):
                    mine, *places = shard.places(polynomial)
                    first, first_bits, second, second_bits = (x[mine].astype(np.int64) for x in places)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([first, second])), pa.array(np.concatenate([first_bits, second_bits]))], names=["block", "bits"])

    return words.filter(F.length("word").isin(list(of))).mapInArrow(mark, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))


def _passed(filters: np.ndarray, shard: Shard, polynomial: np.ndarray) -> np.ndarray:
    """The places of the hashes that the filter of a shard has."""
    mine, first, first_bits, second, second_bits = shard.places(polynomial)
    at = np.flatnonzero(mine & ((filters[first] & first_bits) == first_bits))
    return at[(filters[second[at]] & second_bits[at]) == second_bits[at]]


def edits(words: list[str], letters: np.ndarray, filters: np.ndarray, of: dict[int, list[Shard]]) -> Iterator[tuple[int, str]]:
    """(place of the word, edit) of the edits of words of one length that filters have."""
    m, length = letters.shape
    powers = _powers(length)
    terms = letters * powers
    before = np.zeros((m, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    whole = before[:, -1]
    for shard in of.get(length - 1, ()):
        # of equal letters side by side only the last is deleted
        row, at = np.nonzero(np.concatenate([letters[:, :-1] != letters[:, 1:], np.ones((m, 1), bool)], axis=1))
        for low in range(0, len(row), CHUNK * 16):
            r, i = row[low : low + CHUNK * 16], at[low : low + CHUNK * 16]
            for k in _passed(filters, shard, before[r, i] + (whole[r] - before[r, i + 1]) * np.uint64(_INVERSE)):
                word = words[r[k]]
                yield int(r[k]), word[: i[k]] + word[i[k] + 1 :]
    for shard in of.get(length, ()):
        for low in range(0, m * length, CHUNK):
            r, i = np.divmod(np.arange(low, min(low + CHUNK, m * length)), length)
            pair, letter = np.nonzero(ALPHABET[None, :] > letters[r, i][:, None])
            r, i, new = r[pair], i[pair], ALPHABET[letter]
            for k in _passed(filters, shard, whole[r] - terms[r, i] + new * powers[i]):
                word = words[r[k]]
                yield int(r[k]), word[: i[k]] + chr(int(new[k])) + word[i[k] + 1 :]


def near_pairs(words: DataFrame, most_blocks: int = 1 << 21, words_per_task: int = 20_000) -> DataFrame:
    """(word, n, other, other_n) of all pairs of near words of a written table (word, n), in
    both directions."""
    ship(words.sparkSession)
    lengths = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}  # a row for each length
    tasks = max(1, -(-sum(lengths.values()) // words_per_task))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("other", pa.string())])
    positives = words.select("word", "n", F.col("word").alias("other")).limit(0)
    for shards_ in shards(lengths, most_blocks):
        filters = np.zeros(max(s.offset + s.blocks for s in shards_), np.uint64)
        bits = _marked(words, shards_).toArrow()  # at most `most_blocks` rows
        filters[bits.column("block").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
        sent = words.sparkSession.sparkContext.broadcast(filters)
        of: dict[int, list[Shard]] = {}
        for s in shards_:
            of.setdefault(s.length, []).append(s)

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, of=of) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, found, n, letters in _by_length(batch):
                    rows = [(found[k], n[k], edit) for k, edit in edits(found, letters, sent.value, of)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [()] * 3, schema, strict=True)], schema=schema)

        probed = words.filter(F.length("word").isin([x for s in of for x in (s, s + 1)])).repartition(tasks)
        positives = positives.unionByName(written(probed.mapInArrow(probe, "word string, n long, other string"), "edits"))
        sent.unpersist()
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = written(positives.join(known, "other").select("word", "n", "other", "other_n"), "near")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): each round joins every word with what
    its root so far leads to, so that chains of length n take about log2(n) rounds."""
    led = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = led.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = led.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        led = written(joined, "roots")
        if not led.filter("_moved").limit(1).count():
            return led.drop("_moved")
        led = led.drop("_moved")


def grouped(words: DataFrame, times: int = 5, most_blocks: int = 1 << 21) -> DataFrame:
    """One row for each word of a written table (word, n): form, root, n, n_near, form_n."""
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other"))).alias("best")
    near = near_pairs(words, most_blocks).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    chosen = -F.col("best.less") >= times * F.col("n")
    near = written(near.select("word", "n_near", F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n")), "forms")
    led = roots(near.filter("form is not null"))
    whole = words.join(near, "word", "left").join(led, "word", "left")
    return whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_length: int = 6, least_n: int = 5, times: int = 5, typo_every: int | None = None, most_blocks: int = 1 << 21) -> DataFrame:
    """The words of documents, each with its form and its root."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return grouped(written(count_words(docs, least_length, least_n, typo_every), "words"), times, most_blocks)
