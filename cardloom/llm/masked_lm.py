"""Pseudo-likelihood of documents under a masked, bidirectional window network.

Every word is masked in turn and predicted from the two words before and the two
after it.  Its log-probability has two parts:

* The network: the embeddings of the window give a hidden layer, which gives the
  word's code in three digits of ``BASE`` values, each under the condition of those
  before.  All but ``SHARED`` codes stand for one of the corpus's most frequent words.
* Words that are not frequent share a code by their ending.  Under the condition of
  their code they are spelled, by a model of three letters at a time learned from all
  such words; but where the same window stands elsewhere in the corpus, with such a
  word in its middle, the words found there are counted.  The masked occurrence itself
  is left out of its counts, so a text isn't likely for being in the corpus once.
  These counts are over all documents and grow with the corpus; within a window and code
  words are told apart by 16 bits of their hash, and spellings are sent in parts of a nat
  up to a bound (``NAT``).

Training goes over all documents.  A lane is a number of documents by hash; in each
round the lanes start from the same weights, mask the positions whose turn it is, and
take steps in numpy; then the weights are averaged by the number of masked words.  Over
the rounds each position of each document is masked once.  Lanes, the order in them and
the masks depend on the documents alone, so the weights are the same on any cluster and
after any retry; the number of weights is fixed, and one row of them reaches the driver.

Defined results: a null or empty text, or one without a word, has no words, a sum of 0
and no mean; very long texts are scored whole; repeated rows are scored one by one and
are alike (each is found elsewhere, in the other); ties in the frequency of words are
broken by hash of the word; an empty table gives an empty result; columns besides the
two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import most_frequent, ship, words_of, written
from cardloom.llm.ngram_quality import pack, slices, unpack

BASE, DIGITS = 8, 5
CODES = BASE**DIGITS
#: Where the rows of each digit begin in the table of biases, which has a row for every beginning of a code.
_ROWS = [sum(BASE**i for i in range(d)) for d in range(DIGITS + 1)]
#: Code 0 stands beside a text; the last codes are shared by words that aren't frequent.
SHARED = 1000
FIRST_SHARED = CODES - SHARED
#: How often a word must stand in the corpus to have a code of its own, which can be learned.
SEEN = 50
SIDE, WIDTH, HIDDEN = 2, 16, 32
SHAPES = {"embed": (CODES, WIDTH), "inner": (2 * SIDE * WIDTH, HIDDEN), "inner_bias": (HIDDEN,), "outer": (HIDDEN, DIGITS * BASE), "bias": (_ROWS[-1], BASE)}
Weights = dict[str, np.ndarray]
_AROUND = [*range(-SIDE, 0), *range(1, SIDE + 1)]
#: Words of a lane, and words that aren't frequent of a shard of windows.
LANE, WINDOWS = 4_000_000, 1_000_000
#: What is taken from the count of a word in a window, for words not seen there.
CUT = 0.75
#: Values in one: so many of its parts a nat of a word's spelling is sent in.
NAT = 8

# Letters for spelling: 26 letters and 10 digits; other characters and bytes share 27 more; 0 is the end.
_LETTER = np.array([1 + b - 97 if 97 <= b <= 122 else 27 + b - 48 if 48 <= b <= 57 else 37 + b % 27 for b in range(256)])
_ALIKE = np.log(np.bincount(_LETTER, minlength=64)[_LETTER])
_MIX = np.random.default_rng(3).integers(0, 2**63, (64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Spelled:
    """Words, end to end as bytes, with what is known of each from its letters."""

    def __init__(self, words: list[bytes]):
        flat = np.frombuffer(b"\0".join([*words, b""]), np.uint8)
        sizes = np.array([len(w) + 1 for w in words], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.ends = self.starts + sizes - 1
        owner = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(flat)) - self.starts[owner]
        self.flat, self.place = flat, place
        letter = np.where(flat == 0, 0, _LETTER[flat])
        letter[self.ends] = 0
        before = np.where(place > 0, np.roll(letter, 1), 0)
        self.cells = (np.where(place > 1, np.roll(letter, 2), 0) * 64 + before) * 64 + letter

    def hashes(self) -> np.ndarray:
        mixed = _MIX[self.place & 63, self.flat] * (2 * (self.place >> 6) + 1).astype(np.uint64)
        return scrambled(np.add.reduceat(mixed, self.starts)) if len(self.starts) else np.zeros(0, np.uint64)

    def endings(self) -> np.ndarray:
        """Which of the shared codes each word has."""
        last = self.flat[self.ends - 1].astype(np.int64) * 256 + np.where(self.ends - self.starts > 1, self.flat[self.ends - 2], 0)
        return last * 40503 % 65521 % SHARED

    def worth(self, letters: np.ndarray) -> np.ndarray:
        """The log-probability of each word's spelling."""
        each = letters[self.cells] - np.where(self.cells % 64 > 0, _ALIKE[self.flat], 0)
        return np.add.reduceat(each, self.starts) if len(self.starts) else np.zeros(0)


class Codes:
    """The codes of frequent words, the letters' log-probabilities (64 * 64 * 64) and the
    log-share of each shared code among the words that aren't frequent."""

    def __init__(self, frequent: list[bytes], letters: np.ndarray, shares: np.ndarray):
        self.frequent = {w: i + 1 for i, w in enumerate(frequent)}
        self.letters, self.shares = letters, shares

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All words of the texts: their codes and identities and each text's number of
        words; then the places of those that aren't frequent and, of these, the
        log-probability of the spelling under their code."""
        get = self.frequent.get
        parts = [(t or "").lower().encode().split() for t in texts]
        words = [w for part in parts for w in part]
        codes = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        rare = np.flatnonzero(codes == 0)
        spelled = Spelled([words[i] for i in rare])
        ending = spelled.endings() if len(rare) else np.zeros(0, np.int64)
        codes[rare] = FIRST_SHARED + ending
        identity = scrambled(codes.astype(np.uint64))
        identity[rare] = spelled.hashes()
        return codes, identity, np.array([len(p) for p in parts], np.int64), rare, np.minimum(spelled.worth(self.letters) - self.shares[ending], 0.0)


def vocabulary(docs: DataFrame) -> Codes:
    """Codes from the words of all documents."""
    counted = written(docs.select(F.explode(words_of(F.lower("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n")), "words")
    frequent, _ = most_frequent(counted.filter(F.col("n") >= SEEN), "word", FIRST_SHARED - 1)
    known = docs.sparkSession.sparkContext.broadcast({w.encode() for w in frequent})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, shared = np.zeros(64**3, np.int64), np.zeros(SHARED, np.int64)
        for batch in batches:
            words, n = [w.encode() for w in batch.column("word").to_pylist()], batch.column("n").to_numpy()
            kept = [i for i, w in enumerate(words) if w not in known.value]
            if kept:
                spelled = Spelled([words[i] for i in kept])
                cells += np.bincount(spelled.cells, minlength=len(cells))
                shared += np.bincount(spelled.endings(), n[kept], SHARED).astype(np.int64)
        flat = np.concatenate([cells, shared])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["cell", "n"])

    rows = counted.mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most 64 ** 3 + SHARED rows
    flat = np.full(64**3 + SHARED, 0.1)
    flat[rows.column("cell").to_numpy()] += rows.column("n").to_numpy()
    cells, shared = flat[: 64**3].reshape(64, 64, 64), flat[64**3 :]
    return Codes([w.encode() for w in frequent], np.log(cells / cells.sum(axis=2, keepdims=True)).ravel(), np.log(shared / shared.sum()))


ENCODED = "kind string, row long, doc_id long, n_words long, spelled double, codes binary, shard int, keys binary, words binary, worths binary, counts binary, owners binary"


def encode(docs: DataFrame, known: Codes, shards: int) -> DataFrame:
    """Written rows of two kinds: ``text``, one for each document, with its codes; and
    ``window``, for each batch of documents and shard the distinct windows around words
    that aren't frequent, with the documents that have them."""
    codes = docs.sparkSession.sparkContext.broadcast(known)
    names = [c.split()[0] for c in ENCODED.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in ENCODED.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column("text").to_pylist()
            for start, stop in slices(texts):
                batch = whole.slice(start, stop - start)
                flat, identity, n, rare, worth = codes.value.read(texts[start:stop])
                ends, owners = np.cumsum(n), np.repeat(np.arange(len(n)), n)[rare]
                spelled = np.bincount(owners, worth, len(n))
                small = flat.astype("<u2")
                rows = [("text", r, d, k, s, small[e - k : e].tobytes(), *[None] * 6) for r, d, k, s, e in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), n.tolist(), spelled.tolist(), ends.tolist(), strict=True)]
                keys, words = windows(identity, flat, n, rare)
                shard = (keys % np.uint64(shards)).astype(np.int64)
                order = np.lexsort((owners, words, keys, shard))
                keys, words, owners, shard = keys[order], words[order], owners[order], shard[order]
                nats = np.clip(np.round(-worth[order] * NAT), 0, 255).astype("<u1")
                cuts = [*np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(shard)] if len(shard) else []
                for a, b in zip([0, *cuts], cuts, strict=False):
                    first = a + np.flatnonzero(np.append(True, (keys[a + 1 : b] != keys[a : b - 1]) | (words[a + 1 : b] != words[a : b - 1])))
                    counts = np.diff(np.append(first, b)).astype("<u4")
                    rows.append(("window", batch.column("row")[0].as_py(), None, None, None, None, int(shard[a]), pack(np.diff(keys[first], prepend=np.uint64(0)).astype("<u8")), pack(words[first]), pack(nats[first]), pack(counts), pack(np.diff(owners[a:b].astype("<u2"), prepend=np.uint16(0)))))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return written(numbered.mapInArrow(read, ENCODED), "encoded", ("kind",))


def windows(identity: np.ndarray, codes: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the words at ``at`` a key of the window around each, with the word's code, and
    16 bits of the word itself."""
    padded = np.zeros(len(identity) + SIDE * (len(n) + 1), np.uint64)
    place = positions(n)
    padded[place] = identity
    key = codes[at].astype(np.uint64)
    for k in _AROUND:
        key = scrambled(key * np.uint64(0xD1342543DE82EF95) + padded[place[at] + k] + np.uint64(k + SIDE))
    return key, (scrambled(identity[at]) & np.uint64(0xFFFF)).astype("<u2")


def recalled(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """What a word's log-probability changes by the window's other occurrences: ``n`` of
    the word, ``total`` of ``kinds`` words, all with the masked one; ``worth`` is the
    log-probability of its spelling."""
    n, others, kinds = n - 1, total - 1, kinds - (n == 1)
    with np.errstate(divide="ignore"):
        return np.where(others == 0, 0.0, np.log((np.maximum(n - CUT, 0) * np.exp(-worth) + CUT * kinds) / np.maximum(others, 1)))


def remembered(encoded: DataFrame) -> DataFrame:
    """(row, value): for each document with windows that stand elsewhere what they add."""

    part = pa.schema([("row", pa.int64()), ("places", pa.binary()), ("values", pa.binary())])

    def shard(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [(np.cumsum(unpack(r["keys"], "<u8"), dtype=np.uint64), unpack(r["words"], "<u2"), unpack(r["counts"], "<u4")) for r in rows]
        keys, words, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((words, keys))
        new_key = np.append(True, keys[order][1:] != keys[order][:-1])
        new_word = new_key | np.append(True, words[order][1:] != words[order][:-1])
        word_of, key_of = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        word_of[order], key_of[order] = np.cumsum(new_word) - 1, np.cumsum(new_key) - 1
        n, total = np.bincount(word_of, counts), np.bincount(key_of, counts)
        kinds = np.bincount(np.cumsum(new_key)[new_word] - 1)
        out, start = [], 0
        for r, (k, _, c) in zip(rows, parts, strict=True):
            here = slice(start, start + len(k))
            start += len(k)
            value = recalled(n[word_of[here]], total[key_of[here]], kinds[key_of[here]], unpack(r["worths"], "<u1") / -NAT)
            owners = np.cumsum(unpack(r["owners"], "<u2"), dtype=np.uint16)
            sums = np.bincount(owners, np.repeat(value, c))
            at = np.flatnonzero(sums)
            if len(at):
                out.append((r["row"], at.astype("<u2").tobytes(), sums[at].astype("<f8").tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else ([],) * 3, part.types, strict=True)], schema=part)

    def batch(table: pa.Table) -> pa.Table:
        sums = np.zeros(1 << 16)
        for r in sorted(table.to_pylist(), key=lambda r: (r["places"], r["values"])):
            sums[np.frombuffer(r["places"], "<u2")] += np.frombuffer(r["values"], "<f8")
        at = np.flatnonzero(sums)
        # the rows of a batch follow each other
        return pa.table({"row": at + table.column("row")[0].as_py(), "value": sums[at]})

    asked = encoded.filter("kind = 'window'").select("row", "shard", "keys", "words", "worths", "counts", "owners")
    told = asked.groupBy("shard").applyInArrow(shard, "row long, places binary, values binary")
    return told.groupBy("row").applyInArrow(batch, "row long, value double")


def positions(n: np.ndarray) -> np.ndarray:
    """Where words stand if there are ``SIDE`` more places around each text."""
    return np.arange(n.sum()) + SIDE * (1 + np.repeat(np.arange(len(n)), n))


def fresh(seed: int = 11) -> Weights:
    random = np.random.default_rng(seed)
    return {k: (random.normal(0, 0.1, s) if k in ("embed", "inner", "outer") else np.zeros(s)).astype(np.float32) for k, s in SHAPES.items()}


def flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def shaped(values: np.ndarray) -> Weights:
    out, start = {}, 0
    for k, s in SHAPES.items():
        size = int(np.prod(s))
        out[k] = values[start : start + size].reshape(s).astype(np.float32)
        start += size
    return out


def outputs(w: Weights, hidden: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The exponentials of what the network says of each digit's values (place, digit,
    value), under the condition of the digits before; the digits wanted; their rows of
    biases."""
    left = [target // BASE ** (DIGITS - d) for d in range(DIGITS + 1)]
    wanted = np.stack([x % BASE for x in left[1:]], axis=1)
    rows = np.stack([start + x for start, x in zip(_ROWS, left, strict=False)], axis=1)[:, :DIGITS]
    x = (hidden @ w["outer"]).reshape(-1, DIGITS, BASE)
    x += np.take(w["bias"], rows, axis=0)
    return np.exp(np.clip(x, -60, 60, out=x), out=x), wanted, rows


def totals(x: np.ndarray) -> np.ndarray:
    """Sums of the last of three axes, of ``BASE`` values: by halves, as ``sum`` adds them, but over the whole array at once."""
    while x.shape[2] > 1:
        x = x[:, :, ::2] + x[:, :, 1::2]
    return x


def spread(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows of values that have the same place."""
    at, out = at.astype(np.intp), np.empty((size, values.shape[1]), np.float32)
    for k, column in enumerate(np.ascontiguousarray(values.T, np.float64)):
        out[:, k] = np.bincount(at, column, size)
    return out


def gradients(w: Weights, context: np.ndarray, target: np.ndarray) -> Weights:
    """Of the mean negative log-probability of ``target`` under ``context``."""
    at, out = gradients_of_seen(w, context, target)
    out["embed"], rows = np.zeros((CODES, WIDTH), np.float32), out["embed"]
    out["embed"][at] = rows
    return out


def gradients_of_seen(w: Weights, context: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, Weights]:
    """The codes in ``context``, and the gradients, of embeddings those of these codes alone."""
    n = len(target)
    seen = np.take(w["embed"], context, axis=0).reshape(n, -1)
    hidden = np.tanh(seen @ w["inner"] + w["inner_bias"])
    x, wanted, rows = outputs(w, hidden, target)
    x /= totals(x)
    x.reshape(-1)[np.arange(0, x.size, BASE) + wanted.ravel()] -= 1
    x /= n
    d = x.reshape(n, -1)
    d_inner = (d @ w["outer"].T) * (1 - hidden**2)
    d_seen = (d_inner @ w["inner"].T).reshape(-1, WIDTH)

    held = np.bincount(context.ravel(), minlength=CODES) > 0
    at = np.flatnonzero(held)
    return at, {
        "embed": spread((np.cumsum(held) - 1)[context.ravel()], d_seen, len(at)),
        "inner": seen.T @ d_inner,
        "inner_bias": d_inner.sum(axis=0),
        "outer": hidden.T @ d,
        "bias": spread(rows.ravel(), x.reshape(-1, BASE), _ROWS[-1]),
    }


class Trainer:
    """Steps from given weights, each weight's shorter the more it has moved."""

    def __init__(self, weights: Weights, rate: float = 0.1):
        self.weights, self.rate, self.seen = {k: v.copy() for k, v in weights.items()}, rate, 0
        self.square = {k: np.full(v.shape, 1e-8, np.float32) for k, v in weights.items()}

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        self.seen += len(target)
        codes, found = gradients_of_seen(self.weights, context, target)
        for k, g in found.items():
            # words that aren't in the windows of these steps have no gradient
            at = codes if k == "embed" else slice(None)
            square = self.square[k][at] + g * g
            self.square[k][at] = square
            self.weights[k][at] -= self.rate * g / np.sqrt(square)


def laid_out(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words' codes with ``SIDE`` zeros around each text, and their places."""
    n = np.array([len(c) // 2 for c in codes], np.int64)
    out = np.zeros(n.sum() + SIDE * (len(n) + 1), np.int32)
    at = positions(n)
    out[at] = np.frombuffer(b"".join(codes), "<u2")
    return out, at


def masked(text: np.ndarray, at: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The places whose turn it is: by a hash of the place, each in one round."""
    return at[scrambled(at.astype(np.uint64) + np.uint64(1)) % np.uint64(rounds) == turn]


def train(encoded: DataFrame, lanes: int, rounds: int = 2, batch: int = 8192) -> Weights:
    """Weights after ``rounds`` of steps in all lanes and averaging."""
    spark, weights = encoded.sparkSession, fresh()
    texts = laned(encoded, lanes).filter("n_words > 0").select("lane", "doc_id", "codes")
    size = len(flat(weights))
    kind = pa.schema([("lane", pa.int64()), ("seen", pa.int64()), ("weights", pa.binary())])

    def total(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["lane"])
        out = np.zeros(size)
        for r in rows:
            out += np.frombuffer(r["weights"], np.float64)
        return pa.table([[rows[0]["to"]], [sum(r["seen"] for r in rows)], [out.tobytes()]], schema=kind)

    def lane_with(start, turn: int):
        def lane(table: pa.Table) -> pa.Table:
            # rows that are alike in both are the same to training
            order = sorted(zip(table.column("doc_id").to_pylist(), table.column("codes").to_pylist(), strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
            text, at = laid_out([c for _, c in order])
            at = masked(text, at, turn, rounds)
            # neighbours share topics; steps are taken over the whole lane
            at = at[np.argsort(scrambled(at.astype(np.uint64)), kind="stable")]
            trainer = Trainer(start.value)
            for i in range(0, len(at), batch):
                here = at[i : i + batch]
                trainer.learn(text[here[:, None] + _AROUND], text[here])
            return pa.table([[table.column("lane")[0].as_py()], [trainer.seen], [(flat(trainer.weights).astype(np.float64) * trainer.seen).tobytes()]], schema=kind)

        return lane

    for turn in range(rounds):
        learn = lane_with(spark.sparkContext.broadcast(weights), turn)
        rows, n = texts.groupBy("lane").applyInArrow(learn, "lane long, seen long, weights binary"), lanes
        while True:  # sums of at most 32 rows each
            n = -(-n // 32)
            rows = rows.withColumn("to", F.pmod("lane", F.lit(n)))
            rows = rows.groupBy("to").applyInArrow(total, "lane long, seen long, weights binary")
            if n == 1:
                break
        done = rows.collect()  # one row
        if done and done[0]["seen"]:
            weights = shaped(np.frombuffer(done[0]["weights"], np.float64) / done[0]["seen"])
    return weights


def laned(encoded: DataFrame, lanes: int) -> DataFrame:
    """The rows of texts with their lanes, each lane in one partition."""
    texts = encoded.filter("kind = 'text'").withColumn("lane", F.pmod(F.xxhash64("doc_id", "codes"), F.lit(lanes).cast("long")).cast("int"))
    return texts.repartitionById(lanes, "lane")


def log_probabilities(w: Weights, text: np.ndarray, at: np.ndarray, chunk: int = 8192) -> np.ndarray:
    """Of the codes of each word at ``at`` under the words around it."""
    tables = [w["embed"] @ part for part in np.split(w["inner"], 2 * SIDE)]
    out = np.empty(len(at))
    for start in range(0, len(at), chunk):
        here = at[start : start + chunk]
        hidden = np.tanh(w["inner_bias"] + sum(np.take(table, text[here + k], axis=0) for table, k in zip(tables, _AROUND, strict=True)))
        x, wanted, _ = outputs(w, hidden, text[here])
        chosen = x.reshape(-1)[np.arange(0, x.size, BASE) + wanted.ravel()].reshape(wanted.shape)
        out[start : start + chunk] = np.log(chosen / totals(x)[:, :, 0]).sum(axis=1)
    return out


def score(encoded: DataFrame, weights: Weights, lanes: int) -> DataFrame:
    """(row, doc_id, n_words, value) of all documents, by the network and by spelling."""
    known = encoded.sparkSession.sparkContext.broadcast(weights)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n_words").to_numpy()
            sums = np.append(0.0, np.cumsum(log_probabilities(known.value, *laid_out(batch.column("codes").to_pylist()))))
            ends = np.cumsum(n)
            value = sums[ends] - sums[ends - n] + batch.column("spelled").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("n_words"), pa.array(value)], names=["row", "doc_id", "n_words", "value"])

    texts = laned(encoded, lanes).select("row", "doc_id", "n_words", "spelled", "codes")
    return texts.mapInArrow(tell, "row long, doc_id long, n_words long, value double")


def pseudo_likelihood(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Trains on all documents and scores all documents: the id, n_words, the sum
    log_likelihood of all words' log-probabilities and their mean_log_likelihood."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # about six bytes a word, and a third of the words not frequent
    lanes, shards = n_bytes // (6 * LANE) + 1, n_bytes // (18 * WINDOWS) + 1
    encoded = encode(docs, vocabulary(docs), shards)
    found = score(encoded, train(encoded, lanes, **options), lanes).unionByName(remembered(encoded), allowMissingColumns=True)
    told = found.groupBy("row").agg(F.max("doc_id").alias(id_column), F.max("n_words").alias("n_words"), F.sum("value").alias("log_likelihood")).drop("row")
    return told.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))
