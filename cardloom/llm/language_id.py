"""The languages of a document as a mixture of character n-gram models.

A text is a row of n-grams (three bytes of the lower-cased text, white space and
digits folded), each hashed to one of ``CELLS`` cells.  For every language the
cells of all its learned documents are counted; cell counts over all documents,
at most languages x CELLS numbers, are the models.

For a document expectation-maximisation finds the proportions under which its
n-grams are likeliest.  Languages are then taken away, least first, as long as
the log-likelihood lost is smaller than the penalty for one language more; the
language with the largest proportion among those left is the prediction, and
that proportion the score.  ``languages`` are all that are left.

At most ``LANGUAGES`` values of ``lang`` are learned, those that most documents have
(of equals the first by name), so that a dirty column doesn't make the models grow.

Defined results: a null or empty text and one without a letter are ``und`` with score 0
and no languages, as is everything if no language was learned; rows without language or
text are not learned from; very long texts are read whole; of equal proportions the
first language by name is predicted and the last one taken away; rows are predicted one
by one, repeated or not; an empty table gives an empty result; only the three named
columns are read, whatever others are called.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import ship, written

CELLS = 1 << 15
LANGUAGES = 256
UNKNOWN = "und"
_FOLD = bytes(32 if b < 65 or 91 <= b <= 96 or 123 <= b <= 127 else b for b in range(256))


def cells_of(text: str) -> np.ndarray:
    """The cells of a text's n-grams, in order, repeats and all."""
    folded = b" " + b" ".join(text.lower().encode().translate(_FOLD).split()) + b" "
    b = np.frombuffer(folded, np.uint8).astype(np.uint32)
    return ((b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35) >> 7) & (CELLS - 1)


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log models (language x cell) from (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                counts = held.setdefault(lang, np.zeros(CELLS, np.int64))
                cells, times = np.unique(cells_of(text), return_counts=True)
                counts[cells] += times
        for lang, counts in held.items():
            cells = np.nonzero(counts)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cells)), pa.array(cells.astype(np.int32)), pa.array(counts[cells])], names=["lang", "cell", "n"])

    docs = docs.filter("lang is not null and text is not null").select("text", "lang")
    found = written(docs.groupBy("lang").count(), "languages")
    chosen = found.orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    sums = docs.join(F.broadcast(chosen), "lang", "left_semi").select("text", "lang").mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    # at most LANGUAGES rows, with at most CELLS entries in each
    rows = sums.groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells")).orderBy("lang").collect()
    models = np.full((len(rows), CELLS), 0.5)
    for model, row in zip(models, rows, strict=True):
        for cell, n in row["cells"]:
            model[cell] += n
    return [r["lang"] for r in rows], np.log(models / models.sum(axis=1, keepdims=True)).astype(np.float32)


def mixture(likely: np.ndarray, times: np.ndarray, start: np.ndarray, steps: int = 12) -> tuple[np.ndarray, float]:
    """Proportions of the languages and the log-likelihood; ``likely`` is (language x
    n-gram), each n-gram's largest entry 1."""
    share, total = start, times.sum()
    for _ in range(steps):
        joint = share @ likely
        share = share * (likely @ (times / joint)) / total
    return share, float(times @ np.log(share @ likely))


def infer(cells: np.ndarray, models: np.ndarray, penalty: float) -> tuple[int, float, np.ndarray]:
    """(likeliest language, its proportion, all proportions) of one text."""
    found, times = np.unique(cells, return_counts=True)
    logs = models[:, found]
    likely = np.exp(logs - logs.max(axis=0))
    times = times.astype(np.float32)
    kept = np.arange(len(models))
    share, score = mixture(likely, times, np.full(len(models), 1 / len(models), np.float32))
    cost = penalty * np.log(times.sum() + 1)
    while len(kept) > 1:
        fewer = np.delete(np.arange(len(kept)), len(share) - 1 - share[::-1].argmin())
        start = share[fewer] + 1e-6
        next_share, next_score = mixture(likely[kept[fewer]], times, start / start.sum())
        if score - next_score > cost:
            break
        kept, share, score = kept[fewer], next_share, next_score
    out = np.zeros(len(models))
    out[kept] = share / share.sum()
    best = int(out.argmax())
    return best, float(out[best]), out


def predict(docs: DataFrame, languages: list[str], models: np.ndarray, penalty: float = 4.0) -> DataFrame:
    """(doc_id, text) as (doc_id, lang_pred, score, languages): the last are all
    languages of the set that was selected, largest proportion first."""
    ship(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(models)
    kinds = [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string()))]

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, sets = [], [], []
            for text in batch.column("text").to_pylist():
                if not languages or not text or not any(c.isalpha() for c in text):
                    name, score, chosen = UNKNOWN, 0.0, []
                else:
                    best, score, shares = infer(cells_of(text), known.value, penalty)
                    name, chosen = languages[best], [languages[i] for i in np.argsort(-shares) if shares[i] > 0]
                names.append(name)
                scores.append(score)
                sets.append(chosen)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, t) for x, (_, t) in zip((names, scores, sets), kinds[1:], strict=True)]], names=[n for n, _ in kinds])

    return docs.select("doc_id", "text").mapInArrow(tell, "doc_id long, lang_pred string, score double, languages array<string>")


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: a quarter, by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learns from documents that aren't held out and predicts all (doc_id, text, lang)."""
    ship(docs.sparkSession)
    learned = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    told = predict(docs, *learn(learned))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")


def crc_is_two(doc_id: int) -> bool:
    """``held_out`` for one id, in Python."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
