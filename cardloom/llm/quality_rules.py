"""Quality rules: a threshold table compiled into one projection.

``THRESHOLDS`` names a measure, the least and the greatest value that a good
document has, and why.  ``judge`` turns the table into one select over measures
that are themselves built-in functions of the text: no Python runs and nothing
is shuffled.

Stop words are one list for all languages by default; another list is a parameter.

Defined results: a null text is an empty one; an empty text has no words and
fails; very long texts are measured whole; a value at a threshold is good; of equal
lines all but the first are duplicates; repeated rows are judged one by one; an empty
table gives an empty result; columns of the input that have the name of a measure are
replaced in the measures and left alone by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import where_computed, words_of

SYMBOLS = "[#*$%&|<>]"

#: Frequent function words of the languages the rules know.
STOP_WORDS = (
    "the of and to in is that for it was with as on be at by this are from or an "
    "le la les de des du et en un une est que pour dans qui pas par au sur plus "
    "der die das und den von zu mit ist ein eine nicht auf sich im dem es "
    "el los las y del una por con se no lo al su para"
).split()


@dataclass(frozen=True)
class Threshold:
    """A document is good in ``measure`` from ``least`` to ``most`` inclusive."""

    measure: str
    least: float | None = None
    most: float | None = None


#: The base rules fix n_words and the share of repeated words; the method adds the rest.
BASE = (Threshold("n_words", least=50), Threshold("repeat_pct", most=50))
THRESHOLDS = (
    Threshold("mean_word_chars", 2, 15),
    Threshold("symbols_per_word", most=0.1),
    Threshold("stop_word_ratio", least=0.02),
    Threshold("dup_line_ratio", most=0.3),
    Threshold("bullet_line_ratio", most=0.9),
    Threshold("ellipsis_line_ratio", most=0.3),
)


def measures(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``docs`` with one column for each measure."""
    t = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumns({"_words": words_of(F.col(text)), "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long")})
    w = F.col("_words")
    windows = F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")))
    docs = docs.withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
    docs = docs.withColumn("_windows", F.sort_array(F.slice(windows, 1, F.greatest(F.size(w) - 2, F.lit(0)))))
    s = F.col("_windows")
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    docs = docs.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["p"])))
    at, lines = F.col("_at"), F.col("_lines")
    # a window covers three words; where the next repeated window begins earlier, only up to it
    covered = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    n_words, n_lines = F.size(w), F.size(lines)
    share = lambda part, whole: F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))
    return docs.withColumns(
        {
            "n_words": n_words.cast("long"),
            "n_dup_lines": (n_lines - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": covered.cast("long"),
            "repeat_pct": share(100 * covered, n_words),
            "mean_word_chars": share(F.col("word_chars"), n_words),
            "symbols_per_word": share(F.col("n_symbols"), n_words),
            "stop_word_ratio": share(F.size(F.filter(w, lambda x: F.lower(x).isin(list(stop_words)))), n_words),
            "dup_line_ratio": share(n_lines - F.size(F.array_distinct(lines)), n_lines),
            "bullet_line_ratio": share(F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))), n_lines),
            "ellipsis_line_ratio": share(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*\z"))), n_lines),
        }
    ).drop("_words", "_lines", "_windows", "_at")


def holds(thresholds: tuple[Threshold, ...]) -> Column:
    """The table as one boolean expression."""
    out = F.lit(True)
    for t in thresholds:
        if t.least is not None:
            out = out & (F.col(t.measure) >= t.least)
        if t.most is not None:
            out = out & (F.col(t.measure) <= t.most)
    return out


def judge(docs: DataFrame, text: str = "text", thresholds: tuple[Threshold, ...] = THRESHOLDS, base: tuple[Threshold, ...] = BASE, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """The measures with ``base_failed`` and ``kept``."""
    return measures(docs, text, stop_words).withColumn("base_failed", ~holds(base)).withColumn("kept", ~F.col("base_failed") & holds(thresholds))


def keep_good(docs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = judge(docs.select(whole, F.col(text).alias("_text")), "_text", **rules)
    return where_computed(judged.select("_row", "kept"), "kept").select("_row.*")
