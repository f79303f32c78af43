"""Personal data: base patterns plus spans that boosted trees select.

Everything is a built-in expression of the row's text, so the spans of a document
are found where it is and no Python runs on the executors.  ``matches`` gives all
matches of a pattern with their places: the text between matches and the matches
themselves have lengths, whose running total is the place of each match.

Generators propose many spans, overlapping ones too.  Each gets a bit mask of format
and context features.  What the trees learn is none of them: whether a candidate

* overlaps a span of a base kind, whose checks (check digit, ranges, number of digits)
  the features don't see, or holds a number with the ranges of a social security
  number or the check digits of a bank account; or
* is a secret or a code that isn't made of words (those that occur alone in several
  texts of the corpus) and isn't repeated in many texts.

The facts of the second kind come from joins over the corpus.  Trees are boosted on
the counts of masks of at most about ``train_rows`` candidates, chosen by hash of the
text; a fifth of these is held out, and the threshold is the lowest score that these
confirm to ``precision``.  At most 2 ** len(FEATURES) rows reach the driver.

Defined results: a null or empty text has no spans; rows are judged one by one, repeated
or not; very long texts are searched to their end, spans of any length included; spans
of one start are listed by kind, and a span that a base span covers isn't added to it;
an empty table gives an empty result, and without candidates nothing is added to the
base; places count code points, the end is exclusive; the two named columns are read,
whatever others are called.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import written

#: Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "code", "number", "run", "address")
KINDS = BASE_KINDS + MORE_KINDS
#: Matches that are added up in one go; longer lists are added in two levels.
CHUNK = 256

# A match can only begin where a run of its characters begins or another match has
# ended, so looking behind and not giving back finds what the plain patterns find,
# in one pass over the text.
_LOCAL = "[A-Za-z0-9._%+-]"
_GROUP = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?i)(?<![a-z])(?:pass(?:word|wd|phrase)?|pwd|secret|token|credentials?|(?:api|access|private)[_-]?key)[\x20\x09]{0,3}[=:][\x20\x09]{0,3}[\"']?[^\s\"']{4,}+",
    # with a digit, or a capital after a small letter: no plain word
    "code": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9]|[A-Za-z+/_-]*[a-z][A-Z])[A-Za-z0-9+/_-]{16,}+",
    "number": r"(?<![0-9A-Za-z+.])\(?[0-9]{2,5}\)?(?:[\x20.-][0-9]{2,6}){2,6}+(?![0-9A-Za-z])",
    "run": r"(?<![0-9A-Za-z])(?:[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}|[0-9]{7,}+)(?![0-9A-Za-z])",
    "address": r"(?<![^\s<>()\[\]\"',;:@])[^\s<>()\[\]\"',;:@]++@[^\s<>()\[\]\"',;:@]++",
}
#: What a text holds if it can match at all; the rest of the texts skip the pattern.
TRIGGERS: dict[str, Callable[[Column], Column]] = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike("[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "secret": lambda t: F.contains(t, F.lit("=")) | F.contains(t, F.lit(":")),
    "code": lambda t: t.rlike("[0-9]|[a-z][A-Z]"),
    "number": lambda t: t.rlike("[0-9]"),
    "run": lambda t: t.rlike("[0-9]{7}|[A-Z]{2}[0-9]{2}"),
    "address": lambda t: F.contains(t, F.lit("@")),
}


def with_running(df: DataFrame, values: str, out: str, combine: Callable[[Column, Column], Column]) -> DataFrame:
    """Adds the running total, under ``combine``, of an array of non-negative integers.

    Chunks are added up on their own and then shifted by the chunks before, as
    adding one by one copies the whole result at every step.
    """
    none = F.array().cast("array<int>")
    add = lambda done, x: F.concat(done, F.array(combine(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)), x)))
    last = F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / CHUNK).cast("int")
    df = df.withColumn("_chunks", F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(values, k * CHUNK + 1, CHUNK), none, add)))
    df = df.withColumn("_ends", F.aggregate(F.transform("_chunks", lambda c: F.coalesce(F.get(c, F.size(c) - 1), F.lit(0))), none, add))
    shift = lambda k: F.when(k > 0, F.get(F.col("_ends"), k - 1)).otherwise(0)
    return df.withColumn(out, F.flatten(F.transform("_chunks", lambda c, k: F.transform(c, lambda x: combine(shift(k), x))))).drop("_chunks", "_ends")


def add_matches(df: DataFrame, kind: str, text: str = "text") -> DataFrame:
    """Adds column ``kind``: an array of (start, end, value, before)."""
    t, pattern = F.col(text), F.lit(PATTERNS[kind])
    may = TRIGGERS[kind](t)
    parts = F.zip_with(F.split(t, PATTERNS[kind], -1), F.regexp_extract_all(t, pattern, F.lit(0)), lambda gap, value: F.struct(F.length(gap).alias("gap"), F.length(value).alias("size"), F.right(gap, F.lit(24)).alias("before"), value.alias("value")))
    df = df.withColumn("_parts", F.filter(F.when(may, parts), lambda p: p["size"].isNotNull()))
    df = df.withColumn("_parts", F.coalesce("_parts", F.filter(F.array(F.struct(F.lit(0).alias("gap"), F.lit(0).alias("size"), F.lit("").alias("before"), F.lit("").alias("value"))), lambda p: p["size"] > 0)))
    df = df.withColumn("_steps", F.transform("_parts", lambda p: p["gap"] + p["size"]))
    df = with_running(df, "_steps", "_stops", lambda a, b: a + b)
    spans = F.zip_with("_parts", "_stops", lambda p, stop: F.struct((stop - p["size"]).alias("start"), stop.alias("end"), p["value"].alias("value"), p["before"].alias("before")))
    return df.withColumn(kind, F.when(F.size("_parts") > 0, spans).otherwise(F.slice(spans, 1, 0))).drop("_parts", "_steps", "_stops")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has the check digit of payment cards."""
    figures = F.transform(F.regexp_extract_all(F.reverse(number), F.lit("[0-9]"), F.lit(0)), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2, F.lit(10)) + F.when(d.cast("int") > 4, 1).otherwise(0)))
    return F.aggregate(figures, F.lit(0), lambda a, d: a + d) % 10 == 0


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^0*{_GROUP}\.0*{_GROUP}\.0*{_GROUP}\.0*{_GROUP}$"),
    "card": lambda v: luhn(digits(v)),
    "phone": lambda v: F.length(digits(v)).between(10, 15),
}

_NEAR = r"(?i)(?:pass|pwd|secret|token|key|credential|ssn|social|passport|account|iban|tel|phone|call|mobile|fax|id)[^A-Za-z]*(?:is|no|nr|number)?[^A-Za-z]*$"
#: Bit by bit, what the trees may ask of a candidate (value, text before it, kind).
FEATURES: tuple[tuple[str, Callable[[Column, Column, str], Column]], ...] = (
    ("names_a_secret", lambda v, b, k: F.lit(k == "secret")),
    ("is_number", lambda v, b, k: F.lit(k in ("number", "run"))),
    ("keyword_before", lambda v, b, k: b.rlike(_NEAR)),
    ("assigned", lambda v, b, k: b.rlike(r"[=:][\x20\"']*$") | F.lit(k == "secret")),
    ("long_hexadecimal", lambda v, b, k: v.rlike(r"[0-9a-f]{16,}")),
    ("mixed_case_and_digits", lambda v, b, k: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")),
    ("capitals_and_digits", lambda v, b, k: v.rlike("^[A-Z0-9]+$") & v.rlike("[A-Z]") & v.rlike("[0-9]")),
    ("letters", lambda v, b, k: v.rlike("[A-Za-z]")),
    ("digits", lambda v, b, k: F.length(digits(v)) >= 4),
    ("digits_of_a_phone", lambda v, b, k: F.length(digits(v)).between(9, 13)),
    ("more_digits", lambda v, b, k: F.length(digits(v)) >= 14),
    ("groups_of_an_id", lambda v, b, k: v.rlike(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("dots", lambda v, b, k: v.rlike(r"[A-Za-z0-9]\.[A-Za-z0-9]")),
    ("plus_before", lambda v, b, k: b.rlike(r"\+[0-9]{0,3}[\x20.-]?$")),
)


def checked(value: Column, kind: str) -> Column:
    """Whether a number has the ranges of a social security number or the check digits
    of a bank account."""
    if kind == "number":
        return value.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    if kind != "run":
        return F.lit(False)
    turned = F.concat(F.substring(value, 5, 40), F.substring(value, 1, 4))
    figures = F.transform(F.regexp_extract_all(turned, F.lit("."), F.lit(0)), lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55))
    rest = F.aggregate(figures, F.lit(0), lambda a, d: F.when(d > 9, a * 100 + d).otherwise(a * 10 + d) % 97)
    return F.when(value.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}$"), rest == 1).otherwise(False)


def own_part(value: Column, kind: str) -> Column:
    """The secret itself, without the name it is assigned to."""
    return F.regexp_replace(value, r"^[^=:]*[=:][\s\"']*", "") if kind == "secret" else value


def described(kind: str, base: Column) -> Callable[[Column], Column]:
    """A match of a generator as (kind, start, end, mask, held, good, value): ``held`` if a
    base span covers it, ``good`` if it has passed a check."""

    def of(s: Column) -> Column:
        bits = [F.when(f(s["value"], s["before"], kind), 1 << i).otherwise(0) for i, (_, f) in enumerate(FEATURES)]
        over = F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"]))
        held = F.exists(base, lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), sum(bits, F.lit(0)).alias("mask"), held.alias("held"), (over | checked(s["value"], kind)).alias("good"), s["value"].alias("value"))

    return of


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds arrays ``base`` of (start, kind_no, end, kind), sorted, and ``candidates``."""
    for kind in BASE_KINDS:
        docs = add_matches(docs, kind, text)
        docs = docs.withColumn(kind, valid_spans(kind))
    docs = docs.withColumn("base", F.array_sort(F.concat(*BASE_KINDS))).drop(*BASE_KINDS)
    for kind in MORE_KINDS:
        docs = add_matches(docs, kind, text)
        docs = docs.withColumn(kind, F.transform(kind, described(kind, F.col("base"))))
    return docs.withColumn("candidates", F.concat(*MORE_KINDS)).drop(*MORE_KINDS)


Tree = tuple[int, int, tuple[float, float, float, float]]


class Boosted:
    """Trees of depth two over the feature bits, for the log odds of a candidate."""

    def __init__(self, rows: list[tuple[int, int, int]], held: list[tuple[int, int, int]] | None = None, rounds: int = 24, rate: float = 0.5, precision: float = 0.98, ridge: float = 1.0):
        """``rows``: (mask, candidates, confirmed ones) to learn from, ``held``: those that
        set the threshold, the same ones by default."""
        held = rows if held is None else held
        total, good = sum(n for _, n, _ in rows), sum(g for *_, g in rows)
        self.start = math.log((good + 1) / (total - good + 1))
        self.trees: list[Tree] = []
        scores = {m: self.start for m, *_ in rows}
        for _ in range(rounds if rows else 0):
            slopes = []
            for m, n, g in rows:
                p = 1 / (1 + math.exp(-scores[m]))
                slopes.append((m, g - n * p, n * p * (1 - p)))
            best = max(((self._gain(slopes, a, b, ridge), a, b) for a in range(len(FEATURES)) for b in range(a + 1, len(FEATURES))), key=lambda x: x[0][0])
            (_, leaves), a, b = best
            tree = (a, b, tuple(rate * x for x in leaves))
            self.trees.append(tree)
            for m in scores:
                scores[m] += tree[2][(m >> a & 1) * 2 + (m >> b & 1)]
        self.threshold, n_over, g_over = math.inf, 0, 0
        ranked = sorted(((self.value(m), n, g) for m, n, g in held), key=lambda r: -r[0])
        for i, (score, n, g) in enumerate(ranked):
            n_over, g_over = n_over + n, g_over + g
            last_of_score = i + 1 == len(ranked) or ranked[i + 1][0] < score - 1e-9
            if last_of_score and g_over >= precision * n_over and g_over:
                self.threshold = score - 1e-9

    def value(self, mask: int) -> float:
        """The score of one mask."""
        return self.start + sum(leaves[(mask >> a & 1) * 2 + (mask >> b & 1)] for a, b, leaves in self.trees)

    @staticmethod
    def _gain(slopes: list[tuple[int, float, float]], a: int, b: int, ridge: float) -> tuple[float, list[float]]:
        first, second = [0.0] * 4, [0.0] * 4
        for m, g, h in slopes:
            leaf = (m >> a & 1) * 2 + (m >> b & 1)
            first[leaf] += g
            second[leaf] += h
        return sum(g * g / (h + ridge) for g, h in zip(first, second, strict=True)), [g / (h + ridge) for g, h in zip(first, second, strict=True)]

    def score(self, mask: Column) -> Column:
        """The trees as one expression."""
        has = lambda i: mask.bitwiseAND(F.lit(1 << i)) != 0
        out = F.lit(self.start)
        for a, b, (none, only_b, only_a, both) in self.trees:
            out = out + F.when(has(a) & has(b), both).when(has(a), only_a).when(has(b), only_b).otherwise(none)
        return out

    def selects(self, mask: Column) -> Column:
        return self.score(mask) >= (self.threshold if self.threshold < math.inf else float("inf"))


#: A value in more texts than that is no one's own; a word is one if it stands in so many texts.
MANY_TEXTS, WORD_TEXTS = 20, 3


def labelled(docs: DataFrame, text: str = "text", train_rows: int = 200_000) -> DataFrame:
    """(kind, mask, good, apart): candidates to learn from and whether they are held out."""
    docs = docs.select(F.col(text).alias("text")).filter("text is not null")
    found = with_candidates(docs).select(F.xxhash64("text").alias("text_key"), F.explode_outer("candidates").alias("c")).filter("c is not null").select("text_key", "c.kind", "c.mask", "c.good", "c.value")
    own = F.when(F.col("kind") == "secret", own_part(F.col("value"), "secret")).otherwise(F.col("value"))
    found = written(found.select("text_key", "kind", "mask", "good", own.alias("value"), F.xxhash64(own).alias("value_key")), "candidates")
    n = found.count()
    # a share by hash of the text, so that a text's candidates are in or out together
    chosen = found.filter(F.pmod("text_key", F.lit(1 << 20)) < F.lit(max(1, (train_rows << 20) // max(n, 1)))).distinct()
    texts_of = found.select("value_key", "text_key").distinct().groupBy("value_key").count()
    common = texts_of.filter(F.col("count") > MANY_TEXTS).select("value_key", F.lit(True).alias("common"))
    asked = chosen.filter(F.col("kind").isin("secret", "code") & ~F.col("good")).select("value_key", "value").distinct()
    parts = written(asked.select("value_key", F.length("value").alias("size"), F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{4,}"), F.lit(0))).alias("word")), "parts")
    # bounded by train_rows
    wanted = F.broadcast(parts.select("word").distinct())
    words = docs.select(F.xxhash64("text").alias("text_key"), F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).join(wanted, "word", "left_semi")
    known = words.distinct().groupBy("word").count().filter(F.col("count") >= WORD_TEXTS).select("word")
    worded = parts.join(known, "word").groupBy("value_key", "size").agg(F.sum(F.length("word")).alias("letters")).filter("2 * letters >= size").select("value_key", F.lit(True).alias("worded"))
    judged = chosen.join(common, "value_key", "left").join(worded, "value_key", "left")
    secret = F.col("kind").isin("secret", "code") & F.col("worded").isNull() & F.col("common").isNull() & (F.length("value") >= 8)
    return judged.select("kind", "mask", (F.col("good") | secret).alias("good"), (F.pmod(F.xxhash64("text_key"), F.lit(5)) == 0).alias("apart"))


def train(docs: DataFrame, text: str = "text", train_rows: int = 200_000, **options) -> Boosted:
    """Trees from the candidates of the documents."""
    counts = labelled(docs, text, train_rows).groupBy("mask", "apart").agg(F.count("*").alias("n"), F.count_if("good").alias("g"))
    rows = sorted(counts.collect())  # at most 2 ** (len(FEATURES) + 1) rows
    return Boosted([(r.mask, r.n, r.g) for r in rows if not r.apart], [(r.mask, r.n, r.g) for r in rows if r.apart], **options)


def valid_spans(kind: str) -> Column:
    """The matches of a base kind that hold, as (start, kind_no, end, kind)."""
    held = F.filter(kind, lambda s: VALID[kind](s["value"]))
    return F.transform(held, lambda s: F.struct(s["start"].alias("start"), F.lit(BASE_KINDS.index(kind)).alias("kind_no"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find_spans(docs: DataFrame, model: Boosted | None = None, text: str = "text") -> DataFrame:
    """Adds arrays ``base`` and ``all_spans`` of (start, kind_no, end, kind), sorted.

    Input columns must not be called by the names of kinds; ``spans_of`` and
    ``redact`` keep the input apart.
    """
    model = model or train(docs, text)
    docs = with_candidates(docs, text)
    chosen = F.filter("candidates", lambda c: model.selects(c["mask"]) & ~c["held"])
    number = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    more = F.transform(chosen, lambda c: F.struct(c["start"].alias("start"), F.element_at(number, c["kind"]).alias("kind_no"), c["end"].alias("end"), c["kind"].alias("kind")))
    return docs.withColumn("all_spans", F.array_sort(F.concat("base", more))).drop("candidates")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def spans_of(docs: DataFrame, id_column: str = "doc_id", text: str = "text", model: Boosted | None = None) -> DataFrame:
    """One row for each document: its id, counts by base kind, a digest of the base
    spans, and all spans as text."""
    found = find_spans(docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), model).select("doc_id", "base", "all_spans")
    return found.select(F.col("doc_id").alias(id_column), *map(count_of, BASE_KINDS), F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("all_spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", model: Boosted | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; spans that
    overlap are replaced together, under the first one's kind."""
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")
    found = find_spans(docs.select(whole, F.coalesce(F.col(text), F.lit("")).alias("text")), model)
    found = found.withColumn("_stops", F.transform("all_spans", lambda s: s["end"]))
    found = with_running(found, "_stops", "_reach", F.greatest)
    before = lambda i: F.when(i > 0, F.get(F.col("_reach"), i - 1)).otherwise(0)
    piece = lambda s, i: F.when(s["start"] >= before(i), F.concat(F.substring(F.col("text"), before(i) + 1, s["start"] - before(i)), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")
    rest = F.substring(F.col("text"), F.element_at("_reach", -1) + 1, F.length("text"))
    clean = F.when(F.size("all_spans") > 0, F.concat(F.array_join(F.transform("all_spans", piece), ""), rest)).otherwise(F.col("_row")[text])
    return found.select(*[clean.alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns])
