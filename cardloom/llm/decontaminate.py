"""Documents that hold a benchmark item: SimHash of item-sized windows.

1. A first pass drops texts without loss: a window that is similar to an item of n
   shingles has at least 80 % of n in common with it, so only texts that share so
   many places with some item of n shingles have windows of that size to look at.
2. Every window of such a size in such a text, whatever shingles it has, gets a
   64-bit SimHash.  Windows may hang over the ends of a text by a fifth.
3. Fingerprints are looked up by size in a multi-index of the items: the bits are
   cut into four blocks, and two fingerprints within ``RADIUS`` differ in at most
   three bits of some block, so the index holds each block value with all values
   within three bits.  Every fingerprint within the radius is found, and only those
   are candidates.
4. Candidates are confirmed by the exact similarity of their weighted shingles:
   the weight is the number of times a shingle occurs, and the similarity the
   sum of the smaller weights over the sum of the larger.

Votes of a window are counted for many bits at once: a number holds one lane for
each of several bits, and the lanes of all shingles are added up; of windows, from sums over
1, 2, 4... shingles, so that a window isn't gone through shingle by shingle.

Case is ignored.  All steps are built-in functions and joins.  Equal texts are
looked at once.

Defined results: null and empty texts hold nothing; items and texts of fewer than
five words have no shingle and match nothing; repeated rows all get the result of
their text; very long texts are looked at whole, window by window; of equally
similar windows the first counts; an item id that several rows have stands for all
their texts, and gives one row for a document with any of them; an empty benchmark or
an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import operator
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import shingles_of, small_if_checked, text_keys, where_computed, words_of, written

BLOCKS, BITS = 4, 16
#: Bits that may differ in a block of the index.
FREE = 3
#: The largest radius for which some block differs in at most that many bits.
RADIUS = (FREE + 1) * BLOCKS - 1
#: Rows of the index up to which it is broadcast: one number as key and two more.
INDEX_ROWS = 2_000_000
#: Texts whose windows are looked at by one task.
TEXTS = 200
#: Windows of one size that are looked at in a row.
TILE = 1024


def with_shingles(texts: DataFrame, size: int) -> DataFrame:
    """(…, text) with the column ``shingles``; texts that are too short have none."""
    worded = texts.withColumn("words", words_of(F.lower("text"))).drop("text")
    long_enough = F.when(F.size("words") >= size, shingles_of(F.col("words"), size))
    return worded.withColumn("shingles", F.coalesce(long_enough, F.array().cast("array<long>"))).drop("words")


def lane_for(most: int) -> int:
    """The width of a lane that can count up to ``most`` shingles."""
    return next(w for w in (8, 16, 32) if most < 1 << (w - 1))


def every(step: int) -> int:
    """The number whose bits 0, step, 2 * step... are set."""
    return sum(1 << i for i in range(0, 64, step))


def simhash(shingles: Column, lane: int) -> Column:
    """64 bits: each is set if more hashes of the window have it than have it not.

    Number j of ``lane`` numbers counts the bits j, j + lane, j + 2 * lane...
    """
    none = F.struct(*[F.lit(0).cast("long").alias(f"c{j}") for j in range(lane)])
    add = lambda c, h: F.struct(*[(c[f"c{j}"] + v).alias(f"c{j}") for j, v in enumerate(votes(h, lane))])
    return F.aggregate(shingles, none, add, lambda c: majority([c[f"c{j}"] for j in range(lane)], F.size(shingles), lane))


def votes(h: Column, lane: int) -> list[Column]:
    """The bits of a hash, dealt over ``lane`` numbers."""
    unit = F.lit(every(lane)).cast("long")
    return [F.call_function("shiftrightunsigned", h, F.lit(j)).bitwiseAND(unit) for j in range(lane)]


def majority(counts: list[Column], size: Column, lane: int) -> Column:
    """The bits that more than half of ``size`` hashes have."""
    # a lane has its highest bit once what it lacks to more than a half is added; every second lane at a time, so that nothing runs over
    wide = every(2 * lane)
    long = lambda x: F.lit(x).cast("long")
    lack = (long(1 << (lane - 1)) - F.floor(size / 2) - 1) * long(wide)
    out = long(0)
    for j, count in enumerate(counts):
        for half in (0, lane):
            part = F.call_function("shiftrightunsigned", count, F.lit(half)).bitwiseAND(long(wide * ((1 << lane) - 1)))
            more = F.call_function("shiftrightunsigned", part + lack, F.lit(lane - 1)).bitwiseAND(long(wide))
            out = out.bitwiseOR(F.call_function("shiftleft", more, F.lit(j + half)))
    return out


def marked_windows(texts: DataFrame, most: int, lane: int, percent: int) -> DataFrame:
    """(key_a, key_b, n, start, mark) for every window of the ``sizes``, at most ``most``, of
    each text (key_a, key_b, shingles, sizes).

    The votes of 1, 2, 4... shingles from each place on are added up by doubling, so those of
    a window are the sum of one number for each bit of its size.  Texts are cut into tiles of
    ``TILE`` starts, each with the shingles that its windows reach.
    """
    over = lambda n: F.floor(n * (100 - percent) / 100).cast("int")
    length = F.size("shingles")
    pad = most * (100 - percent) // 100
    tiles = F.sequence(F.lit(0), F.floor((length - 1 + pad) / TILE).cast("int"))
    tiled = texts.select("key_a", "key_b", "sizes", "shingles", length.alias("length"), F.explode(tiles).alias("tile")).withColumn("low", F.col("tile") * TILE - pad)
    ends = F.least(F.col("low") + (TILE + most - 2), F.col("length") - 1)
    # before a text there is nothing to count
    padded = F.concat(F.array_repeat(F.lit(None).cast("long"), F.greatest(-F.col("low"), F.lit(0))), F.slice("shingles", F.greatest("low", F.lit(0)) + 1, ends - F.greatest("low", F.lit(0)) + 1))
    fields = lambda values: F.struct(*[v.alias(f"c{j}") for j, v in enumerate(values)])
    tiled = tiled.withColumn("part", padded).drop("shingles")
    tiled = tiled.withColumn("votes0", F.transform("part", lambda h: fields([F.coalesce(v, F.lit(0).cast("long")) for v in votes(h, lane)]))).drop("part")
    levels = most.bit_length()
    for k in range(1, levels):
        below = F.col(f"votes{k - 1}")
        added = F.zip_with(below, F.slice(below, (1 << (k - 1)) + 1, F.size(below)), lambda a, b: F.when(b.isNull(), a).otherwise(fields([a[f"c{j}"] + b[f"c{j}"] for j in range(lane)])))
        tiled = tiled.withColumn(f"votes{k}", added)

    sized = tiled.withColumn("n", F.explode("sizes")).drop("sizes")
    first = F.greatest("low", -over(F.col("n")))
    last = F.least(F.col("low") + (TILE - 1), F.greatest(F.col("length") - F.col("n") + over(F.col("n")), -over(F.col("n"))))
    starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    at = sized.withColumn("start", F.explode(starts))
    summed = [F.when(F.col("n").bitwiseAND(F.lit(1 << k)) != 0, F.get(f"votes{k}", F.col("start") - F.col("low") + F.col("n").bitwiseAND(F.lit((1 << k) - 1)))).alias(f"sum{k}") for k in range(levels)]
    at = at.select("key_a", "key_b", "n", "start", "length", *summed)
    count = lambda j: reduce(operator.add, [F.coalesce(F.col(f"sum{k}")[f"c{j}"], F.lit(0).cast("long")) for k in range(levels)])
    counts = at.select("key_a", "key_b", "n", "start", "length", *[count(j).alias(f"c{j}") for j in range(lane)])
    held = F.greatest(F.least(F.col("start") + F.col("n"), F.col("length")) - F.greatest("start", F.lit(0)), F.lit(0))
    # never null, and said so: else the optimizer filters on it, far below, and makes each mark once more for that
    mark = F.coalesce(majority([F.col(f"c{j}") for j in range(lane)], held, lane), F.lit(0).cast("long"))
    return counts.select("key_a", "key_b", "n", "start", mark.alias("mark"))


def window_at(start: Column, n: Column, shingles: Column) -> Column:
    """The part of the window of ``n`` shingles from ``start`` that is in the text."""
    low = F.greatest(start, F.lit(0))
    return F.slice(shingles, low + 1, F.greatest(F.least(start + n, F.size(shingles)) - low, F.lit(0)))


def block(fingerprint: Column, number: int) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, F.lit(number * BITS)).bitwiseAND(F.lit((1 << BITS) - 1).cast("long"))


def place(n: Column, number: int, value: Column) -> Column:
    """Size, block and block value as one number."""
    return (n.cast("long") * BLOCKS + number) * (1 << BITS) + value


def near_values() -> list[int]:
    """All changes of at most ``FREE`` bits of a block."""
    return [sum(1 << i for i in bits) for k in range(FREE + 1) for bits in combinations(range(BITS), k)]


def counted(shingles: Column) -> Column:
    """A sorted array with its repeats told apart, so that sets of these are weighted sets."""
    return F.transform(shingles, lambda h, i: F.xxhash64(h, i - F.array_position(shingles, h)))


def index_of(items: DataFrame) -> DataFrame:
    """(place, item_key, item_mark): the items' fingerprints under all block values near theirs."""
    near = F.array(*[F.lit(x).cast("long") for x in near_values()])

    def places_of(number: int) -> Column:
        return F.transform(near, lambda x: place(F.col("n"), number, block(F.col("item_mark"), number).bitwiseXOR(x)))

    places = F.concat(*map(places_of, range(BLOCKS)))
    return items.select("item_key", "item_mark", F.explode(places).alias("place"))


def candidates(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(…, item_key, distance) for windows (…, n, mark) whose fingerprints are within the
    radius of an item (item_key, n, item_mark) of their size."""
    asked = windows.withColumn("place", F.explode(F.array(*[place(F.col("n"), k, block(F.col("mark"), k)) for k in range(BLOCKS)])))
    found = asked.join(small_if_checked(index_of(items), INDEX_ROWS), "place").drop("place")
    return found.withColumn("distance", F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark")))).filter(F.col("distance") <= RADIUS).drop("item_mark").distinct()


def holders(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(key_a, key_b, item_id, start, distance, shared, total): for each text of
    ``docs`` (column text) and each item (item_id, text) in it the best window, its
    first word counted from 0, and the weights shared and in total."""
    items = where_computed(with_shingles(items.select("item_id", "text"), size), "size(shingles) > 0")
    items = written(items.select("item_id", F.xxhash64("shingles").alias("item_key"), F.size("shingles").alias("n"), F.sort_array("shingles").alias("item")).dropDuplicates(["item_id", "item_key"]), "items")
    most = items.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    lane = lane_for(most)
    shared = items.select("item_key", "n", F.explode("item").alias("shingle")).distinct()

    keyed = docs.select(*text_keys(F.col("text")), "text")
    # explode_outer: for explode the optimizer filters on the array's size, and makes it once more for that
    found = with_shingles(keyed, size).select("key_a", "key_b", F.explode_outer("shingles").alias("shingle"))
    hits = found.join(small_if_checked(shared), "shingle").groupBy("key_a", "key_b", "item_key", "n").count().filter(100 * F.col("count") >= percent * F.col("n"))
    sizes = written(hits.groupBy("key_a", "key_b").agg(F.collect_set("n").alias("sizes")), "sizes")  # at most as many as items have sizes
    texts = keyed.join(small_if_checked(sizes), ["key_a", "key_b"]).dropDuplicates(["key_a", "key_b"])
    # what follows is much work for each text, so few of them make a task
    texts = written(with_shingles(texts, size).repartition(min(sizes.count() // TEXTS + 1, 100_000)), "texts")

    windows = marked_windows(texts, most, lane, percent)
    marked = items.select("item_key", "n", simhash(F.col("item"), lane).alias("item_mark")).distinct()
    near = written(candidates(windows, marked).drop("mark"), "candidates")

    exact = near.join(texts.select("key_a", "key_b", "shingles"), ["key_a", "key_b"]).join(items.drop("n"), "item_key")
    exact = exact.withColumn("window", F.sort_array(window_at(F.col("start"), F.col("n"), F.col("shingles"))))
    both = F.size(F.array_intersect(counted(F.col("window")), counted(F.col("item"))))
    exact = exact.select("key_a", "key_b", "item_id", "start", "distance", both.cast("long").alias("shared"), (F.size("window") + F.size("item")).cast("long").alias("sizes"))
    exact = exact.withColumn("total", F.col("sizes") - F.col("shared")).filter(100 * F.col("shared") >= percent * F.col("total"))
    best = Window.partitionBy("key_a", "key_b", "item_id").orderBy((F.col("shared") / F.col("total")).desc(), "start")
    return exact.withColumn("rank", F.row_number().over(best)).filter("rank = 1").select("key_a", "key_b", "item_id", F.greatest("start", F.lit(0)).cast("long").alias("start"), "distance", "shared", "total")


def contaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row for each document and each item it holds."""
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    found = written(holders(texts, items, **options), "holders")
    joined = texts.select("doc_id", *text_keys(F.col("text"))).join(small_if_checked(found), ["key_a", "key_b"])
    return joined.select(F.col("doc_id").alias(id_column), "item_id", "start", "shared", "total")


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    found = written(holders(docs.select(F.col(text).alias("text")), items, **options).select("key_a", "key_b").distinct(), "holders")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(whole, *text_keys(F.col(text))).join(small_if_checked(found), ["key_a", "key_b"], "left_anti").select("_row.*")
