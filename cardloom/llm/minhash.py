"""Near-duplicate groups by min-max hashing.

Each permutation of a document's shingle hashes gives two signature values, its
minimum and its maximum, so that a band of four values costs two permutations.
The number of bands follows from the similarity: a pair at the threshold shares
no band with a probability of under one in a million.

1. Documents with the same set of shingles are one node, the smallest id.
2. In every band bucket each node is compared on the full sets with the bucket's head,
   the smallest node; the links found are joined into components.  Buckets whose nodes
   still lie in several components get a new head, by hash, and what isn't of its
   component is compared with it, ``ROUNDS`` times in all.  Each round costs one
   comparison a node, and near copies of one text are joined within few.
3. Nodes of buckets that still have several components are joined by prefixes: each set's
   shingles are put in order, rarest first, and two sets are compared on the whole only
   where the smaller one's first ninth or so (at 80 %) and the larger one's first fifth have
   a shingle in common, which similar sets always have.  Pages that share a template
   but aren't similar have none in common.  Where a shingle has many nodes they are
   compared in blocks bounded by nodes and by shingles, and a block pair gives at most one
   link for each two components it joins.

So every similar pair of a bucket that lies in different components is found, whatever
the rounds have found.  No set is cut short, no bucket is capped and nothing but counts
reaches the driver.

Defined results: a null text or one without a word has an empty set and is
linked with nothing; rows that repeat an id are one node, with the sets of all of them,
and of them ``without_near_duplicates`` keeps the first one as text; very long texts
have all their shingles; of equal sets the smallest id is the group's; a row without id
is returned unlinked and kept; an empty table gives an empty result; only the two named
columns are read, and others may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import ascii_lower, shingles_of, ship, small_if_checked, words_of, written
from cardloom.llm.components import components

#: Nodes and shingles of a bucket in one block.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
#: How often the buckets get a new head.
ROUNDS = 5
ROWS = 4
#: Cells of the sketch of how frequent shingles are; comparisons under a shingle that are made as pairs.
CELLS, PAIRS = 1 << 20, 64
#: Parts into which the copies of one set are dealt when they look up their node.
SALTS = 32


def bands_for(percent: int, miss: float = 1e-6) -> int:
    """Bands of four values so that a pair at the threshold is missed that rarely."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** ROWS))


def with_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text) as (doc_id, set, n_shingles, key_a, key_b); the set is sorted."""
    worded = docs.select("doc_id", words_of(ascii_lower(F.col("text"))).alias("words"))
    sets = worded.select("doc_id", F.sort_array(F.array_distinct(shingles_of(F.col("words"), size))).alias("set"))
    return sets.select("doc_id", "set", F.size("set").cast("long").alias("n_shingles"), F.xxhash64("set").alias("key_a"), F.xxhash64(F.lit(1), "set").alias("key_b"))


def band_keys(hashes: np.ndarray, factors: np.ndarray, shifts: np.ndarray, mixers: np.ndarray) -> np.ndarray:
    """The bucket of a set in each band: both ends of two permutations, mixed."""
    least, most = np.full(len(factors), 2**64 - 1, np.uint64), np.zeros(len(factors), np.uint64)
    for start in range(0, len(hashes), 4096):
        permuted = hashes[start : start + 4096, None] * factors + shifts
        least, most = np.minimum(least, permuted.min(axis=0)), np.maximum(most, permuted.max(axis=0))
    ends = np.stack([least, most], axis=1).reshape(-1, ROWS)
    mixed = (ends ^ (ends >> np.uint64(31))) * mixers[:, None]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.array([3, 5, 7, 11], np.uint64)
    return (mixed.sum(axis=1, dtype=np.uint64) ^ mixers).view(np.int64)


def signatures(sets: DataFrame, bands: int, seed: int = 7) -> DataFrame:
    """Adds the band buckets to ``with_sets`` and drops the sets."""
    random = np.random.default_rng(seed)
    draw = lambda n: random.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    factors, shifts, mixers = draw(2 * bands), draw(2 * bands), draw(bands)
    kept = ["doc_id", "n_shingles", "key_a", "key_b"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("set")
            values, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            keys = [band_keys(values[a:b], factors, shifts, mixers) for a, b in zip(offsets[:-1], offsets[1:], strict=True) if b > a]
            ends = np.concatenate([[0], np.cumsum((offsets[1:] > offsets[:-1]) * bands)]).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.ListArray.from_arrays(pa.array(ends), flat)], names=[*kept, "buckets"])

    return sets.mapInArrow(sign, "doc_id long, n_shingles long, key_a long, key_b long, buckets array<long>")


def similar(n_a: Column, n_b: Column, shared: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n_a + n_b - shared)


def star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar."""
    side = lambda x: sets.select(F.col("node").alias(x), F.col("set").alias(f"set_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    n_a, n_b = F.size("set_a"), F.size("set_b")
    close = joined.filter((n_a > 0) & (n_b > 0)).filter(100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))
    return close.filter(similar(n_a, n_b, F.size(F.array_intersect("set_a", "set_b")), percent)).select("a", "b")


def joined_components(labels: np.ndarray, sets: list[np.ndarray], blocks: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of components that a similar pair of sets joins, without circles.

    Where two blocks meet, only pairs across them are compared.
    """
    n = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    _, which, times = np.unique(flat, return_inverse=True, return_counts=True)
    common = times > 1  # a hash of one set alone is in no intersection
    column = np.cumsum(common) - 1
    owner, which = owner[common[which]], column[which[common[which]]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(common.sum()), 4096):
        a, b = np.searchsorted(which, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[owner[a:b], which[a:b] - start] = 1
        shared += part @ part.T
    links = (100 * shared >= percent * (n[:, None] + n[None, :] - shared)) & (labels[:, None] != labels[None, :])
    if len(np.unique(blocks)) > 1:
        links &= blocks[:, None] != blocks[None, :]
    parent = {x: x for x in labels.tolist()}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(links)), strict=True):
        a, b = root(int(labels[i])), root(int(labels[j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((min(a, b), max(a, b)))
    return out


def relabelled(labelled: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(bucket, node, n_shingles, label) after links between labels; buckets that have
    one label left are done and go."""
    found = components(links, name).select(F.col("node").alias("label"), F.col("label").alias("next"))
    labelled = labelled.join(found, "label", "left").select("bucket", "node", "n_shingles", F.coalesce("next", "label").alias("label"))
    return written(labelled, f"{name}-labelled")


def several(labelled: DataFrame, name: str) -> DataFrame:
    """The rows of buckets with several labels."""
    open_ = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("bucket")
    return written(labelled.join(written(open_, f"{name}-open"), "bucket", "left_semi"), f"{name}-several")


def new_heads(labelled: DataFrame, sets: DataFrame, percent: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between labels: each bucket's head of this turn, by hash, with the
    nodes that aren't of its label; and the rows without the heads, of which all is known."""
    heads = labelled.groupBy("bucket").agg(F.min_by(F.struct("node", "label"), F.xxhash64(F.lit(turn), "node")).alias("h")).select("bucket", F.col("h.node").alias("head"), F.col("h.label").alias("head_label"))
    headed = labelled.join(written(heads, f"heads-{turn}"), "bucket")
    met = headed.filter("label <> head_label")
    met = written(met.groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(F.min("head_label").alias("label_a"), F.min("label").alias("label_b")), f"met-{turn}")
    links = star_links(met.select("a", "b"), sets, percent).join(met, ["a", "b"]).select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()
    return links, headed.filter("node <> head").select(*labelled.columns)


def prefix_lengths(n: int, percent: int) -> tuple[int, int]:
    """How many of a set's shingles, rarest first, hold the first one that it shares with a
    similar set: if it is the smaller one of the two (or equal), and if it is the larger."""
    return n + 1 - -(-2 * percent * n // (100 + percent)), n + 1 - -(-percent * n // 100)


def prefixes(nodes: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, n_shingles, label, index) of nodes (node, n_shingles, label, set): the
    shingles of each node's prefix as buckets, and whether they are in the shorter prefix.

    The order by rarity is one of counts in a sketch of fixed size, then of hashes; any order
    that is the same for all sets is right.
    """
    cell = F.pmod("shingle", F.lit(CELLS)).alias("cell")
    counted = nodes.select(F.explode("set").alias("shingle")).groupBy(cell).agg(F.count("*").alias("n")).toArrow()  # at most CELLS rows
    sketch = np.zeros(CELLS, np.int64)
    sketch[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    sent = nodes.sparkSession.sparkContext.broadcast(sketch)
    kept = ["node", "n_shingles", "label"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("set")
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            keys, rows, index = [], [], []
            for row, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                own = values[a:b]
                short, long = prefix_lengths(len(own), percent)
                keys.append(own[np.lexsort((own, sent.value[own % CELLS]))[:long]])
                rows.append(np.full(len(keys[-1]), row))
                index.append(np.arange(len(keys[-1])) < short)
            at = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            flat = lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
            yield pa.RecordBatch.from_arrays([flat(keys, pa.int64()), *[batch.column(c).take(at) for c in kept], flat(index, pa.bool_())], names=["bucket", *kept, "index"])

    return nodes.select(*kept, "set").mapInArrow(cut, "bucket long, node long, n_shingles long, label long, index boolean")


def prefix_links(held: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the labels of nodes of ``held`` (bucket, node, n_shingles, label)
    that are similar: the first shingle that two similar sets share, rarest first, stands in
    the shorter prefix of the smaller set and in the longer prefix of the other.

    Under each shingle the nodes with it in their shorter prefix are compared with the others,
    but not within the most frequent label: as pairs where they are few, else in blocks.
    """
    nodes = held.select("node", "n_shingles", "label").distinct()
    nodes = written(nodes.join(sets.select("node", "set"), "node"), "open-nodes")
    rows = written(prefixes(nodes, percent), "prefixes")
    small = F.when(F.col("index"), 1).otherwise(0)
    by_label = rows.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum(small).alias("own"), F.sum("n_shingles").alias("shingles"))
    most = F.max_by(F.struct("label", "n", "own"), F.struct("n", "label"))
    sizes = by_label.groupBy("bucket").agg(most.alias("m"), F.sum("n").alias("n"), F.sum("own").alias("own"), F.sum("shingles").alias("shingles"), F.count("*").alias("labels")).filter("labels > 1 and own > 0")
    asked = [F.col("own") - F.col("m.own"), F.col("n") - F.col("m.n")]
    told = [F.col("n"), F.col("m.own")]
    each = F.col("shingles") / F.col("n")
    parts = lambda n: F.greatest(F.ceil(F.greatest(n / BLOCK, n * each / BLOCK_SHINGLES)).cast("int"), F.lit(1))
    sizes = sizes.select("bucket", F.col("m.label").alias("main"), (asked[0] * told[0] + asked[1] * told[1]).alias("cost"), *[parts(x).alias(f"{name}_{k}") for name, of in (("asks", asked), ("tells", told)) for k, x in enumerate(of)])
    sizes = written(sizes.filter("cost > 0"), "sizes")
    dealt = written(rows.join(sizes, "bucket"), "dealt")
    # 0: smaller sets outside of the main label against all; 1: all outside of it against its smaller sets
    sides = {0: ("index and label <> main", "true"), 1: ("label <> main", "index and label = main")}
    side = lambda k, which, few: dealt.filter(f"{sides[k][which]} and cost {'<=' if few else '>'} {PAIRS}")

    pairs = None
    for k in sides:
        own = side(k, 0, True).select("bucket", F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("label").alias("label_a"))
        met = own.join(side(k, 1, True).select("bucket", F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("label").alias("label_b")), "bucket")
        met = met.filter((F.col("label_a") != F.col("label_b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))).select("a", "b", "label_a", "label_b")
        pairs = met if pairs is None else pairs.unionByName(met)
    swapped = F.col("a") > F.col("b")
    ends = [F.when(swapped, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("label_a", "label_b"), ("label_b", "label_a"))]
    pairs = written(pairs.select(*ends).groupBy("a", "b").agg(F.min("label_a").alias("label_a"), F.min("label_b").alias("label_b")), "prefix-pairs")
    links = star_links(pairs.select("a", "b"), sets, percent).join(pairs, ["a", "b"]).select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct()

    grouped = None
    for k in sides:
        i, j = F.pmod(F.xxhash64("node"), F.col(f"asks_{k}")).cast("int"), F.pmod(F.xxhash64(F.lit(1), "node"), F.col(f"tells_{k}")).cast("int")
        to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asks = side(k, 0, False).withColumn("j", to(f"tells_{k}")).select("bucket", F.lit(k).alias("kind"), i.alias("i"), "j", "node", "label", F.lit(0).alias("side"))
        tells = side(k, 1, False).withColumn("i", to(f"asks_{k}")).select("bucket", F.lit(k).alias("kind"), "i", j.alias("j"), "node", "label", F.lit(1).alias("side"))
        both = asks.unionByName(tells)
        grouped = both if grouped is None else grouped.unionByName(both)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = joined_components(rows["label"].to_numpy(), list(rows["set"]), rows["side"].to_numpy(), percent) if rows["side"].nunique() > 1 else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    blocks = grouped.join(sets.select("node", "set"), "node").groupBy("bucket", "kind", "i", "j").applyInPandas(compare, "a long, b long")
    return links.unionByName(blocks)


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: id, n_shingles, component_id (the smallest id
    reachable over links) and kept (whether it is that id)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = written(signatures(with_sets(docs, size), bands_for(percent)), "signatures")
    same = signed.filter("n_shingles > 0").groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")).filter("n > 1").drop("n")
    salted = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    salts = same.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    noded = salted.join(salts, ["key_a", "key_b", "salt"], "left").withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")))
    noded = written(noded.select("doc_id", "n_shingles", "node", F.when(F.col("doc_id") == F.col("node"), F.col("buckets")).alias("buckets")), "nodes")
    members = noded.select("doc_id", "n_shingles", "node")

    buckets = noded.filter("doc_id = node").select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    heads = buckets.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last").drop("last")
    # written, as a join is split where a key is hot only if both sides come straight from a shuffle or a table
    crowded = written(buckets.join(written(heads, "heads"), "bucket"), "crowded")
    wanted = crowded.select(F.col("node").alias("doc_id")).distinct()
    sets = with_sets(docs.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi"), size).dropDuplicates(["doc_id", "key_a", "key_b"])
    sets = written(sets.select(F.col("doc_id").alias("node"), "set"), "sets")

    first = star_links(crowded.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), sets, percent)
    # links between labels are drawn between nodes that bear these labels, so all of them together give the groups
    links = [written(first, "star")]
    rest = crowded.filter("node <> head").select("bucket", "node", "n_shingles", F.col("node").alias("label"))
    held = relabelled(rest, links[0], "star")
    for turn in range(1, ROUNDS):
        held = several(held, f"turn-{turn}")
        if held.isEmpty():
            break
        found, rest = new_heads(held, sets, percent, turn)
        links.append(written(found, f"links-{turn}"))
        held = relabelled(rest, links[-1], f"turn-{turn}")
    held = several(held, "last")
    if not held.isEmpty():
        links.append(written(prefix_links(held, sets, percent), "prefix-links"))
    found = components(reduce(DataFrame.unionByName, links), "all").select("node", F.col("label").alias("component"))

    joined = members.join(found, "node", "left")
    component = F.coalesce("component", "node")
    return joined.select(F.col("doc_id").alias(id_column), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group, the smallest id; of rows
    that repeat an id one stays.  Rows without id all stay."""
    found = written(near_duplicates(docs, size, percent, id_column, text).select(F.col(id_column).alias("_id"), "kept"), "kept")
    dropped = found.filter("not kept").select("_id").distinct()
    repeated = found.filter("_id is not null").groupBy("_id").count().filter("count > 1").select("_id")
    own = F.col(f"`{id_column}`").cast("long")
    left = docs.withColumn("_id", own).join(small_if_checked(dropped), "_id", "left_anti")
    repeated = small_if_checked(written(repeated, "repeated"))
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    first = left.join(repeated, "_id", "left_semi").groupBy("_id").agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    once = left.join(repeated, "_id", "left_anti").unionByName(first)
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
