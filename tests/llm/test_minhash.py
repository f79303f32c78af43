import random

import numpy as np
import pytest

from cardloom.llm import minhash
from cardloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, size, percent):
    sets = []
    for t in texts:
        w = (t or "").translate(LOW).encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def cloud(seed, n, words=60, edits=4):
    """Near copies of one text, many of them not similar to each other."""
    random.seed(seed)
    base = [f"w{random.randrange(999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(random.randrange(edits)):
            w[random.randrange(words)] = f"x{random.randrange(9999)}"
        out.append(" ".join(w))
    return out


def check(docs, texts, size, percent):
    got = {r.doc_id: r for r in minhash.near_duplicates(docs(texts), size, percent).collect()}
    for i, (n, component) in enumerate(brute(texts, size, percent)):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, component, component == i), i


def test_against_brute_force(docs, monkeypatch):
    texts = [None, "", "  ", "A", "a", "a b", "A B", "Ä b", "ä b", "long " * 5000, *cloud(1, 60), *cloud(2, 60, edits=7), *cloud(1, 5)]
    check(docs, texts, 3, 85)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    check(docs, texts, 5, 80)


def test_blocks_bounded_by_shingles(docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(minhash, "ROUNDS", 2)
    check(docs, [*cloud(3, 40, edits=8), *cloud(4, 40, edits=8)], 5, 80)


def test_crowded_buckets_cost_a_comparison_a_node_and_round(spark, monkeypatch):
    """The sets that are sent for comparison, of clouds of near copies, grow with the
    rows and not with their square."""
    sent = {}
    for n in (500, 2000):
        held = []
        real = minhash.star_links
        monkeypatch.setattr(minhash, "star_links", lambda pairs, sets, percent: held.append(pairs.count()) or real(pairs, sets, percent))
        blocks = minhash.prefix_links
        monkeypatch.setattr(minhash, "prefix_links", lambda members, sets, percent: held.append(members.filter("label is not null").count()) or blocks(members, sets, percent))
        rows = list(enumerate(cloud(6, n, words=200, edits=20)))
        out = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert out.count() == n
        sent[n] = sum(held)
        monkeypatch.undo()
    assert sent[2000] < 8 * sent[500]


def template(seed, n, words=300, own=55):
    """Pages of one template with a part of their own: buckets are shared, nothing is similar."""
    random.seed(seed)
    base = [f"w{i}" for i in range(words)]
    return [" ".join([*base, *[f"p{i}x{k}" for k in range(own + i % 5)]]) for i in range(n)]


def test_pages_of_a_template_are_not_compared_with_each_other(spark, monkeypatch):
    """The comparisons left after the rounds grow with the pages and not with their square;
    nothing is linked."""
    compared = {}
    for n in (300, 1200):
        pairs = []
        real, kernel = minhash.star_links, minhash.prefix_links
        monkeypatch.setattr(minhash, "star_links", lambda p, sets, percent: pairs.append(p.count()) or real(p, sets, percent))
        monkeypatch.setattr(minhash, "prefix_links", lambda held, sets, percent: (lambda out: pairs.append(out.count()) or out)(kernel(held, sets, percent)))
        out = minhash.near_duplicates(spark.createDataFrame(list(enumerate(template(1, n))), "doc_id long, text string"))
        assert out.filter("kept").count() == n
        compared[n] = sum(pairs)
        monkeypatch.undo()
    assert compared[1200] <= 5 * compared[300]


def test_prefixes_hold_the_first_shared_shingle():
    random.seed(8)
    for _ in range(3000):
        percent = random.choice([50, 80, 85, 100])
        shared, more_a, more_b = random.randrange(1, 40), random.randrange(12), random.randrange(12)
        universe = random.sample(range(1000), shared + more_a + more_b)
        common = universe[:shared]
        a, b = sorted(common + universe[shared : shared + more_a]), sorted(common + universe[shared + more_a :])
        if 100 * shared >= percent * len({*a, *b}):
            x, y = sorted((a, b), key=len)
            assert set(x[: minhash.prefix_lengths(len(x), percent)[0]]) & set(y[: minhash.prefix_lengths(len(y), percent)[1]])


@pytest.mark.parametrize("pairs", [0, 64, 10**9])
def test_prefix_links_alone_against_brute_force(docs, monkeypatch, pairs):
    monkeypatch.setattr(minhash, "PAIRS", pairs)
    monkeypatch.setattr(minhash, "ROUNDS", 1)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    check(docs, [*cloud(1, 50, edits=7), *cloud(2, 30, words=20, edits=3), *template(3, 20, words=40, own=6), *template(4, 20, words=40, own=9)], 5, 80)


def test_edges(spark, docs):
    df = docs(["a b c d", "a b c d", "a b c d", "q"], ids=[5, None, 5, 7])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 5, True), (None, None, True), (7, 7, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    once = minhash.without_near_duplicates(df.withColumnRenamed("source", "node"))
    assert sorted(str(r.doc_id) for r in once.collect()) == ["5", "7", "None"] and "node" in once.columns


def test_chains_are_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in components(chain).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[90] == 90
    assert components(chain.limit(0)).count() == 0


def test_kernel_compares_across_blocks_only():
    sets = [np.array([1, 2, 3]), np.array([1, 2, 3]), np.array([1, 2, 3, 4])]
    labels = np.array([10, 11, 12])
    assert minhash.joined_components(labels, sets, np.array([0, 0, 0]), 100) == [(10, 11)]
    assert minhash.joined_components(labels, sets, np.array([0, 0, 1]), 75) == [(10, 12), (10, 11)]
    assert minhash.joined_components(np.array([1, 1, 1]), sets, np.array([0, 0, 0]), 10) == []


def test_the_kept_row_of_a_repeated_id_is_the_first_as_text(spark):
    rows = [(1, t, t) for t in ("delta x y z q", "alpha b c d e", "gamma u v w x")]
    for n in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string, component_id string").repartition(n)
        kept = minhash.without_near_duplicates(df).collect()
        assert [r.text for r in kept] == ["alpha b c d e"] and kept[0].component_id == "alpha b c d e"
