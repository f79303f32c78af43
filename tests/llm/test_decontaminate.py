import random
from collections import Counter

from pyspark.sql import functions as F

from cardloom.llm import decontaminate as d


def words(seed, n):
    random.seed(seed)
    return [f"v{random.randrange(5000)}" for _ in range(n)]


def shingles(text):
    w = (text or "").lower().split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(texts, items):
    """{(text, item): (start, shared, total)} over every window of every text, with the
    share of the item's weight in the best window."""
    out = {}
    for i, t in enumerate(texts):
        for item, wanted in items:
            s, want = shingles(t), Counter(shingles(wanted))
            n, best = sum(want.values()), None
            for start in range(-n, len(s)) if n else ():
                window = Counter(s[max(start, 0) : max(start + n, 0)])
                shared = sum((window & want).values())
                total = sum(window.values()) + n - shared
                if 100 * shared >= 80 * total and (best is None or shared * best[2] > best[1] * total):
                    best = (max(start, 0), shared, total)
            if best and ((i, item) not in out or best[1] * out[i, item][2] > out[i, item][1] * best[2]):
                out[i, item] = best
    return out


def found(texts, bench):
    return {(r.doc_id, r.item_id): (r.start, r.shared, r.total) for r in d.contaminated(texts, bench).collect()}


def test_planted_items_are_found(spark, docs):
    items = [" ".join(words(s, n)) for s, n in ((1, 30), (2, 17), (3, 60))] + ["too short", None, "same same same same same same same"]
    listed = [*enumerate(items), (2, " ".join(words(11, 20))), (2, items[2])]
    bench = spark.createDataFrame(listed, "item_id long, text string")
    edited = items[2].split()
    edited[3] = "EDIT"
    inserted = items[0].split()
    inserted.insert(15, "more")
    texts = [
        " ".join([*words(9, 50), items[0].upper(), *words(8, 50)]),
        " ".join([*words(7, 500), *edited]),
        " ".join(words(6, 400)),
        None,
        "",
        items[1],
        " ".join([*words(5, 20), *items[0].split()[:12], *words(4, 20)]),
        " ".join([*words(5, 20), *inserted]),
        "same " * 300,
        items[1],
        " ".join(items[0].split()[3:] + words(12, 9)),
        "a b",
        listed[6][1],
    ]
    got = found(docs(texts), bench)
    assert got == brute(texts, listed) and {(0, 0), (1, 2), (5, 1), (9, 1), (8, 5), (10, 0), (12, 2)} == set(got)
    assert sorted(r.doc_id for r in d.without_items(docs(texts), bench).collect()) == sorted(set(range(len(texts))) - {i for i, _ in got})
    assert d.contaminated(docs(texts).limit(0), bench).count() == 0
    assert d.contaminated(docs(texts), bench.limit(0)).count() == 0
    clash = docs(texts).withColumnRenamed("source", "key_a").withColumnRenamed("n_chars", "shingles")
    assert d.without_items(clash, bench).columns == clash.columns
    twice = docs(texts).unionAll(docs(texts))
    assert d.contaminated(twice, bench).count() == 2 * len(got)


def test_long_texts_are_searched_to_the_end(spark, docs):
    item = " ".join(words(1, 40))
    bench = spark.createDataFrame([(1, item), (2, " ".join(["la"] * 140)), (3, " ".join(words(2, 300)))], "item_id long, text string")
    texts = [" ".join([*words(3, 30_000), item]), "la " * 3000 + "end", " ".join([*words(4, 700), *words(2, 300)])]
    assert found(docs(texts), bench) == {(0, 1): (30_000, 36, 36), (1, 2): (0, 136, 136), (2, 3): (700, 296, 296)}


def test_recall_near_the_threshold(spark, docs):
    """Windows that hardly pass: a few words changed, cut or swapped at random."""
    random.seed(5)
    items = [(i, " ".join(words(100 + i, random.randint(16, 60)))) for i in range(40)]
    texts = []
    for i in range(400):
        w = items[i % 40][1].split()
        if i % 3 == 0:
            w = w[random.randint(0, len(w) // 6) :]
        elif i % 3 == 1:
            w[random.randrange(3)] = "x"
        else:
            w[-random.randint(1, 3)] = "y"
        texts.append(" ".join([*words(1000 + i, random.randint(0, 30)), *w, *words(2000 + i, random.randint(0, 30))]))
    want = brute(texts, items)
    got = found(docs(texts), spark.createDataFrame(items, "item_id long, text string"))
    assert len(want) > 200 and set(got) <= set(want)
    assert sum(got.get(k) == v for k, v in want.items()) >= 0.97 * len(want)


def test_index_finds_every_fingerprint_within_the_radius():
    random.seed(1)
    for _ in range(2000):
        bits = random.sample(range(64), d.RADIUS)
        per_block = [sum(b // d.BITS == k for b in bits) for k in range(d.BLOCKS)]
        assert min(per_block) <= d.FREE
    near = d.near_values()
    assert len(set(near)) == len(near) == 697 and all(x.bit_count() <= d.FREE for x in near)


def test_index_selects(spark):
    """Of windows that have nothing to do with the items none is a candidate."""
    random.seed(7)
    mark = lambda: random.randrange(-(2**63), 2**63)
    items = [(i, 20, mark()) for i in range(50)]
    close = [(items[i][2] ^ sum(1 << b for b in random.sample(range(63), d.RADIUS)), i) for i in range(50)]
    windows = spark.createDataFrame([(20, mark(), -1) for _ in range(3000)] + [(20, m, i) for m, i in close] + [(21, m, -1) for m, _ in close], "n int, mark long, want long")
    got = d.candidates(windows, spark.createDataFrame(items, "item_key long, n int, item_mark long")).collect()
    assert sorted(r.want for r in got if r.want == r.item_key) == list(range(50)) and len(got) < 55


def test_simhash_is_the_majority_of_bits(spark):
    random.seed(2)
    for n, lane in ((1, 8), (9, 8), (126, 8), (300, 16), (30, 32), (0, 8)):
        hashes = [random.randrange(-(2**63), 2**63) for _ in range(n)] + [-1] * (n // 3)
        want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
        got = spark.createDataFrame([(hashes,)], "h array<long>").select(d.simhash(F.col("h"), lane)).first()[0]
        assert got % 2**64 == want, (n, lane)
    assert [d.lane_for(x) for x in (1, 127, 128, 32_767, 32_768)] == [8, 8, 16, 16, 32]


def test_window_marks_are_those_of_each_window_alone(spark, monkeypatch):
    """Marks from sums by doubling, over the borders of tiles and of texts."""
    monkeypatch.setattr(d, "TILE", 7)
    random.seed(3)
    rows = [(i, i, [random.randrange(-(2**63), 2**63) for _ in range(n)], [1, 5, 12, 20]) for i, n in enumerate((1, 3, 11, 20, 45))]
    got = d.marked_windows(spark.createDataFrame(rows, "key_a long, key_b long, shingles array<long>, sizes array<int>"), 20, 8, 80).collect()
    want = {}
    for i, _, hashes, sizes in rows:
        for n in sizes:
            for start in range(-(n // 5), max(len(hashes) - n + n // 5, -(n // 5)) + 1):
                window = hashes[max(start, 0) : max(start + n, 0)]
                want[i, n, start] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in window) * 2 > len(window))
    assert len(got) == len(want) and {(r.key_a, r.n, r.start): r.mark % 2**64 for r in got} == want


def test_marks_are_made_once(spark):
    """No filter below the look-up makes the marks of windows once more."""
    texts = spark.createDataFrame([(1, 1, [1, 2, 3], [2])], "key_a long, key_b long, shingles array<long>, sizes array<int>")
    items = spark.createDataFrame([(1, 2, 3)], "item_key long, n int, item_mark long")
    plan = d.candidates(d.marked_windows(texts, 2, 8, 80), items)._jdf.queryExecution().optimizedPlan().toString()
    assert "votes1" in plan and not [line for line in plan.splitlines() if "Filter" in line and "votes1" in line]
