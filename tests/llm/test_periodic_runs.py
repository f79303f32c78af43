import hashlib
import random
import zlib

import numpy as np

from cardloom.llm import periodic_runs


def plain_runs(words):
    """Every period on its own, word by word."""
    out, n = [], len(words)
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(6, 4 * p):
                block = words[i : i + p]
                if not any(p % q == 0 and block == block[:q] * (p // q) for q in range(1, p)):
                    out.append((i, length, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_report(words):
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest(listed), digest(left), len(words))


def odd_texts():
    rng = random.Random(5)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 1000, ["a", "b"] * 3, ["a", "b"] * 4, [*"ab" * 4, "a"], [*"aab" * 40, *"ab" * 40]]
    for _ in range(150):
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        words = []
        for _ in range(rng.randint(1, 6)):
            block = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 16, 31, 33, 64]))]
            words += (block * rng.randint(1, 7))[: rng.randint(1, 400)]
        out.append(words)
    out.append([*map(str, range(3000)), *[str(i) for i in range(611)] * 4, *map(str, range(9, 20))])
    nested = [*["x"] * 9, "y"]
    out.append([w for _ in range(5) for w in [*nested * 5, "z"]])
    return out


def test_fragments_of_documents_side_by_side_give_all_runs():
    texts = [t for t in odd_texts() if t]
    codes, starts, base = [], [], 0
    for words in texts:
        starts.append(len(codes))
        numbers = {}
        codes += [numbers.setdefault(w, len(numbers)) + base for w in words]
        base += len(numbers)
    matches = {}
    for document, p, first, end in periodic_runs.fragments(np.array(codes, np.int64), np.array(starts, np.int64)):
        matches.setdefault((document, p), set()).update(range(first, end))
    got = {d: [] for d in range(len(texts))}
    for (d, p), places in matches.items():
        for start in places:
            if start - 1 not in places:
                end = start
                while end in places:
                    end += 1
                if end - start + p >= max(6, 4 * p):
                    got[d].append((start, end - start + p, p))
    for d, words in enumerate(texts):
        assert sorted(got[d], key=lambda r: (r[0], r[2])) == plain_runs(words), words[:50]
    assert list(periodic_runs.fragments(np.zeros(0, np.int64), np.zeros(0, np.int64))) == []


def test_work_on_one_word_repeated_is_linear():
    calls = {}
    for n in (4096, 32768):
        seen = [0]
        original = periodic_runs.z_function
        periodic_runs.z_function = lambda s, seen=seen: (seen.__setitem__(0, seen[0] + len(s)), original(s))[1]
        try:
            assert len(list(periodic_runs.fragments(np.zeros(n, np.int64), np.zeros(1, np.int64)))) <= n // 8
        finally:
            periodic_runs.z_function = original
        calls[n] = seen[0]
    assert calls[32768] < 9 * calls[4096]


def test_report(spark, docs):
    texts = [" ".join(t) for t in odd_texts()]
    texts = [None, "", " \n\t", *texts, texts[7].replace(" ", "\t\n"), "é\x1cé " * 9, "x\x85 " * 20_000]
    df = docs(texts, ids=[None, *range(1, len(texts))]).withColumnRenamed("source", "row").withColumnRenamed("lang", "fragments").withColumnRenamed("n_chars", "period")
    got = periodic_runs.report(df).collect()
    assert len(got) == len(texts)
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(texts):
        words = [w.decode() for w in (t or "").encode().split()]
        r = by_id[i or None]
        if len(words) < 10_000:
            assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256, r.n_words) == plain_report(words)
    assert (by_id[len(texts) - 1].n_runs, by_id[len(texts) - 1].length) == (1, 20_000)
    assert periodic_runs.report(df.limit(0)).count() == 0
    twice = periodic_runs.report(docs(["a " * 9, "a " * 9, "b"], ids=[3, 3, None])).collect()
    assert sorted((r.doc_id or 0, r.n_runs) for r in twice) == [(0, 0), (3, 1), (3, 1)]


def test_query_on_whole_table(spark, small):
    from cardloom.llm.queries import op13_periodic_runs

    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op13_periodic_runs(spark, small).collect()}
    assert len(got) == len(rows)
    changed = 0
    for r in rows:
        words = [w.decode() for w in (r.text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        if n < 3000:
            x = got[r.doc_id]
            assert (x.n_runs, x.start, x.length, x.period, x.exponent_milli, x.runs_sha256, x.collapsed_sha256, x.n_words) == plain_report(words)
    assert changed
