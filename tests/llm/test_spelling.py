import random
import re
import zlib
from collections import Counter

from cardloom.llm import spelling


def plain_words(rows, least_length=6, least_n=5, typo_every=199):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if doc_id is not None and typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= least_length:
                n[word] += 1
    return {w: k for w, k in n.items() if k >= least_n}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_rows(n, times=5):
    of = {w: [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    form = {}
    for w, others in of.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            if n[best] >= times * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(of[w]), n[form[w]] if w in form else None))
    return out


def rows_of(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def texts():
    rng = random.Random(3)
    words = ["".join(rng.choice("abéÿ") for _ in range(rng.choice([6, 6, 7, 8]))) for _ in range(300)]
    chain = [("chainsaw", 4000), ("chainsaws", 700), ("chainsawss", 120), ("chainsawsss", 20), ("chainsawssss", 5)]
    ties = [("tietie", 50), ("tietif", 50), ("tietiz", 6), ("zoozoo", 30), ("zoozoox", 5)]
    out = [None, "", "short one 1234567", "x" * 5000 + " " + "x" * 4999, "Ünder ÜNDER÷×ab", *(["y" * 3000, "y" * 1500 + "z" + "y" * 1499] * 6)]
    for w, n in [*chain, *ties]:
        out += [" ".join([w.upper() if k % 3 else w] * (n // 5)) for k in range(5)]
    out += [" ".join(rng.choice(words) + rng.choice([" ", "-", "9", "Ā"]) for _ in range(200)) for _ in range(60)]
    return out


def test_words_and_groups(docs):
    t = texts()
    df = docs(t, ids=[None, *range(1, len(t))]).withColumnRenamed("lang", "word").withColumnRenamed("source", "n")
    for typo_every in (None, 7):
        n = plain_words([(r.doc_id, r.text) for r in df.collect()], typo_every=typo_every)
        wanted = plain_rows(n)
        assert sum(r[1] is not None for r in wanted) >= 5
        assert typo_every or any(r[1] != r[2] for r in wanted if r[1])
        assert rows_of(spelling.variants(df, typo_every=typo_every)) == wanted
    assert spelling.variants(df.limit(0)).count() == 0


def test_small_filters_take_several_passes_and_give_the_same(spark, docs):
    t = texts()
    df = docs(t)
    n = plain_words(enumerate(t), typo_every=None)
    assert len(spelling.shards(dict(Counter(map(len, n))), 16)) > 3 and any(s.parts > 1 for p in spelling.shards(dict(Counter(map(len, n))), 16) for s in p)
    assert rows_of(spelling.variants(df, most_blocks=16)) == plain_rows(n)


def test_few_edits_pass_the_filters():
    import numpy as np

    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(5000)})
    (shards_,) = spelling.shards({9: len(words)}, 1 << 21)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(len(words), 9)
    filters = np.zeros(shards_[0].blocks, np.uint64)
    _, first, first_bits, second, second_bits = shards_[0].places((letters * spelling._powers(9)).sum(axis=1, dtype=np.uint64))
    np.bitwise_or.at(filters, first, first_bits)
    np.bitwise_or.at(filters, second, second_bits)
    passed = list(spelling.edits(words, letters, filters, {9: shards_}))
    wrong = sum(edit not in set(words) for _, edit in passed[:2000])
    assert wrong < 0.002 * 9 * 45 * len(words)


def test_query_on_whole_table(spark, small):
    from cardloom.llm.queries import op12_spelling_variants

    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(op12_spelling_variants(spark, small)) == plain_rows(plain_words([(r.doc_id, r.text) for r in rows]))
