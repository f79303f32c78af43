import functools
import math
import random
from collections import Counter

import numpy as np
import pytest

from cardloom.llm import language_id, masked_lm, ngram_quality
from cardloom.llm.queries import op5_quality_classifier, op7_language_id
from cardloom.sources.storage import table

MIX = ["the cat and the dog were in the house of the king " * 3, "le chat et le chien sont dans la maison du roi avec une " * 3, "der hund und die katze sind in dem haus von dem könig " * 3]


@pytest.fixture(scope="module")
def three(spark):
    rows = [(i, MIX[i % 3] + f" w{i}", ("en", "fr", "de")[i % 3]) for i in range(60)]
    rows += [(100, None, "en"), (101, "12 !?", "fr"), (102, MIX[1], None), (103, "", "de")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(three):
    got = {r.doc_id: r for r in language_id.identify(three).collect()}
    assert all(got[i].lang_pred == ("en", "fr", "de")[i % 3] and 0 < got[i].score <= 1 for i in range(60))
    assert [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "fr", "und"] and got[100].score == 0
    assert all(got[i].held_out == language_id.crc_is_two(i) for i in got)
    assert {r.lang_pred for r in language_id.identify(three.filter("lang is null")).collect()} == {"und"}
    assert language_id.identify(three.limit(0)).count() == 0


def test_a_mixed_text_has_both_languages(spark, three):
    names, models = language_id.learn(three)
    mixed = spark.createDataFrame([(1, MIX[0] + MIX[1]), (2, MIX[0])], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.predict(mixed, names, models).collect()}
    assert set(got[1].languages) == {"en", "fr"} and 0.3 < got[1].score < 0.7 and got[2].languages == ["en"]


def em(text, models, names, penalty=4.0):
    """The likeliest language, its proportion and the set, n-gram by n-gram in plain Python."""
    grams = Counter(int(c) for c in language_id.cells_of(text))

    def fit(kept, start):
        share = dict(start)
        for _ in range(12):
            new = dict.fromkeys(kept, 0.0)
            for g, n in grams.items():
                joint = {k: share[k] * math.exp(float(models[k][g])) for k in kept}
                for k in kept:
                    new[k] += n * joint[k] / sum(joint.values())
            share = {k: v / sum(grams.values()) for k, v in new.items()}
        return share, sum(n * math.log(sum(share[k] * math.exp(float(models[k][g])) for k in kept)) for g, n in grams.items())

    kept = list(range(len(names)))
    share, best = fit(kept, dict.fromkeys(kept, 1 / len(kept)))
    while len(kept) > 1:
        least = min(reversed(kept), key=lambda k: share[k])
        fewer = [k for k in kept if k != least]
        start = {k: share[k] + 1e-6 for k in fewer}
        next_share, score = fit(fewer, {k: v / sum(start.values()) for k, v in start.items()})
        if best - score > penalty * math.log(sum(grams.values()) + 1):
            break
        kept, share, best = fewer, next_share, score
    top = max(kept, key=lambda k: share[k])
    return names[top], share[top] / sum(share.values()), {names[k] for k in kept}


def test_languages_against_plain_expectation_maximisation(spark, three):
    names, models = language_id.learn(three)
    texts = [MIX[0], MIX[1] + MIX[2], MIX[0] + MIX[1] + MIX[2], "the", "xyz qq", "le der the " * 30, MIX[2] * 400]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), names, models).collect()}
    for i, t in enumerate(texts):
        name, share, chosen = em(t, models, names)
        assert got[i].lang_pred == name and abs(got[i].score - share) < 1e-3 and set(got[i].languages) == chosen, i


def test_languages_are_bounded_and_repeats_alike(spark, three, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 2)
    dirty = three.unionAll(spark.createDataFrame([(200 + i, MIX[0], f"x{i}") for i in range(30)], three.schema))
    assert language_id.learn(dirty)[0] == ["de", "fr"]  # 21 documents each, and 20 of the third
    twice = dirty.unionAll(dirty).selectExpr("*", "1 AS cell", "2 AS held_out", "'y' AS languages")
    rows = language_id.identify(twice).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r.doc_id, set()).add((r.lang_pred, r.score, tuple(r.languages)))
    assert len(rows) == 188 and all(len(x) == 1 for x in seen.values())


def test_held_out_accuracy(spark, small):
    truth = {r.doc_id: r.lang for r in table(spark, small, "documents").collect()}
    told = [r for r in op7_language_id(spark, small).collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in told) >= 0.95 * len(told)


def forward(w, context, target):
    """Log-probabilities one word at a time, digit by digit."""
    out = []
    for seen, code in zip(context, target, strict=True):
        hidden = np.tanh(sum(w["embed"][c] @ w["inner"][p * masked_lm.WIDTH : (p + 1) * masked_lm.WIDTH] for p, c in enumerate(seen)) + w["inner_bias"])
        total, before, row = 0.0, 0, 0
        for i in range(masked_lm.DIGITS):
            wanted = int(code) // masked_lm.BASE ** (masked_lm.DIGITS - 1 - i) % masked_lm.BASE
            x = hidden @ w["outer"][:, i * masked_lm.BASE : (i + 1) * masked_lm.BASE] + w["bias"][row + before]
            total += x[wanted] - np.log(np.exp(x).sum())
            row, before = row + masked_lm.BASE**i, before * masked_lm.BASE + wanted
        out.append(total)
    return np.array(out)


def test_gradients_are_those_of_the_loss():
    w = {k: v.astype(np.float64) for k, v in masked_lm.fresh().items()}
    at_random = np.random.default_rng(1)
    context, target = at_random.integers(0, masked_lm.CODES, (20, 4)), at_random.integers(0, masked_lm.CODES, 20)
    for k, g in masked_lm.gradients(w, context, target).items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[k][at] += 1e-5
        up = -forward(w, context, target).mean()
        w[k][at] -= 2e-5
        down = -forward(w, context, target).mean()
        w[k][at] += 1e-5
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6, k


def test_sums_of_a_step_are_the_plain_ones():
    """Sums by halves and by place give the bits of the plain sums, embeddings only for codes that are there."""
    at_random = np.random.default_rng(2)
    x = at_random.random((500, masked_lm.DIGITS, masked_lm.BASE)).astype(np.float32)
    assert (masked_lm.totals(x) == x.sum(axis=2, keepdims=True)).all()
    at, values = at_random.integers(0, 40, 300).astype(np.int32), at_random.random((300, 3)).astype(np.float32)
    plain = np.zeros((50, 3))
    np.add.at(plain, at, values)
    assert (masked_lm.spread(at, values, 50) == plain.astype(np.float32)).all()
    context, target = at_random.integers(0, 100, (20, 4)), at_random.integers(0, 100, 20)
    codes, found = masked_lm.gradients_of_seen(masked_lm.fresh(), context, target)
    whole = masked_lm.gradients(masked_lm.fresh(), context, target)["embed"]
    assert (codes == np.unique(context)).all() and (found["embed"] == whole[codes]).all() and np.abs(whole).sum(axis=1).astype(bool).sum() == len(codes)


def spelling(rare):
    """log p(word) from letters, three at a time, of all rare words."""
    fold = lambda w: [0, 0, *[int(masked_lm._LETTER[b]) for b in w], 0]
    three = Counter(x for w in rare for x in zip(fold(w), fold(w)[1:], fold(w)[2:]))
    two = Counter()
    for (a, b, _), n in three.items():
        two[a, b] += n
    alike = Counter(masked_lm._LETTER.tolist())

    def log_p(w):
        f = fold(w)
        return sum(math.log((three[x] + 0.1) / (two[x[:2]] + 6.4)) for x in zip(f, f[1:], f[2:])) - sum(math.log(alike[x]) for x in f[2:-1])

    return log_p


def test_pseudo_likelihood_against_one_word_at_a_time(spark, monkeypatch):
    """Network, spelling and windows, from their definitions."""
    random.seed(8)
    texts = [" ".join(random.choice(["a", "b", "c", f"x{i}y", f"éz{i % 3}"]) for _ in range(30)) for i in range(12)]
    texts += [texts[0], texts[1] + " more", "a b q c a", "a b r c a", "a b q c a", None, "", "Solo", "w" * 500]
    monkeypatch.setattr(masked_lm, "most_frequent", lambda counted, key, most: (["a", "b", "c"], 1))
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, row string")
    codes = masked_lm.vocabulary(df)
    encoded = masked_lm.encode(df.select("doc_id", "text"), codes, 3)
    weights = masked_lm.train(encoded, 2, batch=64)
    monkeypatch.setattr(masked_lm, "vocabulary", lambda docs: codes)
    monkeypatch.setattr(masked_lm, "train", lambda *x: weights)
    got = {r.doc_id: r for r in masked_lm.pseudo_likelihood(df).collect()}

    words = [(t or "").lower().encode().split() for t in texts]
    rare = Counter(w for t in words for w in t if w not in (b"a", b"b", b"c"))
    log_p = spelling(rare)
    ending = lambda w: int(masked_lm.Spelled([w]).endings()[0])
    shares = Counter()
    for w, n in rare.items():
        shares[ending(w)] += n
    total = sum(rare.values()) + 0.1 * masked_lm.SHARED
    known = {b"a": 1, b"b": 2, b"c": 3}
    code = lambda w: known.get(w) or masked_lm.FIRST_SHARED + ending(w)
    held = {}
    for t in words:
        p = [None, None, *t, None, None]
        for i in range(2, len(p) - 2):
            if p[i] in rare:
                held.setdefault((p[i - 2], p[i - 1], p[i + 1], p[i + 2], ending(p[i])), Counter())[p[i]] += 1
    for doc, t in enumerate(words):
        p = [None, None, *t, None, None]
        c = [0 if w is None else code(w) for w in p]
        want = 0.0
        for i in range(2, len(p) - 2):
            want += forward(weights, [[c[i - 2], c[i - 1], c[i + 1], c[i + 2]]], [c[i]])[0]
            if p[i] in rare:
                e = ending(p[i])
                spelled = min(log_p(p[i]) - math.log((shares[e] + 0.1) / total), 0)
                want += spelled
                here = held[p[i - 2], p[i - 1], p[i + 1], p[i + 2], e].copy()
                here[p[i]] -= 1
                others = sum(here.values())
                if others:
                    nats = min(max(round(-spelled * masked_lm.NAT), 0), 255) / masked_lm.NAT
                    want += math.log((max(here[p[i]] - masked_lm.CUT, 0) * math.exp(nats) + masked_lm.CUT * sum(n > 0 for n in here.values())) / others)
        assert abs(got[doc].log_likelihood - want) < 1e-3 and got[doc].n_words == len(t), doc
        assert got[doc].mean_log_likelihood == (got[doc].log_likelihood / len(t) if t else None)


def test_scores_do_not_depend_on_the_layout(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    got = []
    for n in (1, 4, 16):
        got.append({r.doc_id: r.log_likelihood for r in masked_lm.pseudo_likelihood(docs.repartition(n)).collect()})
    for other in got[1:]:
        assert other.keys() == got[0].keys() and all(abs(other[k] - v) <= 1e-6 * max(abs(v), 1) for k, v in got[0].items())


def test_copies_are_likelier_and_edges(spark):
    random.seed(9)
    word = lambda: "".join(random.choices("abcdefghij", k=6))
    texts = [" ".join(["the", word(), "of", word()] * 20) for _ in range(80)] + [" ".join(word() for _ in range(80)) for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[150:]])] + [(None, "a b"), (7, None)], "doc_id long, text string")
    rows = masked_lm.pseudo_likelihood(df).collect()
    got = {r.doc_id: r.mean_log_likelihood for r in rows if r.n_words}
    assert min(got[i] for i in range(150, 170)) > max(got[i] for i in range(80, 150)) and all(abs(got[150 + i] - got[160 + i]) < 1e-4 for i in range(10))
    assert sorted((r.n_words, r.mean_log_likelihood is None) for r in rows if r.doc_id in (None, 7)) == [(0, True), (2, False), (80, False)]
    assert masked_lm.pseudo_likelihood(df.limit(0)).count() == 0


def test_each_position_is_masked_once_and_training_helps(spark, three):
    at = np.arange(1000)
    assert sorted(np.concatenate([masked_lm.masked(at, at, k, 3) for k in range(3)]).tolist()) == at.tolist()
    docs = three.select("doc_id", "text")
    encoded = masked_lm.encode(docs, masked_lm.vocabulary(docs), 1)
    total = lambda w: masked_lm.score(encoded, w, 1).agg({"value": "sum"}).first()[0]
    assert total(masked_lm.train(encoded, 2, batch=64)) > total(masked_lm.fresh())


def kneser_ney(texts, least=2):
    """p(w | u v), the words, the words seen too rarely, from plain counts."""
    seen = Counter(w for t in texts for w in t.lower().split())
    words = {w for w, n in seen.items() if n >= least}
    rare = len(seen) - len(words)
    rows = [["<", "<", *[w if w in words else "?" for w in t.lower().split()], ">"] for t in texts]
    three = Counter(x for r in rows for x in zip(r, r[1:], r[2:]))
    two = Counter((v, w) for _, v, w in three)
    one = Counter(w for _, w in two)
    after = {2: {}, 3: {}}
    for order, counts in ((2, two), (3, three)):
        for k, n in counts.items():
            after[order].setdefault(k[:-1], {})[k[-1]] = n

    def cut(order, n):
        counts = (one, two, three)[order - 1]
        t = [max(sum(x == k for x in counts.values()), 1) for k in range(1, 5)]
        y = t[0] / (t[0] + 2 * t[1])
        if n == 0:
            return 0.0
        k = min(n, 3)
        return min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.1), k - 0.05)

    cut = functools.cache(cut)

    def p(w, *context):
        w = w if w in words or w == ">" else "?"
        if not context:
            return (max(one[w] - cut(1, one[w]), 0) + sum(cut(1, n) for n in one.values()) / (len(words) + 2)) / sum(one.values())
        order = len(context) + 1
        here = after[order].get(tuple(x if x in words or x == "<" else "?" for x in context), {})
        below = p(w, *context[1:])
        if not here:
            return below
        return (here.get(w, 0) - cut(order, here.get(w, 0)) + sum(cut(order, x) for x in here.values()) * below) / sum(here.values())

    return p, words, rare


def test_scores_against_plain_counts(spark, three, monkeypatch):
    random.seed(4)
    texts = [" ".join(random.choice(["a", "b", "c", "d", f"x{i}"]) for _ in range(12)) for i in range(40)] + MIX + ["a b c a b c"]
    p, words, rare = kneser_ney(texts)
    for context in (("<", "<"), ("a", "b"), ("nope", "a"), ("no", "pe"), ("b", "c")):
        assert abs(sum(p(w, *context) for w in [*words, ">", "?"]) - 1) < 1e-9
    asked = [*texts[:5], MIX[1], "a b zzz qqq a", "zzz", "", None, "a b c " * 20_000, *texts[:2]]
    df = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    model, shards = ngram_quality.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    monkeypatch.setattr(ngram_quality, "BATCH_BYTES", 500)
    got = {r.doc_id: r for r in ngram_quality.score(df, model, shards).collect()}
    for i, t in enumerate(asked):
        r = ["<", "<", *(t or "").lower().split(), ">"]
        known = lambda w: w in words or w == ">"
        want = sum(math.log(p(w, u, v)) - (0 if known(w) else math.log(rare + 1)) for u, v, w in zip(r, r[1:], r[2:]))
        assert abs(got[i].log_probability - want) < 1e-5 * max(len(r), 100) and got[i].n_words == len(r) - 3, i


def test_the_vocabulary_is_bounded_by_a_higher_count(spark, monkeypatch):
    texts = spark.createDataFrame([("a a a a b b b c c d",)] * 2, "text string")
    monkeypatch.setattr(ngram_quality, "MOST_WORDS", 2)
    hashes, rare = ngram_quality.vocabulary(texts, 2)
    assert len(hashes) == 2 and rare == 2


def test_gibberish_of_unseen_letter_words_is_rejected(spark):
    random.seed(6)
    name = lambda: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(3, 9)))
    known = [name() for _ in range(6000)]
    # half of the words are few and frequent, the others are rare and more than any small vocabulary has
    prose = lambda: " ".join(random.choice(known[:40] if random.random() < 0.5 else known) for _ in range(120))
    rows = [(i, prose(), "en") for i in range(400)] + [(1000 + i, " ".join(name() for _ in range(300)), "en") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    got = {r.doc_id: r for r in ngram_quality.classify(df, labels).collect()}
    assert sum(got[i].kept for i in range(400)) >= 380
    assert not any(got[1000 + i].kept for i in range(5))


def test_classifier(spark, three):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    told = op5_quality_classifier(spark, folder).collect()
    good, bad = ([r.kept for r in told if labels.get(r.doc_id) == k] for k in (1, 0))
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.35 * len(bad) and len(told) == table(spark, folder, "documents").count()
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert not any(r.kept for r in ngram_quality.classify(three, none).collect())
    assert ngram_quality.classify(three.limit(0), none).count() == 0


def test_classifier_on_repeats_and_clashing_names(spark, three):
    df = three.unionAll(three).selectExpr("*", "1 AS n_words", "'x' AS perplexity", "2 AS row", "3 AS kept")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] * 2 + [(5, 0), (None, 1)], "doc_id long, quality int")
    got = ngram_quality.classify(df, labels).collect()
    seen = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append((r.n_words, r.perplexity, r.threshold, r.kept))
    assert len(got) == 128 and all(len(x) == 2 and x[0] == x[1] for x in seen.values())
    assert seen[100][0][1] is None and not seen[100][0][3] and seen[102][0][2] is not None
