"""Training reads all trusted text, in as many buckets and shards as it takes."""

import random

from cardloom.llm import ngram_quality


def test_all_trusted_documents_are_trained_on(spark, monkeypatch):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('word', id div 4, ' and word', id div 8) AS text", "'en' AS lang")
    labels = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality")
    real, read = ngram_quality.train, []

    def train(texts, *more):
        read.append(texts.count())
        return real(texts, *more)

    monkeypatch.setattr(ngram_quality, "train", train)
    judged = ngram_quality.classify(docs, labels)
    assert read == [docs.filter("pmod(xxhash64(doc_id), 5) <> 0").count()] and read[0] > 20_000
    assert judged.count() == 30_000


def test_scores_do_not_depend_on_buckets_and_shards(spark, monkeypatch):
    random.seed(7)
    texts = [" ".join(random.choice(["a", "b", "c", "d", f"x{i % 9}"]) for _ in range(30)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")

    def scores():
        model, shards = ngram_quality.train(df.select("text").repartition(3))
        return model.shards, {r.doc_id: r.log_probability for r in ngram_quality.score(df, model, shards).collect()}

    few, want = scores()
    monkeypatch.setattr(ngram_quality, "BUCKET", 20)
    monkeypatch.setattr(ngram_quality, "SHARD", 4)
    many, got = scores()
    assert few == ngram_quality.SHARDS < many and got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-6 * abs(want[i]) for i in want)
