import random
import sys
import zlib
from pathlib import Path

import duckdb
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import test_decontaminate
import test_minhash
import test_quality_rules

import corpus_pipeline
from cardloom.llm import quality_rules
from cardloom.llm.pretokens import PreTokens
from cardloom.llm.queries import ORACLES, QUERIES, tokenizer_file
from cardloom.sources.storage import table


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash", "decontamination", "pii", "packing"]
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert packed.select("doc_id").distinct().count() == before


def test_an_empty_table_goes_through(spark, small):
    docs = table(spark, small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        duck.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    df, relation = QUERIES[name](spark, small), duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    theirs = [relation.columns.index(c) for c in columns]
    key = lambda r: [(v is None, str(v)) for v in r]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted((tuple(r[i] for i in theirs) for r in relation.fetchall()), key=key)


def is_good(text):
    """The quality rules from their table, in Python."""
    n, chars, symbols, duplicates, repeats = test_quality_rules.brute(text)
    lines = [x for x in (text or "").split("\n") if x.split()]
    stops = sum(w.lower() in quality_rules.STOP_WORDS for w in (text or "").split())
    return n >= 50 and 2 * repeats <= n and 2 * n <= chars <= 15 * n and 10 * symbols <= n and 50 * stops >= n and 10 * duplicates <= 3 * len(lines)


def test_run_against_brute_force(spark, tmp_path):
    """Planted junk, copies, benchmark items and personal data, through all stages."""
    random.seed(21)
    prose = lambda n: " ".join(random.choice(["the", *[f"w{random.randrange(9999)}" for _ in range(5)]]) for _ in range(n))
    items = [prose(30), prose(45)]
    near = prose(120).split()
    texts = [prose(random.randint(60, 300)) for _ in range(30)]
    texts += [None, "", "short text", "### $$$ " * 60, "again and again the " * 60, "x | y " * 80]
    texts += [texts[0], texts[1] + " end", " ".join([*near[:60], "edit", *near[61:]]), " ".join(near), texts[2].upper()]
    texts += [prose(80) + " " + items[0] + " " + prose(20), items[1] + " " + prose(40)]
    data = [("Mail me at jo.do@mail.example.com", "Mail me at <EMAIL>"), ("from 10.20.30.40 on", "from <IP> on"), ("pay 4111111111111111 now", "pay <CARD> now"), ("call +1 (347) 555-9637 !", "call <PHONE> !")]
    redacted = {}
    for before, after in data:
        a, b = prose(40), prose(40)
        redacted[len(texts)] = f"{a} {after} {b}"
        texts.append(f"{a} {before} {b}")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")

    kept = [i for i, t in enumerate(texts) if is_good(t)]
    groups = test_minhash.brute([texts[i] for i in kept], 5, 80)
    kept = [i for k, i in enumerate(kept) if groups[k][1] == k]
    held = {kept[k] for k, _ in test_decontaminate.brute([texts[i] for i in kept], list(enumerate(items)))}
    kept = [i for i in kept if i not in held]
    library = Tokenizer.from_file(tokenizer_file())
    want = {i: [*library.encode(redacted.get(i, texts[i]), add_special_tokens=False).ids, 2] for i in kept}
    assert 30 <= len(want) < len(texts) - 10 and set(redacted) <= set(want)

    got = {}
    for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect():
        assert r.length <= 4096 and (r.start, r.length) == (0, r.doc_tokens)
        got[r.doc_id] = (r.length, r.ids_crc32)
    assert got == {i: (len(ids), zlib.crc32(PreTokens.packed(ids))) for i, ids in want.items()}


def test_stages_keep_clashing_columns(spark, small):
    docs = table(spark, small, "documents").limit(60).selectExpr("*", "1 AS kept", "'x' AS candidates", "2 AS shingles", "3 AS n_words")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
    assert docs.columns[-4:] == ["kept", "candidates", "shingles", "n_words"] and {tuple(r)[-4:] for r in docs.collect()} == {(1, "x", 2, 3)}
