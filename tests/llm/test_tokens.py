import os
import zlib

import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from cardloom.llm import packing, token_counts  # noqa: E402
from cardloom.llm.pretokens import PreTokens  # noqa: E402
from cardloom.llm.queries import tokenizer_file  # noqa: E402

TEXTS = [None, "", "\n", "It's we'll ''s !'t x'D 'LL", "a\x1cb\x85c\xa0d", "Σας ΟΔΟΣ", "İstanbul ŉ ﬁ", "<|endoftext|> hi <|startoftext|>", "你好 世界 ١٢", "ÀÖØÞß ÿŸ €–“”… ·÷×µ ½²3ª", "word " * 9000, "é" * 5000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pretokens_give_the_librarys_ids(library):
    cache = PreTokens(tokenizer_file(), capacity=50)
    more = [f"a{chr(c)}b {chr(c)}1 '{chr(c)}" for c in range(0x20, 0x260)]
    for text in [*TEXTS, *more]:
        assert cache.ids(text or "") == cache.packed(ids(library, text)), repr(text)[:80]
    assert len(cache) <= 51


def test_counts(docs, library):
    df = docs(TEXTS).withColumnRenamed("source", "n_tokens")
    got = {r.doc_id: r for r in token_counts.count_tokens(df, tokenizer_file()).collect()}
    for i, t in enumerate(TEXTS):
        n = len(ids(library, t))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 2048)
    assert token_counts.count_tokens(df.limit(0), tokenizer_file()).count() == 0
    twice = token_counts.count_tokens(df.unionAll(df), tokenizer_file()).collect()
    assert len(twice) == 2 * len(TEXTS) and all(r.n_tokens == got[r.doc_id].n_tokens for r in twice)


def test_frequent_lengths_are_those_of_all_documents(docs, library):
    texts = ["common word " * 50 + f"rare{i} only{i}" for i in range(200)] + ["z" * 100 + " "] * 300
    table = token_counts.frequent(docs(texts), tokenizer_file(), table_size=4)
    assert 2 <= len(table) <= 4 and {"common", "word"} <= set(table) and "z" * 100 not in table
    assert all(n == len(ids(library, t)) for t, n in table.items())
    assert token_counts.frequent(docs([]), tokenizer_file()) == {}


def test_packing_places_each_id_once(docs, library):
    texts = [*TEXTS, *["some words here " * (i % 700) for i in range(300)]]
    rows = packing.pack(docs(texts), tokenizer_file()).collect()
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(documents) == set(range(len(texts)))
    for i, pieces in documents.items():
        whole, at = [*ids(library, texts[i]), 2], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(PreTokens.packed(whole[at : at + r.length]))
            at += r.length
        assert at == len(whole)
    used = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        used += at
    assert used / (4096 * len(sequences)) > 0.97
    assert packing.pack(docs(texts).limit(0), tokenizer_file()).count() == 0
    assert sum(r.length == 4096 for r in rows) == sum(r.length == 4096 and r.offset == 0 for r in rows) > 1
    clash = docs(texts[:20]).withColumnRenamed("source", "length").withColumnRenamed("lang", "rank")
    assert packing.pack(clash, tokenizer_file()).select("doc_id").distinct().count() == 20
    twice = packing.pack(docs(["a", "a"], ids=[1, 1]), tokenizer_file()).collect()
    assert sorted(r.offset for r in twice) == [0, twice[0].length]


def test_patterns_hold_all_lengths():
    histogram = {10: 7, 6: 3, 4: 10, 1: 25}
    found = packing.patterns(histogram, 10)
    held = {}
    for count, pattern in found:
        assert sum(length * times for length, times in pattern) <= 10
        for length, times in pattern:
            held[length] = held.get(length, 0) + count * times
    assert held == histogram and packing.patterns({}, 10) == []
