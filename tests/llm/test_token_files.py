import os
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

os.environ["TOKENIZERS_PARALLELISM"] = "false"
from tokenizers import Tokenizer  # noqa: E402

from cardloom.llm import token_files  # noqa: E402
from cardloom.llm.queries import tokenizer_file  # noqa: E402

FILE = "byte_bpe_50k.json"
TEXTS = [None, "", "\n", " ", "It's we'll ''s !'t x'D 'LL'll  two", "a\x1cb\x85c\xa0d \xa0 e", "a \n\n b\t\tc  ", "Σας ΟΔΟΣ", "İstanbul ŉ ﬁ", "<|endoftext|> hi <|endoftext|>", "你好 世界 ١٢", "ÀÖØÞß ÿŸ €–“”… ·÷×µ ½²3ª  x", "!!! ! 0!", "word " * 9000, "é" * 5000, "éa"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file(FILE))


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def packed(numbers):
    return struct.pack(f"<{len(numbers)}I", *numbers)


def test_pretokens_give_the_librarys_ids(library):
    cache = token_files.BytePreTokens(tokenizer_file(FILE), capacity=50)
    more = [f"a{chr(c)}b {chr(c)}1 '{chr(c)}  {chr(c)}{chr(c)} \n{chr(c)}" for c in [*range(0x09, 0x260), *range(0x2000, 0x2070), 0x20AC]]
    rng = random.Random(2)
    odd = " \n\t'sltred1½éa.!\xa0\x85  <|"
    more += ["".join(rng.choice(odd) for _ in range(40)) for _ in range(3000)]
    for text in [*TEXTS, *more]:
        assert cache.ids(text or "") + cache.packed([0]) == packed(ids(library, text)), repr(text)[:80]


def rows_of(rows, library):
    """What the documents must give, in the order of their ids."""
    out, start = [], 0
    for doc_id, text in rows:
        x = ids(library, text)
        out.append((doc_id, start, len(x), zlib.crc32(packed(x))))
        start += len(x)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


@pytest.mark.parametrize("options", [{}, {"size": 7, "batch": 3, "file_bytes": 1}, {"size": 64, "batch": 2, "file_bytes": 3000}])
def test_documents_come_back_in_order(docs, library, options):
    texts = [*TEXTS, *["some words here " * (i % 70) for i in range(200)]]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    df = docs([texts[i] for i in order], ids=order).repartition(5).withColumnRenamed("source", "place").withColumnRenamed("lang", "start")
    assert got(token_files.round_trip(df, tokenizer_file(FILE), **options)) == rows_of(enumerate(texts), library)


def test_ids_that_repeat_or_are_missing(docs, library):
    texts = [f"text {i % 4}" for i in range(400)]
    df = docs(texts, ids=[None] * 30 + [7] * 300 + list(range(8, 78)))
    rows = got(token_files.round_trip(df, tokenizer_file(FILE), size=16))
    assert [r[0] for r in rows] == [None] * 30 + [7] * 300 + list(range(8, 78))
    assert rows == rows_of(zip([r[0] for r in rows], texts, strict=True), library)
    assert token_files.round_trip(df.limit(0), tokenizer_file(FILE)).count() == 0


def test_sequences_are_views_of_the_file(spark, docs, library, tmp_path):
    texts = ["! a few words! " * (i % 9) for i in range(100)]
    manifest = token_files.write_sequences(docs(texts).select("doc_id", "text"), f"file://{tmp_path}/x", tokenizer_file(FILE), size=32, batch=4).orderBy("part", "number").collect()
    whole, docs_seen = [], []
    for m in manifest:
        assert m.base == len(whole)
        held = token_files.Sequences(m.file)
        assert len(held) == m.n_sequences
        for i in reversed(range(len(held))):
            before = pa.total_allocated_bytes()
            numbers, mask, ends, doc_ids = held[i]
            assert pa.total_allocated_bytes() == before
            assert numbers.dtype == np.uint16 and len(numbers) == len(mask) == 32 and not numbers.flags.owndata
            assert sum(ends.to_pylist()) == len(doc_ids) and (mask.to_pylist() == [True] * 32 or i == len(held) - 1)
        for i in range(len(held)):
            numbers, mask, _, doc_ids = held[i]
            whole += numbers[np.array(mask.to_pylist())].tolist()
            docs_seen += doc_ids
        with pytest.raises(IndexError):
            held[len(held)]
    assert whole == [x for t in texts for x in ids(library, t)] and docs_seen == list(range(100))
    assert token_files.sequence_schema(8, 70_000).field("ids").type.value_type == pa.uint32()


def test_query_on_whole_table(spark, small, library):
    from cardloom.llm.queries import op11_token_files

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    assert got(op11_token_files(spark, small)) == rows_of(rows, library)
