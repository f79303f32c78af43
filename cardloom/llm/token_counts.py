"""Token counts by a two-tier look-up inside the map tasks.

Tier one is a broadcast table of frequent pre-tokens with their numbers of tokens, at
most ``table_size`` entries of at most ``LONGEST`` characters, so its size is bounded.
Tier two is the cache of each Python worker, which encodes what it misses and keeps
lengths only.  No pre-token of the corpus is shuffled: every document's count is made
where the document is read.

The table decides only how fast a pre-token is found, never the count.  It is taken
from all documents: each task sends its ``task_size`` most frequent pre-tokens, which
are added up and ranked by levels in Spark, so only the table itself reaches the driver.

Defined results: a null or empty text has 0 bytes and 0 tokens; very long texts are
counted whole; rows are counted one by one, repeated or not; pre-tokens of equal
frequency are taken by hash; an empty input gives an empty result; input
columns besides the two named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import most_frequent, ship, written
from cardloom.llm.pretokens import Lengths, for_worker, texts


#: Longer pre-tokens are left to the workers' caches.
LONGEST = 64


def frequent(docs: DataFrame, tokenizer: str, table_size: int = 20_000, task_size: int = 5_000) -> dict[str, int]:
    """The numbers of tokens of the most frequent pre-tokens of all documents."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, seen = for_worker(tokenizer), Counter()
        for batch in batches:
            for text in texts(batch):
                seen.update(t for t in cache.split(text) or () if len(t) <= LONGEST)
                if len(seen) > 20 * task_size:  # bounded: rare ones start anew
                    seen = Counter(dict(seen.most_common(10 * task_size)))
        top = seen.most_common(task_size)
        yield pa.RecordBatch.from_pydict({"token": [t for t, _ in top], "n": pa.array([n for _, n in top], pa.int64())}, schema=pa.schema([("token", pa.string()), ("n", pa.int64())]))

    summed = written(docs.select("text").mapInArrow(heads, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")), "pretokens")
    cache = Lengths(tokenizer)
    return {t: cache[t] for t in most_frequent(summed, "token", table_size)[0]}


def count_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """One row for each document: id, n_bytes, n_tokens and whether it is over ``limit``."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(frequent(docs, tokenizer))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = for_worker(tokenizer, Lengths, known.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for t in texts(batch):
                n_bytes.append(len(t.encode()))
                n_tokens.append(cache.count(t))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], schema=schema)

    counted = docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("doc_id", id_column)
