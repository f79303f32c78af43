"""Digests of landed files of any size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from cardloom.sources.storage import ship

FILES = "path string, content_length long, sha256 string"


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a path, a pattern or a folder names, hidden ones
    left out."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    out, open_ = [], [f for f in store.globStatus(pattern) or ()]
    while open_:
        f = open_.pop()
        if f.isDirectory():
            open_ += [x for x in store.listStatus(f.getPath()) if not x.getPath().getName().startswith(("_", "."))]
        else:
            out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def _uri(path: str) -> str:
    """A path as Hadoop writes it (not escaped, local ones with one slash) as a URI."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}{colon}{'//' if not rest.startswith('//') else ''}{quote(rest, safe='/:@')}"


def digests(spark: SparkSession, path: str, piece: int = 1 << 16) -> DataFrame:
    """(path, content_length, sha256) of files, one task for each few of them.

    A file is read in pieces, of which a task holds one, so its size is not bounded; the
    files' store must be one that Arrow can open.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for file in batch.column("path").to_pylist():
                store, at = fs.FileSystem.from_uri(_uri(file))
                sha = hashlib.sha256()
                with store.open_input_stream(at, compression=None) as stream:
                    while data := stream.read(piece):
                        sha.update(data)
                sums.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("content_length"), pa.array(sums, pa.string())], names=["path", "content_length", "sha256"])

    ship(spark)
    found = listed(spark, path)
    tasks = max(1, min(len(found), 10_000))
    return spark.createDataFrame(found, "path string, content_length long").repartition(tasks).mapInArrow(digest, FILES)
