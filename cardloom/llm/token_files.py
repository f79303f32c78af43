"""Token ids as Arrow files of equal-length sequences, for training.

A file is in Arrow's random-access file format: record batches of ``batch`` sequences, whose
columns are

* ``ids``: fixed-size list of ``size`` unsigned integers, of 16 bits where the vocabulary
  has at most 65,536 entries, else of 32;
* ``mask``: fixed-size list of ``size`` booleans, true for an id and false for padding;
* ``ends``: fixed-size list of ``size`` booleans, true at a document's last id;
* ``doc_ids``: the ids of the documents that end in the sequence, in order.

Every sequence has its fixed place, so a reader finds the n-th one without reading others, and
gets it as a view of the file's bytes (``Sequences``).  Documents stand in ascending order
of their ids and run on from one sequence into the next; a file's last sequence is padded.

Documents are dealt out by ranges of (id, place in the input), so that an id which many rows
share is no single task, and sorted within; each task encodes and writes its range as files
of at most about ``file_bytes``.  What the tasks wrote stands in a manifest, whose commit
takes one attempt of each task: files of lost attempts are in no manifest and never read.

Defined results: a null or empty text is the end id alone; very long texts go through whole,
over as many sequences and batches as they need; rows that share an id follow each other as
they stand in the input, rows without one come first; an empty table gives no files
and an empty result; only the two columns named are read.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardloom.llm.common import shared_folder, ship, written
from cardloom.llm.pretokens import PreTokens, for_worker, texts

MANIFEST = "part long, number long, file string, n_tokens long, n_documents long, n_sequences long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Characters of which the pattern below is sure what they are.
_SURE = re.compile("[\t-\r -~\xa0-ɏ‐-‧‰-⁞€]*")


def _members(kind: str) -> str:
    ranges = (range(0x21, 0x250), range(0x2010, 0x205F), range(0x20AC, 0x20AD))
    return "".join(re.escape(c) for r in ranges for c in map(chr, r) if unicodedata.category(c)[0] == kind)


def _pattern() -> re.Pattern:
    """Pre-tokens of the byte-level scheme: contractions, then letters, numbers or other
    signs with a space before them, then white space, of which the last goes to the word."""
    letters, numbers = _members("L"), _members("N")
    blank = "\t-\r \xa0"
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?[^{blank}{letters}{numbers}]+|[{blank}]+(?![^{blank}])|[{blank}]+")


class BytePreTokens(PreTokens):
    """Maps a pre-token of a byte-level vocabulary to its packed ids, with the case kept.

    Texts with characters beyond ``_SURE``, or with a special token's string, go
    to the library whole.
    """

    def __init__(self, path: str, fixed: dict | None = None, capacity: int = 300_000):
        super().__init__(path, fixed, capacity)
        self.pattern = _pattern()

    def split(self, text: str) -> list[str] | None:
        if not _SURE.fullmatch(text) or any(s in text for s in self.special):
            return None
        return self.pattern.findall(text)


def sequence_schema(size: int, vocabulary: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, size)), ("mask", pa.list_(pa.bool_(), size)), ("ends", pa.list_(pa.bool_(), size)), ("doc_ids", pa.list_(pa.int64()))])


class _Writer:
    """Takes documents one after another and writes files of whole batches."""

    def __init__(self, folder: str, schema: pa.Schema, batch: int, file_bytes: int):
        self.folder, self.schema, self.file_bytes = folder, schema, file_bytes
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.size = schema.field("ids").type.list_size
        self.kind = np.uint16 if schema.field("ids").type.value_type == pa.uint16() else np.uint32
        self.room = batch * self.size
        self.done: list[tuple[int, str, int, int, int]] = []
        self.out = self.writer = None
        self._empty()

    def _empty(self) -> None:
        self.ids, self.ends = np.zeros(self.room, self.kind), np.zeros(self.room, bool)
        self.used, self.doc_ids = 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            if self.used == self.room:
                self._flush()
            n = min(self.room - self.used, len(ids) - at)
            self.ids[self.used : self.used + n] = ids[at : at + n]
            self.used += n
            at += n
        self.ends[self.used - 1] = True
        self.doc_ids.append(doc_id)
        self.documents += 1

    documents = tokens = sequences = 0

    def _flush(self) -> None:
        if not self.used:
            return
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.arrow"
            self.out = self.store.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.writer = pa.ipc.new_file(self.out, self.schema)
        n = -(-self.used // self.size)
        places = np.arange(n * self.size)
        each = np.add.reduceat(self.ends[: n * self.size].astype(np.int64), np.arange(0, n * self.size, self.size))
        offsets = np.concatenate([[0], np.cumsum(each)])
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(self.ids[: n * self.size]), self.size),
            pa.FixedSizeListArray.from_arrays(pa.array(places < self.used), self.size),
            pa.FixedSizeListArray.from_arrays(pa.array(self.ends[: n * self.size]), self.size),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.doc_ids, pa.int64())),
        ]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.tokens += self.used
        self.sequences += n
        self._empty()

    def end_file(self) -> None:
        self._flush()
        if self.out is not None:
            self.writer.close()
            self.out.close()
            self.done.append((len(self.done), f"{self.folder}/{self.name}", self.tokens, self.documents, self.sequences))
            self.out = self.writer = None
        self.documents = self.tokens = self.sequences = 0

    def end_document(self) -> None:
        if self.tokens * np.dtype(self.kind).itemsize >= self.file_bytes:
            self.end_file()


def write_sequences(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, size: int = 2048, batch: int = 128, file_bytes: int = 1 << 28) -> DataFrame:
    """Writes the texts of documents (doc_id, text) in ascending order of their ids, each
    followed by ``end_id``, and returns the manifest with ``base``: the ids before a file."""
    ship(docs.sparkSession)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = for_worker(tokenizer, BytePreTokens)
        out = _Writer(folder, sequence_schema(size, cache.library.get_vocab_size()), batch, file_bytes)
        end = cache.packed([end_id])
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts(b), strict=True):
                out.add(doc_id, np.frombuffer(cache.ids(text) + end, np.dtype("<u4")))
                out.end_document()
        out.end_file()
        part = TaskContext.get().partitionId()
        columns = list(zip(*[(part, *d) for d in out.done], strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 2 else pa.int64()) for i, c in enumerate(columns)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    placed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
    ordered = placed.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place").select("doc_id", "text")
    manifest = written(ordered.mapInArrow(write, MANIFEST), "sequences")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Sequences:
    """Random access to the sequences of one file, without copies where it is mapped."""

    def __init__(self, file: str):
        store, path = fs.FileSystem.from_uri(file)
        self._source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
        self._reader = pa.ipc.open_file(self._source)
        n = self._reader.num_record_batches
        # all batches but the last hold the same number of sequences
        self._batch = self._reader.get_batch(0).num_rows if n else 0
        self._n = (n - 1) * self._batch + self._reader.get_batch(n - 1).num_rows if n else 0

    def __len__(self) -> int:
        return self._n

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray, pa.BooleanArray, list[int | None]]:
        """(ids, mask, ends, doc_ids) of one sequence."""
        if not 0 <= i < self._n:
            raise IndexError(i)
        batch, row = self._reader.get_batch(i // self._batch), i % self._batch
        size = batch.schema.field("ids").type.list_size
        part = lambda name: batch.column(name).values.slice(row * size, size)
        return part("ids").to_numpy(), part("mask"), part("ends"), batch.column("doc_ids")[row].as_py()


def documents_of(reader: pa.RecordBatchFileReader) -> Iterator[tuple[int | None, int, int, int]]:
    """(doc_id, start in the file, n_tokens, checksum) of the documents of a file, with one
    batch in memory at a time."""
    start = n = crc = 0
    for i in range(reader.num_record_batches):
        batch = reader.get_batch(i)
        used = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        ids = batch.column("ids").flatten().to_numpy()[used].astype("<u4")
        ends = np.flatnonzero(batch.column("ends").flatten().to_numpy(zero_copy_only=False)[used])
        at = 0
        for doc_id, end in zip(batch.column("doc_ids").flatten().to_pylist(), (ends + 1).tolist(), strict=True):
            yield doc_id, start, n + end - at, zlib.crc32(ids[at:end], crc)
            start += n + end - at
            n = crc = 0
            at = end
        n, crc = n + len(ids) - at, zlib.crc32(ids[at:], crc)
    if n:
        raise EOFError(f"{n} ids after the last document's end")


def read_documents(manifest: DataFrame, rows: int = 10_000) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, from the files; one task reads
    a file."""
    names = [c.split()[0] for c in DOCUMENTS.split(", ")]

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, base in zip(b.column("file").to_pylist(), b.column("base").to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(file)
                found = []
                with store.open_input_file(path) as source:
                    for doc_id, start, n, crc in documents_of(pa.ipc.open_file(source)):
                        found.append((doc_id, base + start, n, crc))
                        if len(found) == rows:
                            yield batch_of(found)
                            found = []
                if found:
                    yield batch_of(found)

    n = max(1, manifest.count())
    return manifest.select("file", "base").repartition(n).mapInArrow(read, DOCUMENTS)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, id_column: str = "doc_id", text: str = "text", **files: int) -> DataFrame:
    """Writes the documents' ids as files and describes each document as read back."""
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    manifest = write_sequences(docs, f"{shared_folder(docs.sparkSession)}/sequences-{uuid.uuid4().hex}", tokenizer, end_id, size, **files)
    return read_documents(manifest).withColumnRenamed("doc_id", id_column)
