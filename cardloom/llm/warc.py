"""WARC archives as a chunked record table.

``write_archives`` writes gzip archives from a table of records, ``read_chunks``
reads archives back as rows of (record, chunk number).  A payload passes through
in chunks of ``chunk_bytes`` on both ways; each chunk row carries the number of
payload bytes and the SHA-1 up to its end, so the last chunk's values are those
of the whole payload and no task ever holds a whole large record.

Only digests and ids decide what is a response: the records that a payload has are found
by an aggregate of these, and come back to the payloads as a small table, or else by a
join of written tables, which Spark splits where a digest is hot.

A record's last chunk row tells whether its payload is ``intact``: of the length and the
SHA-1 that the record declares (null for revisits, and where it declares none).
``round_trip`` fails on a record that isn't.

Archives of others are read too: plain or gzip, with folded header lines, ids of any
kind, without payload digests (none is declared then), and with ``resource`` records or
responses of other protocols, whose whole block is the payload.  Other record types are
skipped.

A task writes archives under names of its own and returns a manifest row for
each.  The manifest is a Parquet table, whose commit takes one attempt of each
task: what a lost or repeated attempt left behind is in no manifest and not read.

Defined results: a null payload is empty; of equal payloads of ``least_bytes``
or more, the record with the largest id is the response and the others revisit
it (a repeated id makes several responses); null ids revisit the largest id, or
are responses if there is none; repeated rows are archived one by one; very large
payloads pass in chunks; no records give no archives and an empty result; other columns
than the three named are not read, whatever they are called.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import shared_folder, ship, small_if_checked, written

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, n_records long, n_bytes long"
CHUNKS = "record_id string, record_type string, refers_to string, target_uri string, declared_digest string, declared_bytes long, chunk_no long, data binary, bytes_so_far long, digest_so_far string, last boolean, intact boolean"


def base32_sha1(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def with_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds sha1, n_bytes and refers_to to records of (id, url, payload)."""
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    records = records.withColumn("payload", payload).withColumn("sha1", F.sha1("payload")).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    heads = records.filter(F.col("n_bytes") >= least_bytes).groupBy("sha1").agg(F.max("id").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = records.join(small_if_checked(written(heads, "heads")), "sha1", "left")
    return joined.withColumn("refers_to", F.when(~F.col("head").eqNullSafe(F.col("id")), F.col("head"))).drop("head")


def _head(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


def _fields(record_id: int | None, url: str | None, n_bytes: int, sha1: str, refers_to: int | None, date: str) -> bytes:
    head = len(_head(n_bytes))
    name = lambda x: "<urn:page:" + ("" if x is None else str(x)) + ">"
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(record_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base32_sha1(sha1)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {head + (n_bytes if refers_to is None else 0)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, chunk_bytes: int = 1 << 16, archive_bytes: int = 1 << 28, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes records of ``with_revisits`` and returns the manifest.

    Each record is a gzip member of its own.  A task begins another archive
    once one has ``archive_bytes``.
    """
    ship(records.sparkSession)
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    n_chunks = F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(F.greatest(F.ceil(F.col("n_bytes") / chunk_bytes), F.lit(1)))
    chunked = records.select("id", "url", "n_bytes", "sha1", "refers_to", "payload", F.explode(F.sequence(F.lit(0), n_chunks.cast("int") - 1)).alias("chunk_no"))
    data = F.when(F.col("refers_to").isNull(), F.expr(f"substring(payload, chunk_no * {chunk_bytes} + 1, {chunk_bytes})")).otherwise(F.lit("").cast("binary"))
    chunked = chunked.select("id", "url", "n_bytes", "sha1", "refers_to", "chunk_no", data.alias("data"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        done: list[tuple[str, int, int]] = []
        out, member, name, n = None, None, "", 0

        def close() -> None:
            nonlocal out, member
            if member is not None:
                member.write(b"\r\n\r\n")
                member.close()
                member = None
            if out is not None:
                done.append((f"{folder}/{name}", n, out.tell()))
                out.close()
                out = None

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if member is not None:
                        member.write(b"\r\n\r\n")
                        member.close()
                        member = None
                    if out is not None and out.tell() >= archive_bytes:
                        close()
                    if out is None:
                        name, n = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    member, n = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=6, mtime=0), n + 1
                    member.write(_fields(row["id"], row["url"], row["n_bytes"], row["sha1"], row["refers_to"], date))
                    member.write(_head(row["n_bytes"]))
                member.write(row["data"])
        close()
        files, counts, sizes = zip(*done, strict=True) if done else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["file", "n_records", "n_bytes"])

    return written(chunked.mapInArrow(write, MANIFEST), "manifest")


def _header(stream: io.BufferedReader) -> dict[str, str]:
    """Named fields up to the empty line, names in lower case; a line that begins with
    white space goes on with the field before."""
    out, key = {}, b""
    while (line := stream.readline().rstrip(b"\r\n")):
        if line[:1] in b" \t" and key:
            out[key.decode(errors="replace")] += " " + line.strip().decode(errors="replace")
            continue
        key, _, value = line.partition(b":")
        key = key.strip().lower()
        out[key.decode(errors="replace")] = value.strip().decode(errors="replace")
    return out


def _bare(uri: str | None) -> str | None:
    return uri and uri.removeprefix("<").removesuffix(">")


def records_of(stream: io.BufferedReader, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of one archive, in order; the stream holds at most a chunk more."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields = _header(stream)
        left = int(fields["content-length"])
        if fields.get("warc-type") not in ("response", "revisit", "resource"):
            while left and (skipped := stream.read(min(left, chunk_bytes))):
                left -= len(skipped)
            continue
        head, status = b"", b""
        if fields["warc-type"] != "resource" and fields.get("content-type", "application/http").startswith("application/http"):
            while left and status not in (b"\r\n", b"\n"):
                status = stream.readline(left)
                if not status:
                    break
                left -= len(status)
                head += status
        inner = _header(io.BufferedReader(io.BytesIO(head.partition(b"\n")[2])))
        declared = inner.get("content-length", "")
        whole = int(declared) if declared.isdecimal() else left
        digest_of = fields.get("warc-payload-digest")
        same = (_bare(fields.get("warc-record-id")), fields["warc-type"], _bare(fields.get("warc-refers-to")), _bare(fields.get("warc-target-uri")), digest_of and digest_of.partition(":")[2], whole)
        declared_sha1 = digest_of.partition(":")[2].upper() if digest_of and digest_of.lower().startswith("sha1:") else None
        digest, so_far, chunk_no = hashlib.sha1(), 0, 0
        while True:
            data = stream.read(min(left, chunk_bytes))
            if left and not data:
                raise EOFError(f"record {same[0]} ends {left} bytes early")
            left -= len(data)
            so_far += len(data)
            digest.update(data)
            found = base64.b32encode(digest.digest()).decode()
            intact = None
            if left == 0 and declared_sha1 and fields["warc-type"] != "revisit":
                intact = found == declared_sha1 and so_far == whole
            yield (*same, chunk_no, data, so_far, found, left == 0, intact)
            chunk_no += 1
            if left == 0:
                break


def opened(raw: io.BufferedReader) -> io.BufferedReader:
    """An archive's bytes, whether it is compressed or not."""
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def read_chunks(manifest: DataFrame, chunk_bytes: int = 1 << 16, with_data: bool = True, batch_bytes: int = 1 << 23) -> DataFrame:
    """The chunk rows of all archives of a manifest; one task reads an archive."""
    ship(manifest.sparkSession)
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[c.split()[1]] for c in CHUNKS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(types), types, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for file in batch.column("file").to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                with store.open_input_stream(path, compression=None) as raw:
                    for row in records_of(opened(io.BufferedReader(raw, 1 << 16)), chunk_bytes):
                        held += len(row[7]) + 200
                        rows.append(row if with_data else (*row[:7], None, *row[8:]))
                        if held >= batch_bytes:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    n = max(1, manifest.count())
    return manifest.select("file").repartition(n).mapInArrow(read, CHUNKS)


def round_trip(pages: DataFrame, id_column: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """Archives the pages and describes each record as read back."""
    records = pages.select(F.col(id_column).cast("long").alias("id"), F.col(url).alias("url"), F.col(payload).alias("payload"))
    manifest = write_archives(with_revisits(records, least_bytes), f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}")
    read = read_chunks(manifest, with_data=False).filter("last")
    damaged = F.raise_error(F.concat(F.lit("damaged record "), "record_id"))
    read = read.withColumn("record_type", F.when(F.col("intact"), F.col("record_type")).when(F.col("intact").isNull(), F.col("record_type")).otherwise(damaged))
    own = F.col("record_type") == "response"
    page = lambda c: F.regexp_extract(c, "^urn:page:(-?[0-9]+)$", 1).try_cast("bigint")
    return read.select(
        page("record_id").alias(id_column),
        F.when(own, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(own, F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
