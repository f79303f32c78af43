import gzip
import hashlib
import io

from cardloom.llm import warc
from cardloom.sources.storage import shared_folder


def test_round_trip(spark):
    big = "aé" * 200_000
    rows = [(1, "u\r\nx", big), (2, None, big), (3, "é", None), (4, "b", ""), (5, "c", "z"), (None, "d", "z"), (7, "e", "\r\n\r\nWARC/1.1\r\n"), (8, "f", "one"), (8, "f", "one")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    facts = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str)
    assert facts == sorted([(1, 600_000, "revisit", 2), (2, 600_000, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 1, "response", None), (None, 1, "revisit", 5), (7, 14, "response", None), (8, 3, "response", None), (8, 3, "response", None)], key=str)
    assert {r.payload_digest for r in got if r.page_id == 1} == {warc.base32_sha1(hashlib.sha1(big.encode()).hexdigest())}


def test_small_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", "xyz"), (4, "a", "xyz")], "page_id long, url string, html string")
    assert {r.page_id: r.record_type for r in warc.round_trip(df, least_bytes=2).collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_chunks_carry_running_digests(spark):
    text = "0123456789" * 10
    records = spark.createDataFrame([(1, "u", text)], "id long, url string, payload string")
    manifest = warc.write_archives(warc.with_revisits(records), f"{shared_folder(spark)}/chunks", chunk_bytes=7, archive_bytes=50)
    rows = warc.read_chunks(manifest, chunk_bytes=9).orderBy("chunk_no").collect()
    assert b"".join(bytes(r.data) for r in rows).decode() == text and [r.last for r in rows] == [False] * 11 + [True]
    for r in rows:
        assert r.digest_so_far == warc.base32_sha1(hashlib.sha1(text[: r.bytes_so_far].encode()).hexdigest())
    assert rows[-1].digest_so_far == rows[-1].declared_digest
    plain = gzip.decompress(open(manifest.first().file.removeprefix("file://"), "rb").read())
    assert plain.startswith(b"WARC/1.1\r\n") and plain.endswith(b"\r\n\r\n")


def test_other_records_are_skipped_and_short_ones_are_errors():
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert list(warc.records_of(io.BufferedReader(io.BytesIO(info)), 3)) == []
    cut = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:A\r\nContent-Length: 50\r\n\r\nHTTP/1.1 200 OK\r\n\r\nabc"
    try:
        list(warc.records_of(io.BufferedReader(io.BytesIO(cut)), 3))
    except EOFError:
        return
    raise AssertionError("a cut record was read")


def test_foreign_archives_are_read(spark, tmp_path):
    parts = [
        b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1-2>\r\nWARC-Target-URI: <http://a/>\r\nContent-Type: application/http;\r\n msgtype=response\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:3>\r\nContent-Type: text/dns\r\nContent-Length: 9\r\n\r\n1 A 1.2.3\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:4>\r\nWARC-Payload-Digest: sha1:X\r\nContent-Length: 3\r\n\r\n\xff\x00z\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:5>\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: many\r\n\r\n\r\n\r\n",
    ]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "small.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    files = spark.createDataFrame([(f"file://{tmp_path}/{f}",) for f in ("plain.warc", "small.warc.gz")], "file string")
    got = [(r.record_id, r.record_type, bytes(r.data), r.declared_digest, r.target_uri) for r in warc.read_chunks(files).collect()]
    want = [("urn:uuid:1-2", "response", b"body", None, "http://a/"), ("urn:uuid:3", "response", b"1 A 1.2.3", None, None), ("urn:uuid:4", "resource", b"\xff\x00z", "X", None)]
    assert sorted(x for x in got if x[0] != "urn:uuid:5") == sorted(want * 2) and len(got) == 8


def test_other_columns_and_hot_payloads(spark):
    df = spark.range(500).selectExpr("id AS page_id", "'u' AS url", "if(id % 3 = 0, 'hot', concat('p', id)) AS html", "'x' AS head", "1 AS sha1", "2 AS payload")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(df).collect()}
    assert all(got[i] == (("revisit", 498) if i % 3 == 0 and i != 498 else ("response", None)) for i in range(500))


def test_damaged_records_are_told(spark, tmp_path):
    body = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x:%d>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 3\r\n\r\n%s\r\n\r\n"
    digest = warc.base32_sha1(hashlib.sha1(b"abc").hexdigest()).encode()
    short = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:4>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 41\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n" % digest
    parts = [body % (1, digest, b"abc"), body % (2, digest, b"abd"), body % (3, b"md5"[:0] + digest.lower(), b"abc"), short]
    (tmp_path / "x.warc").write_bytes(b"".join(parts).replace(b"Content-Length: 41", b"Content-Length: %d" % len(b"HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nabc")))
    got = {r.record_id: r.intact for r in warc.read_chunks(spark.createDataFrame([(f"file://{tmp_path}/x.warc",)], "file string")).collect()}
    assert got == {"urn:x:1": True, "urn:x:2": False, "urn:x:3": True, "urn:x:4": False}
