import base64
import gzip
import hashlib

import pytest

from logloom.llm.warc import ARC_FIELDS, pages_to_warc, parse_arc, parse_warc, read_arc, write_arc


def sha(p):
    return base64.b32encode(hashlib.sha1(p).digest()).decode()


def check(spark, rows, **kwargs):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder, records = pages_to_warc(pages, **kwargs)
    found = records.collect()
    least = kwargs.get("least_payload", 0)
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in payloads:
        if i is not None and first.get(p, -1) is not None:
            first[p] = max(first.get(p, i), i)
    want = []
    counted = set()
    for i, p in sorted(payloads, key=lambda x: (x[0] is None, x[0])):
        own = len(p) < least or p not in first or (first[p] == i and p not in counted)
        if own and len(p) >= least:
            counted.add(p)
        want.append((i, len(p), sha(p), "response" if own else "revisit", None if own else first[p]))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=str) == sorted(want, key=str)
    return folder, found


def test_round_trip_of_the_table(spark):
    from tests.conftest import SF_SMALL
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    folder, found = check(spark, rows, archive_bytes=1 << 18)
    files = [p for p, in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path").collect()]
    assert len(files) > 1


def test_edges(spark):
    rows = [(1, "http://a b/", None), (2, None, ""), (None, "", " x\r\n\r\nWARC/1.1\r\n"), (3, "u", "é\n\n" * 10), (3, "u", "é\n\n" * 10), (9, "u\nv", ""),
            (4, "dns:x", "HTTP/1.1 200 OK\r\n\r\nnot a header"), (5, "http://l/", "filedesc://x 0 0 0 5\n" * 200_000), (6, "http://m/", "\x00\x01\r\n")]
    check(spark, rows)
    check(spark, rows, least_payload=1)
    check(spark, rows, archive_bytes=1)


def test_a_third_of_all_pages_is_one_page(spark):
    check(spark, [(i, f"http://h/{i}", "same" if i % 3 == 0 else f"own {i}") for i in range(300)])


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages_to_warc(pages)[1].collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_truncation_and_spaces(version):
    body = f"{version} 0 test\n{ARC_FIELDS[version]}\n".encode()
    rest = "" if version == 1 else "200 - - 0 f "
    records = [("http://a/ b", b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nhello\n"), ("dns:a", b"1.2.3.4\n\n")]
    arc = f"filedesc://f 0.0.0.0 20010203 text/plain {rest}{len(body)}\n".encode() + body
    for uri, doc in records:
        arc += f"\n{uri} 1.2.3.4 200102030405 text/html {rest}{len(doc)}\n".encode() + doc
    found = list(parse_arc("f", gzip.compress(arc)))
    assert [(r[2], r[3], r[5], r[8], r[9], r[11]) for r in found] == [
        (version, "http://a/ b", "2001-02-03T04:05:00Z", 7, False, b"hello\n"), (version, "dns:a", "2001-02-03T04:05:00Z", None, False, b"1.2.3.4\n\n")]
    assert [r[9] for r in parse_arc("f", arc[:-3])] == [False, True]
    with pytest.raises(ValueError, match="no length"):
        list(parse_arc("f", arc + b"\nhttp://a 1 2 3 x\n"))


def test_both_arc_versions_are_written(spark):
    import uuid

    from logloom.session import ensure_checkpoint_dir
    folder = f"{ensure_checkpoint_dir(spark)}/test-arc-{uuid.uuid4().hex}"
    write_arc(spark.range(40).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat('x', 1000) as html").coalesce(1), folder, archive_bytes=4000)
    found = read_arc(spark, folder).collect()
    assert {r.version for r in found} == {1, 2} and sorted(r.page_id for r in found) == list(range(40))


def test_parse_warc_rejects_what_is_not_warc():
    with pytest.raises(ValueError, match="not a WARC"):
        list(parse_warc(b"hello\r\n"))


def test_ordinary_archives(spark, tmp_path):
    """Records of other writers: no HTTP header, no length field in it, or one in lower case; all of them twice."""
    from logloom.llm.warc import convert_to_warc, read_warc
    messages = [("dns:h", b"20240101 1.2.3.4"), ("http://h/a", b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\nbody a"),
                ("http://h/b", b"HTTP/1.0 200 OK\r\ncontent-length: 6\r\n\r\nbody b"), ("http://h/c", b"HTTP/1.1 204 No Content\r\n\r\n")]
    head = b"1 0 test\n" + ARC_FIELDS[1].encode() + b"\n"
    content = b"filedesc://t 0.0.0.0 20240101000000 text/plain %d\n" % len(head) + head
    for uri, m in messages * 2:
        content += f"{uri} 1.2.3.4 20240102030405 text/html {len(m)}\n".encode() + m + b"\n"
    (tmp_path / "arc" / "archive=t").mkdir(parents=True)
    (tmp_path / "arc" / "archive=t" / "part.arc").write_bytes(content)
    convert_to_warc(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    found = read_warc(spark, str(tmp_path / "warc")).collect()
    payloads = [b"20240101 1.2.3.4", b"body a", b"body b", b""]
    assert sorted((r.payload_bytes, r.payload_digest) for r in found) == sorted((len(p), sha(p)) for p in payloads * 2)
    assert sorted(r.record_type for r in found) == sorted(["resource", "response", "response", "response"] + ["revisit"] * 4)


def test_revisits_of_other_writers():
    """Without this library's length field the HTTP header decides, in any case; without both the size is null."""
    def revisit(http):
        lines = ["WARC/1.1", "WARC-Type: revisit", "WARC-Record-ID: <urn:x>", "WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: application/http", f"Content-Length: {len(http)}"]
        return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"
    sizes = [next(parse_warc(revisit(h)))[1:3] for h in (b"HTTP/1.1 200 OK\r\ncontent-LENGTH:  12 \r\n\r\n", b"HTTP/1.1 200 OK\r\n\r\n", b"")]
    assert sizes == [(12, None), (None, None), (None, None)]
