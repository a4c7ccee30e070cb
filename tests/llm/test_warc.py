import gzip

import pytest

from forecourt.llm import warc as W

ROWS = [
    (1, "http://a/b c%20\t?x", "<p>é\r\n\r\nWARC/1.0\r\n\r\n</p>"),
    (2, None, None),
    (3, "", ""),
    (4, "-", "same"),
    (5, "%", "same"),
    (9, "http://日本/\u3000", "same"),
    (9, "http://日本/\u3000", "same"),
    (None, "u", "same"),
    (None, "u", "only nulls"),
    (None, "v", "only nulls"),
    (7, "big", "x" * 300000 + "\n"),
]
KIND = "page_id long, url string, html string, payload string, first int"


def archives(spark, tmp_path, rows, min_bytes=0):
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], KIND)
    for version in (1, 2):
        W.write_archive(W.arc_records(df.where(f"coalesce(page_id, 0) % 2 = {version - 1}"), version), str(tmp_path / f"arc/v{version}"))
    W.convert(spark, str(tmp_path / "arc/*"), str(tmp_path / "warc"), min_bytes)
    return W.read_warc(spark, str(tmp_path / "warc"), payloads=True).collect()


@pytest.mark.parametrize("least", [0, 5])
def test_records_come_back_with_revisits(spark, tmp_path, least):
    got = sorted(([r["page_id"], r["url"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], None if r["payload"] is None else r["payload"].decode()] for r in archives(spark, tmp_path, ROWS, least)), key=repr)
    want = []
    for page, url, html in ROWS:
        raw = (html or "").encode()
        ids = [p for p, _, h in ROWS if (h or "") == (html or "") and p is not None]
        top = max(ids, default=None) if len(raw) >= least else None
        other = top is not None and top != page
        want.append([page, url, len(raw), W.sha1_32(raw), "revisit" if other else "response", top if other else None, None if other else html or ""])
    assert got == sorted(want, key=repr)


def test_both_versions_of_arc_are_read_by_declared_lengths():
    body = "1 0 local\n" + W.ARC_FIELDS[1] + "\n"
    block = b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\nhttp://x 0.0.0.0 1 t 3\nabc\n"
    one = f"filedesc://f 0.0.0.0 20240101000000 text/plain {len(body)}\n{body}\nhttp://a%20b 1.2.3.4 20010203040506 text/html {len(block)}\n".encode() + block + b"\n"
    row = list(W.arc_pages(gzip.compress(one[:40]) + gzip.compress(one[40:])))
    assert row == [(5, "5", "http://a b", "20010203040506", "text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: 5", b"http://x 0.0.0.0 1 t 3\nabc\n")]
    assert list(W.arc_pages(one)) == row
    body = "2 0 local\n" + W.ARC_FIELDS[2] + "\n"
    two = f"filedesc://f 0.0.0.0 20240101000000 text/plain 200 - - 0 f {len(body)}\n{body}\n-  ".encode()
    with pytest.raises(ValueError):
        list(W.arc_pages(gzip.compress(two[:-3] + f"u 0.0.0.0 1 t 200 - - 0 f 99\n{'x' * 20}".encode())))
    with pytest.raises(ValueError):
        list(W.arc_pages(gzip.compress(one.replace(b"URL", b"url"))))


def test_synthesised_fields():
    record = W.warc_record(5, "5", "u r", "20010203040506", "text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: 5", b"abc", None, "a9993e364706816aba3e25717850c26c9cd0d89d", 3)
    head = dict(line.split(": ", 1) for line in record.decode().split("\r\n\r\n")[0].split("\r\n")[1:])
    assert head["WARC-Date"] == "2001-02-03T04:05:06Z" and head["WARC-Type"] == "response" and head["WARC-Target-URI"] == "u%20r"
    assert head["WARC-Payload-Digest"] == f"sha1:{W.sha1_32(b'abc')}" and head["WARC-Record-ID"].startswith("<urn:uuid:")
    again = W.warc_record(6, "6", "u", "20010203040506", "text/html", b"HTTP/1.1 200 OK", None, 5, "a9993e364706816aba3e25717850c26c9cd0d89d", 3)
    assert f"WARC-Refers-To: {head['WARC-Record-ID']}" in again.decode()
    with pytest.raises(ValueError):
        list(W.warc_rows(gzip.compress(record.replace(b"abc", b"abd"))))


def test_foreign_archives_are_converted(spark, tmp_path):
    """Records without a page number, lookups without an HTTP head, Latin-1 bytes, urls with spaces, short dates, bare line ends."""
    body = "1 0 somewhere\n" + W.ARC_FIELDS[1] + "\n\n"
    latin = "HTTP/1.0 200 OK\nContent-Type: text/html; charset=iso-8859-1\n\n".encode() + "caf\xe9".encode("latin-1")
    bodies = [
        ("dns:example.org 1.2.3.4 20010203040506 text/dns", b"20010203040506\nexample.org. 1 IN A 1.2.3.4\n"),
        ("http://example.org/a b 1.2.3.4 20010203040506 text/html", latin),
        ("http://ex\xe4mple.org/ 1.2.3.4 2001 text/html", latin),
        ("http://example.org/empty 1.2.3.4 20010203040506 no-type", b""),
        ("http://example.org/head 1.2.3.4 20010203040506 text/html", b"HTTP/1.0 304 Not Modified"),
    ]
    data = f"filedesc://f 0.0.0.0 20010203040506 text/plain {len(body)}\n{body}\n".encode()
    for line, block in bodies:
        data += f"{line} {len(block)}\n".encode("latin-1") + block + b"\n"
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "a.arc").write_bytes(data)
    (tmp_path / "old" / "b.arc.gz").write_bytes(gzip.compress(data))
    W.convert(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    got = [(r["url"], r["record_type"], bytes(r["payload"])) for r in W.read_warc(spark, str(tmp_path / "new"), payloads=True).where("page_id is null").collect()]
    want = [
        ("dns:example.org", "resource", bodies[0][1]),
        ("http://example.org/a b", "response", b"caf\xe9"),
        ("http://ex\xe4mple.org/", "response", b"caf\xe9"),
        ("http://example.org/empty", "resource", b""),
        ("http://example.org/head", "response", b""),
    ]
    assert sorted(got) == sorted(want * 2)


def test_every_record_is_a_gzip_member_of_its_own(spark, tmp_path):
    import zlib

    archives(spark, tmp_path, ROWS)
    seen = 0
    for path in (tmp_path / "warc").glob("part-*"):
        data = path.read_bytes()
        while data:
            one = zlib.decompressobj(31)
            text = one.decompress(data)
            assert one.eof and (not text or text.startswith(b"WARC/1.0\r\n") and text.endswith(b"\r\n\r\n"))
            seen += bool(text)
            data = one.unused_data
    assert seen == len(ROWS)


def test_empty_table(spark, tmp_path):
    assert archives(spark, tmp_path, []) == []
