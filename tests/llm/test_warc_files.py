"""WARC files: gzip members, records end to end, header names of any case, repeated and folded
fields, other record types, damaged members."""

import gzip
import json

from annolytics.llm import warc


def response(number: int, http: str, body: bytes) -> bytes:
    block = f"HTTP/1.1 200 OK\r\n{http}\r\n\r\n".encode() + body
    return f"WARC/1.1\r\nwarc-type: response\r\nWARC-RECORD-ID: <urn:x:{number}>\r\nwarc-target-uri: http://h/{number}\r\nWARC-Payload-Digest: sha1:{number}\r\ncontent-length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


COOKIES = "Set-Cookie: a=1\r\nset-cookie: b=2\r\nX-Long: one\r\n two\r\nContent-Type: text/html; charset=latin-1"


def files(folder):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x:0>\r\nContent-Length: 10\r\n\r\n\r\n\r\n\r\n\r\nab\r\n\r\n"
    one, two = response(1, COOKIES, "<p>café".encode("latin-1")), response(2, "Content-Type: text/html; charset=nonesuch", b"<p>second" + b" word" * 50_000)
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in (info, one, b"no record at all", two)))
    (folder / "b.warc").write_bytes(one + two)
    (folder / "c.warc.gz").write_bytes(gzip.compress(one + two) + gzip.compress(two)[:150])
    (folder / "e.warc.gz").write_bytes(gzip.compress(one) + b"\0" * 100)
    (folder / "d.warc").write_bytes(b"")
    return one, two


def test_records_of_files(spark, tmp_path):
    files(tmp_path)
    rows = warc.derivatives_of_files(spark, str(tmp_path)).collect()
    by_file = {n: [r for r in rows if r.file.endswith(n)] for n in ("a.warc.gz", "b.warc", "c.warc.gz", "d.warc", "e.warc.gz")}
    assert [(r.record_type, r.refers_to) for r in by_file["b.warc"]] == [(k, f"<urn:x:{i}>") for i in (1, 2) for k in ("metadata", "conversion")]
    assert sorted(r.record_type for r in by_file["a.warc.gz"]) == ["conversion"] * 2 + ["malformed"] + ["metadata"] * 2
    assert not by_file["d.warc"]
    whole = [r for r in by_file["c.warc.gz"] if r.record_type != "malformed"]
    assert [(r.record_id, r.block) for r in whole] == [(r.record_id, r.block) for r in by_file["b.warc"]]
    # the record that is cut, and the member that is
    assert len(by_file["c.warc.gz"]) == len(whole) + 2
    assert [r.record_type for r in by_file["e.warc.gz"]] == ["metadata", "conversion", "malformed"]
    meta, text = by_file["b.warc"][:2]
    assert text.block == "café" and text.source_digest == "sha1:1" and text.headers["WARC-Target-URI"] == "http://h/1"
    http = json.loads(meta.block)["Envelope"]["Payload-Metadata"]["Headers"]
    assert http["Set-Cookie"] == ["a=1", "b=2"] and http["X-Long"] == "one two"
    assert by_file["b.warc"][3].content_length == len("second") + 5 * 50_000


def test_written_members_are_read_again(spark, tmp_path):
    pages = [(1, "u", "<p>One page"), (None, None, None)]
    data = b"".join(gzip.compress(warc.response_record(*p)) for p in pages)
    (tmp_path / "x.warc.gz").write_bytes(data)
    table = warc.derivative_records(spark.createDataFrame(pages, "page_id long, url string, html string"))
    same = ("record_type", "record_id", "refers_to", "target_uri", "source_digest", "block_digest", "content_length", "block")
    read = warc.derivatives_of_files(spark, str(tmp_path / "x.warc.gz"))
    assert sorted(read.select(*same).collect()) == sorted(table.select(*same).collect())
