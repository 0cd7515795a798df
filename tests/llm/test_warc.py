import hashlib
import struct

import pytest

from tarnwork.llm import warc as W


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 300 + "</p>"
    rows = [(5, "http://a", big), (3, "http://b\r\n c", big), (9, None, big), (9, "http://d", big), (1, "http://e", "short"), (2, "http://f", "short"), (4, "http://g", None), (None, "http://h", big), (6, "http://i", "é" * 50), (7, "http://j", "é" * 50), (8, "x", "a" * 3_000_000)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    out = f"file://{tmp_path}/warc"
    files = W.write_archives(df, out, dictionary=b"<p>xxxxxxxx</p>" * 20)
    got = W.read_archives(files, out, with_payload=True).collect()
    assert len(got) == len(rows)
    want = []
    for page, _, html in rows:
        p = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == p and i is not None]
        first = min(same) if same else None
        revisit = len(p) >= 100 and page != first
        want.append((page, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first if revisit else None, None if revisit else p))
    assert sorted(map(str, want)) == sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))) for r in got)
    assert {r.url for r in got if r.page_id == 3} == {"http://b%0D%0A%20c"}
    assert W.archive_pages(df.limit(0), f"file://{tmp_path}/none").count() == 0


def record(**change):
    kw = dict(page_id=1, url="http://a", payload=b"hello", digest=hashlib.sha256(b"hello").hexdigest(), refers_to=None, revisit=False) | change
    return W.build_record(**kw)


def test_bad_records_are_refused():
    assert W.parse_record(record())["payload"] == b"hello"
    good = record()
    for bad in (good.replace(b"WARC/1.1", b"WARX/1.1"), good.replace(b"WARC-Date", b"WARC-Dote"), good[:-2], good.replace(b"hello", b"hellp"), record(digest="0" * 64), good.replace(b"Content-Length: 5", b"Content-Length: 6"), good.replace(b"response\r\nWARC-R", b"metadata\r\nWARC-R")):
        with pytest.raises((ValueError, KeyError)):
            W.parse_record(bad)


def test_dictionary_frames():
    import zstandard

    words = [f"<li>item {i} of the list with common words</li>".encode() * 3 for i in range(400)]
    d = zstandard.train_dictionary(2048, words).as_bytes()
    c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d))
    frames = [c.compress(record(page_id=i)) for i in range(5)]
    packed = W.archive_head(d) + b"".join(frames)
    raw = struct.pack("<II", W.DICT_FRAME, len(d)) + d + b"".join(frames)
    for data in (packed, raw):
        assert W.load_dictionary(memoryview(data))[0] == d
        assert [r["page_id"] for r in W.read_archive(data)] == list(range(5))
    for bad in (packed[:-3], packed + b"junk!!", packed[:20]):
        with pytest.raises(ValueError):
            list(W.read_archive(bad))
