"""Zstandard WARC archives: writer, and a reader that decodes one frame per record.

A file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, raw or itself
compressed; then each record is one frame compressed against it. Responses carry an HTTP head and the
payload; revisits carry the head alone and refer to the record with the same payload digest. The reader
checks frame bounds, version line, mandatory headers, lengths and payload digests, and raises on the first fault.

Of rows with equal payloads of at least MIN_SHARED bytes, the one with the smallest page_id is the
response. Defined cases: null html is an empty payload; rows that repeat the smallest page_id are all
responses; a null page_id is never the smallest unless all are null; a null url has no target header; control characters in
urls are percent-encoded; an empty table gives no archives.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PartFile, bounded_sample, cut, filesystem, fresh_dir

DICT_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
MIN_SHARED = 100
DICT_PAGES, DICT_BYTES = 1000, 1 << 16
ARCHIVE_BYTES = 24 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# records


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'-' if page_id is None else page_id}>"


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, what: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, sep, value = line.partition(":")
        if not sep or not name or name != name.strip():
            raise ValueError(f"malformed {what} header: {line[:80]!r}")
        out[name.lower()] = value.strip()
    return out


def _page(ref: str) -> int | None:
    if not (ref.startswith("<urn:page:") and ref.endswith(">")):
        raise ValueError(f"unknown record id: {ref[:80]!r}")
    return None if ref[10:-1] == "-" else int(ref[10:-1])


def parse_record(record: bytes) -> dict:
    """page_id, url, payload (None for a revisit), payload_bytes, payload_digest, record_type, refers_to."""
    top, sep, rest = record.partition(b"\r\n\r\n")
    version, _, fields = top.partition(b"\r\n")
    if not sep or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC version line or header end")
    h = _headers(fields, "WARC")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in h:
            raise ValueError(f"no {name}")
    size = int(h["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("block length differs from Content-Length")
    kind = h["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type: {kind}")
    http, sep, payload = rest[:size].partition(b"\r\n\r\n")
    status, _, http_fields = http.partition(b"\r\n")
    if not sep or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP head")
    n = int(_headers(http_fields, "HTTP")["content-length"])
    algorithm, _, digest = h.get("warc-payload-digest", "").partition(":")
    if algorithm != "sha256" or len(digest) != 64:
        raise ValueError("no SHA-256 payload digest")
    if kind == "response":
        if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload differs from its length or digest")
    elif payload or "warc-refers-to" not in h or "warc-profile" not in h:
        raise ValueError("malformed revisit")
    return {"page_id": _page(h["warc-record-id"]), "url": h.get("warc-target-uri"), "payload": payload if kind == "response" else None, "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": _page(h["warc-refers-to"]) if kind == "revisit" else None}


# archives


def archive_head(dictionary: bytes) -> bytes:
    """The leading skippable frame; the dictionary in it is compressed on its own."""
    import zstandard

    body = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary) if dictionary else b""
    return struct.pack("<II", DICT_FRAME, len(body)) + body


def load_dictionary(data: memoryview) -> tuple[bytes, int]:
    """The dictionary of the leading skippable frame and where the records start; empty without such a frame."""
    import zstandard

    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICT_FRAME:
        return b"", 0
    size = struct.unpack_from("<I", data, 4)[0]
    if 8 + size > len(data):
        raise ValueError("truncated dictionary frame")
    body = bytes(data[8 : 8 + size])
    if len(body) >= 4 and struct.unpack_from("<I", body)[0] == ZSTD_FRAME:
        body = zstandard.ZstdDecompressor().decompress(body)
    return body, 8 + size


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at `at` ends, from its header and block headers alone."""
    if at + 6 > len(data) or struct.unpack_from("<I", data, at)[0] != ZSTD_FRAME:
        raise ValueError(f"no frame at byte {at}")
    flags = data[at + 4]
    single = flags >> 5 & 1
    size_bytes = (1 if single else 0, 2, 4, 8)[flags >> 6]
    pos = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + size_bytes
    while True:
        if pos + 3 > len(data):
            raise ValueError("truncated frame")
        head = data[pos] | data[pos + 1] << 8 | data[pos + 2] << 16
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise ValueError("truncated frame")
    return pos


def read_archive(data: bytes):
    """Yield the parsed records of an archive's bytes, decoding one frame at a time."""
    import zstandard

    view = memoryview(data)
    dictionary, at = load_dictionary(view)
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    while at < len(view):
        end = frame_end(view, at)
        if zstandard.frame_content_size(view[at:end]) < 0:
            raise ValueError("a record frame must state its size")
        yield parse_record(d.decompress(view[at:end]))
        at = end


def mark_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (not null), digest, first (page_id of the response with the same payload, if it is another's).

    Payloads meet by digest: counts and minima are combined before the shuffle, and only digests that occur twice are joined back.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("bytes", F.octet_length("html").cast("long"))
    shared = rows.where(F.col("bytes") >= MIN_SHARED).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1").select(F.col("digest").alias("shared"), "first")
    long_enough = (F.col("digest") == F.col("shared")) & (F.col("bytes") >= MIN_SHARED)
    return rows.join(shared, long_enough, "left").select("page_id", "url", "html", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))


def train_dictionary(pages: DataFrame) -> bytes:
    """From at most DICT_PAGES payloads, those with the smallest hash of their id, whatever the size of pages."""
    import zstandard

    rows = bounded_sample(pages.select("page_id", F.coalesce(F.col("html"), F.lit("")).alias("html")), "page_id", DICT_PAGES)
    samples = sorted(b for b in (r["html"].encode() for r in rows.select("html").collect()) if b)
    if len(samples) < 64:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, out_dir: str, dictionary: bytes | None = None) -> DataFrame:
    """Write one record per row; a row per archive: file, records. Files get their name only when whole."""
    spark = pages.sparkSession
    if dictionary is None:
        dictionary = train_dictionary(pages)
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICT_BYTES

    def write(batches):
        import zstandard

        c = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared.value)) if shared.value else zstandard.ZstdCompressor(level=LEVEL)
        head, file, records = archive_head(shared.value), None, 0

        def closed():
            file.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["file", "records"])

        for b in batches:
            columns = [b.column(k) for k in range(5)]
            for i in range(b.num_rows):
                page_id, url, html, digest, first = (col[i].as_py() for col in columns)
                if file is None:
                    name, records = f"{uuid.uuid4().hex}.warc.zst", 0
                    file = PartFile(f"{out_dir}/{name}")
                    file.write(head)
                file.write(c.compress(build_record(page_id, url, html.encode(), digest, first, first is not None)))
                records += 1
                if file.size >= ARCHIVE_BYTES:
                    yield closed()
                    file = None
        if file is not None:
            yield closed()

    return cut(mark_revisits(pages).mapInArrow(write, "file string, records long"))


FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_archives(files: DataFrame, out_dir: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the named archives; each task opens its own files."""
    spark = files.sparkSession
    fields = FIELDS + (", payload binary" if with_payload else "")
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[f.split()[1]] for f in fields.split(", ")]
    dealt = files.select("file").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file")

    def read(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                fs, path = filesystem(f"{out_dir}/{name}")
                with fs.open_input_stream(path, compression=None) as f:
                    data = f.read()
                rows: list[list] = []
                for r in read_archive(data):
                    rows.append([r[k] for k in names])
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    return dealt.mapInArrow(read, fields)


def archive_pages(pages: DataFrame, out_dir: str | None = None) -> DataFrame:
    """Write all pages and read the archives back."""
    out_dir = out_dir or fresh_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, out_dir), out_dir)
