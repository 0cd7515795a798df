import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from tarnwork.llm import token_store as K

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_library(library):
    r = random.Random(1)
    alphabet = " \t\n\r ab'st1.éß中\xa0’\x1c <|endoftext|>"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 50))) for _ in range(3000)] + ["<|endoftext|> a", "  ", "a ", "", "😀 x", "I'll don't 's 're", "\xa0  b", "a \xa0 \xa0b"]
    w = K.WordEncoder(PATH)
    w.CACHE_UNITS = 500
    for k in range(0, len(texts), 97):
        part = texts[k : k + 97]
        for raw, t in zip(w.encode(pa.array(part)), part):
            assert np.frombuffer(raw, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_round_trip_through_files(spark, tmp_path, library):
    docs = [(3, "three words here"), (1, None), (2, ""), (None, "null key"), (3, "again the same id"), (10, "x y z " * 5000)] + [(100 + i, f"document number {i} with some words") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = f"file://{tmp_path}/tokens"
    files = K.write_shards(df, PATH, out)
    got = K.read_shards(files, out, with_ids=True).collect()
    assert len(got) == len(docs)
    start = 0
    for r, (key, _) in zip(sorted(got, key=lambda r: r.start), sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))):
        assert (r.doc_id, r.start) == (key, start)
        start += r.n_tokens
        assert r.ids[-1] == 2 and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids))
    want = sorted(str(library.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in docs)
    assert sorted(str(list(r.ids)) for r in got) == want
    assert sorted(x.tolist() for x in K.fetch(files, out, 3)) == sorted(library.encode(t, add_special_tokens=False).ids + [2] for k, t in docs if k == 3)


def test_short_documents_are_read_by_their_own_bytes(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(K, "SHARD_BYTES", 40_000)
    docs = [(i, " ".join(f"word{(i * 7919 + k * 104729) % 99991}" for k in range(400))) for i in range(300)]
    out = f"file://{tmp_path}/seek"
    files = K.write_shards(spark.createDataFrame(docs, "doc_id long, text string"), PATH, out, dictionary=b"")
    spans = sorted((r.first_key, r.last_key) for r in files.collect())
    assert len(spans) > 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    total = sum(f.stat().st_size for f in (tmp_path / "seek").iterdir())
    seen, real = [], K.filesystem

    class Counting:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.f.close()

        def size(self):
            return self.f.size()

        def read_at(self, n, at):
            seen.append(n)
            return self.f.read_at(n, at)

    class Files:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, p):
            return Counting(self.fs.open_input_file(p))

    monkeypatch.setattr(K, "filesystem", lambda uri: (Files(real(uri)[0]), real(uri)[1]))
    [ids] = K.fetch(files, out, 123)
    assert ids.tolist() == library.encode(docs[123][1], add_special_tokens=False).ids + [2]
    assert sum(seen) < total / 50 and K.fetch(files, out, 10**6) == []


def test_a_hot_key_is_dealt_over_tasks(spark, tmp_path):
    docs = [(None, f"row {i}") for i in range(3000)] + [(i, "x") for i in range(30)]
    out = f"file://{tmp_path}/hot"
    files = K.write_shards(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), PATH, out, dictionary=b"")
    parts = {r.part: r.documents for r in files.collect()}
    assert len(parts) > 1 and max(parts.values()) < 2500
    got = K.read_shards(files, out).collect()
    assert len(got) == 3030 and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None] * 3000 + list(range(30))
    assert len(K.fetch(files, out, None)) == 3000


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert K.store_tokens(df, PATH, f"file://{tmp_path}/none").collect() == []


def test_damage_is_seen():
    data = bytearray(K.pack_shard([1, 2], [b"\1\0\0\0" * 9, b"\2\0\0\0"], b""))
    assert K.Shard(bytes(data)).ids(1).tolist() == [2]
    for bad in (bytes(data[:-3]), b"XXXX" + bytes(data[4:]), bytes(data[:6]) + b"\xff" + bytes(data[7:])):
        with pytest.raises(ValueError):
            K.Shard(bad)
