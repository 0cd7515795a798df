"""Token ids in compressed shard files with a shared dictionary.

File format (all integers little-endian):
  magic "TKS1" | u8 version | 32 bytes SHA-256 of the dictionary | u64 dictionary bytes
  dictionary | frames | index: per document i64 key, u64 frame offset, u32 ids | u64 index offset | u64 documents | magic
Each document is one zstandard frame of its ids as unsigned 32-bit integers, compressed against the
dictionary. `fetch` reads a document from the files whose key range holds it: tail, dictionary, index and its own frame.
Files lie in ascending key order: by name, and within each file.

The dictionary is trained on the serialized ids of about DICT_DOCS documents, those in a range of the hash
of their id; with too few documents for training it is empty. Files are written to a temporary name
and renamed, so a retried task leaves whole files only; readers use just the files whose tasks succeeded.

Defined cases: a null text is empty (only the end id); a null key sorts first and is kept; repeated
keys are separate documents in the order of the input, dealt over several tasks if they are many; an empty table has no files.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PartFile, bounded_sample, cut, filesystem, flat_text, fresh_dir, text_slices

MAGIC, VERSION = b"TKS1", 1
HEAD = struct.Struct("<4sB32sQ")
ENTRY = np.dtype([("key", "<i8"), ("offset", "<u8"), ("ids", "<u4")])
TAIL = struct.Struct("<QQ4s")
DICT_DOCS, DICT_BYTES = 2000, 1 << 16
NULL_KEY = -(2**63)
LEVEL = 3
SHARD_BYTES = 24 << 20

# Ranges in which all Unicode versions agree on letters and numbers, with only ASCII spaces; other texts go whole to the library.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-ȳ‐-‧‰-⁞₠-₵一-龥ぁ-ゖァ-ヺ]*")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True
_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """The library's encoder with its results per unit (spaces and the word after them) in a bounded cache.

    A byte-level pre-token never spans a change from other than space to space, so units end there.
    Arrow makes the units of a slice distinct; new ones go to the library joined to long texts, and
    the byte lengths of the tokens tell which ids belong to which unit.
    """

    CACHE_UNITS = 1_000_000

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        size = self.lib.get_vocab_size()
        self.bytes_of = np.array([len(t) if set(t := self.lib.id_to_token(i) or "") <= alphabet else 0 for i in range(size)], np.int64)
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _add(self, new: list[bytes]) -> None:
        lone = [u for u in new if not _BLANK[u[0]] or u.isspace()]
        for u in lone:
            self.cache[u] = self._whole(u.decode())
        skip = set(lone)
        joined = [u for u in new if u not in skip]
        for i in range(0, len(joined), 20_000):
            part = joined[i : i + 20_000]
            ids = np.array(self.lib.encode_batch_fast([b"".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
            at = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum([len(u) for u in part]), "right")
            raw, start = ids.tobytes(), 0
            for u, end in zip(part, (at * 4).tolist()):
                self.cache[u] = raw[start:end]
                start = end

    def _plain(self, texts: pa.Array) -> list[bytes]:
        buf, offs = flat_text(texts)
        if len(buf) == 0:
            return [b""] * len(texts)
        blank = _BLANK[buf]
        begin = np.zeros(len(buf), bool)
        begin[1:] = blank[1:] & ~blank[:-1]
        begin[offs[:-1][np.diff(offs) > 0]] = True
        cuts = np.append(np.flatnonzero(begin), len(buf))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(buf))]).dictionary_encode()
        names = units.dictionary.to_pylist()
        new = [u for u in names if u not in self.cache]
        if len(self.cache) + len(new) > self.CACHE_UNITS:
            self.cache = {u: self.cache[u] for u in names if u in self.cache}
        self._add(new)
        raws = list(map(self.cache.__getitem__, names))
        flat, sizes = np.frombuffer(b"".join(raws), "<u4"), np.fromiter(map(len, raws), np.int64, len(raws)) // 4
        which = units.indices.to_numpy()
        each = sizes[which]
        ends = np.cumsum(each)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - each), each) + np.arange(ends[-1])]
        bound = np.append(0, ends)[np.searchsorted(cuts, offs)]
        return [ids[i:j].tobytes() for i, j in zip(bound[:-1].tolist(), bound[1:].tolist())]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit integers."""
        values = texts.to_pylist()
        plain = [_PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in values]
        fast = iter(self._plain(texts.filter(pa.array(plain, pa.bool_()))))
        return [next(fast) if p else self._whole(t) for t, p in zip(values, plain)]


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> bytes:
    """A dictionary from the ids of at most DICT_DOCS documents, whatever the size of docs."""
    import zstandard

    rows = bounded_sample(docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")), "k", DICT_DOCS)

    def encode(batches):
        enc = encoder(tokenizer_path)
        for b in batches:
            got = enc.encode(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([g + struct.pack("<I", end_id) for g in got], pa.binary())], names=["ids"])

    samples = [bytes(r[0]) for r in rows.select("t").mapInArrow(encode, "ids binary").collect()]
    if len(samples) < 64:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


class ShardWriter:
    """Writes one file through `write`, a frame at a time; only the index stays in memory."""

    def __init__(self, write, dictionary: bytes):
        import zstandard

        self.codec = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        self.write, self.entries, self.ids = write, [], 0
        write(HEAD.pack(MAGIC, VERSION, hashlib.sha256(dictionary).digest(), len(dictionary)) + dictionary)
        self.at = HEAD.size + len(dictionary)

    def add(self, key: int, payload: bytes) -> None:
        frame = self.codec.compress(payload)
        self.write(frame)
        self.entries.append((key, self.at, len(payload) // 4))
        self.at += len(frame)
        self.ids += len(payload) // 4

    def finish(self) -> None:
        self.write(np.array(self.entries, ENTRY).tobytes() + TAIL.pack(self.at, len(self.entries), MAGIC))


def pack_shard(keys: list[int], payloads: list[bytes], dictionary: bytes) -> bytes:
    """One file's bytes."""
    parts: list[bytes] = []
    w = ShardWriter(parts.append, dictionary)
    for k, p in zip(keys, payloads):
        w.add(k, p)
    w.finish()
    return b"".join(parts)


class Shard:
    """A file, checked: magic, version, dictionary hash, index bounds. Given whole bytes, or read(at, n) and the size; frames are read one by one."""

    def __init__(self, data=None, *, read=None, size: int = 0):
        import zstandard

        if read is None:
            view = memoryview(data)
            read, size = lambda at, n: view[at : at + n], len(view)
        if size < HEAD.size + TAIL.size:
            raise ValueError("truncated shard")
        end, n, tail = TAIL.unpack(read(size - TAIL.size, TAIL.size))
        magic, version, digest, d = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC or tail != MAGIC or version != VERSION:
            raise ValueError("not a token shard")
        if end + n * ENTRY.itemsize + TAIL.size != size or HEAD.size + d > end:
            raise ValueError("index bounds differ")
        dictionary = bytes(read(HEAD.size, d))
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError("dictionary hash differs")
        self.index = np.frombuffer(read(end, n * ENTRY.itemsize), ENTRY)
        self.read, self.ends = read, np.append(self.index["offset"][1:], end)
        self.codec = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def __len__(self) -> int:
        return len(self.index)

    def raw(self, i: int) -> bytes:
        """Ids of document i as bytes; only its own frame is decompressed."""
        n = int(self.index["ids"][i]) * 4
        at = int(self.index["offset"][i])
        out = self.codec.decompress(self.read(at, int(self.ends[i]) - at), max_output_size=max(n, 1))
        if len(out) != n:
            raise ValueError("frame length differs from the index")
        return out

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), "<u4")


def write_shards(docs: DataFrame, tokenizer_path: str, out_dir: str, *, end_id: int = 2, key: str = "doc_id", text: str = "text", dictionary: bytes | None = None) -> DataFrame:
    """Encode and write all documents in ascending key order. Returns one row per file: part, number, file, documents, ids, first_key, last_key.

    A range shuffle deals keys and, within a key, row numbers, so that no key goes to one task whole; each task writes the files of its range, split at SHARD_BYTES of raw ids.
    """
    spark = docs.sparkSession
    if dictionary is None:
        dictionary = train_dictionary(docs, tokenizer_path, end_id, key, text)
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICT_BYTES
    rows = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"), F.monotonically_increasing_id().alias("r"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("k").asc_nulls_first(), F.col("r")]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("k", "t")
    end = struct.pack("<I", end_id)

    def write(batches):
        from pyspark import TaskContext

        enc, part, number, file = encoder(tokenizer_path), TaskContext.get().partitionId(), 0, None

        def closed():
            nonlocal number
            shard.finish()
            file.close()
            made = {"part": part, "number": number, "file": name, "documents": len(shard.entries), "ids": shard.ids, "first_key": shard.entries[0][0], "last_key": shard.entries[-1][0]}
            row = pa.RecordBatch.from_arrays([pa.array([v], pa.string() if k == "file" else pa.int64()) for k, v in made.items()], names=list(made))
            number += 1
            return row

        for b in batches:
            ks, column = b.column(0).fill_null(NULL_KEY).to_pylist(), b.column(1)
            for i, j, _, _ in text_slices(column, 4 << 20):
                for k, ids in zip(ks[i:j], enc.encode(column.slice(i, j - i))):
                    if file is None:
                        name = f"{part:06d}-{number:05d}-{uuid.uuid4().hex[:8]}.tks"
                        file = PartFile(f"{out_dir}/{name}")
                        shard = ShardWriter(file.write, shared.value)
                    shard.add(k, ids + end)
                    if shard.ids * 4 >= SHARD_BYTES:
                        yield closed()
                        file = None
        if file is not None:
            yield closed()

    return cut(dealt.mapInArrow(write, "part long, number long, file string, documents long, ids long, first_key long, last_key long"))


def read_shards(files: DataFrame, out_dir: str, *, with_ids: bool = False, with_crc: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 (and ids) of every document in the files.

    Starts come from a running sum over files (one small row each), then over the documents of each file.
    """
    spark = files.sparkSession
    from pyspark.sql import Window

    # files per range are few: sum each range, then run over ranges; only totals of ranges meet in one task
    per_part = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    base = per_part.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("before"))
    starts = files.withColumn("inner", F.sum("ids").over(Window.partitionBy("part").orderBy("number")) - F.col("ids")).join(base, "part").select("file", (F.col("before") + F.col("inner")).alias("base"))
    # small rows of names are dealt over all tasks; each task opens its own files
    blobs = starts.select(F.concat(F.lit(out_dir.rstrip("/") + "/"), "file").alias("path"), "base").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def decode(batches):
        for b in batches:
            for path, base_ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, p = filesystem(path)
                with fs.open_input_stream(p, compression=None) as f:
                    shard = Shard(f.read())
                n = shard.index["ids"].astype(np.int64)
                start = base_ids + np.cumsum(n) - n
                for i in range(0, len(shard), 2000):
                    j = min(i + 2000, len(shard))
                    raws = [shard.raw(k) for k in range(i, j)]
                    keys = shard.index["key"][i:j].astype(np.int64)
                    cols = [pa.array(keys, mask=keys == NULL_KEY), pa.array(start[i:j]), pa.array([len(r) // 4 for r in raws], pa.int64()), pa.array([zlib.crc32(r) for r in raws], pa.int64())]
                    if with_ids:
                        cols.append(pa.array([np.frombuffer(r, "<u4").astype(np.int64) for r in raws], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in fields.split(", ")])

    if files.isEmpty():
        return spark.createDataFrame([], fields)
    return blobs.mapInArrow(decode, fields)


def fetch(files: DataFrame, out_dir: str, doc_id: int | None) -> list[np.ndarray]:
    """The ids of the documents with this key. Opens the files whose key range holds it; of each it reads the dictionary, the index and the frames asked for."""
    key, out = NULL_KEY if doc_id is None else doc_id, []
    for r in files.where((F.col("first_key") <= key) & (F.col("last_key") >= key)).orderBy("part", "number").toLocalIterator():
        fs, p = filesystem(f"{out_dir}/{r['file']}")
        with fs.open_input_file(p) as f:
            shard = Shard(read=lambda at, n, f=f: f.read_at(n, at), size=f.size())
            out += [shard.ids(int(i)) for i in np.flatnonzero(shard.index["key"] == key)]
    return out


def store_tokens(docs: DataFrame, tokenizer_path: str, out_dir: str | None = None, **options) -> DataFrame:
    """Write all documents and read the files back."""
    out_dir = out_dir or fresh_dir(docs.sparkSession, "tokens")
    files = write_shards(docs, tokenizer_path, out_dir, **options)
    return read_shards(files, out_dir)
