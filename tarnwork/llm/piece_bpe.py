"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts are split into units that no piece can cross (checked against the vocabulary: a piece has
the space mark only at its start). Distinct units are encoded together on flat symbol arrays: in
each round every unit finds its best pair (lowest rank, that is highest score) with one segmented
minimum and merges its leftmost occurrences at once, then the arrays are compacted, until no unit
has a pair in the vocabulary. Simultaneous merges equal the library's one-by-one order unless a
merge makes a new pair that ranks as well or better; units where that happens merge only
their leftmost best pair in that round.

Defined cases: a null text is empty and gives no ids; unknown characters become byte pieces;
invalid UTF-8 made by byte pieces decodes to U+FFFD per byte, as in the library.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bound_batches, flat_text, release_memory, text_slices

MARK = "▁"
_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    """Pair table and bounded cache of encoded units, built once per Python worker."""

    CACHE_UNITS = 150_000

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.sp, self.size = sp, sp.get_piece_size()
        normal = [i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        self.piece = {i: sp.id_to_piece(i) for i in normal}
        ids = {p: i for i, p in self.piece.items()}
        if any(MARK in p.lstrip(MARK) for p in ids):
            raise ValueError("a piece crosses a word boundary; this model needs whole texts as units")
        scores = sorted({sp.get_score(i) for i in normal}, reverse=True)
        rank = {s: k for k, s in enumerate(scores)}
        # Symbols are piece ids; characters that are no piece are numbered from self.size on.
        self.char_ids = {p: i for p, i in ids.items() if len(p) == 1}
        self.extra: dict[str, int] = {}
        keys, to, ranks = [], [], []
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = self._symbol(p[:k], ids), self._symbol(p[k:], ids)
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    to.append(i)
                    ranks.append(rank[sp.get_score(i)])
        self._build_table(np.array(keys, np.int64), np.array(to, np.int64), np.array(ranks, np.int64))
        self.text_of = [self.piece[i].replace(MARK, " ") if i in self.piece else None for i in range(self.size)]
        self.digits = [f",{i}" for i in range(self.size)]
        self.cache: dict[bytes, tuple[bytes, bytes, bytes]] = {}

    def _symbol(self, s: str, ids: dict[str, int]) -> int | None:
        if s in ids:
            return ids[s]
        return self._char(s) if len(s) == 1 else None

    def _char(self, ch: str) -> int:
        i = self.char_ids.get(ch)
        if i is None:
            i = self.extra.setdefault(ch, self.size + len(self.extra))
        return i

    SLOTS_LOG2 = 19

    def _build_table(self, keys: np.ndarray, to: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing with linear probing; -1 marks an empty slot."""
        self.slot_key = np.full(1 << self.SLOTS_LOG2, -1, np.int64)
        self.slot_to, self.slot_rank = np.full(len(self.slot_key), -1, np.int64), np.full(len(self.slot_key), _NONE)
        todo = np.arange(len(keys))
        at = self._slot(keys)
        while len(todo):
            free = self.slot_key[at] < 0
            _, one = np.unique(at[free], return_index=True)
            put = np.flatnonzero(free)[one]
            k = todo[put]
            self.slot_key[at[put]], self.slot_to[at[put]], self.slot_rank[at[put]] = keys[k], to[k], ranks[k]
            left = np.ones(len(todo), bool)
            left[put] = False
            todo, at = todo[left], at[left]
            taken = self.slot_key[at] >= 0
            at = np.where(taken, (at + 1) & (len(self.slot_key) - 1), at)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.SLOTS_LOG2)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (a large number if the pair is no piece) and merged id of each pair."""
        key = a << 32 | b
        at = self._slot(key)
        seen = self.slot_key[at]
        probe = np.flatnonzero((seen != key) & (seen >= 0))
        while len(probe):
            at[probe] = (at[probe] + 1) & (len(self.slot_key) - 1)
            seen = self.slot_key[at[probe]]
            probe = probe[(seen != key[probe]) & (seen >= 0)]
        return self.slot_rank[at], self.slot_to[at]

    def merge_rounds(self, sym: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their unit numbers (ascending) after all merges."""
        done_sym, done_unit = [], []
        while len(sym):
            pair = unit[:-1] == unit[1:]
            rank, to = self.lookup(sym[:-1], sym[1:])
            rank = np.where(pair, rank, _NONE)
            rank = np.append(rank, _NONE)
            to = np.append(to, -1)
            first = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            best = np.minimum.reduceat(rank, first)
            lens = np.diff(np.append(first, len(unit)))
            live = np.repeat(best < _NONE, lens)
            if not live.all():  # units without a pair are finished
                done_sym.append(sym[~live])
                done_unit.append(unit[~live])
                sym, unit, rank, to = sym[live], unit[live], rank[live], to[live]
                if len(sym) == 0:
                    break
                best, lens = best[best < _NONE], lens[best < _NONE]
                first = np.concatenate([[0], np.cumsum(lens)[:-1]])
            target = np.repeat(best, lens)
            wanted = np.flatnonzero(rank == target)
            take = self._leftmost_disjoint(wanted)
            take = self._safe(take, sym, unit, rank, to, first, lens, target)
            sym = sym.copy()
            sym[take] = to[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            sym, unit = sym[keep], unit[keep]
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sym, unit = np.concatenate(done_sym), np.concatenate(done_unit)
        order = np.argsort(unit, kind="stable")
        return sym[order], unit[order]

    @staticmethod
    def _leftmost_disjoint(wanted: np.ndarray) -> np.ndarray:
        """Of pair positions in ascending order, those that a left-to-right scan takes without overlap."""
        if len(wanted) < 2:
            return wanted
        new_run = np.append(True, np.diff(wanted) > 1)
        start = wanted[new_run][np.cumsum(new_run) - 1]
        return wanted[(wanted - start) % 2 == 0]

    def _safe(self, take, sym, unit, rank, to, first, lens, target) -> np.ndarray:
        """Drop all but the first merge of units in which an intermediate pair would rank as well or better."""
        several = np.bincount(np.searchsorted(first, take, "right") - 1, minlength=len(first)) > 1
        owner = np.searchsorted(first, take, "right") - 1
        if not several.any():
            return take
        merged_at = np.zeros(len(sym) + 1, bool)
        merged_at[take] = True
        new = to[take]
        # to the left: the symbol there after earlier merges of this round
        left_pos = take - 1
        has_left = (take > 0) & (unit[np.maximum(left_pos, 0)] == unit[take])
        from_merge = has_left & (take > 1) & merged_at[np.maximum(take - 2, 0)]
        left = np.where(from_merge, to[np.maximum(take - 2, 0)], sym[np.maximum(left_pos, 0)])
        right_pos = np.minimum(take + 2, len(sym) - 1)
        has_right = (take + 2 < len(sym)) & (unit[right_pos] == unit[take])
        rl, _ = self.lookup(left, new)
        rr, _ = self.lookup(new, sym[right_pos])
        bad = (has_left & (rl <= target[take])) | (has_right & (rr <= target[take]))
        unsafe = np.zeros(len(first), bool)
        unsafe[owner[bad]] = True
        unsafe &= several
        if not unsafe.any():
            return take
        is_first = np.append(True, owner[1:] != owner[:-1])
        return take[~unsafe[owner] | is_first]

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """The ids of each unit (in which spaces are already marks)."""
        lens = np.fromiter(map(len, units), np.int64, len(units))
        cps = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        distinct, inverse = np.unique(cps, return_inverse=True)
        table = np.array([self._char(chr(c)) for c in distinct], np.int64)
        sym, unit = self.merge_rounds(table[inverse], np.repeat(np.arange(len(units)), lens))
        unknown = sym >= self.size
        if unknown.any():
            names = {i: ch for ch, i in self.extra.items()}
            out_sym, out_unit = [], []
            for s, u in zip(sym.tolist(), unit.tolist()):
                got = [s] if s < self.size else self.byte_ids[list(names[s].encode("utf-8"))].tolist()
                out_sym += got
                out_unit += [u] * len(got)
            sym, unit = np.array(out_sym), np.array(out_unit)
        flat, ends = sym.tolist(), np.searchsorted(unit, np.arange(1, len(units) + 1)).tolist()
        return [flat[i:j] for i, j in zip([0, *ends], ends)]

    def decode_ids(self, ids: list[int]) -> str:
        """As the library's decode: marks become spaces, the one before the first piece goes, byte pieces form UTF-8."""
        out, raw, first = [], bytearray(), True
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                first = False
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            p = self.piece.get(i)
            if p is None:
                out.append(self.sp.decode([i]))
            elif first and p.startswith(MARK):
                out.append(p[1:].replace(MARK, " "))
            else:
                out.append(p.replace(MARK, " "))
            first = False
        if raw:
            out.append(_utf8(raw))
        return "".join(out)

    def cached(self, units: list[bytes]) -> list[tuple[bytes, bytes, bytes]]:
        """Of each unit (UTF-8, spaces not yet marks): its ids as 32-bit integers, as text with a comma before each, and its decoded text."""
        cache = self.cache
        new = [u for u in units if u not in cache]
        if new:
            if len(cache) + len(new) > self.CACHE_UNITS:
                cache = self.cache = {u: cache[u] for u in units if u in cache}
            texts, digits = self.text_of, self.digits
            for u, ids in zip(new, self.encode_units([u.decode("utf-8", "surrogatepass").replace(" ", MARK) for u in new])):
                text = [texts[i] for i in ids]
                decoded = self._decode_inner(ids) if None in text else "".join(text)
                cache[u] = (struct.pack(f"<{len(ids)}i", *ids), "".join([digits[i] for i in ids]).encode(), decoded.encode("utf-8", "surrogatepass"))
        return [cache[u] for u in units]

    def _decode_inner(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            out.append(self.text_of[i])
        if raw:
            out.append(_utf8(raw))
        return "".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_batch(pa.array([text or ""]))[0], np.int32).tolist()

    def encode_batch(self, texts: pa.Array) -> tuple:
        """(ids, ids as text with commas, decoded text) as flat bytes, and the bounds of each text in each."""
        buf, offs = flat_text(texts)
        buf, offs = _spaced(buf, offs)
        blank = buf == 32
        begin = np.zeros(len(buf), bool)
        begin[1:] = blank[1:] & ~blank[:-1]
        begin[offs[:-1][np.diff(offs) > 0]] = True
        cuts = np.append(np.flatnonzero(begin), len(buf)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(buf)]).dictionary_encode()
        per = np.searchsorted(cuts, offs) if len(buf) else np.zeros(len(offs), np.int64)
        out = []
        for column in zip(*self.cached(units.dictionary.to_pylist())) if len(cuts) > 1 else ((), (), ()):
            flat = pa.array(column, pa.large_binary()).take(units.indices)
            _, ends, data = flat.buffers()
            ends = np.frombuffer(ends, np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
            out += [memoryview(data) if data is not None else memoryview(b""), ends[per]]
        return tuple(out)


def _spaced(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before each that is not empty, and with spaces for marks."""
    mark = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) if len(buf) > 2 else np.zeros(0, np.int64)
    if len(mark):
        keep = np.ones(len(buf), bool)
        keep[mark + 1] = keep[mark + 2] = False
        buf = buf.copy()
        buf[mark] = 32
        offs = offs - 2 * np.searchsorted(mark, offs)
        buf = buf[keep]
    some = np.diff(offs) > 0
    return np.insert(buf, offs[:-1][some], 32), offs + np.concatenate([[0], np.cumsum(some)])


def _utf8(raw: bytearray) -> str:
    """Bytes to text; each byte of an invalid sequence becomes U+FFFD."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, i, raw = [], 0, bytes(raw)
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_NONE = np.int64(1) << 60


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_texts(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """Columns `keep` and any of n_tokens (long), ids (array<int>), decoded (string), ids_sha256, decoded_sha256.

    One narrow pass over whole texts; the model is a small file that every executor has at model_path.
    """
    bound_batches(docs.sparkSession)
    kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    keep = docs.columns if keep is None else keep
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(o, kinds[o]) for o in outputs])

    def run(batches):
        m = model(model_path)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for i, j, _, _ in text_slices(column, 1 << 20):
                ids, id_ends, joined, joined_ends, decoded, decoded_ends = m.encode_batch(column.slice(i, j - i))
                made = []
                for o in outputs:
                    if o == "n_tokens":
                        made.append(pa.array(np.diff(id_ends) // 4, pa.int64()))
                    elif o == "ids":
                        made.append(pa.ListArray.from_arrays(pa.array(id_ends // 4, pa.int32()), pa.array(np.frombuffer(ids, np.int32, id_ends[-1] // 4))))
                    else:  # the comma before the first id, and the space before the first word, are left out
                        data, ends = (joined, joined_ends) if o == "ids_sha256" else (decoded, decoded_ends)
                        pieces = [data[min(a + 1, b) : b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                        made.append(pa.array([str(x, "utf-8") for x in pieces] if o == "decoded" else [hashlib.sha256(x).hexdigest() for x in pieces]))
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in range(len(keep))] + made, names=schema.fieldNames())
            del batch, column
            release_memory()

    return docs.select(*[docs[f"`{c}`"] for c in keep], docs[f"`{text}`"].alias("\0text")).mapInArrow(run, schema)


def decode_texts(tokens: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """tokens with the text of each id list; null lists give an empty text."""
    from pyspark.sql import functions as F

    @F.pandas_udf("string")
    def decode(col):
        m = model(model_path)
        return col.map(lambda x: m.decode_ids([]) if x is None else m.decode_ids(list(x)))

    return tokens.withColumn(out, decode(F.col(ids)))
