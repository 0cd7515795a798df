"""Words, lines and n-grams of many texts at once, on flat byte arrays.

A word is a maximal run of bytes other than the given separators: space and \\t..\\r, or all ASCII
characters but letters, digits and the underscore. A string's 64-bit hash is the mixed sum of one value per byte, a
product that depends on byte and place together, so no rearrangement of bytes cancels out by construction. Equal strings
have equal hashes in every process, as all constants come from a fixed seed; strings of equal hash are taken as equal.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
NOT_ALPHANUMERIC = np.array([b < 128 and not (chr(b).isalnum() or b == 95) for b in range(256)])
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_GRAM = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


_LOW_HALF, _HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * _C1
    h = h ^ (h >> np.uint64(27))
    h = h * _C2
    return h ^ (h >> np.uint64(31))


_PLACES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * _BASE)


def _places(pos: np.ndarray) -> np.ndarray:
    """A random-looking value of each place."""
    if len(pos) == 0 or int(pos.max()) < len(_PLACES):
        return _PLACES[pos]
    return mix((pos.astype(np.uint64) + np.uint64(1)) * _BASE)


def _placed(values: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The product of the two halves of value xor place: not linear in either."""
    x = values ^ _places(pos)
    return (x >> _HALF) * (x & _LOW_HALF)


class FlatWords:
    """Word bounds of the texts buf[offs[i]:offs[i+1]]. bounds[i]:bounds[i+1] are the words of text i."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE):
        self.buf, self.offs, self.n = buf, offs, len(offs) - 1
        size = len(buf)
        inside = ~separators[buf]
        first = np.zeros(size + 1, bool)
        first[offs[:-1]] = True
        begin = inside.copy()
        if size:
            begin[1:] &= ~inside[:-1] | first[1:size]
        self.inside, self.begin = inside, begin
        self.starts = np.flatnonzero(begin)
        self.bounds = np.searchsorted(self.starts, offs)
        self.n_words = np.diff(self.bounds)

    def word_hashes(self) -> np.ndarray:
        if len(self.starts) == 0:
            return np.zeros(0, np.uint64)
        s0 = self.starts[0]
        lens = np.diff(np.append(self.starts, len(self.buf)))
        pos = np.arange(len(self.buf) - s0) - np.repeat(self.starts - s0, lens)
        outside = ~self.inside[s0:]
        pos[outside] = 0
        vals = _placed(_BYTE[self.buf[s0:]], pos)
        vals[outside] = 0
        return mix(np.add.reduceat(vals, self.starts - s0))

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), self.n_words)

    def grams(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all n-grams of `size` words within texts, their first words, and len+1 bounds per text."""
        per = np.maximum(self.n_words - size + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(per)])
        at = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1] - bounds[:-1], per)
        h = np.zeros(len(at), np.uint64)
        for k in range(size):
            h += words[at + k] * _GRAM[k]
        return mix(h), at, bounds

    def shingles(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """As grams, but a text of 1 to size-1 words has one n-gram: all its words."""
        h, _, bounds = self.grams(words, size)
        short = np.flatnonzero((self.n_words > 0) & (self.n_words < size))
        if len(short) == 0:
            return h, bounds
        extra = []
        for i in short:
            w = words[self.bounds[i] : self.bounds[i + 1]]
            extra.append((w * _GRAM[: len(w)]).sum(dtype=np.uint64) + np.uint64(len(w)))
        h = np.insert(h, bounds[short], mix(np.array(extra, np.uint64)))
        per = np.diff(bounds)
        per[short] = 1
        return h, np.concatenate([[0], np.cumsum(per)])

    def text_hashes(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each text's word sequence; 0, 0 for texts without words."""
        out = []
        some = self.n_words > 0
        for salt in (np.uint64(1), np.uint64(0xD6E8FEB86659FD93)):
            res = np.zeros(self.n, np.uint64)
            if len(words):
                pos = np.arange(len(words)) - np.repeat(self.bounds[:-1], self.n_words)
                vals = mix(words * salt ^ _places(pos))
                res[some] = mix(np.add.reduceat(vals, self.bounds[:-1][some]) + self.n_words[some].astype(np.uint64))
            out.append(res)
        return out[0], out[1]

    def duplicate_lines(self) -> np.ndarray:
        """Per text, lines (\\n-split) with a word that equal an earlier line."""
        if len(self.starts) == 0:
            return np.zeros(self.n, np.int64)
        size = len(self.buf)
        nl = np.flatnonzero(self.buf == 10) + 1
        begin = np.union1d(self.offs[:-1][np.diff(self.offs) > 0], nl[nl < size])
        lens = np.diff(np.append(begin, size))
        pos = np.arange(size) - np.repeat(begin, lens)
        vals = _placed(_BYTE[self.buf], pos)
        vals[self.buf == 10] = 0
        h = np.add.reduceat(vals, begin)
        filled = np.unique(np.searchsorted(begin, self.starts, "right") - 1)
        doc = np.searchsorted(self.offs, begin[filled], "right") - 1
        key = mix(mix(h[filled]) + doc.astype(np.uint64) * _BASE)
        _, at = np.unique(key, return_index=True)
        return np.bincount(doc, minlength=self.n) - np.bincount(doc[at], minlength=self.n)

    def repeated_words(self, words: np.ndarray, size: int) -> np.ndarray:
        """Per text, words in windows of `size` words that occur twice or more in it."""
        h, at, bounds = self.grams(words, size)
        if len(h) == 0:
            return np.zeros(self.n, np.int64)
        doc = np.repeat(np.arange(self.n), np.diff(bounds))
        key = mix(h + doc.astype(np.uint64) * _BASE)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        dup = np.zeros(len(key), bool)
        dup[order[1:][same]] = True
        dup[order[:-1][same]] = True
        edge = np.zeros(len(words) + 1, np.int32)
        np.add.at(edge, at[dup], 1)
        np.add.at(edge, at[dup] + size, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
        return covered[self.bounds[1:]] - covered[self.bounds[:-1]]

    def count_bytes(self, table: np.ndarray, classes: int) -> np.ndarray:
        """n x classes counts of table[byte] per text."""
        doc = np.repeat(np.arange(self.n) * classes, np.diff(self.offs))
        return np.bincount(doc + table[self.buf], minlength=self.n * classes).reshape(self.n, classes)
