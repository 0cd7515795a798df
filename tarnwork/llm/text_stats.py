"""Per-text counts shared by the quality rules and the quality classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bound_batches, release_memory, text_slices
from .flatwords import FlatWords

# Byte classes. Each ASCII punctuation mark is a class of its own.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER, UPPER, DIGIT, BLANK, NEWLINE, CONTROL, LEAD, CONTINUATION = range(8)
N_CLASSES = 8 + len(PUNCTUATION)
SYMBOLS = "#*$%&|<>"


def _class_table() -> np.ndarray:
    t = np.full(256, CONTROL, np.int64)
    t[97:123], t[65:91], t[48:58] = LOWER, UPPER, DIGIT
    t[[32, 9]], t[10] = BLANK, NEWLINE
    t[0x80:0xC0], t[0xC0:] = CONTINUATION, LEAD
    for k, ch in enumerate(PUNCTUATION):
        t[ord(ch)] = 8 + k
    return t


CLASSES = _class_table()
MARK = {ch: 8 + k for k, ch in enumerate(PUNCTUATION)}
_INSIDE = np.ones(256, np.int64)
_INSIDE[[32, 9, 10, 11, 12, 13]] = 0
_INSIDE[0x80:0xC0] = 0

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts and the class histogram of each text."""
    w = FlatWords(buf, offs)
    words = w.word_hashes()
    hist = w.count_bytes(CLASSES, N_CLASSES)
    inside = w.count_bytes(_INSIDE, 2)[:, 1]
    return {
        "n_words": w.n_words,
        "word_chars": inside,
        "n_symbols": hist[:, [MARK[c] for c in SYMBOLS]].sum(1),
        "n_dup_lines": w.duplicate_lines(),
        "n_repeat_words": w.repeated_words(words, 8),
        "hist": hist,
        "n_lines": hist[:, NEWLINE] + (np.diff(offs) > 0),
        "n_distinct": _distinct(w, words),
    }


def _distinct(w: FlatWords, words: np.ndarray) -> np.ndarray:
    if len(words) == 0:
        return np.zeros(w.n, np.int64)
    key = words ^ (w.doc_of_word().astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    _, at = np.unique(key, return_index=True)
    return np.bincount(w.doc_of_word()[at], minlength=w.n)


def map_texts(df: DataFrame, text: str, make, fields: list[T.StructField], keep: list[str]) -> DataFrame:
    """Columns `keep` of df and those that make(bytes, offsets) gives for each whole text. One narrow pass, no shuffle.

    make returns one numpy array, or (flat values, offsets) for a list column, per field.
    """
    bound_batches(df.sparkSession)
    kept = [df.schema[c] for c in keep]
    schema = T.StructType(kept + fields)
    cols = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text}`"].alias("\0text"))
    arrow = [_arrow_type(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for i, j, buf, offs in text_slices(column):
                made = make(buf, offs)
                arrays = [batch.column(k).slice(i, j - i) for k in range(len(kept))]
                for a, kind in zip(made, arrow):
                    if isinstance(a, tuple):
                        arrays.append(pa.ListArray.from_arrays(pa.array(a[1], pa.int32()), pa.array(a[0], kind.value_type)))
                    else:
                        arrays.append(pa.array(a, kind))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())
            del batch, column
            release_memory()

    return cols.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.BooleanType: pa.bool_(), T.FloatType: pa.float32()}[type(t)]
