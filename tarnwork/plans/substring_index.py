"""A stored index of trigrams for case-insensitive substring predicates.

Postings name, for three characters in a row of a lower-cased text, the documents that hold them; they are kept by
segments and tombstones, as TextIndex keeps words. A search takes the trigrams of the term's literal pieces, counts their
postings (the term column alone is read, clustered), reads the documents of the rarest few, and verifies the documents
that hold all of these against the predicate itself, so its rows are those of a scan. A trigram without postings ends
the search. A term without a piece of three characters is verified on all documents.

Each document has one more posting under the empty term, so documents are listed without reading the rest, and
texts shorter than three characters count too. Null texts and null keys are in no posting.

Postings are stored as rows of a term and a list of keys, one for each slice of the documents of a task, so that what is
shuffled, sorted and written are lists instead of a row for every trigram of every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.lineage import cut
from .text_index import TextIndex

SIZE = 3
RAREST = 4  # trigrams whose documents are read; verification does the rest
LIST = 1024  # about so many keys a list at most, after compaction
MAX_KEYS = 500_000  # keys of documents to verify that are broadcast; more meet the documents in a shuffled join


def pieces(term: str, wildcards: bool) -> list[str]:
    """The literal pieces of a lower-cased term; with wildcards they end at % and _, and a backslash quotes the next character."""
    if not wildcards:
        return [term.lower()]
    out = [""]
    for quoted, wild, plain in re.findall(r"\\(.)|([%_])|([^%_\\]+)", term.lower(), re.DOTALL):
        if wild:
            out.append("")
        out[-1] += quoted or plain
    return out


def needed(term: str, wildcards: bool = False) -> list[str]:
    """The trigrams that every text with the term holds."""
    return sorted({p[i : i + SIZE] for p in pieces(term, wildcards) for i in range(len(p) - SIZE + 1)})


SLICE = 1 << 22  # characters whose trigrams are listed at once, in a task
PIECE = 1 << 20  # characters of one text at once; the next piece begins SIZE - 1 earlier


def codes(text: str) -> np.ndarray:
    """The distinct trigrams of a text as numbers, 21 bits a character."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.unique(c[:-2] << 42 | c[1:-1] << 21 | c[2:]) if len(c) >= SIZE else c[:0]


def spelt(found: np.ndarray) -> list[str]:
    chars = np.stack([found >> 42, found >> 21 & 0x1FFFFF, found & 0x1FFFFF], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return [chars[i : i + SIZE] for i in range(0, len(chars), SIZE)]


def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, lower-cased text) to (term, keys): a slice's keys for each of its trigrams, and all its keys for the empty term."""

    def listed(keys: pa.Array, whole: list[int], rows: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        flat = np.concatenate([np.empty(0, np.int64), *found])
        order = np.argsort(flat, kind="stable")
        terms, starts = np.unique(flat[order], return_index=True)
        at = np.repeat(np.array(rows, np.int64), [len(f) for f in found])[order]
        ends = np.concatenate([[0], starts + len(whole), [len(flat) + len(whole)]]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(["", *spelt(terms)], pa.string()), pa.ListArray.from_arrays(ends, keys.take(pa.array(np.concatenate([np.array(whole, np.int64), at]))))], names=["term", "keys"])

    for batch in batches:
        keys, whole, rows, found, size = batch.column(0), [], [], [], 0
        for i, text in enumerate(batch.column(1)):
            text = text.as_py()
            whole.append(i)
            for begin in range(0, max(1, len(text) - SIZE + 1), PIECE):
                rows.append(i)
                found.append(codes(text[begin : begin + PIECE + SIZE - 1]))
                size += min(PIECE, len(text))
                if size >= SLICE:
                    yield listed(keys, whole, rows, found)
                    whole, rows, found, size = [], [], [], 0
        if whole or rows:
            yield listed(keys, whole, rows, found)


class SubstringIndex(TextIndex):
    """Documents by key, one text each. With values as their own keys (`update_values`) it is an index of distinct strings."""

    def _stored(self, path: str, keep=None) -> DataFrame:
        part = self.spark.read.schema(f"term string, keys array<{self.key_type}>").parquet(path)
        part = part if keep is None else part.where(keep)
        return part.select(F.explode("keys").alias("key"), "term", F.array().cast("array<int>").alias("positions"), F.lit(0).cast("long").alias("dl"))

    def _clustered(self, rows: DataFrame) -> DataFrame:
        return rows.repartitionByRange("term", F.get("keys", F.lit(0))).sortWithinPartitions("term", F.get("keys", F.lit(0)))

    def _listed(self, named: DataFrame, texts: list[str]) -> DataFrame:
        if len(texts) != 1:
            raise ValueError("one text per document")
        rows = named.where(F.col(texts[0]).isNotNull()).select("key", F.lower(texts[0]).alias("text"))
        return rows.mapInArrow(lists, f"term string, keys array<{self.key_type}>")

    def _live(self) -> DataFrame:
        blocks = max(1, sum(r["n"] for r in self._state()[1]) // LIST)
        return self.postings().groupBy("term", F.pmod(F.xxhash64("key"), F.lit(blocks))).agg(F.collect_set("key").alias("keys")).select("term", "keys")

    def update_values(self, values: DataFrame, column: str) -> None:
        """Add the distinct strings of a column; known ones are neither read again nor written."""
        new = values.select(F.col(column).alias("key")).where(F.col("key").isNotNull()).distinct()
        if self._state()[1]:
            new = new.join(self._documents().select("key"), "key", "left_anti")
        self.update(cut(new).withColumn("text", F.col("key")), "key", "text")

    def candidates(self, term: str, wildcards: bool = False) -> DataFrame:
        """Distinct keys of the documents that a search verifies."""
        terms = needed(term, wildcards)
        if not terms:
            return self._documents().select("key").distinct()
        counts = dict(self.postings(F.col("term").isin(terms)).groupBy("term").agg(F.count("*")).collect())  # a row per trigram of the term at most
        if len(counts) < len(terms):
            return self._documents().select("key").limit(0)
        rare = sorted(terms, key=lambda g: (counts[g], g))[:RAREST]
        held = self.postings(F.col("term").isin(rare))
        if len(rare) == 1:
            return held.select("key").distinct()
        return held.groupBy("key").agg(F.count_distinct("term").alias("n")).where(F.col("n") == len(rare)).select("key")

    def search_in(self, docs: DataFrame, key: str, text: str, term: str, wildcards: bool = False) -> DataFrame:
        """The rows of docs that are in the index and whose text holds the term; docs: the indexed rows as they are now."""
        keys = cut(self.candidates(term, wildcards))
        few = keys.limit(MAX_KEYS + 1).count() <= MAX_KEYS
        keys = keys.select(F.col("key").alias("__key"))
        met = docs.join(F.broadcast(keys) if few else keys, docs[key].cast(self.key_type) == F.col("__key"), "left_semi")
        return met.where(X.contains_ci(met[text], term, wildcards))

    def values(self, term: str, wildcards: bool = True) -> DataFrame:
        """(value) of the indexed strings that hold the term; for an index made by `update_values`."""
        found = self.candidates(term, wildcards)
        return found.where(X.contains_ci("key", term, wildcards)).select(F.col("key").alias("value"))
