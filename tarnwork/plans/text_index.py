"""A stored full-text index, kept up to date by segments.

A segment holds the postings of the documents that one update brought, range-clustered by term: a row per term and slice of the
documents of a task, with lists of their keys and positions. Words are listed where a document is read, so what is shuffled and written are lists
instead of a row for every word. Each slice has one more row under the empty term, with its documents' lengths, so documents are listed without
reading the rest. A query reads the row groups of its terms, whose bounds Parquet keeps, and no
others. An update or deletion writes tombstones (key, segment) for the documents that it replaces; postings meet them
in an anti-join. Numbers of documents and words are kept per segment in the manifest, those of dead ones as negative numbers, so ranking reads
the lengths and its postings only. `compact` rewrites the live postings as one segment.

Null texts have no words; a document without words is in no segment and counts for nothing. Of rows with equal keys in one
update all words count, as one document. Null keys are left out.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stemming import stem
from ..operators import fulltext
from ..operators.lineage import bytes_of, cut, stored
from .store import publish, versions

POSTING = "key {0}, term string, positions array<int>, dl long"
LISTS = "term string, keys array<{0}>, ends array<int>, positions array<int>, dls array<long>"  # ends: of each key's positions; dls: under the empty term only
GONE = "key {0}, segment int, dl long"
SLICE = 1 << 21  # words that are listed at once, in a task
FILE_BYTES = 8 << 20  # of lists for each file of a segment
BLOCK = 1024  # about so many keys a list at most, after compaction


def lists(term_of: Callable[[str], str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (key, words...) to rows of LISTS: a slice's keys and positions for each of its terms, and the lengths of its documents that have words."""

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, tokens, rows, pos = batch.num_rows, [], [], []
        for i, column in enumerate(batch.columns[1:]):
            sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            tokens.append(column.flatten())
            rows.append(np.repeat(np.arange(n), sizes))
            pos.append(np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + i * fulltext.GAP)
        coded = pa.concat_arrays(tokens).dictionary_encode()
        terms, of = np.unique(np.array([term_of(w) for w in coded.dictionary.to_pylist()], object), return_inverse=True)
        rows, pos = np.concatenate(rows), np.concatenate(pos).astype(np.int32)
        pair = of[coded.indices.to_numpy()] * n + rows if len(rows) else rows
        order = np.argsort(pair, kind="stable")  # by term, then document; positions ascend already
        pairs, starts = np.unique(pair[order], return_index=True)
        firsts = np.searchsorted(pairs, np.arange(len(terms) + 1) * n)  # of each term's pairs
        begins = np.append(starts, len(order))[firsts]  # of each term's positions
        ends = np.append(starts, len(order))[1:] - np.repeat(begins[:-1], np.diff(firsts))
        dl = np.bincount(rows, minlength=n)
        held = np.flatnonzero(dl)
        lists_of = lambda first, offsets, values: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], first + offsets]).astype(np.int32)), values)
        keys = batch.column(0).take(pa.array(np.concatenate([held, pairs % n])))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(["", *terms], pa.string()), lists_of(len(held), firsts, keys), lists_of(0, firsts, pa.array(ends.astype(np.int32))),
                lists_of(0, begins, pa.array(pos[order])), lists_of(len(held), np.zeros(len(terms) + 1, np.int64), pa.array(dl[held].astype(np.int64))),
            ],
            names=["term", "keys", "ends", "positions", "dls"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[1:])
            slices = np.cumsum(sizes) // SLICE
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(slices)) + 1):
                if len(part):
                    yield listed(batch.slice(part[0], len(part)))

    return run


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _running(sizes):
    return sizes.map(lambda x: np.cumsum(x).astype(np.int32))


class TextIndex:
    """key_type: SQL type of the documents' keys. stemmed, forms: as in fulltext.postings; queries in `search` are stemmed likewise."""

    def __init__(self, spark: SparkSession, root: str, key_type: str = "string", stemmed: bool = True, forms: dict[str, str] | None = None):
        self.spark, self.root, self.key_type, self.stemmed, self.forms = spark, root.rstrip("/"), key_type, stemmed, forms

    def _state(self) -> tuple[int, list[dict]]:
        """Version, and the manifest's rows: segments and tombstones, one row per update."""
        names = versions(self.spark, self.root)[-1:]
        if not names:
            return 0, []
        rows = self.spark.read.schema("version int, segment int, postings string, gone string, n long, words long").json(f"{self.root}/manifest/{names[0]}").collect()
        rows = [r.asDict() for r in rows]
        return max(r["version"] for r in rows), [r for r in rows if r["postings"] or r["gone"]]

    def _publish(self, version: int, rows: list[dict]) -> None:
        none = {"segment": None, "postings": None, "gone": None, "n": 0, "words": 0}
        publish(self.spark, self.root, version, [json.dumps(r | {"version": version}) for r in rows or [none]])

    def _folder(self, kind: str) -> str:
        return f"{self.root}/{kind}/{uuid.uuid4().hex}"

    def _stored(self, path: str, keep=None) -> DataFrame:
        """A segment's rows (key, term, positions, dl) of the terms that `keep` selects; dl is 0 but under the empty term."""
        part = self.spark.read.schema(LISTS.format(self.key_type)).parquet(path)
        part = part if keep is None else part.where(keep)

        def posting(key, i):
            begin = F.coalesce(F.get("ends", i - 1), F.lit(0))
            return F.struct(key.alias("key"), F.slice("positions", begin + 1, F.coalesce(F.get("ends", i) - begin, F.lit(0))).alias("positions"), F.coalesce(F.get("dls", i), F.lit(0).cast("long")).alias("dl"))

        return part.select("term", F.inline(F.transform("keys", posting))).select("key", "term", "positions", "dl")

    def postings(self, keep=None) -> DataFrame:
        """Live rows (key, term, positions, dl, segment) of the terms that `keep` selects; all, if None."""
        _, rows = self._state()
        out = self.spark.createDataFrame([], POSTING.format(self.key_type) + ", segment int")
        for r in rows:
            if r["postings"]:
                out = out.unionAll(self._stored(r["postings"], keep).withColumn("segment", F.lit(r["segment"])))
        gone = [r["gone"] for r in rows if r["gone"]]
        if gone:
            dead = self.spark.read.schema(GONE.format(self.key_type)).parquet(*gone).select("key", "segment")
            out = out.join(dead, ["key", "segment"], "left_anti").select(*out.columns)
        return out

    def _documents(self) -> DataFrame:
        """Rows (key, segment, dl) of the live documents."""
        return self.postings(F.col("term") == "").select("key", "segment", "dl")

    def _term_of(self) -> Callable[[str], str]:
        if self.forms:
            forms = self.forms
            return lambda w: forms.get(w, w)
        return stem if self.stemmed else str

    def _listed(self, named: DataFrame, texts: list[str]) -> DataFrame:
        """Rows of LISTS of named(key, texts...). Rows that share their key, if any, are brought together word by word."""
        schema = LISTS.format(self.key_type)
        repeated = cut(named.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
        several = not repeated.isEmpty()
        single = named.join(repeated, "key", "left_anti") if several else named
        out = single.select("key", *[fulltext.words(F.col(t)).alias(t) for t in texts]).mapInArrow(lists(self._term_of()), schema)
        if several:
            words = fulltext.postings(named.join(repeated, "key", "left_semi"), "key", *texts, stemmed=self.stemmed, forms=self.forms)
            own = cut(words.groupBy("key", "term").agg(F.sort_array(F.collect_list("pos")).alias("positions")))
            none = lambda kind: F.array().cast(f"array<{kind}>")
            out = out.unionAll(own.select("term", F.array("key"), F.array(F.size("positions")), "positions", none("long")))
            out = out.unionAll(own.groupBy("key").agg(F.sum(F.size("positions")).alias("dl")).select(F.lit(""), F.array("key"), none("int"), none("int"), F.array("dl")))
        return stored(out, "lists")  # once, not again to find the ranges

    def _bury(self, keys: DataFrame) -> dict:
        """Tombstones of the live documents among keys(key)."""
        live = self._documents().join(keys.select("key").distinct(), "key", "left_semi").distinct()
        path = self._folder("gone")
        live.select("key", "segment", "dl").write.parquet(path)
        n, words = self.spark.read.schema(GONE.format(self.key_type)).parquet(path).agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        return {"segment": None, "postings": None, "gone": path if n else None, "n": -n, "words": -words}

    def _clustered(self, rows: DataFrame) -> DataFrame:
        by = ("term", F.get("keys", F.lit(0)))
        files = -(-bytes_of(self.spark, *{f.rpartition("/")[0] for f in rows.inputFiles()}) // FILE_BYTES)
        return rows.repartitionByRange(max(1, files), *by).sortWithinPartitions(*by)

    def _segment(self, rows: DataFrame, segment: int) -> dict:
        """Write lists, clustered by term."""
        path = self._folder("postings")
        self._clustered(rows).write.option("compression", "zstd").parquet(path)
        docs = self._stored(path, F.col("term") == "").select("key", "dl").distinct()
        n, words = docs.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        return {"segment": segment, "postings": path if n else None, "gone": None, "n": n, "words": words}

    def update(self, docs: DataFrame, key: str, *texts: str) -> None:
        """Add documents; those with known keys are replaced."""
        version, rows = self._state()
        named = docs.where(F.col(key).isNotNull()).select(F.col(key).cast(self.key_type).alias("key"), *[F.col(t).alias(f"text{i}") for i, t in enumerate(texts)])
        dead = [self._bury(named)] if rows else []
        self._publish(version + 1, rows + dead + [self._segment(self._listed(named, [f"text{i}" for i in range(len(texts))]), version + 1)])

    def delete(self, keys: DataFrame, key: str) -> None:
        version, rows = self._state()
        self._publish(version + 1, [*rows, self._bury(keys.select(F.col(key).cast(self.key_type).alias("key")))])

    def _live(self) -> DataFrame:
        """All live postings as `_segment` takes them."""
        blocks = max(1, sum(r["n"] for r in self._state()[1]) // BLOCK)
        rows = self.postings().groupBy("term", F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block")).agg(F.sort_array(F.collect_list(F.struct("key", "positions", "dl"))).alias("p"))
        rows = rows.select("term", F.col("p.key").alias("keys"), _running(F.transform("p", lambda x: F.size(x["positions"]))).alias("ends"), F.flatten("p.positions").alias("positions"), F.col("p.dl").alias("dls"))
        own = F.col("term") == ""
        return stored(rows.withColumns({"ends": F.when(~own, F.col("ends")).otherwise(F.array().cast("array<int>")), "dls": F.when(own, F.col("dls")).otherwise(F.array().cast("array<long>"))}), "lists")

    def compact(self) -> None:
        """One segment of all live postings."""
        version, _ = self._state()
        self._publish(version + 1, [self._segment(self._live(), version + 1)])

    def search(self, query: str, limit: int | None = 20, key: str = "cve_id") -> DataFrame:
        """(key, score) of the live documents that match, best first; keys break ties."""
        _, rows = self._state()
        n, words = sum(r["n"] for r in rows), sum(r["words"] for r in rows)
        tree = fulltext.parse(query, lambda w: self.forms.get(w, w)) if self.forms else fulltext.parse(query)
        found = cut(self.postings(fulltext.wanted(tree)))
        index = found.select("key", "term", F.explode("positions").alias("pos"))
        totals = self.spark.range(1).select(F.lit(n).alias("n"), F.lit(words / max(1, n)).alias("avgdl"))
        return fulltext.rank(tree, index, "key", self._documents().select("key", "dl"), totals, limit).withColumnRenamed("key", key)
