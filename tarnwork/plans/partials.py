"""Pre-aggregates that are kept up to date from changed records only.

For each bucket of a store a partial aggregate is stored, with the folders that it was made from. Folders never change, so a
partial is stale exactly if the store's manifest names others for its bucket; a refresh reads and aggregates stale buckets
alone. Counts, sums and extremes of the partials of all buckets merge into the aggregate of the whole model.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import Tables
from .store import WHOLE, Store, publish, versions

MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


class Partials:
    """name: of the aggregate, in the store's folder. tables: those that `rows` reads, all with a cve_id.

    rows: the model to rows of (cve_id, keys, values); each row of a record may depend on that record alone.
    values: column: sum, min or max. The number of rows, n, is always kept. Null values are passed over, as SQL does.
    """

    def __init__(self, store: Store, name: str, tables: list[str], rows: Callable[[Tables], DataFrame], keys: list[str], values: dict[str, str]):
        self.store, self.spark, self.root = store, store.spark, f"{store.root}/partials/{name}"
        self.tables, self.rows, self.keys, self.values = tables, rows, keys, values

    def _sources(self) -> dict[int, str]:
        """bucket: a digest of the folders of its tables."""
        _, entries = self.store._manifest()
        of: dict[int, list[str]] = {}
        for (table, bucket), path in sorted(entries.items()):
            if table in self.tables and bucket != WHOLE:
                of.setdefault(bucket, []).append(path)
        return {b: hashlib.sha256("\n".join(p).encode()).hexdigest() for b, p in of.items()}

    def _made(self) -> tuple[int, dict[int, tuple[str, str | None]]]:
        """Version, and bucket: (source, folder; null if the bucket gave no rows)."""
        names = versions(self.spark, self.root)[-1:]
        if not names:
            return 0, {}
        rows = self.spark.read.schema("version int, bucket int, source string, path string").json(f"{self.root}/manifest/{names[0]}").collect()
        return max((r["version"] for r in rows), default=0), {r["bucket"]: (r["source"], r["path"]) for r in rows if r["bucket"] is not None}

    def refresh(self) -> list[int]:
        """Aggregate the buckets that changed. Returns them."""
        sources, (version, made) = self._sources(), self._made()
        stale = sorted(b for b, s in sources.items() if made.get(b, ("", None))[0] != s)
        if not stale and set(made) == set(sources):
            return []
        current = {b: made[b] for b in sources if b not in stale}
        if stale:
            path = f"{self.root}/data/{uuid.uuid4().hex}"
            merged = [MERGES[how](c).alias(c) for c, how in self.values.items()]
            grouped = self.rows(self.store.load(stale)).groupBy(self.store.bucket_of().alias("__bucket"), *self.keys).agg(F.count("*").alias("n"), *merged)
            grouped.hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(path)
            top = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            found = {int(f.getPath().getName().partition("=")[2]) for f in fs.listStatus(top) if f.isDirectory()}
            current |= {b: (sources[b], f"{path}/__bucket={b}" if b in found else None) for b in stale}
        lines = [json.dumps({"version": version + 1, "bucket": b, "source": s, "path": p}) for b, (s, p) in sorted(current.items())]
        publish(self.spark, self.root, version + 1, lines or [json.dumps({"version": version + 1, "bucket": None})])
        return stale

    def result(self) -> DataFrame:
        """keys, n, values over the whole model, as of the last refresh."""
        paths = [p for _, p in self._made()[1].values() if p]
        schema = self.rows(self.store.load()).groupBy(*self.keys).agg(F.count("*").alias("n"), *[MERGES[how](c).alias(c) for c, how in self.values.items()]).schema
        parts = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return parts.groupBy(*self.keys).agg(F.sum("n").alias("n"), *[MERGES[how](c).alias(c) for c, how in self.values.items()])
