"""Snapshots of the model: Parquet folders and a manifest that names the current ones.

Tables of records are hashed into buckets by cve_id, all into the same ones, and the manifest names a folder for each table and
bucket. A commit writes new folders, then a manifest under the next version's name, which must not exist: readers see the
old model or the new one, and of two writers from one version the second fails and may retry. A merge of a few records reads
and writes only the buckets that hold them; the other buckets' folders stay in the manifest. A bucket holds many
records and is split over files, so no task writes one whole.

The exclusive rename is atomic on HDFS and local disks; on a store without it, commits must come from one writer. `prune` deletes old versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import SCHEMAS, Tables, conform, schema

WHOLE = -1  # the bucket number of tables without a cve_id
BUCKETS = 64
Entries = dict[tuple[str, int], str]  # (table, bucket): folder
MIGRATED = ("__migrated", WHOLE)  # the entry with the number of the last migration that the data has seen


def is_bucketed(name: str) -> bool:
    return "cve_id" in schema(name).fieldNames()


def _manifests(spark: SparkSession, root: str):
    """Folder of the manifests and its file system."""
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    return top, top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the manifests, oldest first."""
    top, fs = _manifests(spark, root)
    names = [f.getPath().getName() for f in fs.listStatus(top)] if fs.exists(top) else []
    return sorted(n for n in names if n.endswith(".json"))


def publish(spark: SparkSession, root: str, version: int, lines: list[str]) -> None:
    """Write a manifest under a temporary name, then rename it; the rename fails if the version exists."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    top, fs = _manifests(spark, root)
    part, final = jvm.org.apache.hadoop.fs.Path(top, f".{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(top, f"{version:08d}.json")
    out = fs.create(part)
    out.write("".join(x + "\n" for x in lines).encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.getFileSystem(conf).getUri(), conf).rename(fs.makeQualified(part), fs.makeQualified(final), options)
    except Py4JJavaError as e:
        fs.delete(part, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            raise RuntimeError(f"version {version} of {root} was committed by another writer") from e
        raise


class Store:
    """buckets: how many, fixed when the store is first written; 64 suit some 100 GB of records."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name if name.startswith(self.root) else f"{self.root}/{name}")

    def _fs(self):
        return self._path("manifest").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[str]:
        return versions(self.spark, self.root)

    def _manifest(self, name: str | None = None) -> tuple[int, Entries]:
        """Version and folders of a manifest, the latest one by default. The rows are as many as tables and buckets."""
        names = [name] if name else self._versions()[-1:]
        if not names:
            return 0, {}
        rows = self.spark.read.schema("version bigint, name string, bucket int, path string, buckets int").json(f"{self.root}/manifest/{names[0]}").collect()
        self.buckets = next((r["buckets"] for r in rows if r["buckets"]), self.buckets)
        return max(r["version"] for r in rows), {(r["name"], WHOLE if r["bucket"] is None else r["bucket"]): r["path"] for r in rows}

    def _publish(self, version: int, entries: Entries) -> None:
        lines = [json.dumps({"version": version, "name": n, "bucket": b, "path": p, "buckets": self.buckets}) for (n, b), p in sorted(entries.items())]
        publish(self.spark, self.root, version, lines)

    def bucket_of(self, cve_id: str | Column = "cve_id") -> Column:
        return F.pmod(F.xxhash64(cve_id), F.lit(self.buckets)).cast("int")

    def touched(self, ids: DataFrame) -> list[int]:
        """Buckets of the records in ids(cve_id): at most as many as there are buckets."""
        self._manifest()
        return sorted(r[0] for r in ids.select(self.bucket_of().alias("b")).distinct().collect())

    def load(self, buckets: list[int] | None = None) -> Tables:
        """The current model; with `buckets`, the tables of records hold only these."""
        _, entries = self._manifest()
        t = Tables(self.spark)
        for name in sorted({n for n, _ in entries if n in SCHEMAS}):
            paths = [p for (n, b), p in sorted(entries.items()) if n == name and (buckets is None or b == WHOLE or b in buckets)]
            if paths:
                t[name] = self.spark.read.schema(SCHEMAS[name]).parquet(*paths)
        return t

    def _write(self, df: DataFrame, name: str) -> Entries:
        """New folders of a table, one for each bucket that has rows."""
        path = f"{self.root}/data/{name}/{uuid.uuid4().hex}"
        df = conform(df, name)
        if not is_bucketed(name):
            df.write.parquet(path)
            return {(name, WHOLE): path}
        df.withColumn("__bucket", self.bucket_of()).hint("rebalance", "__bucket").write.partitionBy("__bucket").parquet(path)
        made = [f.getPath().getName() for f in self._fs().listStatus(self._path(path)) if f.isDirectory()]
        found: Entries = {(name, int(d.partition("=")[2])): f"{path}/{d}" for d in made}
        return found

    def migrated(self) -> int:
        """Number of the last migration that the data has seen, 0 for none."""
        return int(self._manifest()[1].get(MIGRATED, 0))

    def commit(self, t: Tables, changed: list[str] | None = None, buckets: list[int] | None = None, migrated: int | None = None) -> Tables:
        """Write the changed tables (all, if None) and make them current. Raises if another commit came in between.

        buckets: t holds only these of the tables of records, and the others stay as they are. migrated: see there.
        """
        version, entries = self._manifest()
        for name in sorted(changed if changed is not None else t):
            part = buckets is not None and is_bucketed(name)
            entries = {(n, b): p for (n, b), p in entries.items() if n != name or part and b != WHOLE and b not in buckets}
            new = self._write(t[name], name)
            if part and {b for _, b in new} - set(buckets):
                raise ValueError(f"{name} has rows outside the buckets that were read")
            entries |= new
        if migrated is not None:
            entries[MIGRATED] = str(migrated)
        self._publish(version + 1, entries)
        return self.load()

    def merge(self, ids: DataFrame, make: Callable[[Tables], Tables]) -> list[int]:
        """Commit make(model) where it changes only the records in ids(cve_id) and their children: reads and writes
        their buckets alone, and whole tables without cve_id where these change. Returns the buckets.

        Not for merges that number new rows, as the largest id may lie in a bucket that is not read: these take load() and commit().
        """
        buckets = self.touched(ids)
        before = self.load(buckets)
        after = make(before)
        self.commit(after, changed_tables(before, after), buckets)
        return buckets

    def prune(self, keep: int = 2) -> int:
        """Delete manifests but the latest `keep`, and folders that none of these names. Returns how many folders went.

        Not to be run while a commit is under way, as its folders have no manifest yet.
        """
        names, fs = self._versions(), self._fs()
        live = {p for n in names[-keep:] for p in self._manifest(n)[1].values()}
        for n in names[:-keep]:
            fs.delete(self._path(f"manifest/{n}"), False)
        gone = 0
        for table in fs.listStatus(self._path("data")):
            for commit in fs.listStatus(table.getPath()):
                top = f"{self.root}/data/{table.getPath().getName()}/{commit.getPath().getName()}"
                if top in live:
                    continue
                inner = [f.getPath().getName() for f in fs.listStatus(commit.getPath()) if f.isDirectory()]
                dead = [d for d in inner if f"{top}/{d}" not in live]
                for d in [top] if len(dead) == len(inner) else [f"{top}/{d}" for d in dead]:
                    fs.delete(self._path(d), True)
                    gone += 1
        return gone


def changed_tables(before: Tables, after: Tables) -> list[str]:
    return [n for n in after if n not in before or after[n] is not before[n]]


def stamp(t: Tables, phase: str, now: str, watermark: str | None = None) -> Tables:
    """The phase's state row, in the same commit as its data."""
    row = t.spark.createDataFrame([(phase, now, watermark)], SCHEMAS["pipeline_run"])
    return t.replaced(pipeline_run=t["pipeline_run"].where(F.col("phase") != phase).unionByName(row))


def state(t: Tables, phase: str) -> tuple[str | None, str | None]:
    r = t["pipeline_run"].where(F.col("phase") == phase).first()
    return (r["last_completed_at"], r["last_watermark"]) if r else (None, None)


def row_counts(t: Tables) -> DataFrame:
    from ..operators.views import table_row_counts

    return table_row_counts(t)
