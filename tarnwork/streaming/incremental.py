"""Incremental ingestion: a file stream, drained once, merged batch by batch.

The stream's checkpoint replaces a hand-kept watermark: each landed file is merged exactly once, and a batch that
failed is merged again, which changes nothing as the merges are idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.tables import Tables
from ..plans.store import Store, changed_tables


def drain(spark: SparkSession, path: str, schema: str, checkpoint: str, each: Callable[[DataFrame], None], fmt: str = "json", files_per_batch: int = 1000, **options: str) -> None:
    """Process all files that have landed since the last call, then stop."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for k, v in options.items():
        reader = reader.option(k, v)
    query = reader.load(path).writeStream.foreachBatch(lambda df, _: each(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def merge_stream(store: Store, path: str, schema: str, checkpoint: str, merge: Callable[[Tables, DataFrame], Tables], keyed: bool = False, **options: str) -> Tables:
    """Merge every new file's rows into the store, one commit per batch.

    keyed: rows have a cve_id and the merge changes these records alone, so only their buckets are read and written.
    """

    def each(df: DataFrame) -> None:
        if keyed:
            store.merge(df.select("cve_id"), lambda t: merge(t, df))
            return
        before = store.load()
        after = merge(before, df)
        store.commit(after, changed_tables(before, after))

    drain(store.spark, path, schema, checkpoint, each, **options)
    return store.load()
