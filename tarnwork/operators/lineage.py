"""Lineage cuts for iterative or self-referring plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, a local one with a local master; an error on a cluster."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(path or "file://" + tempfile.mkdtemp(prefix="tarnwork-"))
    return sc._jsc.sc().getCheckpointDir().get()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in the shared folder. Plans that use a table several times would otherwise repeat all work behind it each time."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, computed once, as columns in the shared folder; for a derived table of which several steps read some columns."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PART_BYTES = 4 << 20  # of input files for each partition


def bytes_of(spark: SparkSession, *paths: str) -> int:
    size = 0
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return size


def parts_of(spark: SparkSession, *paths: str) -> int:
    """Partitions for a shuffle of the rows of paths: as many as their bytes need, so a task's memory does not grow with the input, nor is the session's number undercut."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bytes_of(spark, *paths) // PART_BYTES))


def parts_of_rows(df: DataFrame) -> int:
    """parts_of the folders that df reads."""
    return parts_of(df.sparkSession, *sorted({f.rpartition("/")[0] for f in df.inputFiles()}))
