"""Shared helpers: the cluster's shared folder, lineage cuts, Arrow batches as flat bytes."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 17
BATCH_BYTES = 8 << 20  # of an Arrow batch; a longer text makes a batch of its own


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a new local one with a local master; an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tarnwork-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data below the shared folder."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def bounded_share(df: DataFrame, rows: int, *key: str) -> Column:
    """True for about `rows` rows of df, whatever its size, by a fixed hash of the key columns; for all of them if there are fewer.

    A share of the hash range is chosen from the row count, so that no task passes on more than its share.
    """
    total = df.select(*key).count()
    if total <= rows:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 40)) < F.lit(-(-(rows << 40) // total))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows that bounded_share takes, 2 * rows at most."""
    return df.where(bounded_share(df, rows, key)).limit(2 * rows)


def small_side(df: DataFrame, rows: int, bound: int) -> DataFrame:
    """df, marked for broadcast if its counted rows are within the bound; else joins shuffle it like any other side."""
    return F.broadcast(df) if rows <= bound else df


def private_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and len+1 offsets into them; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]]
    return data, offs - offs[0]


def text_slices(column: pa.Array, budget: int = SLICE_BYTES):
    """Yield (first row, end row, bytes, offsets) over whole texts, each slice of about `budget` bytes, at least one text."""
    data, offs = flat_text(column)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + budget, "right")) - 1)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of the session end at BATCH_BYTES, or at a smaller bound that it has already. JVM and Python worker each hold whole batches."""
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def release_memory() -> None:
    """Give the freed memory of a Python worker back to the system: idle workers are kept, and many share a machine."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def filesystem(uri: str):
    """(file system, path) of a URI below the shared folder; driver and executors both reach it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


class PartFile:
    """A file below a shared URI, written piece by piece under a temporary name; it gets its own name when closed."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part, self.size = f"{self.path}.{uuid.uuid4().hex}.part", 0
        self.stream = self.fs.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.part, self.path)


def let(value: Column, body) -> Column:
    """body(value), with value computed once, however often and in whatever lambda body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))
