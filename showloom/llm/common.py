"""Folders, partitions and packed arrays shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, one is made and set for the session in local mode; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: With it Spark removes the shuffle files of a write when the write has ended, instead of when the frame is forgotten.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: cuts the lineage.

    What was shuffled for it goes as soon as it is written; ``df`` itself should not be used again.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` made and that nothing reads any more. Nothing else may be given."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def gathered(df: DataFrame, fewer: int = 8) -> DataFrame:
    """The rows in fewer partitions, but no fewer than there are cores: for what costs something for each task, as the files that it writes do."""
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, partitions(spark) // fewer))


def pieces(batch: pa.RecordBatch, column: str, most: int):
    """Slices of a batch with at most so many bytes of text in a column; a longer text comes alone."""
    text = batch.column(column)
    start, size = 0, 0
    for i, n in enumerate(byte_lengths(text).tolist()):
        if size + n > most and i > start:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column one after the other, and where each text starts (with the end); null is empty."""
    text = text.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = text.buffers()
    at = np.frombuffer(offsets, np.int64, len(text) + 1, text.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def byte_lengths(text: pa.Array) -> np.ndarray:
    return np.diff(utf8(text)[1])


def long_values(column: pa.Array, null: int = 0) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()).fill_null(null))


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``[start, start + length)``, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as byte planes, which the compression of a shuffle shrinks well."""
    return b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)


def unpacked(data: bytes, *types) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    n, at, out = len(data) // sum(widths), 0, []
    for t, w in zip(types, widths, strict=True):
        planes = np.frombuffer(data, np.uint8, n * w, at).reshape(w, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(t))
        at += n * w
    return out
