"""Reading and writing tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions.nested import to_json

#: Stands for an empty text while a file is read, where an unquoted nothing is null.
_EMPTY = "\x00"
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_READ = _CSV | {"emptyValue": _EMPTY}
#: Text of a row that does not fit its schema.
BAD = "_corrupt_record"
#: With it Spark removes the shuffle files of a write when the write has ended, instead of when the frame is forgotten.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Parquet tables of one folder as attributes: ``Tables(spark, folder).pages``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def spread(self, name: str) -> DataFrame:
        """The table for work that is heavy on the processor (see ``spread_scan``)."""
        return spread_scan(getattr(self, name))

    def stream_path(self, name: str) -> str:
        """For file streams, whose path must be a folder or a pattern."""
        return f"{self.path(name)}*"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def spread_scan(scan: DataFrame) -> DataFrame:
    """A scan of fewer splits than there are cores, dealt out to all of them.

    Reading fields out of markup takes far longer than moving it, so idle cores cost more than
    the exchange. A large table has more splits than cores and is left alone. Only for plain
    scans: counting the partitions of anything else could run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header and quoted fields that may hold line breaks and doubled quotes.

    A file with line breaks inside fields is read by one task; key snapshots have none, and
    ``multi_line=False`` lets large ones be split.
    """
    rows = spark.read.schema(schema).options(**_READ, multiLine=multi_line).csv(path)
    return rows.select(*[_text(f) for f in rows.schema])


def _text(f: StructField):
    c = F.col(f"`{f.name}`")
    return F.when(c == _EMPTY, "").otherwise(c).alias(f.name) if isinstance(f.dataType, StringType) else c


def read_nested_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """What ``write_csv`` wrote, in its own types, and a column ``_corrupt_record``.

    A row with a field too few or too many, or with a value that is not of its column's type, has its text there; what can be read of it stays.
    """
    given = spark.createDataFrame([], schema).schema
    nested = {f.name: f.dataType for f in given if isinstance(f.dataType, _NESTED)}
    flat = StructType([StructField(f.name, StringType() if f.name in nested else f.dataType) for f in given])
    options = _READ | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD, "columnPruning": False, "multiLine": multi_line}
    rows = spark.read.schema(flat.add(BAD, "string")).options(**options).csv(path)

    def parsed(name: str):
        wrapped = F.concat(F.lit('{"v":'), F.col(f"`{name}`"), F.lit("}"))
        whole = StructType([StructField("v", nested[name]), StructField(BAD, StringType())])
        return F.from_json(wrapped, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})

    read = rows.withColumns({f"__{n}": parsed(n) for n in nested}) if nested else rows
    broken = [F.col(f"`__{n}`.{BAD}") for n in nested]
    columns = [F.col(f"`__{f.name}`.v").alias(f.name) if f.name in nested else _text(f) for f in given]
    return read.select(*columns, F.coalesce(BAD, *broken).alias(BAD))


_NESTED = (ArrayType, MapType, StructType)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; nested columns as JSON text that keeps null fields."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, _NESTED)]
    flat = df.withColumns({n: to_json(F.col(f"`{n}`")) for n in nested}) if nested else df
    flat.write.mode(mode).options(**_CSV | {"emptyValue": '""'}).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table, or an empty one of the same schema where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a write in here goes as soon as it is written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """Non-null values per column of a Parquet table, one row, added up from the footers of its files: no column is read.

    Spark answers counts from footers only in its second reader interface, which is chosen by session, so this
    frame belongs to a session of its own over the same cluster.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    table = own.read.parquet(path)
    return table.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in table.columns])


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Without that setting a machine-local folder is used in local mode only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="showloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
