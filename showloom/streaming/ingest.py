"""Incremental ingest of captured pages as a stream.

What is stored are versions: for each batch the newest page of each key in it, with its ``page_id``. The
newest version of a key over all batches and streams is what counts, so the result does not depend on
where the stream was cut into batches, nor on their order. Each micro-batch writes a folder named by
stream and batch, so a batch that is run again after a failure replaces its own rows. Pages that
are no newer than what is stored are left out by their keys alone. Whole pages are not shuffled, but for those that are
left of a batch with fewer splits than there are cores, a single file for example: they are dealt out to all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import captures
from ..operators.joins import distinct_keys, keep_rows, key_of
from ..sources import commits
from ..sources import schemas as S
from ..sources import tables

_BATCH_BYTES = 1 << 40


@dataclass(frozen=True)
class Ingest:
    """``extract`` maps pages to ``(page_id, <key>, fields...)``, row by row.

    A later capture has the higher ``page_id``; captures of one key with the same id are taken to be the same.
    """

    spark: SparkSession
    folder: str
    extract: Callable[[DataFrame], DataFrame]
    key: str = "url"

    @property
    def rows(self) -> str:
        return f"{self.folder}/rows"

    def known(self, stream: str, batch_id: int) -> DataFrame:
        """Keys and ids stored by other streams and by earlier batches of this one."""
        schema = f"page_id bigint, {self.key} string, stream string, batch bigint"
        stored = tables.read_or_empty(self.spark, self.rows, schema)
        return stored.filter((F.col("stream") != stream) | (F.col("batch") < batch_id)).select(self.key, "page_id")

    def newer(self, pages: DataFrame, stream: str, batch_id: int) -> DataFrame:
        """Keys of a batch with the id of their newest page, where nothing as new is stored.

        Of what is stored only the keys of the batch are grouped; they are found by a semi join whose small side is the batch.
        """
        arrived = pages.groupBy(self.key).agg(F.max("page_id").alias("page_id"))
        known = keep_rows(self.known(stream, batch_id), distinct_keys(arrived, [self.key]), [self.key], "left_semi")
        last = known.groupBy(self.key).agg(F.max("page_id").alias("__last"))
        keyed = last.select(key_of(last, [self.key]), "__last")
        both = arrived.select("*", key_of(arrived, [self.key])).join(keyed, "__key", "left")
        return both.filter(F.col("__last").isNull() | (F.col("page_id") > F.col("__last"))).select(self.key, "page_id")

    def _newest(self, rows: DataFrame) -> DataFrame:
        return captures.latest(rows.withColumn("__order", F.col("page_id")), self.key, "__order")

    def store_batch(self, pages: DataFrame, stream: str, batch_id: int) -> None:
        part = f"stream={stream}/batch={batch_id}"
        self.newer(pages, stream, batch_id).write.mode("overwrite").parquet(f"{self.folder}/fresh/{part}")
        fresh = self.spark.read.parquet(f"{self.folder}/fresh/{part}")

        near = captures.wanted(pages, fresh, [self.key, "page_id"])
        cores = self.spark.sparkContext.defaultParallelism
        if pages.rdd.getNumPartitions() < cores:
            near = near.repartition(cores)
        once = self._newest(self.extract(near))
        stored = keep_rows(once, distinct_keys(fresh, [self.key, "page_id"]), [self.key, "page_id"], "left_semi")
        stored.write.mode("overwrite").parquet(f"{self.rows}/{part}")

    def run(self, source: str, stream: str, files_per_batch: int | None = None) -> None:
        """Take in what has arrived since the last run of this stream, then stop.

        A backlog is cut into batches by size, or by number of files if that is given.
        """
        limit = ("maxFilesPerTrigger", files_per_batch) if files_per_batch else ("maxBytesPerTrigger", _BATCH_BYTES)
        reader = self.spark.readStream.schema(S.PAGES).option(*limit)
        query = (
            reader.parquet(source)
            .writeStream.foreachBatch(lambda pages, batch_id: self.store_batch(pages, stream, batch_id))
            .option("checkpointLocation", f"{self.folder}/progress/{stream}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def result(self) -> DataFrame:
        """The newest version of each key: only extracted fields are grouped, and combined before the shuffle."""
        return self._newest(self.spark.read.parquet(self.rows).drop("stream", "batch"))

    def publish(self, path: str) -> None:
        """Merge the versions into a table of their own, which readers see as a whole (``commits.read_published``)."""
        commits.publish(self.result(), path)
