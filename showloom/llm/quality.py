"""Quality of texts: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, utf8
from .words import grams, hashed_words

#: Labelled rows that are fitted on at most, and the parts they are learnt in side by side.
MAX_TRAIN_ROWS = 16_000
SHARDS = 1

BITS = 18
SLICE_BYTES = 2_000_000


@dataclass(frozen=True)
class Settings:
    """Step sizes and penalties of the updates, and passes over the sample."""

    alpha: float = 5.0
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    passes: int = 6


def features(text: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words and word pairs of texts: slots, weights and where each text's begin.

    A word is a run of letters and digits or a run of other signs. All pairs of a word with
    itself are one feature. A text's weights are the roots of its counts, scaled to length 1.
    """
    raw, at = utf8(text)
    words = hashed_words(raw, at, lower=False, split="both")
    owner = words.owner()
    pairs = grams(words.hashes, 2)
    pairs[words.hashes[1:] == words.hashes[:-1]] = 0
    inside = owner[:-1] == owner[1:] if len(owner) > 1 else np.zeros(0, bool)
    hashes = np.concatenate([words.hashes, pairs[inside]])
    whose = np.concatenate([owner, owner[:-1][inside]]).astype(np.uint64)
    keys, counts = np.unique((whose << np.uint64(bits)) | (hashes >> np.uint64(64 - bits)), return_counts=True)
    slots, whose = (keys & np.uint64(2**bits - 1)).astype(np.int64), (keys >> np.uint64(bits)).astype(np.int64)
    starts = np.searchsorted(whose, np.arange(len(text) + 1))
    weights = np.sqrt(counts)
    norms = np.sqrt(np.bincount(whose, counts, len(text)))
    return slots, weights / np.maximum(norms, 1)[whose], starts


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings, bits: int) -> np.ndarray:
    """Weights, the last one for the constant, after passing over the rows with per-coordinate updates."""
    z, n = np.zeros(2**bits + 1), np.zeros(2**bits + 1)

    def weights(i):
        return np.where(
            np.abs(z[i]) <= settings.l1, 0.0,
            -(z[i] - np.sign(z[i]) * settings.l1) / ((settings.beta + np.sqrt(n[i])) / settings.alpha + settings.l2),
        )

    for _ in range(settings.passes):
        for slots, values, label in rows:
            w = weights(slots)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
            g = (p - label) * values
            sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / settings.alpha
            z[slots] += g - sigma * w
            n[slots] += g * g
    return weights(np.arange(2**bits + 1))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings(), bits: int = BITS,
    max_rows: int = MAX_TRAIN_ROWS, shards: int = SHARDS,
) -> np.ndarray:
    """Weights learnt from texts whose ``doc_id`` has a label 0 or 1; other labels are left out.

    Fits on at most ``max_rows`` labelled rows, those of the smallest hash. Their texts are
    learnt in ``shards`` parts, whose weights are averaged. Without any row all weights are 0.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_rows rows
    schema = "slot int, weight double"

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")])
        rows, labels_ = [], table.column("label").to_pylist()
        for start in range(0, table.num_rows, 512):
            slots, values, at = features(table.column("text").slice(start, 512).combine_chunks(), bits)
            for i in range(len(at) - 1):
                x, v = slots[at[i] : at[i + 1]], values[at[i] : at[i + 1]]
                rows.append((np.append(x, 2**bits), np.append(v, 1.0), labels_[start + i]))
        w = fit(rows, settings, bits)
        used = np.flatnonzero(w)
        return pa.table({"slot": pa.array(used, pa.int32()), "weight": pa.array(w[used], pa.float64())})

    order = F.xxhash64("doc_id", F.lit(1))
    parts = texts.withColumns({"shard": F.pmod(F.xxhash64("doc_id"), F.lit(shards)), "order": order})
    learnt = parts.groupBy("shard").applyInArrow(learn, schema)
    weights = np.zeros(2**bits + 1)
    for slot, weight in learnt.groupBy("slot").agg(F.sum("weight")).toLocalIterator():  # 2**bits + 1 rows at most
        weights[slot] = weight / shards
    return weights


def scores_of(text: pa.Array, weights: np.ndarray, bits: int) -> np.ndarray:
    slots, values, at = features(text, bits)
    sums = np.append(0.0, np.cumsum(weights[slots] * values))
    dots = sums[at[1:]] - sums[at[:-1]] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(dots, -30, 30)))


def score(docs: DataFrame, weights: np.ndarray, bits: int = BITS) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: label 1 likelier) of every row; null and empty texts have the constant's.

    The weights are an array of fixed size and go to every task. Repeated rows stay.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                scores = scores_of(part.column("text"), w, bits)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(scores)], ["doc_id", "score"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, weights: np.ndarray, bits: int = BITS, least: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all columns, whose ``text`` scores ``least`` or more; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE_BYTES):
                yield part.filter(pa.array(scores_of(part.column("text"), sent.value, bits) >= least))

    return docs.mapInArrow(run, docs.schema)
