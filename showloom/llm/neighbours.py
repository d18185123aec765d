"""Approximate nearest neighbours over balanced posting lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored


@dataclass(frozen=True)
class Settings:
    """How lists are made and searched.

    ``list_size``: vectors a list is meant to hold; the number of lists follows from it, up to ``most_lists``.
    ``sample_rows``: rows the centroids are fitted on at most; all rows are indexed.
    ``part_rows``: rows of a list that are scanned together. ``bucket_rows``: rows of lists that a group of a scan holds.
    ``copies``, ``boundary``: a vector goes to its nearest list and to others, ``copies`` in all, whose centroid is at
    most ``boundary`` times as far.
    ``base_rows``: a query reads its nearest lists until they hold so many rows, and all further lists whose
    centroid is at most ``ratio`` times as far as the last of those (the nearest one alone may be at no distance at all).
    ``recall``, ``judges``: the ratio is the one with which the 10 nearest of ``judges`` sampled vectors, among the sample,
    are found with this recall.
    ``probes``: centroids that the graph gives; a query that needs more is compared with all centroids.
    ``degree``, ``beam``, ``narrow``: neighbours of a centroid in the graph, and how many centroids a search keeps
    open for a query and for a vector that is indexed.
    """

    list_size: int = 64
    most_lists: int = 8192
    sample_rows: int = 40_000
    part_rows: int = 4096
    bucket_rows: int = 1 << 16
    rounds: int = 8
    copies: int = 4
    boundary: float = 1.15
    base_rows: int = 500
    recall: float = 0.97
    judges: int = 256
    probes: int = 48
    degree: int = 24
    beam: int = 96
    narrow: int = 24


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def balanced_centroids(x: np.ndarray, k: int, rounds: int, seed: int = 0) -> np.ndarray:
    """k-means in which a list that holds more than its share looks farther away in the next round."""
    rng = np.random.default_rng(seed)
    x = x[rng.permutation(len(x))]
    centroids, penalty = x[:k].copy(), np.zeros(k)
    for _ in range(rounds):
        nearest, gaps = np.empty(len(x), np.int64), np.empty(len(x))
        for i in range(0, len(x), 2048):
            d = squares(x[i : i + 2048], centroids)
            nearest[i : i + 2048] = np.argmin(d + penalty, 1)
            gaps[i : i + 2048] = d.min(1)
        counts = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        used = counts > 0
        centroids[used] = sums[used] / counts[used, None]
        empty = np.flatnonzero(~used)  # an empty list starts again at a vector far from its own
        centroids[empty] = x[np.argsort(-gaps, kind="stable")[: len(empty)]]
        penalty = np.where(used, penalty + 0.1 * gaps.mean() * (counts * k / len(x) - 1).clip(-1, 4), 0)
        penalty -= penalty.min()
    return centroids


class CentroidGraph:
    """Each centroid linked to its nearest ones; searches walk it from a few entries, for many vectors at once."""

    def __init__(self, centroids: np.ndarray, links: np.ndarray):
        self.centroids, self.links = centroids, links
        self.entries = np.unique(np.linspace(0, len(links) - 1, min(len(links), 32)).astype(np.int64))

    @classmethod
    def over(cls, centroids: np.ndarray, degree: int) -> CentroidGraph:
        k = len(centroids)
        degree = min(degree, k - 1)
        near = np.empty((k, degree), np.int64)
        for i in range(0, k, 1024):
            d = squares(centroids[i : i + 1024], centroids)
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            near[i : i + 1024] = np.argsort(d, 1, kind="stable")[:, :degree]
        ring = (np.arange(k)[:, None] + 1 + np.arange(min(2, k - 1))) % k  # keeps every centroid within reach
        return cls(centroids, np.concatenate([near, ring], 1))

    def search(self, x: np.ndarray, found: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``found`` centroids of each row met on a best-first walk, and their squared distances."""
        out_i, out_d = [], []
        for i in range(0, len(x), 256):
            a, b = self._walk(x[i : i + 256], max(beam, found))
            out_i.append(a[:, :found])
            out_d.append(b[:, :found])
        return np.concatenate(out_i), np.concatenate(out_d)

    def _walk(self, x, beam):
        n, k = len(x), len(self.centroids)
        beam = min(beam, k)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, k), bool)
        done = np.zeros((n, k), bool)
        best = np.full((n, beam), -1)
        far = np.full((n, beam), np.inf)
        new = np.broadcast_to(self.entries, (n, len(self.entries)))
        while True:
            fresh = ~seen[rows, new]
            seen[rows, new] = True
            d = ((x[:, None] - self.centroids[new]) ** 2).sum(2)
            d[~fresh] = np.inf
            both_i, both_d = np.concatenate([best, new], 1), np.concatenate([far, d], 1)
            order = np.argsort(both_d, 1, kind="stable")[:, :beam]
            best, far = np.take_along_axis(both_i, order, 1), np.take_along_axis(both_d, order, 1)
            waiting = np.isfinite(far) & ~done[rows, best]
            if not waiting.any():
                return best, far
            next_ = np.argsort(~waiting, 1, kind="stable")[:, :4]  # the nearest open ones
            open_ = np.take_along_axis(best, next_, 1)
            some = np.take_along_axis(waiting, next_, 1)
            row, at = np.nonzero(some)
            done[row, open_[row, at]] = True
            links = self.links[open_]
            links = np.where(some[:, :, None], links, best[:, :1, None])
            flat = np.sort(links.reshape(n, -1), 1)
            flat[:, 1:][flat[:, 1:] == flat[:, :-1]] = -1
            new = np.where(flat < 0, best[:, :1], flat)


def usable(vectors: DataFrame, dimension: int | None = None) -> DataFrame:
    """``vec_id`` and ``embedding`` (double) of the vectors that take part.

    Left out: null ids, null, empty or zero vectors, null or non-finite components, and vectors of
    another length than most have (the shorter of two equally frequent).
    """
    e = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(
        good & F.exists("embedding", lambda x: x != 0)
    )
    if dimension is None:
        first = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dimension = first["n"] if first else 0
    return rows.filter(F.size("embedding") == dimension)


def matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def chosen_lists(graph: CentroidGraph, x: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The lists that each vector goes to, and which of them count (the first always does)."""
    lists, d = graph.search(x, s.copies, s.narrow)
    return lists, (d <= d[:, :1] * s.boundary**2) & np.isfinite(d)


def needed_ratio(graph: CentroidGraph, x: np.ndarray, share: float, s: Settings, k: int = 10) -> float:
    """The least ratio of distances of centroids with which vectors of a sample (so large a share) find their nearest ones in it."""
    lists, near = chosen_lists(graph, x, s)
    sizes = np.bincount(lists[near], minlength=len(graph.centroids)) / share
    judges = np.random.default_rng(1).permutation(len(x))[: s.judges]
    needed = []
    for part in (judges[i : i + 64] for i in range(0, len(judges), 64)):
        d = squares(x[part], x)
        d[np.arange(len(part)), part] = np.inf
        best = np.argsort(d, 1, kind="stable")[:, : min(k, len(x) - 1)]
        far = squares(x[part], graph.centroids)
        order = np.argsort(far, 1, kind="stable")
        at = (np.cumsum(sizes[order], 1) >= s.base_rows).argmax(1)  # 0 where all lists hold fewer: then all are read
        base = np.take_along_axis(far, np.take_along_axis(order, at[:, None], 1), 1)
        to = np.where(near[best], np.take_along_axis(far[:, None], lists[best], 2), np.inf).min(2)
        needed.append(np.sqrt(to / np.maximum(base, 1e-300)).ravel())
    needed = np.concatenate(needed)
    return float(max(1.0, np.quantile(needed, s.recall))) if len(needed) else 1.0


def _nearest(x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Queries, vectors and distances that hold the k nearest of each query among x, never itself.

    A matrix product finds candidates, with some room for its rounding; their distances are then computed one by one.
    """
    d = squares(q, x)
    d[q_ids[:, None] == ids[None]] = np.inf
    most = min(4 * k, len(ids)) - 1  # copies of one vec_id may be among the nearest
    bound = np.partition(d, most, 1)[:, most : most + 1]
    row, at = np.nonzero((d <= bound * (1 + 1e-9) + 1e-9 * (q * q).sum(1)[:, None]) & np.isfinite(d))
    score = np.empty(len(row))
    for i in range(0, len(row), 1 << 15):
        score[i : i + (1 << 15)] = ((x[at[i : i + (1 << 15)]] - q[row[i : i + (1 << 15)]]) ** 2).sum(1)
    return q_ids[row], ids[at], np.sqrt(score)


def _best(query: np.ndarray, vector: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
    """Of each query the k nearest vectors, each once; ties to the smaller id."""
    order = np.lexsort((score, vector, query))
    new = np.ones(len(order), bool)
    new[1:] = (query[order][1:] != query[order][:-1]) | (vector[order][1:] != vector[order][:-1])
    order = order[new]
    order = order[np.lexsort((vector[order], score[order], query[order]))]
    q = query[order]
    start = np.searchsorted(q, q)
    order = order[np.arange(len(q)) - start < k]
    return [c[order] for c in (query, vector, score)]


class ListIndex:
    """Centroids with their graph, fitted on a bounded sample, and the posting lists of all rows.

    ``lists``: list, part, vec_id, embedding. A list longer than twice ``list_size`` (many equal vectors, say)
    is dealt out over parts, so no task gets more than its share. Rows with the same vec_id are
    copies of one item; the nearest of them counts.
    """

    def __init__(self, vectors: DataFrame, settings: Settings = Settings()):
        self.settings = settings
        self.rows = usable(vectors)
        total = self.rows.count()
        share = min(1.0, 0.97 * settings.sample_rows / max(total, 1))
        place = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))
        sample = self.rows.filter(place).select("embedding").limit(settings.sample_rows).toArrow()
        x = np.unique(matrix(sample.column("embedding").combine_chunks()), axis=0) if sample.num_rows else np.zeros((0, 0))
        k = max(1, min(settings.most_lists, -(-total // settings.list_size), len(x)))
        arrays, self.ratio = None, 1.0
        if len(x):
            graph = CentroidGraph.over(balanced_centroids(x, k, settings.rounds), settings.degree)
            arrays = (graph.centroids, graph.links)
            self.ratio = needed_ratio(graph, x, len(x) / total, settings)
        self.sent = vectors.sparkSession.sparkContext.broadcast(arrays)
        postings = stored(self._assigned(), "postings")
        sizes = postings.groupBy("list").agg(F.count(F.lit(1)).alias("size"))
        parts = F.ceil(F.col("size") / F.lit(settings.part_rows)).cast("int")
        self.parts = stored(sizes.select("list", "size", parts.alias("parts")), "lists")  # one row a list, most_lists at most
        self.lists = postings.join(F.broadcast(self.parts), "list").withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        )
        sizes = np.zeros(k, np.int64)
        for row in self.parts.select("list", "size").collect():
            sizes[row["list"]] = row["size"]
        self.sizes = vectors.sparkSession.sparkContext.broadcast(sizes)
        held = int(sizes.sum())
        self.buckets = max(partitions(vectors.sparkSession), -(-held // settings.bucket_rows))

    def _assigned(self) -> DataFrame:
        sent, s = self.sent, self.settings

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph = sent.value and CentroidGraph(*sent.value)
            for batch in batches:
                if graph is None or not batch.num_rows:
                    continue
                x = matrix(batch.column("embedding"))
                lists, near = chosen_lists(graph, x, s)
                row, which = np.nonzero(near)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists[row, which], pa.int32()), taken.column("vec_id"), taken.column("embedding")],
                    ["list", "vec_id", "embedding"],
                )

        return self.rows.mapInArrow(run, "list int, vec_id long, embedding array<double>")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """query_id, rank (from 1), vec_id and score (Euclidean distance) of each query's ``k`` nearest found.

        ``queries``: vec_id and embedding as in ``usable``; an item is never its own neighbour.
        Ties go to the smaller vec_id. Queries that take no part have no rows.
        """
        sent, sizes, s, ratio = self.sent, self.sizes, self.settings, self.ratio * (1 + 1e-9)
        enough = max(s.base_rows, s.copies * (k + 1))  # the latter hold k others for certain

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            graph = sent.value and CentroidGraph(*sent.value)
            for batch in batches:
                if graph is None or not batch.num_rows:
                    continue
                x = matrix(batch.column("embedding"))
                lists, d = graph.search(x, s.probes, s.beam)
                held = np.cumsum(np.where(np.isfinite(d), sizes.value[lists], 0), 1)
                few = held[:, -1] < enough
                base = np.take_along_axis(d, np.where(few, d.shape[1] - 1, (held >= enough).argmax(1))[:, None], 1)
                near = (d <= base * ratio**2) & np.isfinite(d)
                more = ((d[:, -1:] <= base * ratio**2)[:, 0] | few) & (d.shape[1] < len(graph.centroids))
                row, which = np.nonzero(near & ~more[:, None])
                chosen = [(row, lists[row, which])]
                wide = np.flatnonzero(more)
                for part in (wide[i : i + 256] for i in range(0, len(wide), 256)):
                    within = (squares(x[part], graph.centroids) <= base[part] * ratio**2) | few[part, None]
                    row, which = np.nonzero(near[part])
                    within[row, lists[part][row, which]] = True  # the graph's distances are the more exact ones
                    row, which = np.nonzero(within)
                    chosen.append((part[row], which))
                for row, which in chosen:
                    taken = batch.take(pa.array(row, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(which, pa.int32()), taken.column("vec_id"), taken.column("embedding")],
                        ["list", "query_id", "query"],
                    )

        def scan(lists: pa.Table, asked: pa.Table) -> pa.Table:
            """The nearest of each query among the lists of this bucket that it reads."""
            found: list[tuple[np.ndarray, ...]] = []
            if lists.num_rows and asked.num_rows:
                ids, x = np.asarray(lists.column("vec_id").combine_chunks()), matrix(lists.column("embedding").combine_chunks())
                q_ids, q = np.asarray(asked.column("query_id").combine_chunks()), matrix(asked.column("query").combine_chunks())
                names = [np.stack([np.asarray(t.column(c).combine_chunks()).astype(np.int64) for c in ("list", "part")], 1) for t in (lists, asked)]
                _, which = np.unique(np.concatenate(names), axis=0, return_inverse=True)
                one, two = which.ravel()[: len(ids)], which.ravel()[len(ids) :]
                by_list, by_query = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
                edges = [np.searchsorted(w[o], np.arange(which.max() + 2)) for w, o in ((one, by_list), (two, by_query))]
                for g in range(which.max() + 1):
                    rows, queries_ = by_list[edges[0][g] : edges[0][g + 1]], by_query[edges[1][g] : edges[1][g + 1]]
                    for part in (queries_[i : i + 512] for i in range(0, len(queries_) if len(rows) else 0, 512)):
                        found.append(_nearest(x[rows], ids[rows], q[part], q_ids[part], k))
            out = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            out = _best(*out, k)
            return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

        asked = queries.mapInArrow(choose, "list int, query_id long, query array<double>")
        asked = asked.join(F.broadcast(self.parts), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        bucket = F.pmod(F.xxhash64("list", "part"), F.lit(self.buckets)).cast("int").alias("bucket")
        asked = asked.select(bucket, "list", "part", "query_id", "query")
        held = self.lists.select(bucket, "list", "part", "vec_id", "embedding")
        found = held.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(
            scan, "query_id long, vec_id long, score double"
        )
        nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        ranked = nearest.groupBy("query_id").agg(
            F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("best")
        )
        return ranked.select("query_id", F.posexplode("best").alias("at", "x")).select(
            "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
        )
