"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut in two halves, each quantised by its own centroids (k-means on a bounded sample); a vector's cell is
the pair of its halves' centroids. A query visits cells in the order of the summed squared distances of its halves to the
centroids, by a heap over the sorted distances, until the visited cells hold enough entries; every entry of a visited cell
is then ranked by its exact cosine.

What is enough is measured: for at most CALIBRATION queries the nearest rows are found by brute force over all rows, and
the number of entries is chosen that would have reached the share RECALL of them. Vectors with structure need few entries,
vectors without need a good part of the table, and the recall stays the same.

Every valid row is indexed. Entries are dealt over as many parts as their number asks for, by cell; a cell with more than BLOCK entries is dealt in
several blocks by the id's hash, and a query goes to each block of a visited cell, so a vector that a third of the
rows share is many blocks. A part returns its best few for each query, and these meet by query. The driver holds the
sample, the centroids, the sizes of the cells and the calibration's neighbours, all bounded by the constants below.

Cases: rows whose vector is null, zero, or holds null or non-finite components, or whose length is not the most common
one among the sampled rows (ties: the smaller), take no part; a null id takes no part; rows with a query's id are its own;
equal scores are ranked by id; with fewer candidates than asked for all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import configure, mix

SAMPLE = 16384
MAX_CENTROIDS = 512
ENTRIES_PER_CELL = 8
CALIBRATION = 64
RECALL = 0.95
BLOCK = 1024
ENTRIES_PER_PART = 1024
ROUNDS = 12


def valid(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(ok, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def vectors_of(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to between a half and one, so that no product overflows or
    vanishes; cosines keep every digit."""
    largest = np.abs(x).max(1, initial=0)
    return np.ldexp(x, -np.frexp(largest)[1][:, None])


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Centroids of the distinct rows of x, from spread-out first ones; ties go to the first."""
    x = np.unique(x, axis=0)
    centres, near = x[:1], distances(x, x[:1])[:, 0]
    random = np.random.default_rng(1)
    while len(centres) < min(k, len(x)):
        weight = np.maximum(near, 0)
        if not weight.sum() > 0:
            break
        pick = random.choice(len(x), p=weight / weight.sum())
        centres = np.vstack((centres, x[pick]))
        near = np.minimum(near, distances(x, x[pick:pick + 1])[:, 0])
    for _ in range(ROUNDS):
        of = distances(x, centres).argmin(1)
        size = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.sizes: dict[int, int] = {}

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = unit(x)
        cut = self.first.shape[1]
        return distances(x[:, :cut], self.first), distances(x[:, cut:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def visit(self, a: np.ndarray, b: np.ndarray, candidates: int) -> list[int]:
        """The non-empty cells in the order of a[i] + b[j] until they hold `candidates` entries."""
        rows, columns = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        heap, out, held, width = [(a[rows[0]] + b[columns[0]], 0, 0)], [], 0, len(self.second)
        while heap and held < candidates:
            _, i, j = heapq.heappop(heap)
            cell = int(rows[i]) * width + int(columns[j])
            if size := self.sizes.get(cell):
                out.append(cell)
                held += size
            if j + 1 < len(columns):
                heapq.heappush(heap, (a[rows[i]] + b[columns[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (a[rows[i + 1]] + b[columns[0]], i + 1, 0))
        return out

    def needed(self, a: np.ndarray, b: np.ndarray, cells: list[int]) -> list[int]:
        """With how many candidates visit() reaches each of the cells."""
        held, needed = 0, {}
        for cell in self.visit(a, b, sum(self.sizes.values())):
            needed[cell] = held + 1
            held += self.sizes[cell]
        return [needed[c] for c in cells]

    def blocks(self, cell: int) -> int:
        return -(-self.sizes.get(cell, 1) // BLOCK)


def _hash(x: np.ndarray) -> np.ndarray:
    return mix(np.asarray(x, np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def fit(rows: DataFrame, count: int) -> tuple[MultiIndex, int]:
    """Centroids from at most SAMPLE of the `count` valid rows (vec_id, embedding), those with the smallest hash of the
    id; the vectors' length."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()["embedding"]
    lengths = np.array([len(v) for v in sample])
    if not len(lengths):
        return MultiIndex(np.zeros((0, 0)), np.zeros((0, 0))), 0
    length = int(np.bincount(lengths).argmax())
    x = unit(np.array([v for v in sample if len(v) == length], dtype=np.float64))
    k = int(min(MAX_CENTROIDS, max(1, round((count / ENTRIES_PER_CELL) ** 0.5))))
    cut = (length + 1) // 2
    second = kmeans(x[:, cut:], k) if length > 1 else np.zeros((1, 0))
    return MultiIndex(kmeans(x[:, :cut], k), second), length


def best_rows(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


def calibrated(entries: DataFrame, queries: DataFrame, index: MultiIndex, neighbours: int) -> int:
    """The number of candidates that reaches RECALL of the calibration queries' nearest rows."""
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).collect()
    if not asked:
        return 0
    own, y = np.array([r["vec_id"] for r in asked]), np.array([r["embedding"] for r in asked], dtype=np.float64)

    def nearest_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))] * len(own)
        for batch in batches:
            if batch.num_rows:
                ids, cells = batch.column("vec_id").cast(pa.int64()).to_numpy(), batch.column("cell").to_numpy()
                scores = unit(vectors_of(batch.column("embedding"))) @ unit(y).T
                for k, q in enumerate(own):
                    other = ids != q
                    both = [np.concatenate(c) for c in zip(held[k], (ids[other], scores[other, k], cells[other]))]
                    best = best_rows(both[0], both[1], neighbours)
                    held[k] = tuple(c[best] for c in both)
        rows = [(k, *row) for k, columns in enumerate(held) for row in zip(*(c.tolist() for c in columns))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.float64(), pa.int64()))],
                                         names=["query", "vec_id", "score", "cell"])

    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    found = (entries.mapInArrow(nearest_of_task, "query int, vec_id long, score double, cell long")
             .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select("query", "cell").collect())
    halves = index.halves(y)
    needed = []
    for k in range(len(own)):
        needed += index.needed(halves[0][k], halves[1][k], [r["cell"] for r in found if r["query"] == k])
    return sorted(needed)[max(0, int(np.ceil(RECALL * len(needed))) - 1)] if needed else 0


def nearest(rows: DataFrame, is_query: Column, neighbours: int, candidates: int | None = None) -> DataFrame:
    """For each row (vec_id, embedding) for which is_query holds: query_id, rank, vec_id, score of its nearest rows among
    the entries of the cells visited until they hold `candidates` (None: as many as calibrated() finds)."""
    spark = rows.sparkSession
    configure(spark)
    rows = rows.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
    count = rows.count()
    index, length = fit(rows, count)
    rows = rows.where(F.size("embedding") == length)
    parts = max(1, -(-count // ENTRIES_PER_PART))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = index.cells(vectors_of(batch.column("embedding")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64())], names=["vec_id", "embedding", "cell"])

    types = dict(rows.dtypes)
    entries = rows.mapInArrow(assign, f"vec_id {types['vec_id']}, embedding {types['embedding']}, cell long")
    if length:
        index.sizes = {r["cell"]: r["count"] for r in entries.groupBy("cell").count().collect()}
        if candidates is None:
            candidates = calibrated(entries, rows.where(is_query), index, neighbours)

    def part_of(cell: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (_hash(np.asarray(cell) * 65537 + np.asarray(block)) % np.uint64(parts)).astype(np.int32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            count = np.array([index.blocks(c) for c in cells.tolist()], np.uint64)
            block = (_hash(batch.column("vec_id").cast(pa.int64()).to_numpy()) % np.maximum(count, 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(cells, block)), *batch.columns], names=["part", "vec_id", "embedding", "cell"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each query and part that holds blocks of visited cells, with these cells."""
        for batch in batches:
            out: list[tuple[int, int, list[int]]] = []
            if batch.num_rows:
                for k, (a, b) in enumerate(zip(*index.halves(vectors_of(batch.column("embedding"))))):
                    cells = index.visit(a, b, candidates)
                    both = [(c, n) for c in cells for n in range(index.blocks(c))]
                    by: dict[int, set[int]] = {}
                    for part, (c, _) in zip(part_of([c for c, _ in both], [n for _, n in both]).tolist(), both):
                        by.setdefault(part, set()).add(c)
                    out += [(part, k, sorted(cs)) for part, cs in by.items()]
            take = pa.array([k for _, k, _ in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _, _ in out], pa.int32()), batch.column("vec_id").take(take), batch.column("embedding").take(take),
                 pa.array([c for _, _, c in out], pa.list_(pa.int64()))], names=["part", "vec_id", "embedding", "cells"])

    def rank(queries: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by([("cell", "ascending"), ("vec_id", "ascending")])
        ids, cells = found.column("vec_id").to_numpy(), found.column("cell").to_numpy()
        x = scaled(vectors_of(found.column("embedding").combine_chunks()) if len(ids) else np.zeros((0, length)))
        size = np.sqrt((x * x).sum(1))
        out = []
        for q, vector, own in zip(queries.column("vec_id").to_pylist(), queries.column("embedding").to_pylist(), queries.column("cells").to_pylist()):
            bounds = zip(np.searchsorted(cells, own), np.searchsorted(cells, own, side="right"))
            rows = np.concatenate([np.arange(a, b) for a, b in bounds]) if own else np.zeros(0, np.int64)
            rows = rows[ids[rows] != q]
            y = scaled(np.array([vector], np.float64))[0]
            score = (x[rows] * y).sum(1) / (size[rows] * np.sqrt((y * y).sum()))
            best = best_rows(ids[rows], score, neighbours)
            out += [(q, int(ids[rows[k]]), float(score[k])) for k in best]
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "vec_id": pa.array([o[1] for o in out], pa.int64()),
                         "score": pa.array([o[2] for o in out], pa.float64())})

    dealt = entries.mapInArrow(deal, f"part int, vec_id {types['vec_id']}, embedding {types['embedding']}, cell long")
    routed = rows.where(is_query).mapInArrow(route, f"part int, vec_id {types['vec_id']}, embedding {types['embedding']}, cells array<long>")
    best = routed.groupBy("part").cogroup(dealt.groupBy("part")).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
