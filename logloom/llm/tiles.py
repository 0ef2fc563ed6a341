"""Stated queries against all rows, tile by tile.

Rows become blocks (one Arrow row with matrices in it), queries become groups,
and every group of queries meets every group of blocks in one task, which
streams through the blocks: memory is one query group and one block, at every
size. Of the queries each group is sent to all groups of blocks and the other
way round, which is what a blocked matrix product moves; rows are moved as
blocks, never as pairs.
"""

from __future__ import annotations

import heapq
import math
import pickle
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
QUERY_GROUP = 1 << 14
ROW_GROUP = 1 << 19
PAIRS = 1 << 13
BLOCKS = "slot int, dim int, n int, part int, k int, payload binary"


def finite(vector: str) -> Column:
    """True for vectors that are not null and hold finite numbers only."""
    return F.coalesce(F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def first_of_class(rows: DataFrame, keys: list[str], most: int, name: str = "vec_id") -> DataFrame:
    """Of rows that agree in ``keys`` those with the ``most`` smallest names.

    A search that returns fewer than ``most`` rows in order of (score, name) finds
    the same rows in what is left, and one vector that fills a third of a table
    costs no more than any other. Ranks are cut in every task before the shuffle.
    """
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(name))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")


def vector_hashes(vector: str) -> dict[str, Column]:
    """128 bits that name a vector."""
    return {"h1": F.xxhash64(vector), "h2": F.xxhash64(F.lit(7), vector)}


def packed(rows: DataFrame, make, columns: list[str], vector: str, slot: Column | None = None) -> DataFrame:
    """Blocks of at most ``BLOCK`` rows of one slot and one length of ``vector``; ``make(matrix, columns)`` gives a block's arrays."""

    def run(batches):
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes, slots = np.asarray(batch.column(vector).value_lengths()), np.asarray(batch.column("slot"))
            for at, size in sorted(set(zip(slots.tolist(), sizes.tolist()))):
                some = batch.filter(pa.array((slots == at) & (sizes == size)))
                for k in range(0, some.num_rows, BLOCK):
                    rows_ = some.slice(k, BLOCK)
                    matrix = np.asarray(rows_.column(vector).flatten()).reshape(rows_.num_rows, size)
                    arrays = make(matrix, {c: np.asarray(rows_.column(c)) for c in columns})
                    count += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array([v], pa.int32()) for v in (at, size, rows_.num_rows, part, count)),
                            pa.array([pickle.dumps(arrays, protocol=5)], pa.binary()),
                        ],
                        ["slot", "dim", "n", "part", "k", "payload"],
                    )

    chosen = rows.select((F.lit(0) if slot is None else slot).cast("int").alias("slot"), *columns, vector)
    if slot is not None:
        chosen = chosen.repartition("slot").sortWithinPartitions("slot")
    return chosen.mapInArrow(run, BLOCKS)


def group_counts(queries: int, rows: int, cores: int) -> tuple[int, int]:
    """Groups of queries and of blocks; small inputs are dealt over all cores."""
    return max(1, math.ceil(queries / QUERY_GROUP)), max(math.ceil(rows / ROW_GROUP), min(cores, math.ceil(rows / BLOCK)), 1)


def met(queries: DataFrame, blocks: DataFrame, counts: tuple[int, int], work, schema: str) -> DataFrame:
    """Every query group with every group of blocks: ``work(dim)`` is made per task and length, takes
    ``queries(arrays)`` for each query block, then ``rows(arrays)`` for each block, and gives batches from ``done()``."""
    far, wide = counts

    def run(batches):
        for group in _streamed(batches):
            works: dict[int, object] = {}
            for kind, dim, payload in group:
                arrays = pickle.loads(payload)
                if kind == 0:
                    if dim not in works:
                        works[dim] = work(dim)
                    works[dim].queries(arrays)
                elif dim in works:
                    works[dim].rows(arrays)
            for one in works.values():
                yield from one.done()

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select(F.col("slot").alias("far"), every(wide).alias("wide"), F.lit(0).alias("kind"), "dim", "payload")
    right = blocks.select(every(far).alias("far"), F.pmod(F.xxhash64("part", "k"), F.lit(wide)).cast("int").alias("wide"), F.lit(1).alias("kind"), "dim", "payload")
    both = left.unionByName(right)
    # as many tasks as tiles, dealt one by one rather than by a hash
    dealt = both.withColumn("tile", F.col("far") * wide + F.col("wide")).repartitionByRange(far * wide, "tile")
    return dealt.sortWithinPartitions("tile", "kind").select("tile", "kind", "dim", "payload").mapInArrow(run, schema)


def _streamed(batches):
    """Sorted rows -> an iterator of (kind, dim, payload) per tile, without holding a tile."""
    rows = (row for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(4))))
    for _, group in groupby(rows, key=lambda r: r[0]):
        yield (r[1:] for r in group)


def exact(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of left[a] and right[b], in double precision summed in order of the components, as a plain loop does."""
    out = np.zeros(len(a), left.dtype)
    for k in range(0, len(a), PAIRS):
        x, y = left[a[k : k + PAIRS]], right[b[k : k + PAIRS]]
        part = np.zeros(len(x), left.dtype)
        for j in range(left.shape[1]):
            part += x[:, j] * y[:, j]
        out[k : k + PAIRS] = part
    return out


def whole_products(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of left[a] and right[b], in the narrowest type in which every partial sum is exact."""
    if not len(a) or not left.shape[1]:
        return np.zeros(len(a), np.int64)
    most = float(np.abs(left).max()) * float(np.abs(right).max()) * left.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    left, right = left.astype(kind), right.astype(kind)
    out = np.zeros(len(a), np.int64)
    for k in range(0, len(a), PAIRS):
        out[k : k + PAIRS] = np.einsum("ij,ij->i", left[a[k : k + PAIRS]], right[b[k : k + PAIRS]])
    return out


class Heaps:
    """For each query the best ``size`` of (score, smaller name first), with the score from which on a row can still enter."""

    def __init__(self, queries: int, size: int, floor):
        self.size = size
        self.heaps: list[list[tuple]] = [[] for _ in range(queries)]
        self.floor = np.array(np.broadcast_to(floor, queries))

    def offer(self, queries: np.ndarray, scores: np.ndarray, names: np.ndarray) -> None:
        fit = np.flatnonzero(scores >= self.floor[queries])
        fit = fit[np.argsort(-scores[fit], kind="stable")]
        for q, score, name in zip(queries[fit].tolist(), scores[fit].tolist(), names[fit].tolist()):
            heap = self.heaps[q]
            if len(heap) < self.size:
                heapq.heappush(heap, (score, -name))
            elif (score, -name) > heap[0]:
                heapq.heapreplace(heap, (score, -name))
            else:
                continue
            if len(heap) == self.size and heap[0][0] > self.floor[q]:
                self.floor[q] = heap[0][0]

    def rows(self):
        for q, heap in enumerate(self.heaps):
            for score, name in heap:
                yield q, -name, score
