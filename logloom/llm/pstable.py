"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised in double precision. A table's key is a tuple of random
projections, shifted and quantised; the number of tables follows from the wished
recall at the threshold distance. Equal vectors of a label are one class, so
copies never meet in a bucket. Buckets of two or more classes fetch their
vectors; the exact cosine decides, and a pair counts in the first table where
it meets. A bucket larger than a block is split into pairs of blocks, each a
group of its own, so memory is bounded and no candidate is dropped. Groups give
back a row per vector and table at most: its links and the smallest vector it is
joined to within the group, not the pairs themselves.

A vector that is null, empty, zero or holds a null or a non-finite component,
and a row with a null label, link with nothing; vectors of different lengths
never link. Repeated rows are copies and link. A null vec_id takes no part.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import Staged, components, read_table

THRESHOLD = 0.93
RECALL = 0.995
HASHES = 8
WIDTH = 1.2
SEED = 4
BLOCK = 512


def tables_needed(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES, width: float = WIDTH) -> int:
    """Tables so that a pair at the threshold meets in one of them with probability ``recall``."""
    ratio = width / math.sqrt(2 - 2 * threshold)
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    one = 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - one**hashes)))


def _projections(size: int, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([SEED, size])
    return random.standard_normal((size, tables * hashes)), random.uniform(0, width, tables * hashes)


def _keys(unit: np.ndarray, tables: int, hashes: int, width: float, memory: dict) -> np.ndarray:
    """A 64-bit key for each vector and table; ``memory`` keeps the projections of a task."""
    size = unit.shape[1]
    if size not in memory:
        memory[size] = _projections(size, tables, hashes, width)
    directions, shifts = memory[size]
    cells = np.floor((unit @ directions + shifts) / width).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, hashes)
    mixed = np.zeros(cells.shape[:2], np.uint64)
    for k in range(hashes):
        mixed = (mixed ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of one common length as unit vectors."""
    size = len(vectors[0])
    raw = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), size)
    # scaled first, so that squares neither overflow nor vanish
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _bucket_rows(tables: int, hashes: int, width: float):
    def run(batches):
        memory: dict = {}
        for batch in batches:
            sizes = np.asarray(batch.column("vector").value_lengths())
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                for k in range(0, some.num_rows, 2048):
                    part = some.slice(k, 2048)
                    keys = _keys(_matrix(part.column("vector")), tables, hashes, width, memory)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.asarray(part.column("node")), tables)), pa.array(np.repeat(np.asarray(part.column("label")), tables)),
                            pa.array(np.tile(np.arange(tables, dtype=np.int32), part.num_rows)), pa.array(keys.ravel()),
                        ],
                        ["node", "label", "table", "key"],
                    )

    return run


def _verify(threshold: float, tables: int, hashes: int, width: float):
    """Rows sorted by (label, size, table, key, low, high); each such group is compared and summed up."""

    def compare(rows: pa.RecordBatch, memory: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        node, copies, block = (np.asarray(rows.column(c)) for c in ("node", "copies", "block"))
        table, low, high = rows.column("table")[0].as_py(), rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        unit = _matrix(rows.column("vector"))
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        linked = unit[a] @ unit[b].T >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return None
        if table:
            # a pair counts in the first table where it meets
            keys = _keys(unit, tables, hashes, width, memory)[:, :table]
            for k in range(table):
                linked &= keys[a, k][:, None] != keys[b, k][None, :]
        counts = np.zeros(len(node), np.int64)
        np.add.at(counts, a, linked @ copies[b])
        root = node.copy()
        if low != high:
            np.add.at(counts, b, linked.T @ copies[a])
        for _ in range(len(node)):
            # the smallest node next to every row, until nothing changes
            before = root.copy()
            far = np.iinfo(np.int64).max
            root[a] = np.minimum(root[a], np.where(linked, root[b][None, :], far).min(axis=1, initial=far))
            root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], far).min(axis=0, initial=far))
            if (root == before).all():
                break
        some = (counts > 0) | (root != node)
        return node[some], counts[some], root[some]

    def run(batches):
        held, memory = None, {}
        keys = ["label", "size", "table", "key", "low", "high"]
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            if not batch.num_rows:
                continue
            marks = np.stack([np.asarray(batch.column(k), np.int64) for k in keys])
            cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1
            borders = [0, *cuts.tolist()]
            found = [compare(batch.slice(a, b - a), memory) for a, b in zip(borders[:-1], borders[1:])]
            held = batch.slice(borders[-1])
            yield from _out(found)
        if held is not None and held.num_rows:
            yield from _out([compare(held, memory)])

    def _out(found):
        found = [x for x in found if x is not None]
        if found:
            columns = [np.concatenate(x) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "links", "root"])

    return run


def _valid(vector: str, label: str, row: str) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = F.col(vector)
    return F.coalesce(
        F.col(label).isNotNull() & F.col(row).isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False)
    )


def linked(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES, width: float = WIDTH) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    stage = Staged(vectors.sparkSession, "vectors")
    tables = tables_needed(threshold, recall, hashes, width)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label"))
    # zeros of either sign are one value; 128 bits of two hashes name a vector
    plain = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("valid", _valid("vector", "label", "vec_id"))
    named = rows.withColumns({"h1": F.when(F.col("valid"), F.xxhash64(plain)), "h2": F.when(F.col("valid"), F.xxhash64(F.lit(SEED), plain))})
    ids = stage.write(named.select("vec_id", "label", "valid", "h1", "h2"))
    classes = stage.write(
        ids.where("valid").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    )
    # one row of a class carries the vector; a repeated id with the same vector is taken once
    first = named.where("valid").join(classes, ["label", "h1", "h2"]).where("vec_id = node").select("node", "label", "copies", "vector", "h1", "h2")
    first = stage.write(first.groupBy("node", "label", "h1", "h2").agg(F.first("copies").alias("copies"), F.first("vector").alias("vector")).drop("h1", "h2"))
    buckets = stage.write(first.select("node", "label", "vector").mapInArrow(_bucket_rows(tables, hashes, width), "node long, label long, table int, key long"))
    full = buckets.groupBy("label", "table", "key").agg(F.count("*").alias("members")).where("members > 1")
    met = buckets.join(full, ["label", "table", "key"])
    # a bucket over one block: every row goes to the block pairs its block is in
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("low"), F.greatest(o, F.col("block")).alias("high")))
    spread = met.withColumn("block", block).select("node", "label", "table", "key", "block", F.inline(pairs))
    group = ["label", "size", "table", "key", "low", "high"]
    payload = first.withColumn("size", F.size("vector"))
    compared = (
        spread.join(payload, ["node", "label"])
        .select(*group, "block", "node", "copies", "vector")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(_verify(threshold, tables, hashes, width), "node long, links long, root long")
    )
    found = stage.write(compared)
    counts = found.groupBy("node").agg(F.sum("links").alias("others"))
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), Staged(vectors.sparkSession, "vector-components"))
    per_class = stage.write(
        classes.join(counts, "node", "left").join(joined, "node", "left").select(
            "label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component_id")
        )
    )
    return ids.join(per_class, ["label", "h1", "h2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op4_embedding_links(spark, folder) -> DataFrame:
    return linked(read_table(spark, folder, "embeddings"))
