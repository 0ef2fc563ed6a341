"""Hard-negative mining with rotated one-bit codes.

Components become whole numbers, floor(256 * x), and scores are their integer
inner products. A vector is turned by a random rotation and kept as sign bits
with the code vector's alignment, the stored length of the vector along its
code. One code leaves a residual of 0.6 of the length, for which the interval
below is too wide to rule anything out, so what a code leaves is coded again,
``CODES`` times in all, each with its own alignment. Popcounts of two vectors'
codes give the estimate of their product; by Cauchy-Schwarz the residuals' lengths
bound its error for certain. Only pairs whose interval meets a window that is
still open are scored on the integers, and only those scores decide.

There are two passes over the same blocks of rows, tile by tile: each anchor's
best rows of its own label, then, for each of these positives, the best rows
of other labels with a score between ``share`` of the positive's and the
positive's. Blocks mostly hold one label, so a pass looks at its side only.
Equal vectors of a label beyond the first names can't be in a result and are
left out before.

Nulls: rows with a null vec_id, a null label, a null vector or a null or
non-finite component take no part; zero and empty vectors do. Vectors of
different lengths do not meet. A row with the anchor's own vec_id is never its
positive; other repeated rows count each; of repeated anchors the smallest
(label, vector) counts. Products are taken in 64-bit integers, so components are
to stay below 2**31 / 256. An anchor without positives or negatives gives no
rows; so does an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm import tiles
from logloom.llm.common import Staged, read_table
from logloom.session import ship_package

POSITIVES = 5
NEGATIVES = 5
SHARE = 80
CODES = 4
SCALE = 256
ANCHOR_EVERY = 100
#: The query's labels: rows of every seventh name move on to the next of ten labels.
SHIFTED_EVERY, LABELS = 7, 10
SEED = 12
#: Rows of a tile that are worked on together, so that they stay in a core's cache.
STRIP = 16
#: Relative slack for rounding in rotation and estimate.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    turned, upper = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
    return turned * np.sign(np.diag(upper))


def coded(matrix: np.ndarray, turn: np.ndarray, codes: int = CODES) -> dict:
    """Sign bits (rows, codes, words) of the rotated vectors, alignments, and the lengths of estimate, whole and rest."""
    left = matrix.astype(np.float64) @ turn
    whole, (n, dim) = np.sqrt((left * left).sum(axis=1)), left.shape
    words = max(1, -(-dim // 64))
    bits, alignment = np.zeros((n, codes, words), np.uint64), np.zeros((n, codes))
    estimate = np.zeros_like(left)
    for k in range(codes if dim else 0):
        sign = left >= 0
        alignment[:, k] = np.abs(left).mean(axis=1)
        step = np.where(sign, 1.0, -1.0) * alignment[:, k : k + 1]
        estimate += step
        left = left - step
        packed = np.zeros((n, words * 8), np.uint8)
        packed[:, : -(-dim // 8)] = np.packbits(sign, axis=1)
        bits[:, k] = packed.view(np.uint64)
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    return {"bits": bits, "alignment": alignment, "known": length(estimate), "whole": whole, "left": length(left)}


def intervals(a: dict, rows: np.ndarray, b: dict, columns: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of a[rows] with b[columns], from popcounts and lengths alone."""
    slopes, other = a["alignment"][rows], b["alignment"][columns]
    # a product of two code vectors is dim less twice the bits in which they differ
    estimate = dim * np.outer(slopes.sum(axis=1), other.sum(axis=1))
    for k in range(0, len(rows), STRIP):
        strip = estimate[k : k + STRIP]
        for i in range(slopes.shape[1]):
            for j in range(other.shape[1]):
                apart = np.bitwise_count(a["bits"][rows[k : k + STRIP], i, 0][:, None] ^ b["bits"][columns, j, 0])
                for w in range(1, a["bits"].shape[2]):
                    apart = apart + np.bitwise_count(a["bits"][rows[k : k + STRIP], i, w][:, None] ^ b["bits"][columns, j, w]).astype(np.int32)
                strip -= apart * np.outer(2 * slopes[k : k + STRIP, i], other[:, j])
    # <q, x> - <q', x'> = <q', x - x'> + <q - q', x>
    error = np.outer(a["known"][rows], b["left"][columns]) + np.outer(a["left"][rows], b["whole"][columns])
    error += SLACK * (1 + np.outer(a["whole"][rows], b["whole"][columns]))
    return estimate - error, estimate + error


def _block(codes: int):
    turns: dict[int, np.ndarray] = {}

    def make(matrix: np.ndarray, columns: dict) -> dict:
        dim = matrix.shape[1]
        if dim not in turns:
            turns[dim] = rotation(dim)
        return {"name": columns["vec_id"], "label": columns["label"], "vector": matrix, **coded(matrix, turns[dim], codes)}

    return make


class _Positives:
    """The best rows of each anchor's own label."""

    SCHEMA = "anchor_id long, vec_id long, score long"

    def __init__(self, dim: int, most: int):
        self.dim, self.most, self.parts, self.heaps = dim, most, [], []

    def queries(self, arrays: dict) -> None:
        self.parts.append(arrays)
        self.heaps.append(tiles.Heaps(len(arrays["name"]), self.most, np.iinfo(np.int64).min))

    def rows(self, block: dict) -> None:
        for part, heaps in zip(self.parts, self.heaps):
            for label in np.unique(block["label"]):
                mine, some = np.flatnonzero(part["label"] == label), np.flatnonzero(block["label"] == label)
                if not len(mine):
                    continue
                _, upper = intervals(part, mine, block, some, self.dim)
                open_ = (upper >= heaps.floor[mine][:, None]) & (part["name"][mine][:, None] != block["name"][some])
                q, r = np.nonzero(open_)
                q, r = mine[q], some[r]
                heaps.offer(q, tiles.whole_products(part["vector"], block["vector"], q, r), block["name"][r])

    def done(self):
        for part, heaps in zip(self.parts, self.heaps):
            found = list(heaps.rows())
            if found:
                q, name, score = (np.array(x, np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(part["name"][q]), pa.array(name), pa.array(score)], ["anchor_id", "vec_id", "score"])


class _Negatives:
    """The best rows of other labels in each positive's window; windows are columns of ``high``, -1 where there is none."""

    SCHEMA = "anchor_id long, place int, vec_id long, score long"

    def __init__(self, dim: int, most: int, share: int):
        self.dim, self.most, self.share, self.parts, self.windows = dim, most, share, [], []

    def queries(self, arrays: dict) -> None:
        high = arrays["high"]
        low = -(-self.share * high // 100)
        self.parts.append(arrays)
        # an empty window is closed by a floor above it
        self.windows.append([tiles.Heaps(len(high), self.most, np.where(h < 0, np.iinfo(np.int64).max, at)) for h, at in zip(high.T, low.T)])

    def rows(self, block: dict) -> None:
        for part, windows in zip(self.parts, self.windows):
            for label in np.unique(block["label"]):
                mine, some = np.flatnonzero(part["label"] != label), np.flatnonzero(block["label"] == label)
                if not len(mine):
                    continue
                lower, upper = intervals(part, mine, block, some, self.dim)
                open_ = np.zeros(lower.shape, bool)
                for place, heaps in enumerate(windows):
                    open_ |= (upper >= heaps.floor[mine][:, None]) & (lower <= part["high"][mine, place][:, None])
                q, r = np.nonzero(open_)
                q, r = mine[q], some[r]
                scores, names = tiles.whole_products(part["vector"], block["vector"], q, r), block["name"][r]
                for place, heaps in enumerate(windows):
                    inside = scores <= part["high"][q, place]
                    heaps.offer(q[inside], scores[inside], names[inside])

    def done(self):
        for part, windows in zip(self.parts, self.windows):
            for place, heaps in enumerate(windows):
                found = list(heaps.rows())
                if found:
                    q, name, score = (np.array(x, np.int64) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part["name"][q]), pa.array(np.full(len(q), place, np.int32)), pa.array(name), pa.array(score)],
                        ["anchor_id", "place", "vec_id", "score"],
                    )


def _windowed(make, positives: int):
    """Anchor blocks with the scores of their positives."""

    def run(matrix, columns):
        flat = make(matrix, columns)
        flat["high"] = np.stack([columns[f"high{k}"] for k in range(positives)], axis=1)
        return flat

    return run


def mined(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE, codes: int = CODES, scale: int = SCALE
) -> DataFrame:
    """(vec_id, embedding, label) -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is the condition on the rows that ask; every other row is searched whole.
    """
    spark = ship_package(rows.sparkSession)
    stage = Staged(spark, "negatives")
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & tiles.finite("embedding")
    typed = rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("vector"), anchors.alias("asks"))
    asked = stage.write(typed.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*"))
    fewer = tiles.first_of_class(typed.withColumns(tiles.vector_hashes("vector")), ["label", "h1", "h2"], max(positives + 1, negatives))
    blocks = stage.write(tiles.packed(fewer, _block(codes), ["vec_id", "label"], "vector"))
    counts = tiles.group_counts(asked.count(), blocks.agg(F.sum("n")).first()[0] or 0, spark.sparkContext.defaultParallelism)
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(counts[0]))

    first = tiles.packed(asked, _block(codes), ["vec_id", "label"], "vector", slot)
    found = tiles.met(first, blocks, counts, lambda dim: _Positives(dim, positives), _Positives.SCHEMA)
    order = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    best = stage.write(best.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "place"))

    highs = best.groupBy("anchor_id").agg(*[F.max(F.when((F.col("place") == k) & (F.col("positive_score") >= 0), F.col("positive_score"))).alias(f"high{k}") for k in range(positives)])
    with_windows = asked.join(highs, F.col("vec_id") == F.col("anchor_id")).select(
        "vec_id", "label", "vector", *[F.coalesce(f"high{k}", F.lit(-1)).alias(f"high{k}") for k in range(positives)]
    )
    columns = ["vec_id", "label", *[f"high{k}" for k in range(positives)]]
    second = tiles.packed(with_windows, _windowed(_block(codes), positives), columns, "vector", slot)
    found = tiles.met(second, blocks, counts, lambda dim: _Negatives(dim, negatives, share), _Negatives.SCHEMA)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.col("score").desc(), "vec_id")
    worst = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return worst.join(best, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark, folder) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % SHIFTED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mined(rows.withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)
