"""Nearest neighbours by a block matrix join.

Every vector is also kept as int8 codes with a scale. A tile is the product of
the codes of a query block and a row block, whole numbers throughout; with the
lengths of what rounding left, each product bounds the true inner product. A
pair whose upper bound does not reach the query's floor is out; the others are
computed again in double precision on the original vectors and go into the
query's heap, whose worst entry is the next floor. The best of each group of
blocks are merged at the end. No pair is lost, so recall is 1.

Equal vectors beyond the smallest names of their class can't be in a result and
are left out before, so a vector that fills a third of the table is no burden.

Nulls: a null vec_id takes no part, nor does a vector that is null, empty, zero
or holds a null or a non-finite component. Vectors of different lengths do not
meet. A row with the query's own vec_id is never its candidate; other repeated
rows are candidates of their own; of repeated queries the smallest vector
counts. Ties go to the smaller vec_id. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from logloom.llm import tiles
from logloom.llm.common import read_table
from logloom.session import ship_package

NEAREST = 20
QUERY_EVERY = 20
LEVELS = 127
#: Relative slack for rounding in the bounds themselves.
SLACK = 1e-9


def quantised(matrix: np.ndarray, columns: dict) -> dict:
    """A block's arrays: vectors, int8 codes, scale, length of the coded vector, of the whole one and of what is left."""
    wide = matrix.astype(np.float64)
    most = np.abs(wide).max(axis=1)
    # scaled by the largest component first: squares neither overflow nor vanish
    unit = wide / most[:, None]
    codes = np.rint(unit * LEVELS).astype(np.int8)
    coded = codes / LEVELS
    length = lambda x: np.sqrt((x * x).sum(axis=1)) * most
    return {
        "name": columns["vec_id"], "vector": matrix, "codes": codes, "scale": most / LEVELS,
        "coded": length(coded), "whole": length(unit), "left": length(unit - coded),
    }


def bounds(a: dict, b: dict) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two blocks."""
    # products of int8 codes are whole numbers that floats of this width hold exactly
    exact = np.float32 if a["codes"].shape[1] * LEVELS**2 < 1 << 24 else np.float64
    product = (a["codes"].astype(exact) @ b["codes"].T.astype(exact)).astype(np.float64) * (a["scale"][:, None] * b["scale"])
    # <q, x> - <q', x'> = <q', x - x'> + <q - q', x>
    error = np.outer(a["coded"], b["left"]) + np.outer(a["left"], b["whole"]) + SLACK * np.outer(a["whole"], b["whole"])
    return product - error, product + error


class _Search:
    """One query group of a task and the blocks that pass by."""

    def __init__(self, nearest: int):
        self.nearest, self.parts, self.heaps = nearest, [], []

    def queries(self, arrays: dict) -> None:
        arrays["wide"] = arrays["vector"].astype(np.float64)
        self.parts.append(arrays)
        self.heaps.append(tiles.Heaps(len(arrays["name"]), self.nearest, -np.inf))

    def rows(self, block: dict) -> None:
        wide, names = block["vector"].astype(np.float64), block["name"]
        for part, heaps in zip(self.parts, self.heaps):
            with np.errstate(over="ignore", invalid="ignore"):
                lower, upper = bounds(part, block)
            # a bound beyond the range of doubles bounds nothing
            lower[np.isnan(lower)] = -np.inf
            own = part["name"][:, None] == names
            if len(names) > self.nearest:
                lower[own] = -np.inf
                sure = np.partition(lower, -self.nearest, axis=1)[:, -self.nearest]
                np.maximum(heaps.floor, sure, out=heaps.floor)
            q, r = np.nonzero(~(upper < heaps.floor[:, None]) & ~own)
            if len(q):
                heaps.offer(q, tiles.exact(part["wide"], wide, q, r), names[r])

    def done(self):
        for part, heaps in zip(self.parts, self.heaps):
            found = list(heaps.rows())
            if found:
                q, name, score = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part["name"][list(q)]), pa.array(name, pa.int64()), pa.array(score, pa.float64())], ["query_id", "vec_id", "score"]
                )


def nearest_rows(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` rows of ``vectors`` for each of ``queries`` (both vec_id, embedding)."""
    spark = ship_package(vectors.sparkSession)
    typed = {"queries": queries, "rows": vectors}
    for name, df in typed.items():
        kept = "array<float>" if isinstance(df.schema["embedding"].dataType.elementType, FloatType) else "array<double>"
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kept).alias("vector"))
        usable = F.col("vec_id").isNotNull() & tiles.finite("vector") & F.exists("vector", lambda x: x != 0)
        typed[name] = df.where(usable)
    asked = typed["queries"].groupBy("vec_id").agg(F.min("vector").alias("vector"))
    counts = tiles.group_counts(queries.count(), vectors.count(), spark.sparkContext.defaultParallelism)
    slot = F.pmod(F.xxhash64("vec_id"), F.lit(counts[0]))
    rows = tiles.first_of_class(typed["rows"].withColumns(tiles.vector_hashes("vector")), ["h1", "h2"], nearest + 1)
    left = tiles.packed(asked, quantised, ["vec_id"], "vector", slot)
    right = tiles.packed(rows, quantised, ["vec_id"], "vector")
    found = tiles.met(left, right, counts, lambda dim: _Search(nearest), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op13_block_search(spark, folder) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return nearest_rows(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
