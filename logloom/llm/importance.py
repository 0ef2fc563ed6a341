"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (n = 1, 2) are counted: one of
the target (labelled good and not toxic documents), one of the raw text (all
documents). A document's log importance weight is the sum over its n-grams of
log p_target - log p_raw; divided by their number it is comparable between
lengths. Documents are sampled without replacement by Gumbel top-k: weight over
temperature plus Gumbel noise, the k largest stay. k is the number of documents
whose weight reaches a low quantile of labelled good ones that were held out of
the fit, so the sample is as large as the share that looks like the target.

The target is fitted on half of a bounded sample of labelled rows (TARGET_ROWS,
smallest hashes first) and calibrated on the other half; counts of the raw model, weights and the cut cover all
documents. The cut is found in a histogram of keys and the one bin it lies in.

Nulls: a null text has no n-grams and weight 0; a null doc_id has no label.
Ties of keys fall in doc_id order. Repeated rows are documents of their own and
share their key. Without any label the weights are 0 and every document stays.
Extra columns are kept by ``kept_documents``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table, uniform_key

BUCKETS = 1 << 16
TARGET_ROWS = 20_000
QUANTILE = 0.003
TEMPERATURE = 0.005
SMOOTHING = 1.0
SEED = 8
BINS = 1 << 16
BATCH = 256


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of every word and every pair of neighbouring words, by crc32 of the lower-cased bytes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    crc = zlib.crc32
    one = np.array([crc(w) for w in words], np.uint64)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([one % np.uint64(buckets), (two >> np.uint64(40)) % np.uint64(buckets)]).astype(np.int64)


def labelled(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """Ids of at most ``rows`` labelled good documents, those with the smallest hashes."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def _counts(good: set[int], buckets: int):
    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                some = batch.slice(k, BATCH)
                found = [features(t, buckets) for t in some.column(1).to_pylist()]
                raw += np.bincount(np.concatenate(found), minlength=buckets)
                wanted = [x for x, doc_id in zip(found, some.column(0).to_pylist()) if doc_id in good]
                if wanted:
                    target += np.bincount(np.concatenate(wanted), minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    return run


def fit(docs: DataFrame, good: set[int], buckets: int = BUCKETS) -> np.ndarray:
    """log p_target - log p_raw of every bucket; a vector of fixed length."""
    counts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _counts(good, buckets), "bucket long, raw long, target long"
    )
    table = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    if not target.sum():
        return np.zeros(buckets)
    # the raw distribution smooths the target's, so an n-gram the sample lacks costs little
    p_raw = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    p_target = (target + SMOOTHING * buckets * p_raw) / (target.sum() + SMOOTHING * buckets)
    return np.log(p_target) - np.log(p_raw)


def _weights(model: np.ndarray, held_out: set[int]):
    def run(batches):
        for batch in batches:
            found = [features(t.as_py(), len(model)) for t in batch.column(2)]
            n = np.array([len(x) for x in found], np.int64)
            total = np.array([float(model[x].sum()) for x in found])
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(total / np.maximum(n, 1)), pa.array([i in held_out for i in ids], pa.bool_())],
                ["doc_id", "u", "n_features", "weight", "held_out"],
            )

    return run


def uniform(docs: DataFrame) -> Column:
    return (uniform_key(SEED, "doc_id") + F.lit(0.5)) / F.lit(float(1 << 48))


def _key(weight: Column, u: Column) -> Column:
    """Weight over temperature plus Gumbel noise."""
    return weight / F.lit(TEMPERATURE) - F.log(-F.log(u))


def _reaches(key: Column, last_key: float, last_id: int) -> Column:
    return (key > F.lit(last_key)) | ((key == F.lit(last_key)) & (F.coalesce("doc_id", F.lit(-(1 << 63))) <= F.lit(last_id)))


def weighed(docs: DataFrame, model: np.ndarray, held_out: set[int], stage: Staged) -> DataFrame:
    """doc_id, n_features, weight, key, held_out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), uniform(docs).alias("u"), F.col("text").cast("string")).mapInArrow(
        _weights(model, held_out), "doc_id long, u double, n_features long, weight double, held_out boolean"
    )
    return stage.write(rows.withColumn("key", _key(F.col("weight"), F.col("u"))))


def chosen(rows: DataFrame, stage: Staged, quantile: float = QUANTILE) -> tuple[float, int, int]:
    """The cut of the sample: (key, doc_id) of the last document that stays, and k."""
    bounds = rows.agg(F.min("key"), F.max("key"), F.count("*")).first()
    low, high, n = bounds
    floor = rows.where("held_out").agg(F.percentile_approx("weight", F.lit(quantile), F.lit(10_000))).first()[0]
    k = n if floor is None else rows.where(F.col("weight") >= floor).count()
    if not n or k >= n:
        return float("-inf"), -(1 << 63), n
    width = max(high - low, 1e-9) / BINS
    bin_of = F.least(F.floor((F.lit(high) - F.col("key")) / F.lit(width)), F.lit(BINS - 1)).cast("int")
    bins = rows.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = bins.withColumn("before", before).where((F.col("before") < k) & (F.col("before") + F.col("n") >= k)).first()
    inside = rows.where(bin_of == edge["bin"]).select("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("key"), "doc_id"))
    last = inside.withColumn("place", place).where(F.col("place") == k - edge["before"]).first()
    return last["key"], last["doc_id"], k


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, key, kept for every row."""
    stage = Staged(docs.sparkSession, "importance")
    known = [r[0] for r in labelled(labels).collect()]
    rows = weighed(docs, fit(docs, set(known[::2])), set(known[1::2]), stage)
    key, doc_id, _ = chosen(rows, stage)
    return rows.select("doc_id", "n_features", "weight", "key", _reaches(F.col("key"), key, doc_id).alias("kept"))


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` in the sample; weights are computed again in place, so no text is shuffled."""
    stage = Staged(docs.sparkSession, "importance")
    known = [r[0] for r in labelled(labels).collect()]
    model = fit(docs, set(known[::2]))
    key, doc_id, _ = chosen(weighed(docs, model, set(known[1::2]), stage), stage)

    @F.pandas_udf("double")
    def weight(texts: pd.Series) -> pd.Series:
        found = (features(t, len(model)) for t in texts)
        return pd.Series([float(model[x].sum()) / max(len(x), 1) for x in found], dtype="float64")

    kept = _reaches(_key(weight(F.col("text").cast("string")), uniform(docs)), key, doc_id)
    return docs.where(kept)


def op8_importance(spark, folder) -> DataFrame:
    return sampled(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
