"""Packing: concatenate and cut.

Documents are tokenised once, in the order of the scan; every task numbers its
own tokens. Totals per task become global offsets, and every document is cut at
the window borders it crosses, on its own row. Nothing is shuffled, no window
or document order is collected, and only the last sequence is not full.

Nulls: a null text is an empty one (only the end id); a null doc_id stays null.
Repeated rows and repeated ids are documents of their own. An empty table gives
no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table
from logloom.llm.tokens import byte_level_encoder

LENGTH = 1024
END = 0
BATCH = 256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenised(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """doc_id, part (the task), at (tokens of the task before it), n, ids (little-endian, 16 bits each if the vocabulary allows)."""

    def run(batches):
        from pyspark import TaskContext

        encode, part, at = byte_level_encoder(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                some = batch.slice(k, BATCH)
                ids = [x + last for x in encode([t or "" for t in some.column(1).to_pylist()])]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                if n.size and max(int(np.frombuffer(x, "<u4").max()) for x in ids) < 1 << 16:
                    ids = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(pa.int64()), pa.array(np.full(len(n), part, np.int32)), pa.array(before), pa.array(n), pa.array(ids, pa.binary())],
                    ["doc_id", "part", "at", "n", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, part int, at long, n long, ids binary")


def _cut(length: int, with_ids: bool):
    def run(batches):
        for batch in batches:
            n, first = (np.asarray(batch.column(k), np.int64) for k in ("n", "first"))
            if not len(n):
                continue
            window = first // length
            count = (first + n - 1) // length - window + 1
            row = np.repeat(np.arange(len(n)), count)
            window = window[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = np.maximum(window * length - first[row], 0)
            stop = np.minimum((window + 1) * length - first[row], n[row])
            ids, sums, cut = batch.column("ids"), [], []
            seen, whole = -1, None
            for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist()):
                if r != seen:
                    raw = ids[r].as_py()
                    seen, whole = r, np.frombuffer(raw, "<u2" if len(raw) == 2 * n[r] else "<u4").astype("<u4")
                piece = whole[a:b].tobytes()
                sums.append(zlib.crc32(piece))
                cut.append(piece if with_ids else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(stop - start), pa.array(sums, pa.int64()),
                    pa.array(n[row]), pa.array(window), pa.array(first[row] + start - window * length), pa.array(cut, pa.binary()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """One row per piece; ``ids`` holds the piece's ids, little-endian unsigned 32-bit (null without ``with_ids``)."""
    stage = Staged(docs.sparkSession, "pack")
    tokens = stage.write(tokenised(docs, tokenizer or default_tokenizer(), end), "zstd")
    totals = tokens.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task; written first, so that the join below knows its size
    offsets = stage.write(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")))
    placed = tokens.join(offsets, "part").select("doc_id", "n", (F.col("offset") + F.col("at")).alias("first"), "ids")
    return placed.mapInArrow(_cut(length, with_ids), PIECES)


def op5_packing(spark, folder) -> DataFrame:
    return pack(read_table(spark, folder, "documents"), with_ids=False).drop("ids")
