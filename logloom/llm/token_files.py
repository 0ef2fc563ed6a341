"""Token-id output: Parquet files with list columns, in ascending doc_id order.

Ids are dictionary encoded (a vocabulary fits one dictionary page, so an id
costs 16 bits), doc_id and positions are delta encoded, row groups and pages
have set sizes, and the page index lets a reader skip to some documents or read
the lengths alone. Rows of a task are in order and tasks are in order, so a
document's place in the whole stream is the offset of its part plus ``at``.

Nulls: a null text is an empty one (only the end id), a null doc_id comes
first. Repeated rows are documents of their own, in the order of their texts'
checksums. An empty table gives files without rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table, text_of
from logloom.llm.tokens import encoder
from logloom.session import new_path

END = 2
BATCH = 256
SCHEMA = "doc_id long, part int, at long, n_tokens long, ids array<int>"
#: Row groups of 32 MB, pages of 256 KB or 2,000 documents, dictionaries for ids, delta encoding for numbers that rise.
LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _encode(tokenizer: str, end: int):
    def run(batches):
        from pyspark import TaskContext

        encode, part, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for k in range(0, batch.num_rows, BATCH):
                some = batch.slice(k, BATCH)
                ids = [x + last for x in encode([t or "" for t in some.column(1).to_pylist()])]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                before = at + np.cumsum(n) - n
                at += int(n.sum())
                borders = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).cast(pa.int64()), pa.array(np.full(len(n), part, np.int32)), pa.array(before), pa.array(n), lists],
                    ["doc_id", "part", "at", "n_tokens", "ids"],
                )

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, layout: dict | None = None) -> None:
    """Sorts the texts by doc_id over all tasks, encodes them and writes one file per task."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    check = F.crc32("text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), check).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), check)
    encoded = ordered.mapInArrow(_encode(tokenizer or default_tokenizer(), end), SCHEMA)
    encoded.write.options(**(LAYOUT if layout is None else layout)).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids. Lengths come from their own columns, without the ids."""
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = Staged(spark, "token-offsets").write(totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset")))
    return files.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids")


def _checksums(batches):
    for batch in batches:
        ids = batch.column("ids")
        values = np.asarray(ids.values).astype("<u4")
        borders = np.asarray(ids.offsets)
        sums = [zlib.crc32(values[a:b]) for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
        columns = [batch.column(k) for k in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def op9_token_files(spark, folder) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    path = new_path(spark, "token-files")
    write_token_files(docs, path)
    return read_token_files(spark, path).mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
