"""SimHash near-dedup: pigeonhole blocks, joined on blocks, verified by Hamming distance.

Fingerprints come from whole texts: A-Z lowered, words split at ASCII white
space, three-word shingles with repeats, XXH64 with seed 42. Equal fingerprints
are one class, so copies never meet in a join. With d = 2 differing bits
allowed, the 64 bits are cut into 5 blocks; two fingerprints in reach agree in
at least 3 of them, so there is a table for each choice of 3. A bucket with
many fingerprints is cut again: its 26 free bits into 8 blocks of which 6 must
agree, which leaves at most 128 members. A bucket emits a row for each pair of
its members only below that size, so the work per fingerprint is bounded and no
pair in reach is lost.

Nulls: a null text has no words (fingerprint zero, linked like any other); a
row with a null doc_id links like any other but names no component, so a
component of such rows alone has a null component_id. Repeated rows are one more
copy; rows that share a doc_id but not a text are documents of their own. An empty table gives an empty result. Extra columns are dropped by
``near_copies`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import Staged, components, read_table
from logloom.session import ship_package

BITS, REACH, BLOCKS, FINE = 64, 2, 5, 8
CROWD = 128
SHINGLE = 3


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    import xxhash

    # bytes.lower and bytes.split know ASCII letters and the six white-space bytes only
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) >= size else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    set_bits = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column(batch.num_columns - 1)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(values)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _fingerprints, "doc_id long, fp long"
    )


def _masks(bits: list[int], blocks: int) -> list[int]:
    """Masks of the block choices: every choice of all but REACH blocks."""
    borders = [round(k * len(bits) / blocks) for k in range(blocks + 1)]
    block = [sum(1 << b for b in bits[borders[k] : borders[k + 1]]) for k in range(blocks)]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), blocks - REACH)]


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _tables(fp: str, masks: list[int], tag: Column) -> Column:
    return F.array(*[F.struct((tag + k).alias("table"), F.col(fp).bitwiseAND(_long(m)).alias("key")) for k, m in enumerate(masks)])


def links(classes: DataFrame, stage: Staged) -> DataFrame:
    """(fp, node) with distinct fp -> linked pairs (u, v) of nodes, each once per table it is found in."""
    masks = _masks(list(range(BITS)), BLOCKS)
    coarse = classes.select("fp", "node", F.inline(_tables("fp", masks, F.lit(0))))
    full = coarse.groupBy("table", "key").agg(F.count("*").alias("members")).where("members > 1")
    met = stage.write(coarse.join(full, ["table", "key"]))
    # crowded buckets: the bits outside the key, cut finer
    finer = [_masks([b for b in range(BITS) if not m >> b & 1], FINE) for m in masks]
    wide = len(finer[0])
    choices = F.array(*[F.array(*[_long(x | m) for x in fine]) for m, fine in zip(masks, finer)])
    again = met.where(f"members > {CROWD}").select(
        "fp", "node", F.posexplode(F.get(choices, F.col("table"))).alias("k", "mask"), "table"
    )
    again = again.select("fp", "node", (F.lit(len(masks)) + F.col("table") * wide + F.col("k")).alias("table"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sides = met.where(f"members <= {CROWD}").select("fp", "node", "table", "key").unionByName(again)
    left, right = sides.select("table", "key", F.col("fp").alias("a"), F.col("node").alias("u")), sides.select("table", "key", F.col("fp").alias("b"), F.col("node").alias("v"))
    pairs = left.join(right, ["table", "key"]).where((F.col("u") < F.col("v")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= REACH))
    return pairs.select("u", "v")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable by links, one row per row of ``docs``."""
    ship_package(docs.sparkSession)
    stage = Staged(docs.sparkSession, "simhash")
    rows = stage.write(fingerprints(docs))
    # a class is its own node, whether its rows have ids or not
    classes = stage.write(rows.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("node", F.col("fp")))
    pairs = links(classes, Staged(docs.sparkSession, "simhash-links"))
    joined = components(pairs, Staged(docs.sparkSession, "simhash-components"))
    parts = stage.write(classes.join(joined, "node", "left").select("fp", "first", F.coalesce("component", "node").alias("part")))
    names = parts.groupBy("part").agg(F.min("first").alias("component_id"))
    return rows.join(parts.join(names, "part").select("fp", "component_id"), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component by ``near_copies``.

    Of rows that agree in doc_id the smallest row stays; rows without a doc_id
    cannot be named as copies and all stay.
    """
    chosen = near_copies(docs).where("doc_id = component_id").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n"))
    stage = Staged(docs.sparkSession, "simhash-kept")
    chosen = stage.write(chosen)
    several = stage.write(chosen.where("__n > 1").select("__id"))
    same = F.col("doc_id") == F.col("__id")
    # a merge join at every size: the texts move once, in proportion to the input
    single = docs.join(chosen.where("__n = 1").hint("merge"), same, "left_semi")
    again = docs.join(several, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return single.unionByName(again.select("__row.*")).unionByName(docs.where("doc_id is null"))


def op2_simhash(spark, folder) -> DataFrame:
    return near_copies(read_table(spark, folder, "documents"))
