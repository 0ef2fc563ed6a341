"""Sharding by balanced label propagation, law ``bytes``: all shards get nearly equal sizes.

Documents with equal texts are linked. Every linked document starts in a shard
by its hash; in each round a group's documents move to the shards where most of
their neighbours are, if there is room. Neighbours are counted per (group,
shard) cell, moves are decided per cell and quotas per target shard, and the
moves are joined back to the documents, so a group of any size is spread over
its cells and never meets in one task. A group larger than a shard fills as many
shards as it needs. Documents without neighbours level the shards: large ones
first, then the small ones, dealt by running sizes over what each shard lacks.
Loads then differ from the mean by about the smallest documents' sizes, and by
no more than one document of the last tier where there are enough of them.

The growth law ``key`` and ``rows`` are not offered; ``grown_shard`` is null.
Nulls: a null text has size 16, checksum 0 and no neighbours; a null doc_id is
dealt like an id. Repeated rows are linked documents. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, first_above, read_table, running_sum

SHARDS = 40
ROUNDS = 6
OVERHEAD = 16
#: Groups fill a shard up to this share; documents without neighbours level the rest.
FILL = 0.95
PIECE_ROWS = 20_000
LAW = "bytes"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, group (null without a text), deal (a hash that orders and spreads rows)."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.sha2(text, 256).alias("group"),
        F.xxhash64(F.coalesce("doc_id", F.lit(-1)), text).alias("deal"),
    )


def _cells(linked: DataFrame) -> DataFrame:
    return linked.groupBy("group", "shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def _moves(cells: DataFrame, capacity: float, shards: int) -> DataFrame:
    """(group, shard, target, share): the share of a cell's documents that moves to target.

    A group's cells are ranked by their number of documents. The first k cells
    are its homes, k the shards its bytes need; every other cell moves to one of
    them. A target takes what its free room and the room its own leavers make
    allows; if more want to come, each cell sends the same share.
    """
    group = Window.partitionBy("group")
    home = group.orderBy(F.desc("n"), F.xxhash64("group", "shard"))
    ranked = (
        cells.withColumn("place", F.row_number().over(home) - 1)
        .withColumn("homes", F.greatest(F.lit(1), F.ceil(F.sum("bytes").over(group) / F.lit(capacity))).cast("int"))
        .withColumn("homes_in_order", F.collect_list("shard").over(home.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.get("homes_in_order", F.col("place") % F.least("homes", F.size("homes_in_order"))))
    )
    wanted = ranked.where("target != shard")
    loads = cells.groupBy("shard").agg(F.sum("bytes").alias("load"))
    demand = wanted.groupBy(F.col("target").alias("shard")).agg(F.sum("bytes").alias("demand"))
    leaving = wanted.groupBy("shard").agg(F.sum("bytes").alias("leaving"))
    room = demand.join(loads, "shard", "left").join(leaving, "shard", "left").select(
        F.col("shard").alias("target"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(capacity) - F.coalesce("load", F.lit(0)) + F.coalesce("leaving", F.lit(0)) / 2) / F.col("demand")).alias("share"),
    )
    return wanted.join(F.broadcast(room), "target").where("share > 0").select("group", "shard", "target", "share")


def propagated(linked: DataFrame, capacity: float, shards: int, rounds: int, stage: Staged) -> DataFrame:
    """Linked documents with their shard after at most ``rounds`` rounds of moves."""
    current = stage.write(linked.withColumn("shard", F.pmod(F.col("deal"), F.lit(shards)).cast("int")))
    for k in range(rounds):
        moves = stage.write(_moves(_cells(current), capacity, shards))
        if moves.isEmpty():
            break
        draw = F.pmod(F.xxhash64("deal", F.lit(k)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        moved = current.join(moves, ["group", "shard"], "left")
        shard = F.when(draw < F.col("share"), F.col("target")).otherwise(F.col("shard"))
        current = stage.write(moved.select(*linked.columns, shard.alias("shard")))
        stage.drop_before(3)
    return current


def _released(settled: DataFrame, mean: float, rows: int, stage: Staged) -> tuple[DataFrame, DataFrame]:
    """Splits off what a shard holds beyond the mean, whole groups as far as possible."""
    pieces = max(1, rows // PIECE_ROWS)
    piece = F.pmod(F.xxhash64("group"), F.lit(pieces)) * 16 + F.pmod(F.col("deal"), F.lit(16))
    placed = running_sum(stage.write(settled.withColumn("piece", piece)), ["shard"], "piece", ["group", "deal"], "size", "before")
    placed = stage.write(placed.drop("piece"))
    over = F.col("before") + F.col("size") > F.lit(mean)
    return placed.where(~over).drop("before"), placed.where(over).drop("before", "shard")


def _levelled(single: DataFrame, lacking: list[float], stage: Staged) -> DataFrame:
    """Deals rows over the shards in proportion to what each lacks, by running sizes."""
    edges, total = [], 0.0
    for x in lacking:
        total += x
        edges.append(total)
    rows = single.agg(F.count("*"), F.sum("size")).first()
    if not rows[0]:
        return single.withColumn("shard", F.lit(0))
    pieces = max(1, rows[0] // PIECE_ROWS)
    # a staged piece number keeps both reads of the running sum alike
    cut = stage.write(single.withColumn("piece", F.pmod(F.col("deal"), F.lit(pieces)).cast("int")))
    placed = running_sum(cut, [], "piece", ["deal", "doc_id"], "size", "before")
    scaled = [e / max(total, 1e-9) * rows[1] for e in edges]
    return placed.withColumn("shard", first_above(scaled, F.col("before") + F.col("size") / 2)).drop("piece", "before")


def _loads(rows: DataFrame, shards: int) -> list[float]:
    found = {r[0]: r[1] for r in rows.groupBy("shard").agg(F.sum("size")).collect()}  # a row per shard
    return [float(found.get(s, 0)) for s in range(shards)]


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    spark = docs.sparkSession
    stage = Staged(spark, "shards")
    rows = stage.write(sized(docs))
    groups = rows.where("group is not null").groupBy("group").agg(F.count("*").alias("members")).where("members > 1")
    groups = stage.write(groups.select("group"))
    linked = rows.join(groups, "group", "left_semi")
    single = rows.where("group is not null").join(groups, "group", "left_anti").unionByName(rows.where("group is null"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    mean = max(total[0] / shards, 1.0)
    settled = propagated(linked, FILL * mean, shards, rounds, Staged(spark, "shard-rounds"))
    loads = _loads(settled, shards)
    if max(loads) > mean:
        settled, released = _released(settled, mean, total[1] // shards, stage)
        single = single.unionByName(released)
        loads = _loads(settled, shards)
    parts = [settled]
    # large documents first, then the small ones even out what is left
    border = mean / 200
    single = stage.write(single.withColumn("large", F.col("size") > F.lit(border)))
    for tier in (single.where("large"), single.where("not large")):
        missing = tier.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        level = _water_level(loads, missing)
        dealt = stage.write(_levelled(tier.drop("large"), [max(0.0, level - x) for x in loads], stage))
        parts.append(dealt)
        loads = [a + b for a, b in zip(loads, _loads(dealt, shards))]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    pieces = max(1, total[1] // (shards * PIECE_ROWS))
    whole = stage.write(whole.withColumns({"piece": F.pmod(F.xxhash64("deal"), F.lit(pieces)).cast("int"), "one": F.lit(1)}))
    slots = running_sum(whole, ["shard"], "piece", ["deal", "doc_id"], "one", "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "group",
    )


def _water_level(loads: list[float], more: float) -> float:
    """The level to which shards fill up if ``more`` is poured over the lowest ones; a number per shard only."""
    rest, level = float(more), 0.0
    ordered = sorted(loads)
    for k, load in enumerate(ordered):
        above = ordered[k + 1] if k + 1 < len(ordered) else float("inf")
        level = load
        step = (above - load) * (k + 1)
        if step >= rest:
            return load + rest / (k + 1)
        rest -= step
    return level


def op1_sharding(spark, folder) -> DataFrame:
    return sharded(read_table(spark, folder, "documents")).drop("group")
