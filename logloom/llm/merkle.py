"""Merkle dataset manifest: a persistent, path-copying hash tree over rows.

A row's leaf is the sha256 of its fields. Per source the leaves are put in order
of doc_id, and runs of three nodes become one node until one is left; the roots
of the sources, in order, become the root in the same way. H is lower-case hex
sha256 of its inputs one after another; digests go in as hex text.

The tree is built in aligned blocks of 3**6 nodes: a task builds a block's levels
and hands on its top node, and the tops of the blocks are the leaves of the next
round, so no task holds a source. Then paths go down again: a block gets the
siblings of its top up to the root, once for all its leaves. In a block every
tampered leaf makes a version: it copies only the ancestors of the leaf (the
untouched nodes are the base's own lists) and goes on over the block's path,
where all other nodes are shared as well. Versions of a block live in one task
and blocks are spread, so versions of upper levels are distributed too.

Nulls: a null field is hashed as ``-``; a null source comes first and is a source
of its own; a null doc_id comes first in its source and is never tampered with.
Rows that agree in doc_id are in order of their leaves; repeated rows are leaves
of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, groups, read_table
from logloom.session import ship_package

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
LEVELS = 6
DIGEST = 64
TAMPERED_EVERY = 2
NODE = "tree string, block long, pos long, width long, digest string"
PATH = "siblings array<string>, turns array<int>"
LEAF = f"doc_id long, tree string, pos long, width long, leaf string, changed string, {PATH}, version string, subroot string, root string"


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _up(width: int) -> int:
    return -(-width // FANOUT)


def block_levels(digests: list[str], width: int, most: int) -> list[list[str]]:
    """The levels of a block from its leaves to its top; ``width`` counts the nodes of the whole tree beside them."""
    levels = [digests]
    while width > 1 and len(levels) <= most:
        below = levels[-1]
        levels.append([_hash(below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)])
        width = _up(width)
    return levels


def siblings_of(levels: list[list[str]], place: int) -> tuple[list[str], list[int]]:
    """For each level below the top: the other nodes of the run as one text, and the place in the run."""
    texts, turns = [], []
    for below in levels[:-1]:
        turn = place % FANOUT
        run = below[place - turn : place - turn + FANOUT]
        texts.append("".join(run[:turn] + run[turn + 1 :]))
        turns.append(turn)
        place //= FANOUT
    return texts, turns


class Version:
    """The tree after one leaf changed: new nodes on the leaf's path, all others read from ``base``."""

    def __init__(self, base: list[list[str]], place: int, digest: str):
        self.base, self.place, self.copies = base, place, [digest]
        for level in range(len(base) - 1):
            run = place // FANOUT * FANOUT
            self.copies.append(_hash([self.node(level, k) for k in range(run, min(run + FANOUT, len(base[level])))]))
            place //= FANOUT

    def node(self, level: int, place: int) -> str:
        return self.copies[level] if self.place // FANOUT**level == place else self.base[level][place]

    @property
    def top(self) -> str:
        return self.copies[-1]


def folded(digest: str, siblings: list[str], turns: list[int]) -> str:
    """The root that a node and the siblings above it give."""
    for text, turn in zip(siblings, turns):
        digest = _hash([text[: DIGEST * turn], digest, text[DIGEST * turn :]])
    return digest


def leaf_digest(fields: dict[str, Column]) -> Column:
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns, schema=schema)


_TOPS = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("width", pa.int64()), ("digest", pa.string())])
_PATHS = pa.schema(
    [("tree", pa.string()), ("block", pa.int64()), ("siblings", pa.list_(pa.string())), ("turns", pa.list_(pa.int32())), ("subroot", pa.string()), ("root", pa.string())]
)


def _tops(batches, most: int):
    """Nodes by block -> the top node of each block, with its place and the width of its level."""
    out: dict[str, list] = {name: [] for name in _TOPS.names}
    for group in groups(batches, ["tree", "block"]):
        width = group.column("width")[0].as_py()
        levels = block_levels(group.column("digest").to_pylist(), width, most)
        for _ in levels[1:]:
            width = _up(width)
        for name, value in zip(_TOPS.names, (group.column("tree")[0].as_py(), group.column("block")[0].as_py(), width, levels[-1][0])):
            out[name].append(value)
        if len(out["tree"]) >= 4096:
            yield _batch(out, _TOPS)
            out = {name: [] for name in _TOPS.names}
    yield _batch(out, _TOPS)


def _opened(group: pa.RecordBatch, most: int) -> tuple[dict, pa.RecordBatch, list[list[str]]]:
    """A block's path row, its node rows and its levels."""
    path = {name: group.column(name)[0].as_py() for name in ("siblings", "turns", "subroot", "root")}
    nodes = group.slice(1)
    return path, nodes, block_levels(nodes.column("digest").to_pylist(), nodes.column("width")[0].as_py(), most)


def _inner(batches, most: int):
    """Nodes of an upper level and the paths of their blocks -> the path of every node, which is a block one level below."""
    for group in groups(batches, ["tree", "block"]):
        path, nodes, levels = _opened(group, most)
        out: dict[str, list] = {name: [] for name in _PATHS.names}
        for place, (tree, pos) in enumerate(zip(nodes.column("tree").to_pylist(), nodes.column("pos").to_pylist())):
            texts, turns = siblings_of(levels, place)
            for name, value in zip(_PATHS.names, (tree, pos, texts + path["siblings"], turns + path["turns"], path["subroot"], path["root"])):
                out[name].append(value)
        yield _batch(out, _PATHS)


def _outer(batches, most: int):
    """Leaves and the paths of their blocks -> every leaf with its path and the root of its version."""
    for group in groups(batches, ["tree", "block"]):
        path, nodes, levels = _opened(group, most)
        siblings, turns, roots = [], [], []
        for place, (leaf, changed) in enumerate(zip(nodes.column("digest").to_pylist(), nodes.column("changed").to_pylist())):
            texts, steps = siblings_of(levels, place)
            top = Version(levels, place, leaf if changed is None else changed).top
            siblings.append(texts + path["siblings"])
            turns.append(steps + path["turns"])
            roots.append(folded(top, path["siblings"], path["turns"]))
        n = nodes.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                *(nodes.column(c) for c in ("doc_id", "tree", "pos", "width", "digest", "changed")),
                pa.array(siblings, pa.list_(pa.string())), pa.array(turns, pa.list_(pa.int32())),
                pa.array(roots), pa.array([path["subroot"]] * n), pa.array([path["root"]] * n),
            ],
            ["doc_id", "tree", "pos", "width", "leaf", "changed", "siblings", "turns", "version", "subroot", "root"],
        )


def _placed(nodes: DataFrame, order: list[str], stage: Staged) -> DataFrame:
    """Adds pos (0-based within ``tree``, which leads ``order``) and width (nodes of the tree)."""
    by = [F.col(c).asc_nulls_first() for c in order]
    ranged = nodes.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    # ids of a task lie above those of the tasks before it
    ranged = stage.write(ranged.withColumn("part", F.shiftright("row", 33)))
    per_part = ranged.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = per_part.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("width"))
    return ranged.join(stage.write(parts), ["tree", "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def _blocked(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {FANOUT**levels}"))


def _raised(nodes: DataFrame, stage: Staged, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """(tree, pos, width, digest) -> the node tables of all rounds, and the tops (tree, digest)."""
    rounds, widest = [_blocked(nodes, levels)], nodes.agg(F.max("width")).first()[0] or 0
    while True:
        ready = rounds[-1].select("tree", "block", "pos", "width", "digest").repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        tops = stage.write(ready.mapInArrow(partial(_tops, most=levels), "tree string, pos long, width long, digest string"))
        widest = -(-widest // FANOUT**levels)
        if widest <= 1:
            return rounds, tops.select("tree", "digest")
        rounds.append(_blocked(tops, levels))


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes of every block behind the path of the block (pos -1)."""
    return (
        nodes.unionByName(paths.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "pos")
    )


def _lowered(rounds: list[DataFrame], paths: DataFrame, stage: Staged, levels: int) -> DataFrame:
    """Paths of the tops (tree, block 0) -> paths of the blocks of the first round."""
    for nodes in reversed(rounds[1:]):
        ready = _with_paths(nodes.select("tree", "block", "pos", "width", "digest"), paths)
        paths = stage.write(ready.mapInArrow(partial(_inner, most=levels), f"tree string, block long, {PATH}, subroot string, root string"))
    return paths


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, changes: dict[str, Column] | None = None, changed_where: Column | None = None, levels: int = LEVELS
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its place, its path to the root, and the root of its own version.

    ``changes`` gives fields another value in the rows of ``changed_where``; each
    such row is one version of the tree. ``siblings`` and ``turns`` go from the
    leaf to the root; ``folded(leaf, siblings, turns)`` is the root. ``changed`` is
    the tampered leaf (null where nothing is tampered with), ``version`` the root
    with only that leaf replaced. Blocks hold 3**``levels`` nodes. ``tree`` is '0' without a source, else '1' + source.
    """
    ship_package(docs.sparkSession)
    stage = Staged(docs.sparkSession, "merkle")
    plain = {c: F.col(c) for c in fields}
    other = F.lit(None).cast("string")
    if changes:
        other = F.when(changed_where, leaf_digest(plain | changes))
    tree = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source")))
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf_digest(plain).alias("digest"), other.alias("changed"))
    # the texts are read once; ties are dealt over tasks by a number of their own
    leaves = stage.write(leaves.withColumn("tie", F.monotonically_increasing_id()))
    placed = stage.write(_placed(leaves, ["tree", "doc_id", "digest", "tie"], stage).drop("tie"))
    rounds, subroots = _raised(placed, stage, levels)
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    sources = stage.write(_placed(sources, ["tree", "name"], stage))
    upper, roots = _raised(sources, stage, levels)
    none = F.array().cast("array<string>")
    top = roots.select("tree", F.lit(0).cast("long").alias("block"), none.alias("siblings"), none.cast("array<int>").alias("turns"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    named = _blocked(sources, levels)
    low = _lowered(upper, top, stage, levels)
    ready = _with_paths(named.select("tree", "block", "pos", "width", "digest"), low)
    of_sources = stage.write(ready.mapInArrow(partial(_inner, most=levels), f"tree string, block long, {PATH}, subroot string, root string"))
    starts = of_sources.join(named.select(F.col("pos").alias("block"), "name", "digest"), "block").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "siblings", "turns", F.col("digest").alias("subroot"), "root"
    )
    paths = _lowered(rounds, stage.write(starts), stage, levels)
    ready = _with_paths(rounds[0].select("doc_id", "tree", "block", "pos", "width", "digest", "changed"), paths)
    return ready.mapInArrow(partial(_outer, most=levels), LEAF)


def op11_merkle(spark, folder) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    rows = manifest(docs, changes={"text": F.replace("text", F.lit("\n"), F.lit(""))}, changed_where=F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0)
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        F.col("version").alias("folded_root"), (F.col("version") == F.col("root")).alias("verified"),
    )
