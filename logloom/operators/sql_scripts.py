"""SQL statements out of a line table, without holding a script in one place.

A statement may start in one part of a script and end in another, and a quote
opened earlier decides what a semicolon means. Lines are joined into blocks; for
each block the end state is worked out for every possible start state; composing
these small functions gives the real start state of each block. Then every block
is split on its own and only the cut statements at block edges are joined.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import strip
from logloom.operators.log_entries import CLOSED_PART, TAG, split_statements
from logloom.operators.prefix import dealt, running
from logloom.session import stage

BLOCK_LINES = 2000
# What may be open at the start of any block: nothing, a string, a quoted name, a comment, a dollar body.
# A tagged dollar body is a state too; only blocks that hold its tag can change it.
OPENERS = ["", "'", '"', "/*", "$$"]
BLOCK = ["source_file", "chunk", "block"]


def _left_open(text: Column) -> Column:
    """What is open at the end of a text, as the text that opens it."""
    return F.regexp_extract(F.regexp_replace(text, CLOSED_PART, ""), rf"""^('|"|/\*|\$\$|{TAG})""", 1)


def _ends(text: Column) -> Column:
    """Statements that end in a block; its last part has no semicolon yet."""
    return (F.size(split_statements(text)) - 1).cast("bigint")


def _blocks(lines: DataFrame) -> DataFrame:
    """Lines joined into texts of a bounded number of lines, with their state functions and the statements they end if nothing is open."""
    row = F.col("seq").bitwiseAND(F.lit((1 << 33) - 1))
    grouped = (
        lines.withColumn("block", F.floor(row / BLOCK_LINES))
        .groupBy("source_file", "chunk", "block")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "line"))).alias("__lines"))
    )
    text = F.concat(F.array_join(F.transform("__lines", lambda x: x["line"]), "\n"), F.lit("\n"))
    fixed = F.array(*[F.lit(o) for o in OPENERS])
    openers = F.concat(fixed, F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?=({TAG}))"), F.lit(1))))
    moves = F.transform(openers, lambda o: F.struct(o.alias("opener"), _left_open(F.concat(o, F.col("text"))).alias("after")))
    return grouped.select(*BLOCK, text.alias("text")).withColumns({"moves": moves, "ends": _ends(F.col("text"))})


def _walk(order: str):
    """Start state of each piece of one group, from the state functions in order."""

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        state, states = pdf["start"].iloc[0], []
        for moves in pdf["moves"]:
            states.append(state)
            state = {m["opener"]: m["after"] for m in moves}.get(state, state)
        return pdf.assign(start=states)[["source_file", "chunk", order, "start"]].loc[:, lambda d: ~d.columns.duplicated()]

    return walk


def _block_starts(blocks: DataFrame) -> DataFrame:
    """``source_file, chunk, block, start``: functions composed per chunk, then along the chunks of a file."""
    functions = blocks.select("source_file", "chunk", "block", "moves")
    in_order = functions.groupBy("source_file", "chunk").agg(F.sort_array(F.collect_list(F.struct("block", "moves"))).alias("blocks"))
    openers = F.array_distinct(F.flatten(F.transform("blocks", lambda x: F.transform(x["moves"], lambda m: m["opener"]))))

    def after(moves: Column, state: Column) -> Column:
        return F.coalesce(F.get(F.filter(moves, lambda m: m["opener"] == state), F.lit(0))["after"], state)

    composed = F.aggregate(
        "blocks",
        F.transform(openers, lambda o: F.struct(o.alias("opener"), o.alias("after"))),
        lambda acc, x: F.transform(acc, lambda s: F.struct(s["opener"].alias("opener"), after(x["moves"], s["after"]).alias("after"))),
    )
    per_chunk = in_order.select("source_file", "chunk", composed.alias("moves"), F.lit("").alias("start"))
    # one row per file split here, whatever the size of the file
    chunk_start = per_chunk.groupBy("source_file").applyInPandas(
        _walk("chunk"), "source_file string, chunk bigint, start string"
    )
    return (
        functions.join(chunk_start, ["source_file", "chunk"])
        .groupBy("source_file", "chunk")
        .applyInPandas(_walk("block"), "source_file string, chunk bigint, block bigint, start string")
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    """``source_file, chunk, block, start, ends, before``: start state, statements ended here and in earlier blocks of the file.

    One short row per block, written, so that texts stay where they are while it
    is worked out. Only blocks that start inside something are split for it.
    """
    starts = stage(_block_starts(blocks), "sql-starts")
    outside = blocks.select(*BLOCK, "ends").join(starts.where("start = ''"), BLOCK)
    inside = blocks.select(*BLOCK, "text").join(starts.where("start <> ''"), BLOCK)
    counts = outside.unionByName(inside.withColumn("ends", _ends(F.concat("start", "text"))).drop("text"))
    counts = stage(counts.select(*BLOCK, "start", "ends"), "sql-counts")
    return stage(running(counts, ["source_file"], "chunk", ["block"], before=("sum", F.col("ends"))), "sql-numbers")


def statements_from_lines(lines: DataFrame) -> DataFrame:
    """Line table -> ``source_file, entry_index, statement`` for scripts of any length."""
    blocks = stage(_blocks(lines), "sql-blocks", packed=True)
    numbered = _numbered(blocks)
    # a block is a text of many lines: tasks get their share of lines
    texts = dealt(blocks.select(*BLOCK, "text"), blocks.count() * BLOCK_LINES, *BLOCK)
    each = texts.join(numbered, BLOCK).select(
        *BLOCK, "before", "start", "ends", F.posexplode(split_statements(F.concat("start", "text"))).alias("i", "part")
    ).select(
        *BLOCK,
        (F.col("before") + F.col("i")).alias("entry_index"),
        F.when(F.col("i") == 0, F.substr("part", F.length("start") + 1)).otherwise(F.col("part")).alias("part"),
        ((F.col("i") == 0) | (F.col("i") == F.col("ends"))).alias("edge"),
    )
    inner = each.where(~F.col("edge")).select("source_file", "entry_index", F.col("part").alias("statement"))
    edges = (
        each.where("edge")
        .groupBy("source_file", "entry_index")
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "block", "part"))).alias("__parts"))
        .select(
            "source_file", "entry_index", F.array_join(F.transform("__parts", lambda x: x["part"]), "").alias("statement")
        )
    )
    return inner.unionByName(edges).withColumn("statement", strip(F.col("statement"))).where("statement <> ''")
