"""CSV records whose quoted fields hold line breaks, joined into one line each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.prefix import running
from logloom.session import stage

_KEYS = ["source_file"]
# The longest start of a line after which no quoted field is open.
_CLOSED = r"""^(?:"(?:[^"]++|"")*+"[^,;\t|]*+|[^",;\t|][^,;\t|]*+|[,;\t|])*+"""


def _open_after(text: Column) -> Column:
    return F.startswith(F.regexp_replace(text, _CLOSED, ""), F.lit('"'))


def join_quoted_lines(lines: DataFrame) -> DataFrame:
    """Line table -> line table; a record over several lines becomes one line with breaks.

    A line maps the two states "outside" and "inside quotes" to a state. Such a
    map keeps, swaps or forgets the state, so the state before a line is what the
    last forgetful line left, flipped once per swap since then: two prefixes.
    Only lines of broken records are grouped.
    """
    outside, inside = _open_after(F.col("line")), _open_after(F.concat(F.lit('"'), "line"))
    maps = lines.withColumns({"__out": outside, "__in": inside})
    flips = running(maps, _KEYS, "chunk", ["seq"], __flips=("sum", (F.col("__out") & ~F.col("__in")).cast("bigint")))
    odd = F.col("__flips") % 2
    forgets = F.col("__out") == F.col("__in")
    left = F.when(forgets, F.struct("chunk", "seq", F.col("__out").cast("bigint").bitwiseXOR(odd).alias("state")))
    first = stage(flips.withColumns({"__odd": odd, "__left": left}).drop("__flips", "__in"), "csv-flips", packed=True)
    second = running(first, _KEYS, "chunk", ["seq"], __last=("max", F.col("__left")))
    before = F.coalesce(F.col("__last.state"), F.lit(0).cast("bigint")).bitwiseXOR(F.col("__odd"))
    # a line after which quotes are open, or before which they are, is part of a broken record
    after = F.when(F.col("__left").isNotNull(), F.col("__out")).otherwise((before == 1) != F.col("__out"))
    states = stage(
        second.select("source_file", "chunk", "seq", "line", (before == 1).alias("__before"), after.alias("__after")), "csv-states", packed=True
    )
    whole = states.where(~F.col("__before") & ~F.col("__after")).select("source_file", "chunk", "seq", "line")
    broken = states.where(F.col("__before") | F.col("__after"))
    start = F.when(~F.col("__before"), F.struct("chunk", "seq"))
    placed = running(broken, _KEYS, "chunk", ["seq"], include_current=True, __start=("max", start))
    # a quote that is never closed joins nothing: its lines stay as they are
    closed = placed.where(~F.col("__after")).select("source_file", "__start").distinct().withColumn("__closed", F.lit(True))
    placed = placed.join(closed, ["source_file", "__start"], "left")
    unclosed = placed.where("__closed is null").select("source_file", "chunk", "seq", "line")
    joined = (
        placed.where("__closed").groupBy("source_file", "__start")
        .agg(F.sort_array(F.collect_list(F.struct("chunk", "seq", "line"))).alias("__lines"))
        .select(
            "source_file", "__start.chunk", "__start.seq", F.array_join(F.transform("__lines", lambda x: x["line"]), "\n").alias("line")
        )
    )
    return whole.unionByName(unclosed).unionByName(joined)
