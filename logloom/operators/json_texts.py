"""JSON values that span lines (arrays, pretty-printed objects) as one line each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import is_blank, strip
from logloom.operators.prefix import dealt, running
from logloom.session import stage


def json_layout(first_line: Column) -> Column:
    """``array``, ``object`` (one value over several lines) or ``lines`` from the first filled line."""
    text = strip(first_line)
    whole = F.from_json(text, "map<string,variant>").isNotNull()
    return (
        F.when(F.startswith(text, F.lit("[")), "array")
        .when(text.rlike(r"^\{") & text.rlike(r"[{\[,]$") & ~whole, "object")
        .otherwise("lines")
    )


def _depth(line: Column) -> Column:
    """Brackets opened minus closed on a line, strings left out (a JSON string never spans lines)."""
    code = F.regexp_replace(line, r'"(?:[^"\\]++|\\.)*+"', "")
    return (F.regexp_count(code, F.lit(r"[\[{]")) - F.regexp_count(code, F.lit(r"[\]}]"))).cast("bigint")


def json_layouts(lines: DataFrame, formats: DataFrame) -> DataFrame:
    """``formats`` with ``layout`` in place of ``header``.

    A file is also one object if its first filled line leaves brackets open that
    the whole file closes; a broken first line of a file of lines leaves them open.
    """
    formats = stage(formats.withColumn("layout", json_layout(F.col("header"))), "json-headers")
    unsure = (F.col("source_format") == "json") & (F.col("layout") == "lines")
    unsure &= F.startswith(strip(F.col("header")), F.lit("{")) & (_depth(F.col("header")) > 0)
    depths = lines.join(formats.where(unsure).select("source_file"), "source_file", "left_semi")
    closed = depths.groupBy("source_file").agg(F.sum(_depth(F.col("line"))).alias("__depth")).where("__depth = 0")
    layout = F.when(F.col("__depth") == 0, "object").otherwise(F.col("layout"))
    return formats.join(closed, "source_file", "left").withColumn("layout", layout).drop("header", "__depth")


def json_values(lines: DataFrame, layout: str) -> DataFrame:
    """Line table of ``array`` or ``object`` files -> line table with one value per line.

    Lines are grouped up to the next point between two values, so the largest
    group is one value (or one line), never the file. The values are written once,
    as positions read them twice.
    """
    keys, rows = ["source_file"], lines.count()
    filled = lines.where(~is_blank(F.col("line"))).withColumn("__step", _depth(F.col("line")))
    deep = running(filled, keys, "chunk", ["seq"], rows=rows, __before=("sum", F.col("__step"))).withColumn(
        "__after", F.col("__before") + F.col("__step")
    )
    if layout == "array":
        between = (F.col("__after") == 0) | ((F.col("__after") == 1) & F.endswith(strip(F.col("line")), F.lit(",")))
    else:
        between = F.col("__after") == 0
    # written once: the second prefix reads these rows twice
    # in arrays a value may also be opened by the comma before it
    opens = (F.col("__before") == 1) & F.startswith(strip(F.col("line")), F.lit(",")) if layout == "array" else F.lit(False)
    marked = stage(deep.withColumns({"__cut": between.cast("bigint"), "__opens": opens.cast("bigint")}), "json-depths")
    grouped = running(marked, keys, "chunk", ["seq"], rows=rows, __group=("sum", F.col("__cut") + F.col("__opens"))).withColumn(
        "__group", F.col("__group") + F.col("__opens")
    )
    # the group may cross a chunk border, so the chunk of its first line is kept
    texts = (
        dealt(grouped, rows, "source_file", "__group")
        .groupBy("source_file", "__group")
        .agg(
            F.sort_array(F.collect_list(F.struct("chunk", "seq", "line"))).alias("__lines"),
            F.min("__before").alias("__from"),
            F.min("__after").alias("__to"),
        )
        .select(
            "source_file",
            F.col("__lines")[0]["chunk"].alias("chunk"),
            F.col("__lines")[0]["seq"].alias("seq"),
            strip(F.array_join(F.transform("__lines", lambda x: x["line"]), "\n")).alias("line"),
            "__from",
            "__to",
        )
    )
    if layout != "array":
        return stage(texts.drop("__from", "__to"), "json-values")
    body = F.when(F.col("__from") == 0, F.regexp_replace("line", r"^\[", "")).otherwise(F.regexp_replace("line", r"^,", ""))
    body = F.when(F.col("__to") == 0, F.regexp_replace(body, r"\]$", "")).otherwise(F.regexp_replace(body, r",$", ""))
    items = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<variant>")
    # several values may share a line: sub-positions keep their order
    values = texts.select(
        "source_file", "chunk", F.col("seq").alias("__seq"), F.posexplode(F.coalesce(items, F.array(F.lit(None).cast("variant")))).alias("__i", "__v"), "line"
    ).select(
        "source_file",
        "chunk",
        F.struct(F.col("__seq").alias("line"), F.col("__i").alias("item")).alias("seq"),
        F.coalesce(F.to_json("__v"), F.col("line")).alias("line"),
    )
    return stage(values, "json-values")
