"""Tool-call linking for chat data [native]: columns and joins only.

Calls and results meet in a hash join on (conv_id, call_id). A call may wait for
another call of its conversation; depths come from pointer doubling, so a chain
of n calls takes log n joins. Arguments are parsed as VARIANT, checked against
a table of parameters, and written as canonical JSON (keys sorted, no white
space). Messages are numbered in topological order; the numbering is cut into
ranges, so a conversation of any length is spread over tasks.

Of repeated calls or results with one identifier the first (smallest turn, then
text) is linked, the others get the status ``repeat``. Null identifiers link
with nothing. Unparsable or null arguments are ``invalid_json``; calls on a
cycle, or waiting for one, have a null depth and come last. Empty tables give
empty results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table, running_sum

#: (tool, parameter, type, required); the schemas that arguments are checked against.
SCHEMAS = (
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("search", "strict", "boolean", False),
    ("summarise", "query", "string", True),
    ("summarise", "limit", "integer", True),
)
_MATCHES = {"string": r"^STRING", "integer": r"^(BIGINT|INT|SMALLINT|TINYINT)", "boolean": r"^BOOLEAN", "number": r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL|DOUBLE|FLOAT)"}


def depths(calls: DataFrame, stage: Staged) -> DataFrame:
    """(conv_id, call_id, after) with unique identifiers -> conv_id, call_id, waits (calls before it in its chain, null on a cycle)."""
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("there"))
    state = calls.select("conv_id", "call_id", "after").join(known, ["conv_id", "after"], "left")
    state = stage.write(
        state.select("conv_id", "call_id", F.when(F.col("there"), F.col("after")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("waits"))
    )
    open_before = -1
    while True:
        left = state.where("up is not null").count()
        if left == 0 or left == open_before:
            break
        open_before = left
        parent = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("waits").alias("more"))
        joined = state.join(parent, ["conv_id", "up"], "left")
        state = stage.write(joined.select("conv_id", "call_id", F.col("next").alias("up"), (F.col("waits") + F.coalesce("more", F.lit(0))).alias("waits")))
        stage.drop_before(2)
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("waits")).alias("waits"))


def problems(name: Column, arguments: Column, schemas=SCHEMAS) -> Column:
    """First violation of the tool's schema, or null."""
    value = F.try_parse_json(arguments)
    tools: dict[str, list] = {}
    for tool, parameter, kind, required in schemas:
        tools.setdefault(tool, []).append((parameter, kind, required))
    keys = F.json_object_keys(arguments)
    found = F.when(name.isNull(), "unknown_tool")
    for tool, parameters in tools.items():
        tests = []
        for parameter, kind, required in parameters:
            field = F.try_variant_get(value, f"$.{parameter}", "variant")
            there = F.array_contains(keys, parameter)
            if required:
                tests.append(F.when(~there, f"missing:{parameter}"))
            tests.append(F.when(there & ~F.coalesce(F.schema_of_variant(field).rlike(_MATCHES[kind]), F.lit(False)), f"type:{parameter}"))
        others = F.array_except(keys, F.array(*[F.lit(p) for p, _, _ in parameters]))
        tests.append(F.when(F.size(others) > 0, F.concat(F.lit("unexpected:"), F.array_min(others))))
        found = found.when(name == tool, F.coalesce(*tests))
    return F.when(value.isNull() | keys.isNull(), "invalid_json").otherwise(found.otherwise("unknown_tool"))


def linked(messages: DataFrame, schemas=SCHEMAS) -> DataFrame:
    """Messages (conv_id, turn, kind, call_id, name, arguments, after, content), kind call | result | message.

    Returns conv_id, turn, place, kind, call_id, depth, status, problem, json; one row per message.
    """
    stage = Staged(messages.sparkSession, "tool-calls")
    columns = ["conv_id", "turn", "kind", "call_id", "name", "arguments", "after", "content"]
    rows = stage.write(messages.select(*columns))
    tools = rows.where("kind in ('call', 'result') and call_id is not null and conv_id is not null")
    # the first message of an identifier and kind; an aggregate, so no group is sorted
    order = F.struct("turn", F.xxhash64("name", "arguments", "content"))
    firsts = tools.groupBy("conv_id", "call_id").agg(
        F.min(F.when(F.col("kind") == "call", F.struct(order.alias("order"), "after"))).alias("call"),
        F.min(F.when(F.col("kind") == "result", order)).alias("result"),
    )
    firsts = stage.write(firsts)
    calls = firsts.where("call is not null").select("conv_id", "call_id", F.col("call.after").alias("after"))
    waits = depths(calls, Staged(messages.sparkSession, "tool-depths"))
    pairs = firsts.join(waits, ["conv_id", "call_id"], "left")
    own = F.when(F.col("kind") == "call", F.col("call.order")).when(F.col("kind") == "result", F.col("result"))
    is_tool, is_call = F.col("kind").isin("call", "result"), F.col("kind") == "call"
    other = F.when(is_call, F.col("result").isNotNull()).otherwise(F.col("call").isNotNull())
    status = (
        F.when(~is_tool, "message")
        .when(F.col("call_id").isNull() | F.col("conv_id").isNull(), "no_identifier")
        .when(own != order, "repeat")
        .when(~other, F.when(is_call, "no_result").otherwise("no_call"))
        .otherwise("linked")
    )
    depth = F.when(~is_tool, F.lit(0)).when(is_call, 2 * F.col("waits")).when(F.col("call").isNotNull(), 2 * F.col("waits") + 1)
    full = rows.join(pairs, ["conv_id", "call_id"], "left").select(*columns, depth.cast("long").alias("depth"), status.alias("status"))
    key = [F.col("conv_id"), F.coalesce(F.col("depth"), F.lit((1 << 62))), F.col("turn")]
    ranged = stage.write(full.repartitionByRange(*key).withColumns({"piece": F.spark_partition_id(), "one": F.lit(1), "conv_key": F.coalesce("conv_id", F.lit(-(1 << 63)))}))
    placed = running_sum(ranged, ["conv_key"], "piece", [key[1], "turn", "kind", F.xxhash64("call_id", "name", "arguments", "content")], "one", "place")
    body = F.when(is_call, F.to_json(F.try_parse_json("arguments"))).otherwise(F.to_json(F.struct("content")))
    head = F.to_json(F.struct(F.col("call_id").alias("id")))
    json = F.when(
        is_call, F.concat(F.lit('{"arguments":'), F.coalesce(body, F.lit("null")), F.lit(","), F.to_json(F.struct(F.col("call_id").alias("id"), "name")).substr(F.lit(2), F.lit(1 << 30)))
    ).when(F.col("kind") == "result", F.concat(F.expr("substr(to_json(struct(content)), 1, length(to_json(struct(content))) - 1)"), F.lit(","), head.substr(F.lit(2), F.lit(1 << 30))))
    json = json.otherwise(F.to_json(F.struct("content")))
    return placed.select(
        "conv_id", "turn", F.col("place").cast("long").alias("place"), "kind", "call_id", "depth", "status",
        F.when(is_call, problems(F.col("name"), F.col("arguments"), schemas)).alias("problem"), json.alias("json"),
    )


def as_tool_use(conversations: DataFrame) -> DataFrame:
    """Reads chats as tool use: a user turn is a call with its text as the query, the next assistant turn its result.

    A call waits for the call two turns before. Every seventh limit is written as
    a string, so that the schemas have something to find.
    """
    text = F.coalesce("text", F.lit(""))
    identifier = lambda turn: F.concat(F.lit("call_"), F.substring(F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))), 1, 16))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    limit = F.when(F.col("turn") % 7 == 6, F.lit('"10"')).otherwise((F.length(text) % 50).cast("string"))
    arguments = F.concat(F.lit('{ "query" : '), F.expr("substr(to_json(struct(coalesce(text, '') as q)), 6, length(to_json(struct(coalesce(text, '') as q))) - 6)"), F.lit(', "limit": '), limit, F.lit(" }"))
    return conversations.select(
        "conv_id", "turn",
        F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"),
        F.when(user, identifier(F.col("turn"))).when(assistant, identifier(F.col("turn") - 1)).alias("call_id"),
        F.when(user, F.when(F.col("turn") % 3 == 2, "summarise").otherwise("search")).alias("name"),
        F.when(user, arguments).alias("arguments"),
        F.when(user, identifier(F.col("turn") - 2)).alias("after"),
        F.when(~user | F.col("role").isNull(), text).alias("content"),
    )


def op6_tool_calls(spark, folder) -> DataFrame:
    return linked(as_tool_use(read_table(spark, folder, "conversations")))
