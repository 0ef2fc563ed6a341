"""Perplexity under an n-gram language model counted from a corpus.

The model is interpolated with absolute discounting. The highest order is counted
as it occurs; a lower order counts in how many different words' company an
n-gram was seen (its continuations), so a word that follows one word only does
not become likely elsewhere. With c the counts, D the discount and u' the context
u without its first word:

    p(w | u) = max(c(uw) - D, 0) / c(u.) + D * kinds(u.) / c(u.) * p(w | u')

The single words end in the uniform distribution over the known words and one
unknown one. Texts begin with order - 1 start marks, which are not predicted.

Every level is a table (gram, c, p). Scoring joins the positions of all texts to
these tables. A gram that makes up a large share of all positions would send
them to one task; such grams are few by arithmetic (at most ``FREQUENT``), so they
are split off into a broadcast table and their positions are dealt by document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from logloom.functions.text import normalize_text, tokens
from logloom.operators.gram_blocks import BLOCK, BUCKET, COUNTED, block_fields, counted, scored, to_blocks, to_buckets, to_texts
from logloom.session import ship_package, stage

DISCOUNT = 0.75
#: A gram with more than 1 / FREQUENT of all counts is frequent; there can't be more than FREQUENT of them.
FREQUENT = 2000
START = "<s>"


@dataclass
class NgramModel:
    order: int
    discount: float
    #: per order, from 1 on: gram, c, p
    levels: list[DataFrame]
    #: per order, from 2 on: context, share (what the context leaves to the order below)
    contexts: list[DataFrame]
    #: per order: the sum of c
    totals: list[int]
    unknown: float


def word_table(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, words``: the lower-case words of every text without punctuation. A null text has none."""
    return df.select(key, tokens(normalize_text(F.coalesce(F.col(text), F.lit("")))).alias("words"))


def staged_words(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The same, written once as blocks (``gram_blocks``): a model of several orders and its scores read the words again, not the texts.

    ``count_model``, ``score`` and ``own_scores`` take blocks as they take ``key, words``.
    """
    # normalised words are parted by single spaces: texts go to the tasks as they are, not as lists
    return _packed(df.select(key, normalize_text(F.coalesce(F.col(text), F.lit(""))).alias("words")), key)


def _packed(words: DataFrame, key: str) -> DataFrame:
    ship_package(words.sparkSession)
    if "codes" in words.columns:
        return words
    packed = words.select(key, "words").mapInArrow(to_blocks(BLOCK), block_fields(words.schema[key].dataType.simpleString()))
    return stage(packed, "words")


def _texts(words: DataFrame, key: str = "key") -> DataFrame:
    if "codes" not in words.columns:
        return words
    kind = words.schema["keys"].dataType.elementType.simpleString()
    return words.mapInArrow(to_texts(key), f"`{key}` {kind}, words array<string>")


def grams_of(words: Column, order: int) -> Column:
    """One n-gram for every word, which is its last; start marks fill up what is before the text."""
    if order == 1:
        return words
    padded = F.concat(F.array_repeat(F.lit(START), order - 1), words)
    # the one-element array binds the padded words once, not once for every place
    each = F.transform(
        F.array(padded),
        lambda p: F.transform(F.sequence(F.lit(1), F.size(p) - order + 1), lambda i: F.array_join(F.slice(p, i, F.lit(order)), " ")),
    )
    return F.when(F.size(words) > 0, F.get(each, F.lit(0))).otherwise(F.array().cast("array<string>"))


def _ending(gram: str) -> Column:
    """The gram without its first word."""
    return F.regexp_replace(gram, r"^[^ ]+ ", "")


def _context(gram: str) -> Column:
    """The gram without its last word."""
    return F.regexp_replace(gram, r" [^ ]+$", "")


def count_model(words: DataFrame, order: int, discount: float = DISCOUNT) -> NgramModel:
    """Counts ``words`` (any key, words) into a model; every level is written once."""
    grams = _texts(words).select(F.explode(grams_of(F.col("words"), order)).alias("gram")).groupBy("gram").agg(F.count("*").alias("c"))
    counts = [stage(grams, f"grams-{order}")]
    for k in range(order - 1, 0, -1):
        counts.append(stage(counts[-1].groupBy(_ending("gram").alias("gram")).agg(F.count("*").alias("c")), f"grams-{k}"))
    counts.reverse()
    totals = [c.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0] for c in counts]
    kinds = counts[0].count()
    unknown = discount * kinds / totals[0] / (kinds + 1) if kinds else 1.0
    first = counts[0].withColumn("p", F.greatest(F.col("c") - discount, F.lit(0.0)) / F.lit(float(totals[0] or 1)) + F.lit(unknown))
    model = NgramModel(order, discount, [stage(first, "level-1")], [], totals, unknown)
    for k in range(2, order + 1):
        level = counts[k - 1].withColumns({"context": _context("gram"), "ending": _ending("gram")})
        contexts = level.groupBy("context").agg(F.sum("c").alias("c"), F.count("*").alias("kinds"))
        contexts = stage(contexts.select("context", "c", (F.col("kinds") * discount / F.col("c")).alias("share")), f"contexts-{k}")
        below = model.levels[-1].select(F.col("gram").alias("ending"), F.col("c").alias("__c"), F.col("p").alias("lower"))
        found = _joined(level, below, "ending", totals[k - 2], ["lower"], F.col("gram"))
        found = _joined(found, contexts.select("context", F.col("c").alias("__c"), F.col("c").alias("all"), "share"), "context", totals[k - 1], ["all", "share"], F.col("gram"))
        p = F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("all") + F.col("share") * F.col("lower")
        model.levels.append(stage(found.select("gram", "c", p.alias("p")), f"level-{k}"))
        model.contexts.append(contexts)
    return model


def _joined(rows: DataFrame, table: DataFrame, key: str, total: int, values: list[str], deal: Column) -> DataFrame:
    """``rows`` left-joined to ``table`` (key, __c, values) with the frequent keys split off.

    Frequent keys hold more than 1 / FREQUENT of ``total``, which bounds their
    number; rows that found theirs in the broadcast table, and rows without a key,
    are dealt by ``deal`` in the shuffle of the others.
    """
    frequent = F.col("__c") * FREQUENT > total
    far = table.select(F.col(key).alias("__far"), *[F.col(v).alias(f"__{v}") for v in values]).where(~frequent)
    near = table.select(F.col(key).alias("__near"), *values).where(frequent)
    met = rows.join(F.broadcast(near), F.col(key) == F.col("__near"), "left")
    own = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(deal), F.lit(1 << 20)).cast("string"))
    met = met.withColumn("__key", F.when(F.col("__near").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(own))
    both = met.join(far, F.col("__key") == F.col("__far"), "left")
    return both.withColumns({v: F.coalesce(v, f"__{v}") for v in values}).drop("__near", "__far", "__key", *[f"__{v}" for v in values])


def score(words: DataFrame, key: str, model: NgramModel, counted: bool = False) -> DataFrame:
    """``key, n_tokens, log_prob, perplexity`` for every row of (key, words).

    ``counted`` says that the model was counted from these very texts: then every
    position is found in the highest level. Otherwise positions that are not go
    down through the contexts. Texts without words have no perplexity. Rows that
    share a key are one text.
    """
    positions = _texts(words, key).select(key, F.posexplode_outer(grams_of(F.col("words"), model.order)).alias("__at", "gram"))
    state = positions.withColumns({"__p": F.lit(None).cast("double"), "__weight": F.lit(1.0)})
    deal = F.struct(key, "__at")
    for k in range(model.order, 0, -1):
        open_ = F.when(F.col("__p").isNull(), F.col("gram"))
        table = model.levels[k - 1].select(F.col("gram").alias("__gram"), F.col("c").alias("__c"), F.col("p").alias("found"))
        state = _joined(state.withColumn("__gram", open_), table, "__gram", model.totals[k - 1], ["found"], deal)
        state = state.withColumn("__p", F.coalesce("__p", F.col("__weight") * F.col("found"))).drop("found", "__gram")
        if counted:
            break
        if k == 1:
            state = state.withColumn("__p", F.coalesce("__p", F.col("__weight") * F.lit(model.unknown)))
            break
        context = F.when(F.col("__p").isNull() & F.col("gram").isNotNull(), _context("gram"))
        table = model.contexts[k - 2].select(F.col("context").alias("__context"), F.col("c").alias("__c"), F.col("share").alias("part"))
        state = _joined(state.withColumn("__context", context), table, "__context", model.totals[k - 1], ["part"], deal)
        state = state.withColumns({"__weight": F.col("__weight") * F.coalesce("part", F.lit(1.0)), "gram": _ending("gram")}).drop("part", "__context")
    log = F.when(F.col("gram").isNotNull(), F.ln("__p"))
    return state.groupBy(key).agg(F.count("gram").alias("n_tokens"), F.sum(log).alias("log_prob")).withColumn(
        "perplexity", F.exp(-F.col("log_prob") / F.col("n_tokens"))
    )


def own_scores(words: DataFrame, key: str, top: int, discount: float = DISCOUNT) -> DataFrame:
    """``key, ngram_order, n_tokens, log_prob, perplexity`` of every text under the models of order 1 to ``top`` counted from these very texts.

    Equal to ``count_model`` and ``score`` of each order. All orders come from one move of
    the positions to buckets by the word before (``gram_blocks``): grams of order k and their
    continuations are sums over those of order k + 1, and the continuations of an
    order are the same in every model above it. Buckets are read twice, for the counts of single
    words and for the logarithms; both steps stand in one plan, so Spark moves them once.
    """
    packed = _packed(words, key)
    total = packed.agg(F.sum("n")).first()[0] or 0
    # Counts of words that take half of a bucket's share of a block: what is left out of a word's count is less than half a bucket,
    # so every word that fills one is found. Words found are few: two for each bucket at most.
    shares = packed.select("n", F.explode(F.filter(F.arrays_zip("words", "counts"), lambda x: x["counts"] * (2.0 * max(total, 1)) > F.col("n") * BUCKET)).alias("x"))
    shares = shares.groupBy(F.col("x.words").alias("word")).agg(F.sum("x.counts").alias("c"))
    large = {r["word"]: r["c"] for r in shares.where(F.col("c") * 2 > BUCKET).collect()}
    marks = packed.agg(F.sum(F.size("keys"))).first()[0] or 0
    if marks > BUCKET:
        large[START] = marks + large.get(START, 0)
    buckets = parts = max(1, -(-(total - sum(c for w, c in large.items() if w != START)) // BUCKET))
    split = {}
    for w in sorted(large):
        split[w] = (buckets, -(-2 * large[w] // BUCKET))
        buckets += split[w][1]

    width, kind = max(top, 3), packed.schema["keys"].dataType.elementType
    rows = f"bucket int, keys array<{kind.simpleString()}>, n bigint, n_words bigint, words binary, places binary"
    moved = packed.mapInArrow(to_buckets(width, parts, split, START), rows)
    counts = moved.groupBy("bucket").applyInArrow(counted(width, parts), COUNTED).repartition("word")
    # A row without a word before stands for all words that are not split. A split word's pairs come from several buckets and count once.
    pair, word, every = Window.partitionBy("word", "before"), Window.partitionBy("word"), Window.partitionBy("all")
    pairs = counts.withColumn("befores", F.when(F.col("before").isNull(), F.col("kept")).otherwise((F.row_number().over(pair.orderBy("bucket")) == 1).cast("bigint")))
    # ``sums`` has a row for each split word and one for the others; it uses all columns of ``counts``, so both share their shuffle
    sums = pairs.withColumn("new", F.row_number().over(word.orderBy("before", "bucket")) == 1).groupBy("before").agg(
        F.sum("raw").alias("raws"), F.sum("kept").alias("kepts"), F.sum("befores").alias("kinds"), F.count_if("new").alias("news"), F.min(F.lit(0)).alias("all")
    ).withColumns({"known": F.sum("news").over(every), "total_kept": F.sum("kinds").over(every)})
    sums = sums.select(F.col("before").alias("__before"), "raws", "kepts", "kinds", "known", "total_kept")
    stats = pairs.withColumns({"raw": F.sum("raw").over(pair), "kept": F.sum("kept").over(pair), "word_raw": F.sum("raw").over(word), "word_kept": F.sum("befores").over(word)})
    stats = stats.join(F.broadcast(sums), F.col("before").eqNullSafe(F.col("__before")))
    of_split = [F.when(F.col("before").isNotNull(), F.col(c)).otherwise(0).alias(c) for c in ("raw", "kept", "raws", "kepts", "kinds")]
    stats = stats.select("bucket", "word", "word_raw", "word_kept", "known", "total_kept", *of_split)
    scores = [f"s{n}" for n in range(1, top + 1)]
    fields = StructType([StructField(key, kind), StructField("n", LongType()), *[StructField(x, DoubleType()) for x in scores]])
    found = moved.groupBy("bucket").cogroup(stats.groupBy("bucket")).applyInArrow(scored(width, top, parts, total, discount, to_arrow_schema(fields)), fields)
    # every text has a row, also one without words
    none = packed.select(F.explode("keys").alias(key), F.lit(0).cast("bigint").alias("n"), *[F.lit(None).cast("double").alias(x) for x in scores])
    each = found.unionByName(none).groupBy(key).agg(F.sum("n").alias("n_tokens"), *[F.sum(x).alias(x) for x in scores])
    orders = F.inline(F.array(*[F.struct(F.lit(n).alias("ngram_order"), F.col(x).alias("log_prob")) for n, x in enumerate(scores, 1)]))
    return each.select(key, "n_tokens", orders).select(
        key, "ngram_order", "n_tokens", "log_prob", F.exp(-F.col("log_prob") / F.col("n_tokens")).alias("perplexity")
    )


def corpus_perplexity(scored: DataFrame) -> DataFrame:
    """One row over all texts: tokens, log probability, perplexity."""
    return scored.agg(F.sum("n_tokens").alias("n_tokens"), F.sum("log_prob").alias("log_prob")).withColumn(
        "perplexity", F.exp(-F.col("log_prob") / F.col("n_tokens"))
    )
