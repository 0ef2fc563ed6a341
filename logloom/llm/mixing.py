"""Mixing sources to target weights: Pareto order sampling.

Every source gets a target in words. Whole copies that are certain are given to
all its documents. For the words that are left each document has its own
inclusion probability, in proportion to its words; documents for which it would
be 1 or more are certain as well and are taken first, the others share what
then remains. Of these a fixed-size sample is drawn in Pareto order: they are
ranked by random odds u/(1-u) over inclusion odds p/(1-p), and taken from the
smallest rank on until their words come nearest to the rest.

Probabilities come from a table of sizes per source, which has at most as many
rows as the longest text has words. The cut of a source is found from two
histograms of ranks, the second of the one bin in which the first is cut, so no
task sorts a source; it is applied to every row by a comparison.

Nulls: a null source is a source of its own, a null text has size 0 and is never
drawn. Rows that agree in doc_id and text share their rank and are taken
together. An empty table gives an empty result. Extra columns pass through
``repeated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import Staged, read_table, text_of, uniform_key, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2.0
SEED = 42
BINS = 1 << 12
_ODDS = float(1 << 48)


def ranked(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The columns a decision needs: doc_id, source, __size, __check (of the text), __u in (0, 1)."""
    return docs.select(
        "doc_id",
        "source",
        word_count("text").alias("__size"),
        F.crc32(text_of("text")).alias("__check"),
        ((uniform_key(seed, "doc_id") + F.lit(0.5)) / F.lit(_ODDS)).alias("__u"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size) -> adds target: weights repeat over the sources in order of code points, null last.

    With sources in rising order of limit*size/weight, those up to some point stop
    at their limit and the others share the rest by weight; the point is where the
    next source's share no longer exceeds its limit.
    """
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))
    cap = F.col("source_size") * F.lit(limit)
    order = everything.orderBy(F.col("__cap") / F.col("__weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("__budget") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__weight").over(after)
    capped = F.col("__cap") <= F.col("__level") * F.col("__weight")
    return (
        sizes.withColumns({"__weight": weight, "__cap": cap, "__budget": F.sum("source_size").over(everything) * F.lit(share)})
        .withColumn("__level", level)
        .withColumn("__capped", capped)
        # all sources after the capped ones share at the level of the first of them
        .withColumn("__free", F.min(F.when(~F.col("__capped"), F.struct(F.col("__cap") / F.col("__weight"), "__level"))).over(everything)["__level"])
        .withColumn("target", F.when(F.col("__capped"), F.col("__cap")).otherwise(F.col("__free") * F.col("__weight")))
        .drop("__weight", "__cap", "__budget", "__level", "__capped", "__free")
    )


def chances(sizes: DataFrame) -> DataFrame:
    """(source, __size, __n, __rest) -> per source: __certain (the size from which on documents are certain), __factor, __open.

    p = __factor * size for smaller documents and sum(p * size) is __open, the
    words that the certain ones leave. From the largest size down, a size is
    certain while its share of what is left would be a whole document or more.
    """
    larger = Window.partitionBy("source").orderBy(F.col("__size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy(F.col("__size").desc()).rowsBetween(0, Window.unboundedFollowing)
    words = F.col("__n") * F.col("__size")
    left = F.col("__rest") - F.coalesce(F.sum(words).over(larger), F.lit(0))
    factor = left / F.sum(words * F.col("__size")).over(smaller)
    shared = sizes.where("__size > 0 and __rest > 0").withColumns({"__open": left, "__factor": factor})
    return (
        shared.where(F.col("__factor") * F.col("__size") < 1)
        .groupBy("source")
        .agg(F.max(F.struct("__size", "__factor", "__open")).alias("__top"))
        .select("source", (F.col("__top.__size") + 1).alias("__certain"), "__top.__factor", "__top.__open")
    )


def _rank() -> Column:
    """Random odds over inclusion odds, mapped to (0, 1) so that bins can be counted."""
    p = F.col("__factor") * F.col("__size")
    odds = (F.col("__u") / (1 - F.col("__u"))) / (p / (1 - p))
    return odds / (1 + odds)


def _drawable() -> Column:
    return (F.col("__size") > 0) & (F.col("__size") < F.col("__certain"))


def _fine() -> Column:
    return F.floor(F.col("__rank") * (BINS * BINS)).cast("long")


def _cut_bin(rows: DataFrame, bin_: str, start: str) -> DataFrame:
    """The bin of each source in which its words pass __open; ``start`` counts the words before the rows given."""
    earlier = Window.partitionBy("__s").orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("__s", bin_, "__open", start).agg(F.sum("__size").alias("__words"))
    bins = bins.withColumn("__before", F.col(start) + F.coalesce(F.sum("__words").over(earlier), F.lit(0)))
    cut = bins.where("__before <= __open and __before + __words > __open")
    return cut.select(F.col("__s").alias("__t"), F.col(bin_).alias(f"{bin_}_cut"), F.col("__before").alias(f"{bin_}_before"))


def planned(rows: DataFrame, stage: Staged, **options) -> DataFrame:
    """One row per source: source_size, target, __copies for every document, its __factor and __certain size, and the __cut of the sample.

    Tables with a row per source are written before they are joined, so that the
    planner knows their size and moves the documents only if it is large.
    """
    sizes = stage.write(rows.groupBy("source", "__size").agg(F.count("*").alias("__n")))
    whole = sizes.groupBy("source").agg(F.sum(F.col("__size") * F.col("__n")).alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = stage.write(
        targets(whole, **options)
        .withColumn("__copies", F.floor(ratio))
        .withColumn("__rest", F.col("target") - F.col("__copies") * F.col("source_size"))
    )
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    rest = plan.select(F.col("source").alias("__s"), "__rest")
    chosen = chances(sizes.join(rest, same("source", "__s")).drop("__s"))
    plan = stage.write(plan.join(chosen.withColumnRenamed("source", "__s"), same("source", "__s"), "left").drop("__s", "__rest"))

    sampled = plan.where("__factor is not null").select(F.col("source").alias("__s"), "__certain", "__factor", "__open")
    ranks = rows.join(sampled, same("source", "__s")).where(_drawable()).withColumn("__rank", _rank()).withColumn("__fine", _fine())
    ranks = ranks.withColumns({"__bin": F.floor(F.col("__fine") / BINS).cast("long"), "__zero": F.lit(0).cast("long")})
    coarse = stage.write(_cut_bin(ranks, "__bin", "__zero"))
    near = ranks.join(coarse, same("__s", "__t") & (F.col("__bin") == F.col("__bin_cut"))).drop("__t")
    fine = stage.write(_cut_bin(near, "__fine", "__bin_before"))
    order = Window.partitionBy("__s").orderBy("__rank", "doc_id", "__check").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        near.join(fine, same("__s", "__t") & (F.col("__fine") == F.col("__fine_cut")))
        .withColumn("__at", F.col("__fine_before") + F.coalesce(F.sum("__size").over(order), F.lit(0)))
        .where(F.col("__at") + F.col("__size") / 2 <= F.col("__open"))
        .groupBy("__t")
        .agg(F.max(_place()).alias("__cut"))
    )
    cuts = fine.select(F.col("__t").alias("__s"), "__fine_cut").join(last, same("__s", "__t"), "left").drop("__t")
    return stage.write(plan.join(cuts, same("source", "__s"), "left").drop("__s", "__open"))


def _place() -> Column:
    return F.struct(F.col("__rank"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("id"), F.col("__check"))


def _copies() -> Column:
    """Whole copies, plus one for rows that are certain or in the sample; without a cut everything drawable fits."""
    drawn = _drawable() & (
        F.col("__fine_cut").isNull() | (F.col("__fine") < F.col("__fine_cut"))
        | ((F.col("__fine") == F.col("__fine_cut")) & F.coalesce(_place() <= F.col("__cut"), F.lit(False)))
    )
    return F.col("__copies") + F.when((F.col("__size") >= F.col("__certain")) | drawn, 1).otherwise(0)


def decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the columns of ``ranked`` -> adds source_size, target and copies."""
    plan = plan.withColumnRenamed("source", "__plan_source")
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("__plan_source")))
        .withColumn("__rank", F.when(_drawable(), _rank()))
        .withColumn("__fine", _fine())
        .withColumn("copies", _copies())
        .drop("__plan_source", "__copies", "__certain", "__factor", "__fine_cut", "__cut", "__rank", "__fine")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (words, repeats counted) for every row."""
    stage = Staged(docs.sparkSession, "mix")
    rows = stage.write(ranked(docs))
    result = decided(rows, planned(rows, stage, **options))
    return result.select(
        "doc_id", "source", F.col("__size").alias("size"), "source_size", "target", F.col("copies").cast("int").alias("copies"),
        (F.col("copies") * F.col("__size")).cast("long").alias("taken"),
    )


def repeated(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    stage = Staged(docs.sparkSession, "mix")
    rows = stage.write(ranked(docs))
    plan = planned(rows, stage, **options)
    keys = {
        "__size": word_count("text"), "__check": F.crc32(text_of("text")),
        "__u": (uniform_key(SEED, "doc_id") + F.lit(0.5)) / F.lit(_ODDS),
    }
    out = decided(docs.withColumns(keys), plan).where("copies > 0")
    return out.withColumn("__again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def op10_mixing(spark, folder) -> DataFrame:
    return mixed(read_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
