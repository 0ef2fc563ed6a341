"""Training tables: union, templates, splits, caps, batches, validation, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.text import normalize_text, render_template, token_count, truncate_tokens
from logloom.operators.prefix import numbered, with_position
from logloom.session import stage

SPLITS = {"train": 0.8, "val": 0.1, "test": 0.1}
SEED = 42
SALTS = 32
#: More than the values that are left of a 32-bit hash after the thousand buckets.
FINE = 4_294_968

# --- rows ------------------------------------------------------------------


def text_rows(df: DataFrame, source: str, text: Column, category: Column, file: Column, path: Column | None = None) -> DataFrame:
    """``text`` plus ``metadata{source, category, file, path}``."""
    metadata = F.struct(
        F.lit(source).alias("source"),
        category.alias("category"),
        file.alias("file"),
        (path if path is not None else F.lit(None)).cast("string").alias("path"),
    )
    return df.select(text.alias("text"), metadata.alias("metadata"))


def training_table(documents: DataFrame, logs: DataFrame) -> DataFrame:
    """Documents and logs appended; duplicates stay."""
    return documents.unionByName(logs, allowMissingColumns=True)


def log_instructions(entries: DataFrame, instruction: Column) -> DataFrame:
    """SQL entries -> ``instruction, input, output, metadata``; the statement is the output."""
    return entries.select(
        instruction.alias("instruction"),
        F.lit("").alias("input"),
        F.col("raw_content").alias("output"),
        F.struct(
            F.lit("log").alias("source"), F.lower("log_type").alias("category"), F.col("source_file").alias("file")
        ).alias("metadata"),
    )


def with_prompt(df: DataFrame, template: str | None = None, name: str = "text") -> DataFrame:
    """Adds the filled prompt; missing columns print nothing."""
    slots = {c: F.col(c) for c in df.columns}
    return df.withColumn(name, render_template(template, **slots) if template else render_template(**slots))


def tokenized(df: DataFrame, max_tokens: int, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Truncated text and its token count; other columns are dropped unless kept."""
    cut = truncate_tokens(F.col(text), max_tokens)
    return df.select(*(keep or []), cut.alias(text), token_count(cut).cast("bigint").alias("n_tokens"))


def with_category(df: DataFrame, categories: DataFrame, on: str) -> DataFrame:
    """Left join with a category table; the planner broadcasts it if its bytes are few enough."""
    return df.join(categories, on, "left")


# --- splits, caps, order ---------------------------------------------------


def hash_order(key: Column, seed: int = SEED) -> Column:
    """Reproducible pseudo-random sort key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash32(key: Column, seed: int = SEED) -> Column:
    """The first eight hexadecimal digits of the hash as a number."""
    return F.conv(F.left(hash_order(key, seed), F.lit(8)), 16, 10).cast("bigint")


def bucket(key: Column, seed: int = SEED) -> Column:
    """0..999 from the 32-bit hash."""
    return hash32(key, seed) % 1000


def split_name(key: Column, shares: dict[str, float] | None = None, seed: int = SEED) -> Column:
    """Split of a row from its key alone, so it survives re-runs and repartitioning."""
    shares = shares or SPLITS
    if abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError("split shares must sum to 1")
    names, edge, column = list(shares), 0.0, None
    # the thousand buckets come first, the rest of the hash cuts them finer: close shares give close splits
    position = bucket(key, seed) * FINE + F.floor(hash32(key, seed) / 1000)
    for name in names[:-1]:
        edge += shares[name]
        condition = position < round(edge * 1000 * FINE)
        column = F.when(condition, name) if column is None else column.when(condition, name)
    return F.lit(names[-1]) if column is None else column.otherwise(names[-1])


def hold_out(key: Column, share: float = 0.1, seed: int = SEED) -> Column:
    return split_name(key, {"train": 1 - share, "validation": share}, seed)


def with_validation(train: DataFrame, validation: DataFrame | None = None) -> DataFrame:
    """Train and validation rows with a ``split`` column; without a validation set, train is used again."""
    held = validation if validation is not None else train
    return train.withColumn("split", F.lit("train")).unionByName(held.withColumn("split", F.lit("validation")))


def cap_bound(keys: DataFrame, n: int, order: list[str]) -> tuple[DataFrame, int] | None:
    """The key of the ``n``-th row as a table of one row, and how many rows up to and with it are one row too many.

    Only the keys are sorted, over all tasks. None if there are no more than ``n`` rows.
    """
    placed = numbered(keys.select(*order).orderBy(*order), "__position")
    bound = stage(placed.where(F.col("__position") == n - 1).select(*order), "cap")
    if bound.isEmpty():
        return None
    upto = placed.where(F.struct(*order) <= _only(bound, order))
    return bound, upto.count() - n


def _only(bound: DataFrame, order: list[str]) -> Column:
    return bound.select(F.struct(*order).alias("bound")).scalar()


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows; ``n <= 0`` keeps all.

    One plan for every cap: the key of the last row to keep is found from the keys
    alone, then rows are kept where they are, by comparison with it. Rows that tie
    with it and are too many are numbered. Nulls come first.
    """
    if n <= 0:
        return df
    found = cap_bound(df, n, order)
    if found is None:
        return df
    (bound, surplus), key = found, F.struct(*order)
    if not surplus:
        return df.where(key <= _only(bound, order))
    ties = numbered(df.where(key == _only(bound, order)), "__position")
    left = ties.count() - surplus
    return df.where(key < _only(bound, order)).unionByName(ties.where(F.col("__position") < left).drop("__position"))


def random_rows(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """A seeded sample without replacement."""
    hashed = df.withColumn("__hash", hash_order(F.col(key), seed))
    return first_rows(hashed, n, ["__hash", key]).drop("__hash")


def shuffled(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """All rows in a seeded random order."""
    return df.orderBy(hash_order(F.col(key), seed), key)


def shuffle_position(df: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """The place of each row in the shuffled order."""
    return numbered(shuffled(df, key, seed))


def micro_batches(df: DataFrame, batch: int, micro: int, order: str, chunk: Column, shards: list[str] | None = None) -> DataFrame:
    """Adds ``batch`` and ``micro_batch``: batches of ``batch`` rows, each in slices of ``micro``."""
    placed = with_position(df.withColumn("__chunk", chunk), shards or [], "__chunk", [order], "__position")
    rest = F.col("__position") % batch
    return placed.select(
        *df.columns,
        ((F.col("__position") - rest) / batch).cast("bigint").alias("batch"),
        ((rest - rest % micro) / micro).cast("bigint").alias("micro_batch"),
    )


# --- validation ------------------------------------------------------------


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Fails at planning time and lists what is there."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {', '.join(df.columns)}")
    return df


def violations(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """``key, field, problem`` for every required field that is null or blank."""
    def check(c: str) -> Column:
        value = F.col(c)
        problem = F.when(value.isNull(), "null").when(F.trim(value.cast("string")) == "", "blank")
        return F.struct(F.lit(c).alias("field"), problem.alias("problem"))

    return df.select(key, F.inline(F.array(*[check(c) for c in required]))).where("problem is not null")


def length_flag(n_tokens: Column, low: int, high: int) -> Column:
    return F.when(n_tokens < low, "short").when(n_tokens > high, "long")


def text_statistics(df: DataFrame, groups: list[str], text: str = "text") -> DataFrame:
    """Rows, tokens, mean and quartiles of the token count per group."""
    counted = df.select(*groups, token_count(F.col(text)).cast("bigint").alias("n"))
    # equal lengths are merged first: a huge group becomes a short histogram
    histogram = counted.groupBy(*groups, "n").agg(F.count("*").alias("f"))
    return histogram.groupBy(*groups).agg(
        F.sum("f").alias("examples"),
        F.sum(F.col("n") * F.col("f")).alias("tokens"),
        (F.sum(F.col("n") * F.col("f")) / F.sum("f")).alias("mean_tokens"),
        F.min("n").alias("min_tokens"),
        F.expr("percentile(n, 0.25, f)").alias("q1_tokens"),
        F.expr("percentile(n, 0.5, f)").alias("median_tokens"),
        F.expr("percentile(n, 0.75, f)").alias("q3_tokens"),
        F.max("n").alias("max_tokens"),
    )


def duplicate_flags(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, copies, kept, is_duplicate`` by the hash of the normalised text; the lowest key is kept.

    Groups are counted with map-side aggregation. Only repeated hashes come back,
    each ``SALTS`` times, and the rows are joined on (hash, salt): a text that is
    a third of the table is spread over many tasks.
    """
    # key and hash are written once, so the texts are read and normalised once
    hashed = stage(df.select(key, F.md5(normalize_text(F.col(text))).alias("__hash")), "text-hashes")
    groups = hashed.groupBy("__hash").agg(F.count("*").alias("copies"), F.min(key).alias("kept")).where("copies > 1")
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = hashed.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    return rows.join(salted, ["__hash", "__salt"], "left").select(
        key,
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("kept", F.col(key)).alias("kept"),
        (F.coalesce("kept", F.col(key)) != F.col(key)).alias("is_duplicate"),
    )
