"""Quality rules [native]: a table of thresholds compiled into one projection of built-in functions.

Nulls count as empty texts. Texts, ties and repeated rows are judged row by row;
the number of rows never changes. A column named like a measure is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import WHITE, text_of
from logloom.operators.columns import evaluated

#: Frequent function words of the four languages in the corpus.
STOP_WORDS = (
    "the of and to in is that it for was on are with as be by this from at or an a "
    "der die und das den ist nicht von zu mit sich auf für im dem ein eine des "
    "le la les et des est en un une du que dans pour pas qui sur avec par "
    "el los las de y una es se del al con para no su lo como"
).split()
SYMBOLS = "#*$%&|<>"

#: Thresholds: a document fails a rule if its measure lies outside [low, high]; None is no bound.
RULES = (
    ("mean_word_chars", 1.5, 30.0),
    ("symbol_ratio", None, 0.3),
    ("stop_word_ratio", 0.06, None),
    ("dup_line_ratio", None, 0.4),
)

#: White space inside a regular expression class.
_BREAKS = r"\x20\x09-\x0D"

BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50


def repeated_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Texts without a repeated window (most)
    stop after a distinct; in the others the sorted (hash, position) pairs show
    repeated windows as neighbours, so the work is n log n, never n squared.
    """
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(3)]))
    return F.when(n < 3, 0).otherwise(_once(hashes, _covered)).cast("long")


def _covered(hashes: Column) -> Column:
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    lengths = lambda starts: F.transform(
        starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3)))
    )
    total = lambda starts: F.aggregate(lengths(starts), F.lit(0), lambda a, b: a + b)
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeats, _once(_once(pairs, _repeated_starts), total)).otherwise(0)


def _repeated_starts(pairs: Column) -> Column:
    """Positions of windows whose hash stands in a neighbouring pair too, in text order."""
    twice = F.filter(
        pairs,
        lambda p, k: (F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]),
    )
    return F.sort_array(F.transform(twice, lambda p: p["i"]))


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words."""
    whole = text_of(text)
    trimmed = F.btrim(whole, F.lit(WHITE))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{_BREAKS}]+"))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    stop = F.filter(F.split(F.lower(whole), rf"[{_BREAKS}.,;:!?]+"), lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))
    return docs.withColumns({"__words": words, "__lines": lines}).withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(whole, F.lit(f"[{SYMBOLS}]")).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("__words")),
            "n_stop_words": F.size(stop).cast("long"),
        }
    ).drop("__words", "__lines")


def ratios() -> dict[str, Column]:
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "stop_word_ratio": F.col("n_stop_words") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
    }


def compiled(rules=RULES) -> Column:
    """True if every rule of the table holds."""
    known = ratios()
    tests = []
    for name, low, high in rules:
        if low is not None:
            tests.append(known[name] >= F.lit(low))
        if high is not None:
            tests.append(known[name] <= F.lit(high))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def judge(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """All rows and columns, with the counts, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < BASE_MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(BASE_MAX_REPEAT_PERCENT) * F.col("n_words")
    )
    return measured(docs, text).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def passing(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns. The verdict is reached before the filter, not inside it."""
    own = [F.col(c).alias(f"__own_{c}") for c in docs.columns]
    judged = judge(docs.select(F.struct(*own).alias("__row"), F.col(text).alias(text)), rules, text)
    kept = evaluated(judged.select("__row", "kept"), "kept").where("kept")
    return kept.select(*[F.col(f"__row.__own_{c}").alias(c) for c in docs.columns])


def op7_quality_rules(spark, folder) -> DataFrame:
    from logloom.llm.common import read_table

    return judge(read_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "base_failed", "kept"
    )
