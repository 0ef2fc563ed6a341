"""Personal data and credentials in texts, replaced by keyed pseudonyms.

One pass over a text finds all spans: the alternatives of one expression are
tried at every place in a set order, and what a span covers is not looked at
again, so spans never overlap. Numbers are then checked: an address needs four
parts up to 255, a card number its check digit. Runs that are too long to be
either are matched as well, so that no part of them is taken for one.

The same value gets the same pseudonym in every text of every table, as long as
the key is the same: a keyed hash of its kind and its plain form (letters in
lower case; of card and phone numbers the digits only).

All lengths are bounded, so the work is in proportion to the text; of a mail
address before whose ``@`` stand more than 64 signs only the last 64 are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.operators.columns import evaluated

# What each kind looks like. The expressions read the same in Java and in RE2.
EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}"
SECRET = r"""(?i:api[_-]?key|password|passwd|secret|token)[ \t]{0,4}[=:][ \t]{0,4}["']?[^ \t\n\r\f"']{1,200}["']?"""
DOTTED = r"[0-9]{1,3}(?:\.[0-9]{1,3}){4,20}"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
LONG = r"[0-9]{20,200}"
CARD = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3}[ .-]?[0-9]{4}"
SPAN = "|".join((EMAIL, SECRET, DOTTED, ADDRESS, LONG, CARD, PHONE))
KINDS = ("EMAIL", "SECRET", "IP", "CARD", "PHONE")
DIGITS = 8


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """The check of card numbers: from the right every second digit is doubled, and the digits add up to tens."""
    from_right = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"))
    doubled = F.transform(from_right, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def kind_of(span: Column) -> Column:
    """The kind of a matched span, null for one that fails its check."""
    whole = lambda pattern: span.rlike(f"^(?:{pattern})$")
    parts = F.forall(F.split(span, r"\."), lambda x: x.cast("int") <= 255)
    return (
        F.when(whole(EMAIL), "EMAIL")
        .when(whole(SECRET), "SECRET")
        .when(whole(ADDRESS), F.when(parts, "IP"))
        .when(whole(CARD), F.when(passes_luhn(_digits(span)), "CARD"))
        .when(whole(PHONE), "PHONE")
    )


def pseudonym(kind: Column, span: Column, key: str) -> Column:
    plain = F.when(kind.isin("CARD", "PHONE"), _digits(span)).otherwise(F.lower(span))
    return F.concat(F.lit("["), kind, F.lit("_"), F.left(F.sha2(F.concat(F.lit(key + "|"), kind, F.lit("|"), plain).cast("binary"), 256), F.lit(DIGITS)), F.lit("]"))


def with_spans(df: DataFrame, key: str, text: str = "text", name: str = "spans") -> DataFrame:
    """Adds an array of ``(kind, value, pseudonym)``, one for each match in order; kind and pseudonym are null where a check fails."""
    kinds = F.transform(F.regexp_extract_all(text, F.lit(SPAN), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value")))
    typed = evaluated(df.withColumn(name, kinds), name)
    named = F.transform(name, lambda s: F.struct(s["kind"], s["value"], pseudonym(s["kind"], s["value"], key).alias("pseudonym")))
    return typed.withColumn(name, named)


def anonymised(df: DataFrame, key: str, text: str = "text", spans: str = "spans") -> DataFrame:
    """``text`` with every span of a kind replaced by its pseudonym; the spans stay as a column. A null text stays null."""
    found = evaluated(with_spans(df, key, text, spans), spans)
    between = F.split(F.col(text), SPAN)
    mended = F.transform(between, lambda piece, i: F.concat(piece, F.coalesce(F.get(spans, i)["pseudonym"], F.get(spans, i)["value"], F.lit(""))))
    return found.withColumn(text, F.array_join(mended, ""))


def span_counts(df: DataFrame, spans: str = "spans") -> DataFrame:
    """``kind, documents, matches, different`` over all texts."""
    each = df.select(F.inline(spans)).where("kind is not null")
    per_value = each.groupBy("kind", "pseudonym").agg(F.count("*").alias("n"))
    different = per_value.groupBy("kind").agg(F.sum("n").alias("matches"), F.count("*").alias("different"))
    texts = df.select(F.explode(F.array_distinct(F.filter(F.transform(spans, lambda s: s["kind"]), lambda k: k.isNotNull()))).alias("kind"))
    return different.join(texts.groupBy("kind").agg(F.count("*").alias("documents")), "kind").select("kind", "documents", "matches", "different")
