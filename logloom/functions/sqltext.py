"""Columns over one SQL statement: type, tables, schema, formatting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import strip

# Statement types, clause starts and key words.
STATEMENT_TYPES = (
    "SELECT INSERT UPDATE DELETE MERGE REPLACE UPSERT CREATE ALTER DROP TRUNCATE"
).split()
CLAUSES = "FROM WHERE GROUP ORDER HAVING LIMIT UNION VALUES SET JOIN LEFT RIGHT INNER CROSS".split()
JOIN_WORDS = "LEFT RIGHT INNER CROSS FULL OUTER".split()
KEYWORDS = (
    "SELECT INSERT UPDATE DELETE MERGE REPLACE UPSERT CREATE ALTER DROP TRUNCATE FROM WHERE GROUP ORDER BY HAVING "
    "LIMIT OFFSET UNION ALL DISTINCT VALUES INTO SET JOIN LEFT RIGHT INNER OUTER FULL CROSS ON USING AS AND OR NOT IN "
    "IS NULL LIKE BETWEEN EXISTS CASE WHEN THEN ELSE END WITH TABLE VIEW INDEX IF PRIMARY KEY FOREIGN REFERENCES "
    "DEFAULT ASC DESC BEGIN COMMIT ROLLBACK"
).split()

# words, blanks, comments, quoted text, then any single character
TOKEN = r"""\w+|\s+|--[^\n]*|/\*(?s:.*?)\*/|'[^']*'|"[^"]*"|[^\w\s]"""

_COMMENT = r"--[^\n]*|/\*(?s:.*?)\*/"
_LEADING = r"^(?:\s++|--[^\n]*+|/\*(?s:.*?)\*/)*+"
_NAME = r"""[\w."`]+"""
# a look at the first letter spares the costlier word border
_TABLE_LIST = (
    r"(?i)(?=[fjiut])\b(?:from|join|into|update|table)\s+(?:if\s+(?:not\s+)?exists\s+)?"
    rf"((?:{_NAME}(?:\s+(?:as\s+)?\w+)?\s*,\s*)*{_NAME})"
)
_FROM_IN_CALL = r"(?i)(?=[estod])(?:\b(?:extract|substring|trim|overlay)\s*\([^()]*\)|\bdistinct\s+from\b)"
_CTE_NAME = r"(?i)(?:\bwith|,)\s*(?:recursive\s+)?(\w+)\s*(?:\([^()]*\)\s*)?\bas\s*(?:(?:not\s+)?materialized\s*)?\("


def comment_timestamp_text(stmt: Column) -> Column:
    """Text of the first ``-- YYYY-MM-DD HH:MM:SS`` comment, null if there is none."""
    found = F.regexp_extract(stmt, r"-- (\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2})", 1)
    return F.nullif(found, F.lit(""))


def _once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` looks at it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def statement_type(stmt: Column) -> Column:
    def typed(first: Column) -> Column:
        after_with = _code_only(F.regexp_replace(stmt, _LEADING, ""))
        after_with = F.upper(F.regexp_extract(after_with, r"(?i)\)\s*(SELECT|INSERT|UPDATE|DELETE|MERGE)\b", 1))
        return (
            F.when((first == "CREATE") & stmt.rlike(rf"{_LEADING}(?i:create\s+or\s+replace)\b"), "CREATE OR REPLACE")
            .when(first.isin(STATEMENT_TYPES), first)
            .when(first == "WITH", F.coalesce(F.nullif(after_with, F.lit("")), F.lit("UNKNOWN")))
            .otherwise("UNKNOWN")
        )

    return _once(F.upper(F.regexp_extract(stmt, rf"{_LEADING}(\w+)", 1)), typed)


def _code_only(stmt: Column) -> Column:
    """The statement with quoted text and comments blanked, whichever starts first."""
    return F.regexp_replace(stmt, rf"(?=['/-])(?:'[^']*'|{_COMMENT})", " ")


def qualified_tables(stmt: Column) -> Column:
    """Names after FROM / JOIN / INTO / UPDATE / TABLE in order, with their qualifier."""
    def found(code: Column) -> Column:
        lists = F.regexp_extract_all(code, F.lit(_TABLE_LIST), F.lit(1))
        names = F.transform(
            F.flatten(F.transform(lists, lambda x: F.when(F.contains(x, F.lit(",")), F.split(x, r"\s*,\s*")).otherwise(F.array(x)))),
            lambda x: F.translate(F.regexp_extract(x, rf"^({_NAME})", 1), '"`', ""),
        )
        ctes = F.when(code.rlike(r"(?i)(?=w)\bwith\b"), F.regexp_extract_all(code, F.lit(_CTE_NAME), F.lit(1)))
        kept = F.filter(names, lambda x: ~F.upper(x).isin("SELECT", "LATERAL", "VALUES", "SET", "ONLY"))
        return F.array_except(kept, F.coalesce(ctes, F.array().cast("array<string>")))

    return _once(F.regexp_replace(_code_only(stmt), _FROM_IN_CALL, " "), found)


def table_names(qualified: Column) -> Column:
    """Distinct table names without qualifier, first-seen order."""
    return F.array_distinct(F.transform(qualified, lambda x: F.regexp_extract(x, r"([^.]*)$", 1)))


def first_schema(qualified: Column) -> Column:
    """Qualifier of the first qualified table name, null if none is qualified."""
    dotted = F.filter(qualified, lambda x: F.contains(x, F.lit(".")))
    return F.substring_index(F.get(dotted, F.lit(0)), ".", 1)


def format_query(stmt: Column) -> Column:
    """Key words upper, other names lower, a line break before each clause; quotes and comments kept."""
    def shown(parts: Column, uppers: Column, breaks: Column) -> Column:
        def show(part: Column, i: Column) -> Column:
            word, next_breaks = F.get(uppers, i), F.get(breaks, i + 1)
            blank = F.trim(F.translate(part, "\t\r\n", "   ")) == ""
            # the commonest kinds of token come first; each is of one kind only
            return (
                F.when(part == " ", F.when(next_breaks, "").otherwise(" "))
                .when(F.get(breaks, i), F.concat(F.lit("\n"), word))
                .when(word.isin(KEYWORDS), word)
                .when(part.rlike(r"^\w"), F.lower(part))
                .when(blank, F.when(next_breaks, "").when(F.contains(part, F.lit("\n")), "\n").otherwise(" "))
                .otherwise(part)
            )

        return F.array_join(F.transform(parts, show), "")

    def breaks(uppers: Column) -> Column:
        # a join is broken before its first word: LEFT OUTER JOIN stays together
        def one(word: Column, i: Column) -> Column:
            return word.isin(CLAUSES) & ((word != "JOIN") | ~F.coalesce(F.get(uppers, i - 2).isin(JOIN_WORDS), F.lit(False)))

        return F.transform(uppers, one)

    # each list is bound once: it is looked at from every token
    tokens = F.regexp_extract_all(stmt, F.lit(TOKEN), F.lit(0))
    return strip(_once(tokens, lambda p: _once(F.transform(p, F.upper), lambda u: _once(breaks(u), lambda b: shown(p, u, b)))))
