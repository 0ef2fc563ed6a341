"""Cleaning and language-model scores over the given documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions import anonymise as A
from logloom.operators import ngram_model as M
from logloom.operators import repeated_lines as R
from logloom.plans.metric_queries import norm
from logloom.plans.registry import query

# --- n-gram perplexity ---

_WORDS = f"list_filter(string_split({norm('text')}, ' '), lambda w: w <> '')"


def _ngram_sql(orders: tuple[int, ...]) -> str:
    """Counts, continuation counts and interpolated probabilities of every order, then the mean over the words."""
    parts = [f"w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents)"]
    d = M.DISCOUNT
    for n in orders:
        grams = f"list_transform(range(1, len(ws) + 1), lambda i: array_to_string(ps[i:i + {n - 1}], ' '))"
        parts.append(
            f"g{n} AS MATERIALIZED (SELECT doc_id, unnest({grams}) AS gram FROM (SELECT doc_id, ws, list_concat(list_transform(range({n - 1}), lambda i: '{M.START}'), ws) AS ps FROM w))"
        )
        parts.append(f"c{n}_{n} AS MATERIALIZED (SELECT gram, count(*) AS c FROM g{n} GROUP BY gram)")
        for k in range(n - 1, 0, -1):
            parts.append(f"c{n}_{k} AS MATERIALIZED (SELECT regexp_replace(gram, '^[^ ]+ ', '') AS gram, count(*) AS c FROM c{n}_{k + 1} GROUP BY 1)")
        parts.append(
            f"p{n}_1 AS MATERIALIZED (SELECT gram, greatest(c - {d}::DOUBLE, 0) / sum(c) OVER () + {d}::DOUBLE * count(*) OVER () / sum(c) OVER () / (count(*) OVER () + 1) AS p FROM c{n}_1)"
        )
        for k in range(2, n + 1):
            parts.append(f"x{n}_{k} AS MATERIALIZED (SELECT regexp_replace(gram, ' [^ ]+$', '') AS context, sum(c) AS a, {d}::DOUBLE * count(*) / sum(c) AS share FROM c{n}_{k} GROUP BY 1)")
            parts.append(
                f"p{n}_{k} AS MATERIALIZED (SELECT t.gram, greatest(t.c - {d}::DOUBLE, 0) / a + share * l.p AS p FROM c{n}_{k} t "
                f"JOIN x{n}_{k} ON context = regexp_replace(t.gram, ' [^ ]+$', '') JOIN p{n}_{k - 1} l ON l.gram = regexp_replace(t.gram, '^[^ ]+ ', ''))"
            )
        parts.append(f"s{n} AS (SELECT doc_id, count(*) AS n_tokens, sum(ln(p)) AS log_prob FROM g{n} JOIN p{n}_{n} USING (gram) GROUP BY doc_id)")
    every = " UNION ALL ".join(
        f"SELECT w.doc_id, {n} AS ngram_order, coalesce(n_tokens, 0) AS n_tokens, round(log_prob / n_tokens, 8) AS mean_log_prob, "
        f"round(exp(-log_prob / n_tokens), 3) AS perplexity FROM w LEFT JOIN s{n} USING (doc_id)"
        for n in orders
    )
    return f"WITH {', '.join(parts)} {every}"


@query("ngram_perplexity", _ngram_sql((1, 2, 3)))
def _(t):
    words = M.staged_words(t.wide("documents"), "doc_id")
    return M.own_scores(words, "doc_id", 3).select(
        "doc_id", "ngram_order", "n_tokens", F.round(F.col("log_prob") / F.col("n_tokens"), 8).alias("mean_log_prob"), F.round("perplexity", 3).alias("perplexity")
    )


# --- repeated lines ---

_BARE = "trim({x}, chr(32) || chr(9) || chr(13))"
_REPEATED = f"""lines AS (
  SELECT unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: {_BARE.format(x='x')}), lambda x: x <> ''))) AS line FROM documents
), repeated AS (
  SELECT line, count(*) AS documents FROM lines GROUP BY line HAVING count(*) >= greatest({R.LEAST}, ceil((SELECT count(*) FROM documents) * {R.SHARE}::DOUBLE)))"""


@query("repeated_lines", f"WITH {_REPEATED} SELECT line, documents FROM repeated")
def _(t):
    return R.repeated_lines(t.wide("documents")).select("line", "documents")


@query(
    "repeated_lines_removed",
    f"""WITH {_REPEATED}, s AS (SELECT list(line) AS found FROM repeated),
    k AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls, list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(found, []), {_BARE.format(x='x')})) AS kept FROM documents, s)
    SELECT doc_id, md5(array_to_string(kept, chr(10))) AS text_md5, coalesce(len(ls) - len(kept), 0) AS lines_removed FROM k""",
)
def _(t):
    docs = t.wide("documents").select("doc_id", "text")
    cleaned = R.without_lines(docs, R.repeated_lines(docs))
    return cleaned.select("doc_id", F.md5("text").alias("text_md5"), "lines_removed")


# --- anonymise ---

KEY = "logloom"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _whole(pattern: str) -> str:
    return f"regexp_full_match(m, {_quoted(pattern)})"


_LUHN = "list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN digits[length(digits) - i + 1]::INT ELSE 2 * digits[length(digits) - i + 1]::INT - CASE WHEN digits[length(digits) - i + 1]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
_SPANS = f"""found AS (
  SELECT doc_id, text, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM (SELECT doc_id, text, regexp_extract_all(text, {_quoted(A.SPAN)}) AS ms FROM documents)
), digits AS (SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS digits FROM found
), kinds AS (
  SELECT *, CASE WHEN {_whole(A.EMAIL)} THEN 'EMAIL' WHEN {_whole(A.SECRET)} THEN 'SECRET'
    WHEN {_whole(A.ADDRESS)} THEN CASE WHEN list_max(list_transform(string_split(m, '.'), lambda x: try_cast(x AS INT))) <= 255 THEN 'IP' END
    WHEN {_whole(A.CARD)} THEN CASE WHEN {_LUHN} THEN 'CARD' END WHEN {_whole(A.PHONE)} THEN 'PHONE' END AS kind FROM digits
), spans AS (
  SELECT *, '[' || kind || '_' || left(sha256('{KEY}|' || kind || '|' || CASE WHEN kind IN ('CARD', 'PHONE') THEN digits ELSE lower(m) END), {A.DIGITS}) || ']' AS pseudonym FROM kinds)"""


@query(
    "anonymised_text",
    f"""WITH {_SPANS},
    marks AS (SELECT doc_id, list(coalesce(pseudonym, m) ORDER BY i) AS marks, count(kind) AS n_replaced FROM spans GROUP BY doc_id),
    pieces AS (SELECT d.doc_id, regexp_split_to_array(text, {_quoted(A.SPAN)}) AS ps, marks, coalesce(n_replaced, 0) AS n_replaced FROM documents d LEFT JOIN marks USING (doc_id))
    SELECT doc_id, array_to_string(list_transform(ps, lambda p, i: p || coalesce(marks[i], '')), '') AS text, n_replaced FROM pieces""",
)
def _(t):
    cleaned = A.anonymised(t.wide("documents").select("doc_id", "text"), KEY)
    replaced = F.coalesce(F.size(F.filter("spans", lambda s: s["kind"].isNotNull())), F.lit(0))
    return cleaned.select("doc_id", "text", F.when(F.col("text").isNull(), 0).otherwise(replaced).cast("bigint").alias("n_replaced"))


@query("anonymise_counts", f"WITH {_SPANS} SELECT kind, count(DISTINCT doc_id) AS documents, count(*) AS matches, count(DISTINCT pseudonym) AS different FROM spans WHERE kind IS NOT NULL GROUP BY kind")
def _(t):
    return A.span_counts(A.with_spans(t.wide("documents").select("text"), KEY).select("spans"))
