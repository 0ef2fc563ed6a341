"""Evaluation metrics over prediction / reference pairs of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import stemming
from logloom.functions.text import normalize_text
from logloom.operators import bleu, evaluation, label_scores, pairs, perplexity, rouge
from logloom.plans.registry import query


def turn_pairs(t) -> DataFrame:
    """Assistant turn = prediction, the turn before it = reference."""
    turns = t.wide("conversations")
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction")
    )
    asked = turns.select("conv_id", "turn", F.col("text").alias("reference"))
    return answers.join(asked, ["conv_id", "turn"]).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + 1).cast("string")).alias("example_id"), "prediction", "reference"
    )


TURN_SQL = """pairs AS (SELECT a.conv_id || ':' || a.turn AS example_id, a.text AS prediction, r.text AS reference
  FROM conversations a JOIN conversations r ON r.conv_id = a.conv_id AND r.turn = a.turn - 1 WHERE a.role = 'assistant')"""


def edited_pairs(t) -> DataFrame:
    """Each document against an edited copy of itself: other punctuation, cut, or unchanged."""
    kind = F.col("doc_id") % 4
    edited = (
        F.when(kind == 0, F.concat(F.replace("text", F.lit(" "), F.lit(" - ")), F.lit("!?")))
        .when(kind == 1, F.col("text"))
        .when(kind == 2, F.array_join(F.slice(F.split("text", " "), F.lit(2), F.size(F.split("text", " "))), " "))
        .otherwise(F.col("lang"))
    )
    return t.wide("documents").select(F.col("doc_id").alias("example_id"), edited.alias("prediction"), F.col("text").alias("reference"))


EDITED_SQL = """pairs AS (SELECT doc_id AS example_id, text AS reference, CASE doc_id % 4 WHEN 0 THEN replace(text, ' ', ' - ') || '!?' WHEN 1 THEN text
  WHEN 2 THEN array_to_string(string_split(text, ' ')[2:], ' ') ELSE lang END AS prediction FROM documents)"""


def norm(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}_\\s'']', ' ', 'g'), '\\s+', ' ', 'g'))"
    )


def words(x: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({x}, '[\\s\\p{{Z}}]+'), lambda w: w <> ''))"


def token_sql(pairs_sql: str, normalized: bool = True) -> str:
    p, r = (norm("prediction"), norm("reference")) if normalized else ("lower(prediction)", "lower(reference)")
    return f"""{pairs_sql},
    sets AS (SELECT *, {words(p)} AS p, {words(r)} AS r FROM pairs),
    common AS (SELECT *, len(list_intersect(p, r)) AS c, len(p) AS np, len(r) AS nr FROM sets),
    scored AS (SELECT *,
      CASE WHEN np = 0 AND nr = 0 THEN 1.0::DOUBLE WHEN np = 0 OR nr = 0 THEN 0.0::DOUBLE ELSE c / np END AS tp,
      CASE WHEN np = 0 AND nr = 0 THEN 1.0::DOUBLE WHEN np = 0 OR nr = 0 THEN 0.0::DOUBLE ELSE c / nr END AS tr,
      CASE WHEN np = 0 AND nr = 0 THEN 1.0::DOUBLE WHEN np = 0 OR nr = 0 THEN 0.0::DOUBLE ELSE 2 * c / (np + nr) END AS tf FROM common)"""


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.round("value", 6))


def _long(items: list[tuple[str, str | None, str]], source: str, with_sql: str) -> str:
    selects = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {repr(s) if s else 'NULL::VARCHAR'} AS sub_metric, round(({v})::DOUBLE, 6) AS value FROM {source}"
        for m, s, v in items
    )
    return f"WITH {with_sql} {selects}"


_F1_ITEMS = [("f1", "precision", "avg(tp)"), ("f1", "recall", "avg(tr)"), ("f1", "f1", "avg(tf)")]
_EM = f"avg(CASE WHEN {norm('prediction')} = {norm('reference')} THEN 1.0 ELSE 0.0 END)"


@query("text_normalize", f"SELECT doc_id, {norm('text')} AS normalized FROM documents")
def _(t):
    return t.documents.select("doc_id", normalize_text(F.col("text")).alias("normalized"))


@query("pair_alignment", f"WITH {TURN_SQL} SELECT * FROM pairs")
def _(t):
    return turn_pairs(t)


@query(
    "pair_alignment_missing",
    """SELECT count(*) AS predictions, count(l.quality) AS with_reference,
      round(avg(CASE WHEN CAST(l.quality AS VARCHAR) = CAST(d.doc_id % 2 AS VARCHAR) THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS exact_match
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(t):
    predictions = t.documents.select("doc_id", (F.col("doc_id") % 2).cast("string").alias("prediction"))
    references = t.labels.select("doc_id", F.col("quality").cast("string").alias("reference"))
    aligned = pairs.align(predictions, references, "doc_id")
    return aligned.agg(
        F.count("*").alias("predictions"),
        F.count("reference").alias("with_reference"),
        F.round(F.avg(pairs.exact_match(F.col("prediction"), F.col("reference"))), 6).alias("exact_match"),
    )


@query("exact_match_normalized", _long([("exact_match", None, _EM)], "pairs", EDITED_SQL))
def _(t):
    return rounded(pairs.exact_match_score(edited_pairs(t)))


@query(
    "exact_match_raw",
    _long([("exact_match", None, "avg(CASE WHEN prediction = reference THEN 1.0 ELSE 0.0 END)")], "pairs", EDITED_SQL),
)
def _(t):
    return rounded(pairs.exact_match_score(edited_pairs(t), normalize=False))


@query("token_f1", _long(_F1_ITEMS, "scored", token_sql(TURN_SQL)))
def _(t):
    return rounded(pairs.token_f1_score(turn_pairs(t)))


@query("token_f1_documents", _long(_F1_ITEMS, "scored", token_sql(EDITED_SQL)))
def _(t):
    return rounded(pairs.token_f1_score(edited_pairs(t)))


@query(
    "example_metrics",
    f"""WITH {token_sql(EDITED_SQL, normalized=False)} SELECT example_id,
      CASE WHEN prediction = reference THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS exact_match, round(tf, 6) AS token_f1 FROM scored""",
)
def _(t):
    scored = pairs.example_metrics(edited_pairs(t), domain="qa")
    return scored.select(
        "example_id",
        F.col("metrics")["exact_match"].alias("exact_match"),
        F.round(F.col("metrics")["token_f1"], 6).alias("token_f1"),
    )


# --- labels: quality against the opposite of toxic, and a three-valued label ---


def label_pairs(t) -> DataFrame:
    d = t.labels.join(t.documents.select("doc_id", "lang", "n_chars"), "doc_id")
    long_text = F.when(F.col("n_chars") > 1000, "long").otherwise("short")
    truth = F.when(F.col("quality") == 1, long_text).otherwise(F.when(F.col("toxic") == 1, "toxic").otherwise("poor"))
    guess = F.when(F.col("lang") == "en", long_text).otherwise(F.when(F.col("n_chars") < 300, "poor").otherwise("other"))
    return d.select(F.col("doc_id").alias("example_id"), guess.alias("prediction"), truth.alias("reference"))


LABEL_SQL = """pairs AS (SELECT doc_id AS example_id,
    CASE WHEN lang = 'en' THEN long_text WHEN n_chars < 300 THEN 'poor' ELSE 'other' END AS prediction,
    CASE WHEN quality = 1 THEN long_text WHEN toxic = 1 THEN 'toxic' ELSE 'poor' END AS reference
  FROM (SELECT *, CASE WHEN n_chars > 1000 THEN 'long' ELSE 'short' END AS long_text FROM labels JOIN documents USING (doc_id))),
names AS (SELECT DISTINCT unnest([prediction, reference]) AS label FROM pairs),
counts AS (SELECT label, count(*) FILTER (reference = label) AS support, count(*) FILTER (prediction = label) AS predicted,
    count(*) FILTER (reference = label AND prediction = label) AS hits
  FROM pairs JOIN names ON label IN (prediction, reference) GROUP BY label),
per_label AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r, 2 * hits / (support + predicted) AS f FROM counts)"""


@query(
    "label_scores_per_label",
    f"""WITH {LABEL_SQL} SELECT label, support, predicted, hits, round(p::DOUBLE, 6) AS "precision", round(r::DOUBLE, 6) AS recall,
      round(f::DOUBLE, 6) AS f1 FROM per_label""",
)
def _(t):
    scores = label_scores.per_label(label_pairs(t))
    return scores.select(
        "label", "support", "predicted", "hits", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")]
    )


_MACRO = [("f1", "precision", "avg(p)"), ("f1", "recall", "avg(r)"), ("f1", "f1", "avg(f)")]
_AVERAGES = {
    "macro": _MACRO,
    "micro": [
        ("f1", "precision", "sum(hits) / sum(predicted)"),
        ("f1", "recall", "sum(hits) / sum(support)"),
        ("f1", "f1", "2 * sum(hits) / (sum(support) + sum(predicted))"),
    ],
    "weighted": [
        ("f1", "precision", "sum(p * support) / sum(support)"),
        ("f1", "recall", "sum(r * support) / sum(support)"),
        ("f1", "f1", "sum(f * support) / sum(support)"),
    ],
}
for _average, _items in _AVERAGES.items():
    query(f"label_f1_{_average}", _long(_items, "per_label", LABEL_SQL))(
        lambda t, a=_average: rounded(label_scores.label_f1_score(label_pairs(t), a))
    )

_ACC = "avg(CASE WHEN prediction = reference THEN 1.0 ELSE 0.0 END)"


@query("accuracy", _long([("accuracy", None, _ACC)], "pairs", LABEL_SQL))
def _(t):
    return rounded(pairs.accuracy_score(label_pairs(t)))


# --- ROUGE and BLEU ---


def gram_sql(pairs_sql: str, hyp: str, ref: str, orders: int) -> str:
    """Clipped n-gram counts per example; ``hyp`` / ``ref`` give word lists."""
    return f"""{pairs_sql},
    split_words AS (SELECT example_id, {hyp} AS h, {ref} AS r FROM pairs),
    orders AS (SELECT unnest(range(1, {orders + 1})) AS n),
    grams AS (
      SELECT example_id, n, 'h' AS side, unnest(list_transform(range(1, len(h) - n + 2), lambda i: array_to_string(h[i:i + n - 1], ' '))) AS gram
      FROM split_words, orders UNION ALL
      SELECT example_id, n, 'r', unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], ' ')))
      FROM split_words, orders),
    gram_counts AS (SELECT example_id, n, gram, count(*) FILTER (side = 'h') AS ch, count(*) FILTER (side = 'r') AS cr FROM grams GROUP BY ALL),
    clipped AS (SELECT example_id, n, sum(least(ch, cr)) AS matched, sum(ch) AS nh, sum(cr) AS nr FROM gram_counts GROUP BY ALL)"""


def _rouge_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> '')"


_ROUGE = gram_sql(TURN_SQL, _rouge_words("prediction"), _rouge_words("reference"), 2)
_TOTAL = "(SELECT count(*) FROM pairs)"
_ROUGE_ITEMS = [
    (f"rouge{n}", part, f"coalesce(sum(CASE WHEN n = {n} AND {bottom} > 0 THEN {top} / ({bottom}) END), 0) / {_TOTAL}")
    for n in (1, 2)
    for part, top, bottom in (
        ("precision", "matched", "nh"), ("recall", "matched", "nr"), ("fmeasure", "2 * matched", "(nh + nr)"),
    )
]


@query("rouge_1_2", _long(_ROUGE_ITEMS, "clipped", _ROUGE))
def _(t):
    return rounded(rouge.rouge_score(turn_pairs(t), ("rouge1", "rouge2"), stem=False))


def _stem_sql(pairs_sql: str) -> str:
    """Word lists ``h`` and ``r`` with stems: every distinct word is stemmed once, step by step, and looked up."""
    steps = []
    for k, rules in enumerate(stemming.STEPS):
        cases = " ".join(
            f"WHEN ends_with(x, '{suffix}')" + (f" AND regexp_matches(x, '{guard}')" if guard else "")
            + " THEN regexp_replace(x, '{}', '{}')".format(pattern, replacement.replace("$1", "\\1"))
            for suffix, guard, pattern, replacement in rules
        )
        steps.append(f"stem_{k + 1} AS MATERIALIZED (SELECT w, CASE {cases} ELSE x END AS x FROM stem_{k})")
    fixed = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in stemming.IRREGULAR.items())
    return f"""{pairs_sql},
    raw_words AS (SELECT example_id, {_rouge_words("prediction")} AS h, {_rouge_words("reference")} AS r FROM pairs),
    stem_0 AS (SELECT DISTINCT w, w AS x FROM (SELECT unnest(list_concat(h, r)) AS w FROM raw_words)),
    {", ".join(steps)},
    stems AS (SELECT w, CASE WHEN length(w) <= 3 THEN w ELSE CASE w {fixed} ELSE x END END AS s FROM stem_{len(stemming.STEPS)}),
    places AS (SELECT example_id, 'h' AS side, unnest(h) AS w, generate_subscripts(h, 1) AS i FROM raw_words UNION ALL
      SELECT example_id, 'r', unnest(r), generate_subscripts(r, 1) FROM raw_words),
    stemmed AS (SELECT example_id, list(s ORDER BY i) FILTER (side = 'h') AS h, list(s ORDER BY i) FILTER (side = 'r') AS r
      FROM places JOIN stems USING (w) GROUP BY example_id),
    rouge_words AS (SELECT example_id, coalesce(s.h, []) AS h, coalesce(s.r, []) AS r FROM raw_words LEFT JOIN stemmed s USING (example_id))"""


def _common_sql(pairs_sql: str) -> str:
    """Longest common subsequences as longest increasing runs of match places (a reference word's places in falling order)."""
    split_words = f"split_words AS (SELECT example_id, {_rouge_words('prediction')} AS h, {_rouge_words('reference')} AS r FROM pairs)"
    return f"{pairs_sql}, {split_words}, {_common_of('split_words', 'clipped')}"


def _common_of(lists: str, name: str) -> str:
    places = "flatten(list_transform(r, lambda w: list_reverse(list_filter(range(1, len(h) + 1), lambda p: h[p] = w))))"
    below = "len(list_filter(ends, lambda e: e < p[1]))"
    return f"""matches AS (SELECT example_id, len(h) AS nh, len(r) AS nr, list_prepend([]::BIGINT[], list_transform({places}, lambda p: [p])) AS steps FROM {lists}),
    {name} AS (SELECT nh, nr, len(list_reduce(steps, lambda ends, p: ends[1:{below}] || p || ends[{below} + 2:])) AS matched FROM matches)"""


_ROUGE_L_ITEMS = [
    ("rougeL", part, f"coalesce(sum(CASE WHEN {bottom} > 0 THEN {top} / ({bottom}) END), 0) / {_TOTAL}")
    for part, top, bottom in (("precision", "matched", "nh"), ("recall", "matched", "nr"), ("fmeasure", "2 * matched", "(nh + nr)"))
]


@query("rouge_l", _long(_ROUGE_L_ITEMS, "clipped", _common_sql(TURN_SQL)))
def _(t):
    return rounded(rouge.rouge_score(turn_pairs(t), ("rougeL",), stem=False))


def _stemmed_rouge_sql(pairs_sql: str) -> str:
    """``stemmed_rouge (rouge_type, precision, recall, fmeasure)`` with stems, all three types."""
    grams = gram_sql(_stem_sql(pairs_sql), "h", "r", 2).replace("AS r FROM pairs),\n    orders", "AS r FROM rouge_words),\n    orders")
    means = ", ".join(
        f"coalesce(sum(CASE WHEN {bottom} > 0 THEN {top} / ({bottom}) END), 0) / {_TOTAL} AS \"{part}\""
        for part, top, bottom in (("precision", "matched", "nh"), ("recall", "matched", "nr"), ("fmeasure", "2 * matched", "(nh + nr)"))
    )
    return f"""{grams}, {_common_of('rouge_words', 'common')},
    stemmed_rouge AS (SELECT 'rouge' || n AS rouge_type, {means} FROM clipped GROUP BY n UNION ALL SELECT 'rougeL', {means} FROM common)"""


_STEMMED = _stemmed_rouge_sql(TURN_SQL)


@query(
    "rouge_stemmed",
    f"WITH {_STEMMED} "
    + " UNION ALL ".join(
        f"SELECT rouge_type AS metric, '{p}' AS sub_metric, round(\"{p}\"::DOUBLE, 6) AS value FROM stemmed_rouge" for p in rouge.PARTS
    ),
)
def _(t):
    return rounded(rouge.rouge_score(turn_pairs(t)))


@query(
    "rouge_per_example",
    f"""WITH {_ROUGE} SELECT example_id, 'rouge' || n AS rouge_type, round(coalesce(matched / nullif(nh, 0), 0)::DOUBLE, 6) AS "precision",
      round(coalesce(matched / nullif(nr, 0), 0)::DOUBLE, 6) AS recall, round((2 * matched / (nh + nr))::DOUBLE, 6) AS fmeasure FROM clipped""",
)
def _(t):
    scores = rouge.rouge_per_example(turn_pairs(t), ("rouge1", "rouge2"), stem=False)
    return scores.select("example_id", "rouge_type", *[F.round(p, 6).alias(p) for p in rouge.PARTS])


def _bleu_sql(pairs_sql: str, words_of, smoothing: str) -> str:
    clipped = gram_sql(pairs_sql, words_of("prediction"), words_of("reference"), 4)
    return _bleu_totals(f"{clipped}, lengths AS (SELECT sum(len(h)) AS hyp_len, sum(len(r)) AS ref_len FROM split_words)", smoothing)


def _bleu_totals(clipped_sql: str, smoothing: str) -> str:
    totals = ", ".join(
        f"coalesce(sum(matched) FILTER (n = {n}), 0) AS m{n}, coalesce(sum(nh) FILTER (n = {n}), 0) AS t{n}" for n in range(1, 5)
    )
    precisions = []
    for n in range(1, 5):
        zeros = " + ".join(f"CASE WHEN m{k} = 0 AND t{k} > 0 THEN 1 ELSE 0 END" for k in range(1, n + 1))
        zero = f"1.0 / (pow(2, {zeros}) * t{n})" if smoothing == "exp" else "0.0"
        precisions.append(f"CASE WHEN t{n} = 0 THEN 0.0 WHEN m{n} = 0 THEN {zero} ELSE m{n} / t{n} END::DOUBLE AS p{n}")
    with_sql = f"""{clipped_sql},
    totals AS (SELECT {totals} FROM clipped),
    parts AS (SELECT {', '.join(precisions)}, CASE WHEN hyp_len >= ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END AS bp FROM totals, lengths)"""
    items = [("bleu", "bleu", "CASE WHEN least(p1, p2, p3, p4) > 0 THEN bp * exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0 END")]
    items += [("bleu", f"precision_{n}", f"p{n}") for n in range(1, 5)]
    return _long(items, "parts", with_sql)


def _plain_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def _words_13a(x: str) -> str:
    x = f"(' ' || {x} || ' ')"
    for pattern, replacement in bleu.TOKENIZER_13A:
        p, r = pattern.replace("\n", "' || chr(10) || '"), replacement.replace("$", "\\")
        x = f"regexp_replace({x}, '{p}', '{r}', 'g')"
    return _plain_words(x)


@query("bleu_words", _bleu_sql(TURN_SQL, _plain_words, "none"))
def _(t):
    return rounded(bleu.bleu_score(turn_pairs(t), "word", "none"))


@query("bleu_13a", _bleu_sql(TURN_SQL, _words_13a, "exp"))
def _(t):
    return rounded(bleu.bleu_score(turn_pairs(t)))


_SECOND = "substr(prediction, instr(prediction, ' ') + 1)"
_SEVERAL = f"""{TURN_SQL},
    split_words AS (SELECT example_id, {_words_13a("prediction")} AS h, [{_words_13a("reference")}, {_words_13a(_SECOND)}] AS rs FROM pairs),
    sides AS (SELECT example_id, 0 AS side, h AS w FROM split_words UNION ALL SELECT example_id, 1, rs[1] FROM split_words UNION ALL SELECT example_id, 2, rs[2] FROM split_words),
    grams AS (SELECT example_id, side, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM (SELECT *, unnest([1, 2, 3, 4]) AS n FROM sides))),
    counts AS (SELECT example_id, n, g, side, count(*) AS c FROM grams GROUP BY ALL),
    per_gram AS (SELECT example_id, n, g, coalesce(max(c) FILTER (side = 0), 0) AS h, coalesce(max(c) FILTER (side > 0), 0) AS r FROM counts GROUP BY example_id, n, g),
    clipped AS (SELECT example_id, n, sum(least(h, r)) AS matched, sum(h) AS nh FROM per_gram GROUP BY example_id, n),
    lengths AS (SELECT sum(len(h)) AS hyp_len, sum(CASE WHEN abs(len(rs[1]) - len(h)) < abs(len(rs[2]) - len(h)) OR
      (abs(len(rs[1]) - len(h)) = abs(len(rs[2]) - len(h)) AND len(rs[1]) < len(rs[2])) THEN len(rs[1]) ELSE len(rs[2]) END) AS ref_len FROM split_words)"""


@query("bleu_multi_reference", _bleu_totals(_SEVERAL, "exp"))
def _(t):
    """Two references: the turn before, and the prediction without its first word."""
    second = F.expr("substr(prediction, instr(prediction, ' ') + 1)")
    return rounded(bleu.bleu_score(turn_pairs(t).select("example_id", "prediction", F.array("reference", second).alias("references"))))


# --- perplexity: one event = one batch with a loss and a token count ---

LOSS_SQL = "losses AS (SELECT value / 50.0 AS loss, user_id + 1 AS n_tokens FROM events)"


def batch_losses(t) -> DataFrame:
    return t.events.select((F.col("value") / 50.0).alias("loss"), (F.col("user_id") + 1).alias("n_tokens"))


for _weighted, _mean in ((False, "avg(loss)"), (True, "sum(loss * n_tokens) / sum(n_tokens)")):
    query(
        f"perplexity_{'weighted' if _weighted else 'mean'}",
        _long(
            [("perplexity", "perplexity", f"exp({_mean})"), ("perplexity", "avg_loss", _mean), ("perplexity", "total_tokens", "sum(n_tokens)")],
            "losses",
            LOSS_SQL,
        ),
    )(lambda t, w=_weighted: rounded(perplexity.perplexity_score(batch_losses(t), w)))


# --- bundles, driver, headline, comparison ---


@query(
    "domain_qa",
    _long([("domain", "exact_match", f"(SELECT {_EM} FROM pairs)")], "(SELECT 1)", EDITED_SQL).replace(
        f"WITH {EDITED_SQL}", f"WITH {token_sql(EDITED_SQL)}"
    )
    + "".join(f" UNION ALL SELECT 'domain', '{s}', round(({v})::DOUBLE, 6) FROM scored" for _, s, v in _F1_ITEMS),
)
def _(t):
    return rounded(evaluation.domain_metrics(edited_pairs(t), "qa"))


@query(
    "domain_classification",
    f"WITH {LABEL_SQL} SELECT 'domain' AS metric, 'accuracy' AS sub_metric, round(({_ACC})::DOUBLE, 6) AS value FROM pairs"
    + "".join(f" UNION ALL SELECT 'domain', '{s}', round(({v})::DOUBLE, 6) FROM per_label" for _, s, v in _MACRO),
)
def _(t):
    return rounded(evaluation.domain_metrics(label_pairs(t), "classification"))


# BLEU as one more table beside the stemmed ROUGE
_BLEU_VALUE = f"(SELECT value FROM ({_bleu_sql(TURN_SQL, _words_13a, 'exp')}) WHERE sub_metric = 'bleu')"


@query(
    "domain_summarization",
    f"""WITH {_STEMMED} SELECT 'domain' AS metric, rouge_type || '_f1' AS sub_metric, round(fmeasure::DOUBLE, 6) AS value FROM stemmed_rouge
      UNION ALL SELECT 'domain', 'bleu', {_BLEU_VALUE}""",
)
def _(t):
    return rounded(evaluation.domain_metrics(turn_pairs(t), "summarization"))


_CHOSEN = f"""WITH {token_sql(EDITED_SQL)}, {LOSS_SQL}
  SELECT 'exact_match' AS metric, NULL::VARCHAR AS sub_metric, round(({_EM})::DOUBLE, 6) AS value FROM pairs UNION ALL
  SELECT 'accuracy', NULL, round(({_EM})::DOUBLE, 6) FROM pairs UNION ALL
  SELECT 'perplexity', 'perplexity', round(exp(avg(loss)), 6) FROM losses UNION ALL
  SELECT 'perplexity', 'avg_loss', round(avg(loss), 6) FROM losses UNION ALL
  SELECT 'perplexity', 'total_tokens', sum(n_tokens)::DOUBLE FROM losses""" + "".join(
    f" UNION ALL SELECT 'f1', '{s}', round(({v})::DOUBLE, 6) FROM scored" for _, s, v in _F1_ITEMS
)


@query("chosen_metrics", _CHOSEN)
def _(t):
    return rounded(
        evaluation.calculate_metrics(edited_pairs(t), ["exact_match", "f1", "accuracy", "perplexity"], losses=batch_losses(t))
    )


@query(
    "custom_domain_metric",
    f"""WITH {TURN_SQL} SELECT 'domain' AS metric, 'length_ratio' AS sub_metric,
      round((sum(length(prediction)) / sum(length(reference)))::DOUBLE, 6) AS value FROM pairs
    UNION ALL SELECT 'domain', 'shorter', round(avg(CASE WHEN length(prediction) < length(reference) THEN 1.0 ELSE 0.0 END), 6) FROM pairs""",
)
def _(t):
    """A domain that the caller adds."""

    def brevity(given: DataFrame) -> DataFrame:
        p, r = F.length("prediction"), F.length("reference")
        measures = given.agg((F.sum(p) / F.sum(r)).alias("length_ratio"), F.avg(F.when(p < r, 1.0).otherwise(0.0)).alias("shorter"))
        return pairs.long_table(measures, {m: ("domain", m) for m in measures.columns})

    evaluation.register_domain("brevity", brevity)
    return rounded(evaluation.domain_metrics(turn_pairs(t), "brevity"))


_F1_VALUE = f"(WITH {token_sql(TURN_SQL)} SELECT round(avg(tf)::DOUBLE, 6) FROM scored)"


@query(
    "headline_summary",
    f"""WITH {_STEMMED} SELECT (SELECT round(({_EM})::DOUBLE, 6) FROM pairs) AS exact_match, {_F1_VALUE} AS f1, {_BLEU_VALUE} AS bleu,
      (SELECT round(fmeasure::DOUBLE, 6) FROM stemmed_rouge WHERE rouge_type = 'rougeL') AS rouge_l""",
)
def _(t):
    scores = evaluation.calculate_metrics(turn_pairs(t), ["exact_match", "f1", "bleu", "rouge"])
    row = evaluation.headline(scores)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def model_scores(t) -> DataFrame:
    """Languages as models; the mean of each document measure that a model has."""

    def item(metric, sub, v):
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(sub).cast("string").alias("sub_metric"), v.cast("double").alias("v")
        )

    d = t.documents.join(t.labels, "doc_id", "left")
    items = F.array(
        item("length", "chars", F.col("n_chars")),
        item("quality", None, F.col("quality")),
        item("short", None, F.when((F.col("lang") == "en") & (F.col("n_chars") < 200), 1.0)),
    )
    each = d.select(F.col("lang").alias("model"), F.inline(items)).where("v is not null")
    return each.groupBy("model", "metric", "sub_metric").agg(F.avg("v").alias("value"))


MODEL_SQL = """each AS (
  SELECT lang AS model, 'length' AS metric, 'chars' AS sub_metric, n_chars::DOUBLE AS v FROM documents UNION ALL
  SELECT lang, 'quality', NULL, quality::DOUBLE FROM documents JOIN labels USING (doc_id) UNION ALL
  SELECT lang, 'short', NULL, 1.0 FROM documents WHERE lang = 'en' AND n_chars < 200),
scores AS (SELECT model, metric, sub_metric, avg(v) AS value FROM each GROUP BY ALL),
shared AS (SELECT metric FROM scores GROUP BY metric HAVING count(DISTINCT model) = 4)"""


@query(
    "model_comparison",
    f"""WITH {MODEL_SQL} SELECT metric, sub_metric, {', '.join(f"round(max(value) FILTER (model = '{m}'), 6) AS {m}" for m in ('de', 'en', 'es', 'fr'))}
    FROM scores WHERE metric IN (SELECT metric FROM shared) GROUP BY ALL""",
)
def _(t):
    table = evaluation.compare_models(model_scores(t), ["de", "en", "es", "fr"])
    return table.select("metric", "sub_metric", *[F.round(m, 6).alias(m) for m in ("de", "en", "es", "fr")])


@query("metric_intersection", f"WITH {MODEL_SQL} SELECT metric FROM shared")
def _(t):
    return evaluation.common_metrics(model_scores(t), ["de", "en", "es", "fr"])
