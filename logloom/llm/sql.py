"""DuckDB SQL for the queries that SQL can express; run over the same whole tables."""

from __future__ import annotations

from logloom.llm import block_search, hard_negatives, mixing, quality_rules

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP7 = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: length(translate(l, {_WHITE}, '')) > 0) AS lines
  FROM documents
), w AS (
  SELECT doc_id, i, g, count(*) OVER (PARTITION BY rid, g) AS n, rid
  FROM (SELECT doc_id, rid, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS g
        FROM (SELECT doc_id, rid, words, unnest(generate_series(1, len(words) - 2)) AS i
              FROM (SELECT *, row_number() OVER () AS rid FROM t)))
), r AS (
  SELECT doc_id, count(DISTINCT (rid, p)) AS n_repeat_words
  FROM (SELECT doc_id, rid, unnest([i, i + 1, i + 2]) AS p FROM w WHERE n > 1) GROUP BY doc_id
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(translate(text, {_WHITE}, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D.,;:!?]'), lambda x: x IN ({_STOP})))::BIGINT AS n_stop_words
  FROM t LEFT JOIN r USING (doc_id)
), b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT *, (NOT base_failed AND word_chars / greatest(n_words, 1)::DOUBLE BETWEEN 1.5 AND 30.0
           AND n_symbols / greatest(n_words, 1)::DOUBLE <= 0.3 AND n_stop_words / greatest(n_words, 1)::DOUBLE >= 0.06
           AND n_dup_lines / greatest(n_lines, 1)::DOUBLE <= 0.4) AS kept
FROM b
"""

_U = f"((('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / {mixing._ODDS!r}::DOUBLE)"

OP10 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS size, {_U} AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k,
         sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s
), l AS (
  SELECT *, (budget - coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o
), t AS (
  SELECT source, source_size, CASE WHEN source_size * 2.0::DOUBLE <= level * w THEN source_size * 2.0::DOUBLE
         ELSE w * (SELECT level FROM l WHERE source_size * 2.0::DOUBLE > level * w ORDER BY k LIMIT 1) END AS target FROM l
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS c FROM t
), z AS (
  SELECT d.source, d.size, target - c * source_size AS rest, count(*) AS n FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source WHERE d.size > 0 GROUP BY ALL
), f AS (
  SELECT *, rest - coalesce(sum(n * size) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS room,
         sum(n * size * size) OVER (PARTITION BY source ORDER BY size DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS squares
  FROM z WHERE rest > 0
), k AS (
  SELECT source, max(size) + 1 AS certain, arg_max(room / squares, size) AS factor, arg_max(room, size) AS room FROM f WHERE room / squares * size < 1 GROUP BY source
), q AS (
  SELECT doc_id, d.source, size, source_size, target, c, certain, room,
         CASE WHEN size > 0 AND size < certain THEN (u / (1 - u)) / ((factor * size) / (1 - factor * size)) END AS odds
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
), r AS (
  SELECT *, coalesce(sum(size) FILTER (WHERE odds IS NOT NULL) OVER (
           PARTITION BY source ORDER BY odds / (1 + odds) NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM q
)
SELECT doc_id, size, source_size, target, source,
       ((c + CASE WHEN size >= certain OR odds IS NOT NULL AND before + size / 2.0::DOUBLE <= room THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""

ORACLE = {"op7_quality_rules": OP7, "op10_mixing": OP10}

_ID = "'call_' || substr(md5(conv_id || ':' || ({turn})), 1, 16)"

OP6 = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         CASE role WHEN 'user' THEN {_ID.format(turn='turn')} WHEN 'assistant' THEN {_ID.format(turn='turn - 1')} END AS call_id
  FROM conversations
), w AS (
  SELECT conv_id, turn, 0 AS waits FROM c x WHERE role = 'user'
    AND NOT EXISTS (SELECT 1 FROM c y WHERE y.conv_id = x.conv_id AND y.turn = x.turn - 2 AND y.role = 'user')
  UNION ALL
  SELECT c.conv_id, c.turn, waits + 1 FROM c JOIN w ON c.conv_id = w.conv_id AND c.turn = w.turn + 2 WHERE c.role = 'user'
), d AS (
  SELECT c.*, CASE kind WHEN 'message' THEN 0 WHEN 'call' THEN 2 * own.waits ELSE 2 * up.waits + 1 END::BIGINT AS depth,
         CASE kind WHEN 'message' THEN 'message'
              WHEN 'call' THEN CASE WHEN EXISTS (SELECT 1 FROM c y WHERE y.conv_id = c.conv_id AND y.turn = c.turn + 1 AND y.role = 'assistant') THEN 'linked' ELSE 'no_result' END
              ELSE CASE WHEN up.conv_id IS NOT NULL THEN 'linked' ELSE 'no_call' END END AS status
  FROM c LEFT JOIN w own ON c.kind = 'call' AND own.conv_id = c.conv_id AND own.turn = c.turn
         LEFT JOIN w up ON c.kind = 'result' AND up.conv_id = c.conv_id AND up.turn = c.turn - 1
)
SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY depth NULLS LAST, turn) - 1)::BIGINT AS place, kind, call_id, depth, status,
       CASE WHEN kind = 'call' AND turn % 7 = 6 THEN 'type:limit' END AS problem,
       CASE kind WHEN 'call' THEN '{{"arguments":{{"limit":' || (CASE WHEN turn % 7 = 6 THEN '"10"' ELSE (length(text) % 50)::VARCHAR END) || ',"query":' || to_json(text)::VARCHAR
                                  || '}},"id":"' || call_id || '","name":"' || (CASE WHEN turn % 3 = 2 THEN 'summarise' ELSE 'search' END) || '"}}'
                 WHEN 'result' THEN '{{"content":' || to_json(text)::VARCHAR || ',"id":"' || call_id || '"}}'
                 ELSE '{{"content":' || to_json(text)::VARCHAR || '}}' END AS json
FROM d
"""
ORACLE["op6_tool_calls"] = OP6

# crc32 bit by bit: the digits of the id, each as eight bits from the lowest on
_CRC = """xor(list_reduce(
    flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: list_transform(range(8), lambda k: ((ascii(ch) >> k::INT) & 1)::BIGINT))),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT), 4294967295)"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_TREE = """
  SELECT tree, 0 AS lvl, pos, digest, count(*) OVER (PARTITION BY tree) AS width FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), any_value((width + 2) // 3) FROM {tree} WHERE width > 1 GROUP BY tree, lvl, pos // 3
"""
_SIDES = """
  SELECT a.tree, a.lvl, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM {tree} a JOIN {tree} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.pos // 3 = b.pos // 3 WHERE a.width > 1 GROUP BY a.tree, a.lvl, a.pos
"""

OP11 = f"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} END AS changed,
         CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree FROM documents
), leaves AS MATERIALIZED (
  SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS digest, coalesce(changed, leaf) AS version, doc_id FROM d
), low AS ({_TREE.format(leaves='leaves', tree='low')}
), subroots AS MATERIALIZED (
  SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, digest, tree AS name FROM low WHERE width = 1
), high AS ({_TREE.format(leaves='subroots', tree='high')}
), sides AS MATERIALIZED ({_SIDES.format(tree='low')}), above AS MATERIALIZED ({_SIDES.format(tree='high')}
), climb AS (
  SELECT doc_id, digest AS leaf, tree, pos AS place, 0 AS lvl, pos, version AS folded, '' AS siblings FROM leaves
  UNION ALL
  SELECT doc_id, leaf, c.tree, place, c.lvl + 1, c.pos // 3, sha256(l || folded || r), siblings || l || r FROM climb c JOIN sides s ON c.tree = s.tree AND c.lvl = s.lvl AND c.pos = s.pos
), climbed AS (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY tree, place ORDER BY lvl DESC) = 1
), further AS (
  SELECT doc_id, leaf, c.tree, place, s.digest AS subroot, 0 AS lvl, s.pos, folded, siblings FROM climbed c JOIN subroots s ON c.tree = s.name
  UNION ALL
  SELECT doc_id, leaf, f.tree, place, subroot, f.lvl + 1, f.pos // 3, sha256(l || folded || r), siblings || l || r FROM further f JOIN above s ON f.lvl = s.lvl AND f.pos = s.pos
), top AS (SELECT * FROM further QUALIFY row_number() OVER (PARTITION BY tree, place ORDER BY lvl DESC) = 1)
SELECT doc_id, leaf, subroot, h.digest AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = h.digest AS verified
FROM top JOIN high h ON h.width = 1
"""

_USABLE = "vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"

OP12 = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % {hard_negatives.SHIFTED_EVERY} = 0 THEN (label + 1) % {hard_negatives.LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id AND len(a.v) = len(e.v) WHERE a.vec_id % {hard_negatives.ANCHOR_EVERY} = 0
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}
)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND {hard_negatives.SHARE} * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""

OP13 = f"""
WITH e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {_USABLE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)
SELECT q.vec_id AS query_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, e.v) DESC, e.vec_id)::INT AS rank,
       e.vec_id, list_inner_product(q.v, e.v) AS score
FROM e q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % {block_search.QUERY_EVERY} = 0
QUALIFY rank <= {block_search.NEAREST}
"""

ORACLE |= {"op11_merkle": OP11, "op12_hard_negatives": OP12, "op13_block_search": OP13}
