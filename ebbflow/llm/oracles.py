"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

OP10 = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, len(win) AS m, win FROM (
    SELECT item, unnest(list_transform(generate_series(1, greatest(len(w) - 9, 1)), lambda i: w[i:i+9])) AS win
    FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
doc_windows AS (
  SELECT r, m, i, w[i:i+m-1] AS win FROM (
    SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM doc_words, lengths WHERE len(w) >= m)),
found AS (SELECT r, i, d.m, item FROM doc_windows d JOIN windows p ON d.win = p.win),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS k FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text,'') AS text, coalesce('h' || source, '') AS host FROM documents),
w AS (SELECT r, doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (
  SELECT r, i, list_aggregate(w[i:i+4], 'string_agg', ' ') AS k
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(generate_series(i, i + 4)) AS j FROM twice) GROUP BY r),
lines AS (SELECT r, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT r, string_split(text, chr(10)) AS l FROM d)),
worded AS (SELECT r, pos, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY r),
norm AS (
  SELECT r, host, text, pos, regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g') AS line
  FROM worded JOIN d USING (r)),
ctx AS (
  SELECT *, len(string_split(line, ' ')) AS nw, lag(line) OVER (PARTITION BY r ORDER BY pos) AS before, lead(line) OVER (PARTITION BY r ORDER BY pos) AS after,
         row_number() OVER (PARTITION BY r ORDER BY pos) AS place
  FROM norm),
above AS (
  SELECT host, line, count(DISTINCT text) AS n_docs, greatest(count(DISTINCT before), count(DISTINCT after)) AS n_next FROM ctx GROUP BY host, line
  HAVING count(DISTINCT text) > 20),
held AS (SELECT r, host, line, place, before, after, place - row_number() OVER (PARTITION BY r ORDER BY place) AS run FROM ctx JOIN above USING (host, line)),
runs AS (
  SELECT host, list(line ORDER BY place) AS lines, first(before ORDER BY place) AS before, last(after ORDER BY place) AS after FROM held GROUP BY r, host, run),
around AS (
  SELECT host, line, max(n) AS n_around FROM (
    SELECT host, unnest(lines) AS line, n FROM (
      SELECT host, lines, greatest(count(DISTINCT before), count(DISTINCT after)) AS n FROM runs GROUP BY host, lines))
  GROUP BY host, line),
common AS (SELECT host, line FROM above JOIN around USING (host, line) WHERE greatest(n_next, n_around) >= 0.5 * n_docs),
depl AS (
  SELECT r, sum(CASE WHEN common.line IS NULL THEN nw ELSE 0 END) < 0.2 * sum(nw) AS gone
  FROM ctx LEFT JOIN common USING (host, line) GROUP BY r),
base AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(gone, false) AS kept
FROM failed LEFT JOIN depl USING (r)
"""

OP8 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
f AS (SELECT digest, min(page_id) AS original FROM p WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN original IS NULL OR page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND n >= 100
"""

OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
shown AS (
  SELECT *, 12 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
    + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 11 AS n
  FROM rows)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars, false AS rewrites_history
FROM shown GROUP BY conv_id
"""


OP12 = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label AS anchor_label, x.vec_id, x.label, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM kept a JOIN kept x ON a.vec_id % 100 = 0 AND a.r <> x.r),
positives AS (
  SELECT a, anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score, k FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) AS k FROM scores WHERE label = anchor_label)
  WHERE k <= 5),
negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM positives p JOIN scores s ON p.a = s.a AND s.label <> p.anchor_label
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""


def _vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """SQL of the vector codes: the assignment of each round is a join of all parts with their codebook."""

    def assigned(r: int) -> str:
        return f"""
n{r} AS (
  SELECT x.r, x.p, arg_min(e, (dist, e)) AS e, min(dist) AS dist FROM (
    SELECT x.r, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
    FROM parts x JOIN book{r} b USING (p)) x GROUP BY ALL),"""

    def moved(r: int) -> str:
        return f"""
means{r} AS (
  SELECT p, e, list(m ORDER BY k) AS v FROM (
    SELECT p, e, k, CAST(floor(sum(c) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, e, generate_subscripts(v, 1) AS k, unnest(v) AS c FROM n{r} JOIN parts USING (r, p)) GROUP BY p, e, k) GROUP BY p, e),
book{r + 1} AS (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN means{r} m USING (p, e)),"""

    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT r, p, v[p * w + 1 : (p + 1) * w] AS v FROM (SELECT r, v, len(v) // {parts} AS w, unnest(generate_series(0, {parts - 1})) AS p FROM kept)),
book0 AS (SELECT p, r - 1 AS e, v FROM parts WHERE r <= {entries}),
{"".join(assigned(r) + moved(r) for r in range(rounds))}{assigned(rounds)}
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM n{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (r), digest
"""


ORACLES = {"op1_chat": OP1, "op8_warc": OP8, "op5_quality_rules": OP5, "op10_decontamination": OP10, "op12_hard_negatives": OP12, "op13_vector_codes": _vector_codes()}
