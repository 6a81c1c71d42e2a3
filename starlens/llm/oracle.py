"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from starlens.llm.quality_rules import STOP_WORDS


def _fills(rounds: int) -> str:
    """CTEs r1 .. rN: each picks, in order, the documents that still fit their source's goal."""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(f"""
left{i} AS (
  SELECT skey, max(goal) - sum(CASE WHEN pick THEN size ELSE 0 END) AS room FROM r{i - 1} GROUP BY skey
),
run{i} AS (
  SELECT r.*, l.room, NOT r.pick AND r.size > 0 AND r.size <= l.room AS fits,
         sum(CASE WHEN NOT r.pick AND r.size > 0 AND r.size <= l.room THEN r.size ELSE 0 END) OVER (
           PARTITION BY r.skey ORDER BY r.ord, r.doc_id, r.size ROWS UNBOUNDED PRECEDING) AS run
  FROM r{i - 1} r JOIN left{i} l USING (skey)
),
r{i} AS (SELECT * EXCLUDE (pick, room, fits, run), pick OR (fits AND run <= room) AS pick FROM run{i})""")
    return ",".join(steps)


OP8 = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':8') AS ord
  FROM documents
),
totals AS (
  SELECT skey, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY skey
),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM totals
),
-- the share per unit of weight with the k most limited sources at their caps
ranked AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k FROM weighed),
stated AS (
  SELECT a.k, a.cap, a.weight,
         (SELECT sum(source_size) FROM ranked) - (SELECT coalesce(sum(cap), 0) FROM ranked b WHERE b.k < a.k) AS words,
         (SELECT sum(weight) FROM ranked b WHERE b.k >= a.k) AS weights
  FROM ranked a
),
level AS (SELECT k, words, weights FROM stated WHERE words * weight <= cap * weights ORDER BY k LIMIT 1),
targets AS (
  SELECT r.skey, r.source_size,
         CASE WHEN r.k < l.k THEN CAST(r.cap AS DOUBLE)
              ELSE CAST(CAST(l.words AS BIGINT) * r.weight AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM ranked r CROSS JOIN level l
),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM targets
),
goals AS (
  SELECT skey, source_size, target, passes, (target - passes * source_size) * 2 > source_size AS leave_out,
         CASE WHEN (target - passes * source_size) * 2 > source_size
              THEN source_size - (target - passes * source_size) ELSE target - passes * source_size END AS goal
  FROM passes
),
r0 AS (SELECT s.*, g.* EXCLUDE (skey), FALSE AS pick FROM sized s JOIN goals g USING (skey)),{_fills(3)}
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN size > 0 THEN size * (passes + CASE WHEN pick <> leave_out THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken
FROM r3
"""

#: Base-32 of the digest: 160 bits as 32 groups of five, taken from the bit string of the hex digits.
OP2 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
t AS (
  SELECT page_id, payload_bytes, hex,
         list_aggregate(list_transform(generate_series(1, 40), lambda i:
           lpad(right(bin(strpos('0123456789abcdef', hex[i]) - 1), 4), 4, '0')), 'string_agg', '') AS bits,
         max(page_id) OVER (PARTITION BY hex) AS top
  FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(generate_series(0, 31), lambda g:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_aggregate(list_transform(generate_series(1, 5), lambda j:
           CAST(bits[5 * g + j] AS INTEGER) * CAST(pow(2, 5 - j) AS INTEGER)), 'sum')::INTEGER, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM t
"""

OP5 = """
WITH x AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM x q JOIN x c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
grams AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM worded
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded
),
counted AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, 1 AS k, c.w[1] AS head, array_to_string(c.w[2:], ' ') AS rest FROM candidates c
  UNION ALL
  SELECT c.lang, c.phrase, c.a, 2, array_to_string(c.w[:2], ' '), c.w[3] FROM candidates c WHERE size = 3
),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, 1000000 * c.a * c.a // (x.f * y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000 * c.a * c.a // (x.f * y.f), c.k) AS place
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest
),
kept AS (
  SELECT * FROM scored s WHERE place = 1 AND NOT EXISTS (
    SELECT 1 FROM candidates c
    WHERE c.size = 3 AND c.lang = s.lang AND 100 * c.a >= 50 * s.a
      AND s.phrase IN (c.w[1] || ' ' || c.w[2], c.w[2] || ' ' || c.w[3]))
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_STOP = ", ".join(f"'{w}'" for w in sorted({w for group in STOP_WORDS.values() for w in group.split()}))

OP13 = rf"""
WITH worded AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT row, unnest(range(1, len(w) - 6)) AS i,
         unnest(list_transform(range(1, len(w) - 6), lambda p: array_to_string(w[p:p + 7], ' '))) AS words
  FROM worded
),
twice AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, words) AS times FROM windows) WHERE times > 1),
repeated AS (
  SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY row
),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(regexp_extract_all(text, '[!?]')) AS n_marks, len(lines) AS n_lines,
         len(list_filter(w, lambda x: rtrim(lower(x), '.,;:!?') IN ({_STOP}))) AS n_stop_words
  FROM worded LEFT JOIN repeated USING (row)
),
based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 100 * n_symbols > 10 * n_words
            OR 100 * n_marks > 50 * n_words OR 100 * n_stop_words < 3 * n_words OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM based
"""


ORACLE_SQL: dict[str, str] = {"op2_warc": OP2, "op5_top_k": OP5, "op8_mixing": OP8, "op12_collocations": OP12, "op13_quality_rules": OP13}
