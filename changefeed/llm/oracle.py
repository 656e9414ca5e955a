"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from changefeed.llm.rules import DEFAULT_POLICY, RULES, policy_mask

_FAILED = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))

QUALITY_RULES = rf"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
    SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM texts),
starts AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM split),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s FROM starts),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM windows) WHERE c > 1),
covered AS (
    SELECT rid, count(DISTINCT p) AS n
    FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
measured AS (
    SELECT doc_id, len(ws) AS n_words,
           CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
           coalesce(covered.n, 0) AS n_repeat_words,
           length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS n_upper,
           len(list_distinct(ws)) AS n_distinct_words,
           len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words
    FROM split LEFT JOIN covered USING (rid)),
marked AS (SELECT *, CAST({_FAILED} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       failed & {policy_mask(DEFAULT_POLICY)} = 0 AS kept, failed
FROM marked
"""

HARD_NEGATIVES = """
WITH taking AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM taking a, taking b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""

COLLOCATIONS = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
    FROM documents),
pieces AS (SELECT lang, unnest(regexp_extract_all(x, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM texts),
spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM spelled),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM starts, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
counts AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM counts WHERE k > 1 AND a >= 30),
places AS (SELECT *, unnest(range(1, k)) AS j FROM candidates),
cuts AS (
    SELECT p.lang, p.k, p.phrase, p.a, p.j, f.a AS l, r.a AS r,
           CAST(2000000 AS HUGEINT) * p.a // (f.a + r.a) AS score
    FROM places p
    JOIN counts f ON f.lang = p.lang AND f.phrase = array_to_string(p.ws[1:p.j], ' ')
    JOIN counts r ON r.lang = p.lang AND r.phrase = array_to_string(p.ws[p.j + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
        FROM candidates, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m)
        WHERE m < k AND i + m - 1 <= k)
    GROUP BY lang, phrase),
kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase)
    WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, k AS words
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": QUALITY_RULES,
    "op11_collocations": COLLOCATIONS,
    "op12_hard_negatives": HARD_NEGATIVES,
}
