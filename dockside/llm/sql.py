"""Results of the operators as plain SQL, where SQL can state them."""

from __future__ import annotations

CHECKS: dict[str, str] = {}

CHECKS["op1_exact_dedup"] = r"""
WITH plain AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY body) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
       sha256(body) AS text_sha256
FROM plain
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

CHECKS["op3_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
b_at AS (
  SELECT item_id, words, least(len(words), 10) AS k,
         unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i
  FROM b WHERE len(words) > 0
),
windows AS (SELECT DISTINCT item_id, k, array_to_string(words[i:i + k - 1], ' ') AS win FROM b_at),
d_at AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM d),
d_win AS (
  SELECT doc_id, i, k, array_to_string(words[i:i + k - 1], ' ') AS win
  FROM d_at JOIN (SELECT DISTINCT k FROM windows) ON i + k - 1 <= len(words)
),
hits AS (SELECT doc_id, i, k, item_id FROM d_win JOIN windows USING (k, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
),
-- Longest run of words that a document and one item share from a window on.
pairs AS (
  SELECT h.doc_id, h.i, b_at.item_id, b_at.i AS j, b_at.k
  FROM hits h JOIN b_at ON h.item_id = b_at.item_id AND h.k = b_at.k
  JOIN d ON d.doc_id = h.doc_id
  WHERE array_to_string(b_at.words[b_at.i:b_at.i + b_at.k - 1], ' ') = array_to_string(d.words[h.i:h.i + h.k - 1], ' ')
),
heads AS (
  SELECT doc_id, item_id, k, i - j AS diagonal, i,
         i - row_number() OVER (PARTITION BY doc_id, item_id, k, i - j ORDER BY i) AS run
  FROM pairs
),
-- The longest match from every window on, and those that do not lie inside an earlier one.
from_runs AS (
  SELECT doc_id, i, item_id, i - diagonal AS j, max(i) OVER (PARTITION BY doc_id, item_id, k, diagonal, run) - i + k AS n
  FROM heads
),
from_here AS (
  SELECT * FROM from_runs
  QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY n DESC, CAST(item_id AS VARCHAR), j) = 1
),
maximal AS (
  SELECT * FROM from_here QUALIFY i + n > coalesce(max(i + n) OVER
    (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
),
spans AS (
  SELECT doc_id, string_agg(concat_ws(':', i - 1, n, item_id, j - 1), ',' ORDER BY i) AS spans FROM maximal GROUP BY doc_id
),
longest AS (
  SELECT doc_id, max(n) AS longest_match
  FROM (SELECT doc_id, count(*) - 1 + k AS n FROM heads GROUP BY doc_id, item_id, k, diagonal, run) GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(d.words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items.items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(longest_match, 0) AS BIGINT) AS longest_match, coalesce(spans.spans, '') AS spans
FROM d LEFT JOIN spans USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

CHECKS["op5_suffix_dedup"] = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
),
windows AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS w FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM d WHERE n >= 100)),
later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM windows) WHERE k > 1
),
steps AS (SELECT doc_id, p, p - lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) > 100 AS fresh FROM later),
numbered AS (SELECT doc_id, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM steps),
spans AS (SELECT doc_id, run, min(p) AS low, max(p) + 100 AS high FROM numbered GROUP BY doc_id, run),
cuts AS (
  SELECT doc_id, low, lag(high, 1, 0) OVER (PARTITION BY doc_id ORDER BY low) AS begin, high FROM spans
  UNION ALL
  SELECT d.doc_id, n, coalesce(max(high), 0), n FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id, n
),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * begin + 1, 2 * (low - begin)), '' ORDER BY begin) AS rest
  FROM cuts JOIN d USING (doc_id) GROUP BY doc_id
),
sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT d.doc_id,
       CAST(n AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(rest)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

CHECKS["op12_hard_negatives"] = """
WITH part AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM part a JOIN part r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND label <> anchor_label
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

#: CRC-32 of a text as an unsigned number, bit by bit.
_CRC32 = (
    "xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], "
    "list_transform(range(1, length({0}) + 1), lambda i: CAST(ascii(substr({0}, i, 1)) AS BIGINT))), "
    "lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT) for z in range(8)]), "
    "lambda a, z: xor(a >> 1, CAST(3988292384 AS BIGINT) * (a & 1)))))"
)

CHECKS["op13_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT conv_id, list(x ORDER BY k) AS seq FROM turns GROUP BY conv_id),
heads AS (SELECT conv_id, seq, CAST({_CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS INTEGER) AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.seq[1:c.h], []), c.seq[c.h + 1:]) AS seq
  FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
),
prefixes AS (SELECT conv_id, len(seq) AS n, seq[1:d] AS p, d FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends,
         bool_and(n = d) AS childless,
         CASE WHEN any_value(d) = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(p)[-1].t) END AS saved
  FROM prefixes GROUP BY p
),
under AS (
  SELECT v.p, sum(w.saved) AS saved, count(*) FILTER (w.childless) AS leaves, count(*) FILTER (w.d = v.d + 1) AS children
  FROM nodes v JOIN nodes w ON w.d >= v.d AND w.p[1:v.d] = v.p GROUP BY v.p
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs,
       CAST(children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(under.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN under ON under.p = v.p LEFT JOIN nodes u ON u.d = v.d - 1 AND u.p = v.p[1:v.d - 1]
"""
