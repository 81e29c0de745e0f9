"""DuckDB SQL for the queries that SQL expresses."""

from __future__ import annotations

from reelgauge.llm import quality

OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id, sha1(h) AS hex FROM p GROUP BY h),
d AS (
  SELECT h, first_id, array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
      (cast('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)
    FOR i IN range(32)], '') AS digest FROM f
)
SELECT page_id, cast(strlen(h) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN d USING (h)"""

OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, label, cast(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT vec_id, cast((SELECT count(*) FROM l WHERE a = vec_id) AS BIGINT) AS n_links,
  least(vec_id, coalesce((SELECT min(b) FROM r WHERE a = vec_id), vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce((SELECT min(b) FROM r WHERE a = vec_id), vec_id)) AS kept
FROM v"""


# The 256 steps of a CRC-32 byte; a crc is folded over the bytes of a text with them.
_CRC = """[list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)]"""

OP11 = f"""
WITH crc AS (SELECT {_CRC} AS t),
c AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
h AS (
  SELECT c.*, xor(list_reduce(list_concat([4294967295], [ascii(x) FOR x IN string_split(cast(conv_id AS VARCHAR), '')]),
      lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 4 AS h
  FROM c, crc
),
r AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 20
),
p AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
m AS (SELECT conv_id, n, depth, list_slice(turns, 1, depth) AS node FROM p),
v AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0
      ELSE len(regexp_extract_all(node[depth]['text'], '[^ \\t-\\r]+')) END AS saved
  FROM m GROUP BY depth, node
),
k AS (SELECT depth - 1 AS depth, list_slice(node, 1, depth - 1) AS node, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL),
f AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN k USING (depth, node)),
u AS (SELECT unnest(range(depth + 1)) AS up, node, saved, n_children FROM f),
s AS (
  SELECT up AS depth, list_slice(node, 1, up) AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM u GROUP BY ALL
)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
  cast(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (depth, node) LEFT JOIN v q ON q.depth = f.depth - 1 AND q.node = list_slice(f.node, 1, f.depth - 1)"""

OP12 = f"""
WITH RECURSIVE crc AS (SELECT {_CRC} AS t),
r AS (
  SELECT coalesce(cast(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{5,}}')) AS run
  FROM documents
),
g AS (SELECT id, run, count(*) AS k, hex(id || ':' || run) AS x FROM r GROUP BY id, run),
h AS (
  SELECT run, k, xor(list_reduce(
      list_concat([4294967295], [cast('0x' || substr(x, 2 * i + 1, 2) AS BIGINT) FOR i IN range(length(x) // 2)]),
      lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS h
  FROM g, crc
),
w AS (
  SELECT word, cast(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM h)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
),
d AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
),
f AS (
  SELECT w.word, n, n_near, CASE WHEN m >= 2 * n THEN best END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM w LEFT JOIN (
    SELECT word, count(*) AS n_near, max(near_n) AS m, first(near ORDER BY near_n DESC, near) AS best FROM p GROUP BY word
  ) USING (word)
),
up AS (
  SELECT word, word AS root FROM f
  UNION ALL SELECT up.word, f.form FROM up JOIN f ON f.word = up.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, up.root, f.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM f JOIN up ON up.word = f.word JOIN f z ON z.word = up.root AND z.form IS NULL"""


def _op5() -> str:
    grid = ", ".join(
        f"('{rule}', {place}, {cutoff})"
        for rule, (_, cutoffs) in quality.RULES.items()
        for place, cutoff in enumerate(cutoffs)
    )
    measures = " UNION ALL ".join(
        f"SELECT doc_id, stratum, base_failed, '{rule}' AS rule, CASE WHEN "
        f"{'n_lines' if rule == 'repeated_lines' else 'n_words'} > 0 THEN {measure} END AS x FROM m"
        for rule, (measure, _) in quality.RULES.items()
    )
    tests = sum(len(cutoffs) for _, cutoffs in quality.RULES.values())
    risk = quality.RISK / len(quality.RULES)
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(lang, chr(0)) AS stratum, coalesce(text, '') AS text,
    [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+') IF x <> ''] AS words,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^ \\t-\\r]')] AS lines
  FROM documents
),
runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM t)
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM runs, (VALUES (0), (1), (2)) AS s(k) WHERE n > 1 GROUP BY doc_id
),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM (
    SELECT doc_id, stratum, cast(len(words) AS BIGINT) AS n_words,
      cast(length(regexp_replace(text, '[ \\t-\\r]+', '', 'g')) AS BIGINT) AS word_chars,
      cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
      cast(len(lines) AS BIGINT) AS n_lines,
      cast(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      cast(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM t LEFT JOIN covered USING (doc_id))
),
x AS ({measures}),
g AS (SELECT * FROM (VALUES {grid}) AS v(rule, place, cutoff)),
tested AS (
  SELECT stratum, rule, place, cutoff,
    count(*) FILTER (quality = 1) AS good, count(*) FILTER (quality <> 1) AS bad,
    count(*) FILTER (quality = 1 AND x > cutoff) AS good_out, count(*) FILTER (quality <> 1 AND x > cutoff) AS bad_out
  FROM x JOIN labels USING (doc_id) JOIN g USING (rule)
  WHERE NOT base_failed AND quality IS NOT NULL GROUP BY ALL
),
judged AS (
  SELECT *, bad_out / greatest(bad, 1) - {quality.PENALTY} * good_out / greatest(good, 1) AS worth,
    CASE WHEN good_out < good * {risk} THEN list_sum([
      exp(lgamma(good + 1) - lgamma(j + 1) - lgamma(good - j + 1) + j * ln({risk}) + (good - j) * ln(1 - {risk}))
      FOR j IN range(good_out + 1)]) ELSE 1 END AS doubt
  FROM tested
),
chosen AS (
  SELECT stratum, rule, cutoff FROM judged
  WHERE worth > 0 AND doubt <= {quality.DOUBT} / ({tests} * (SELECT count(DISTINCT stratum) FROM tested))
  QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY worth DESC, place DESC) = 1
),
rejected AS (SELECT DISTINCT doc_id FROM x JOIN chosen USING (stratum, rule) WHERE x > cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM m"""


ORACLE = {
    "op5_quality_rules": _op5(),
    "op7_warc": OP7,
    "op9_embedding_near_dedup": OP9,
    "op11_prefix_trie": OP11,
    "op12_spelling_variants": OP12,
}
