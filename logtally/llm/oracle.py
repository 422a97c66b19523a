"""DuckDB SQL for the queries that SQL can express. The others (hash rings, tokenizers,
edit neighbourhoods, 64-bit SimHash components) are tested against brute force."""

from __future__ import annotations

from logtally.llm import mixing, quality

WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

_SLACK = "\n".join(f" WHEN '{m}' THEN {s}" for m, s in quality.SLACK.items())

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
pos AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, w FROM d WHERE len(w) >= 5),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS k FROM pos),
twice AS (SELECT r, unnest(list(i)) AS i FROM win GROUP BY r, k HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) x(k) GROUP BY r),
line AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
lines AS (SELECT r, count(*) AS n, count(DISTINCT x) AS u FROM line
          WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
 SELECT d.r, doc_id, lang, source, len(w) AS n_words,
  coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(lines.n, 0) AS n_lines, coalesce(lines.n - lines.u, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
 FROM d LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
v AS (
 SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols,
  CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines,
  CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeats,
  CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length
 FROM m),
long AS (
 SELECT r, lang, source, base_failed, x.measure, x.value FROM (
  SELECT r, lang, source, base_failed,
   unnest([{", ".join(f"{{'measure': '{m}', 'value': {m}}}" for m in quality.MEASURES)}]) AS x FROM v)),
ends AS (
 SELECT lang, source, measure, CASE WHEN value < 32 THEN value
  ELSE (((value >> (length(bin(value)) - 5)) + 1) << (length(bin(value)) - 5)) - 1 END AS e
 FROM long WHERE NOT base_failed),
leveled AS (
 SELECT 2 AS level, lang, source, measure, e FROM ends
 UNION ALL SELECT 1, lang, NULL, measure, e FROM ends
 UNION ALL SELECT 0, NULL, NULL, measure, e FROM ends),
ranked AS (
 SELECT *, row_number() OVER (PARTITION BY level, lang, source, measure ORDER BY e) AS k,
  count(*) OVER (PARTITION BY level, lang, source, measure) AS n FROM leveled),
quart AS (
 SELECT level, lang, source, measure, any_value(n) AS n, min(e) FILTER (WHERE 4 * k >= n) AS q1,
  min(e) FILTER (WHERE 4 * k >= 3 * n) AS q3 FROM ranked GROUP BY level, lang, source, measure),
fence AS (
 SELECT level, lang, source, measure, n, q3 + reach AS hi,
  CASE WHEN measure IN ({", ".join(f"'{m}'" for m in quality.TWO_SIDED)}) THEN q1 - reach ELSE -1 END AS lo
 FROM (SELECT *, 3 * (q3 - q1) + CASE measure{_SLACK} END AS reach FROM quart)),
judged AS (
 SELECT long.r, bool_and(
   long.value BETWEEN coalesce(CASE WHEN a.n >= {quality.MIN_DOCS} THEN a.lo END, CASE WHEN b.n >= {quality.MIN_DOCS} THEN b.lo END, c.lo)
    AND coalesce(CASE WHEN a.n >= {quality.MIN_DOCS} THEN a.hi END, CASE WHEN b.n >= {quality.MIN_DOCS} THEN b.hi END, c.hi)) AS good
 FROM long
 JOIN fence a ON a.level = 2 AND a.measure = long.measure AND a.lang IS NOT DISTINCT FROM long.lang
  AND a.source IS NOT DISTINCT FROM long.source
 JOIN fence b ON b.level = 1 AND b.measure = long.measure AND b.lang IS NOT DISTINCT FROM long.lang
 JOIN fence c ON c.level = 0 AND c.measure = long.measure
 GROUP BY long.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND coalesce(good, true) AS kept
FROM v LEFT JOIN judged USING (r)
"""

_W = "list_extract([" + ", ".join(map(str, mixing.WEIGHTS)) + "], CAST((k % " + str(len(mixing.WEIGHTS)) + ") + 1 AS INTEGER))"

MIXING = rf"""
WITH d AS (SELECT doc_id, source, len({WORDS}) AS size FROM documents),
h AS (
 SELECT *, CAST(CAST('0x' || substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))), 1, 12)
  AS UBIGINT) AS BIGINT) AS h FROM d),
s AS (
 SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
 FROM d GROUP BY source),
w AS (SELECT *, CAST({_W} AS DOUBLE) AS w, {mixing.MAX_REPEAT} * CAST(source_size AS DOUBLE) AS most FROM s),
p AS (
 SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per_weight
 FROM w WINDOW o AS (ORDER BY most / w, source NULLS LAST)),
t AS (
 SELECT source, source_size, least(most, w * coalesce(max(CASE WHEN per_weight * w <= most THEN per_weight END) OVER (), 0)) AS target FROM p),
b AS (
 SELECT *, least(CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END, {mixing.MAX_REPEAT}) AS whole FROM t),
c AS (SELECT source, h, sum(size) AS n FROM h GROUP BY source, h),
u AS (
 SELECT c.source, h, n, sum(n) OVER (PARTITION BY c.source ORDER BY h) AS upto, target - whole * source_size AS budget
 FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source),
cut AS (
 SELECT source, arg_min(h + CASE WHEN upto - budget < budget - (upto - n) THEN 1 ELSE 0 END, h) AS below
 FROM u WHERE upto > budget GROUP BY source)
SELECT h.doc_id, h.size, b.source_size, b.target, h.size * least(whole + CASE WHEN below IS NULL OR h.h < below THEN 1 ELSE 0 END,
 {mixing.MAX_REPEAT}) AS taken
FROM h JOIN b ON h.source IS NOT DISTINCT FROM b.source LEFT JOIN cut ON h.source IS NOT DISTINCT FROM cut.source
"""

TOP_K = """
WITH v AS (
 SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

CHAT = r"""
WITH t AS (
 SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
 UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (
 SELECT *, length(x) + length(x) - length(replace(replace(x, '\', ''), '<', '')) AS text_chars,
  length(r) + length(r) - length(replace(replace(replace(r, '\', ''), '<', ''), chr(10), '')) AS role_chars FROM t)
SELECT conv_id, count(*) AS n_turns,
 sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
 CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
 CAST(sum(length('<turn>') + role_chars + 1 + text_chars + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

SUBSTRING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
p AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
win AS (SELECT r, doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS k FROM p),
first AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
hit AS (SELECT r, i FROM win JOIN first USING (k) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, i + k AS i FROM hit, range(13) x(k)),
word AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
 SELECT word.r, count(gone.i) AS n_removed, string_agg(x, ' ' ORDER BY word.i) FILTER (WHERE gone.i IS NULL) AS t
 FROM word LEFT JOIN gone ON word.r = gone.r AND word.i = gone.i GROUP BY word.r)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

# CRC-32 of the decimal doc_id, bit by bit, and the fields of a leaf.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
 lambda c: CAST(ord(c) AS BIGINT))), lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
 lambda a, k: xor(a >> 1, 3988292384 * (a & 1)))))"""


def _leaf(n_chars: str) -> str:
    texts = (f"CAST({f} AS VARCHAR)" for f in ("doc_id", "source", "lang", n_chars, "text"))
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({t}) AS VARCHAR) || ':' || {t}, '-')" for t in texts) + ")"


MERKLE = f"""
WITH RECURSIVE d AS (
 SELECT *, CASE WHEN {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE leaf END AS claim,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
 FROM (SELECT *, {_leaf("n_chars")} AS leaf FROM documents)),
tree AS (
 SELECT lang, 0 AS level, i, count(*) OVER (PARTITION BY lang) AS n, leaf AS node FROM d
 UNION ALL
 SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM tree WHERE n > 1
 GROUP BY lang, level, i // 2, n),
sub AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM tree WHERE n = 1),
top AS (
 SELECT 0 AS level, i, (SELECT count(*) FROM sub) AS n, node FROM sub
 UNION ALL
 SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n),
up AS (
 SELECT doc_id, lang, 0 AS level, i, claim AS node, '' AS others FROM d
 UNION ALL
 SELECT up.doc_id, up.lang, up.level + 1, up.i // 2, sha256(CASE WHEN s.node IS NULL THEN up.node WHEN s.i < up.i THEN s.node || up.node
   ELSE up.node || s.node END), up.others || coalesce(s.node, '')
 FROM up JOIN tree o ON o.lang IS NOT DISTINCT FROM up.lang AND o.level = up.level AND o.i = up.i AND o.n > 1
 LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM up.lang AND s.level = up.level AND s.i = xor(up.i, 1)),
in_sub AS (
 SELECT up.doc_id, sub.node AS subroot, sub.i, up.node, up.others FROM up
 JOIN tree o ON o.lang IS NOT DISTINCT FROM up.lang AND o.level = up.level AND o.i = up.i AND o.n = 1
 JOIN sub ON sub.lang IS NOT DISTINCT FROM up.lang),
above AS (
 SELECT doc_id, subroot, 0 AS level, i, node, others FROM in_sub
 UNION ALL
 SELECT a.doc_id, a.subroot, a.level + 1, a.i // 2, sha256(CASE WHEN s.node IS NULL THEN a.node WHEN s.i < a.i THEN s.node || a.node
   ELSE a.node || s.node END), a.others || coalesce(s.node, '')
 FROM above a JOIN top o ON o.level = a.level AND o.i = a.i AND o.n > 1 LEFT JOIN top s ON s.level = a.level AND s.i = xor(a.i, 1))
SELECT d.doc_id, d.leaf, a.subroot, r.node AS root, sha256(a.others) AS proof_sha256, a.node AS folded_root, a.node = r.node AS verified
FROM d JOIN above a ON d.doc_id IS NOT DISTINCT FROM a.doc_id JOIN top r ON r.n = 1 AND r.level = a.level
"""

NEGATIVES = """
WITH v AS (
 SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
 SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
 FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
 SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
w AS (
 SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
 FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5
"""

ORACLE: dict[str, str] = {
    "op3_quality_rules": QUALITY,
    "op4_mixing": MIXING,
    "op6_exact_top_k": TOP_K,
    "op8_chat_formatting": CHAT,
    "op9_substring_dedup": SUBSTRING,
    "op12_merkle_manifest": MERKLE,
    "op13_hard_negatives": NEGATIVES,
}
