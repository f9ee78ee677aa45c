"""DuckDB statements for the text operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality_rules import BASE_RULES, RULES, STOP_WORDS

_FAILED = ", ".join(f"CASE WHEN {r.sql()} THEN '{r.name}' END" for r in (*BASE_RULES, *RULES))
_BASE = " OR ".join(f"({r.sql()})" for r in BASE_RULES)
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
again AS (SELECT doc_id, win FROM wins GROUP BY doc_id, win HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM wins JOIN again USING (doc_id, win), range(8) AS r(k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaims,
    CAST(len(list_filter(words, lambda w: lower(w) IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
    CAST(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS BIGINT) AS n_doubled_words,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id))
SELECT *, concat_ws(',', {_FAILED}) AS failed_rules, ({_BASE}) AS base_failed, concat_ws(',', {_FAILED}) = '' AS kept
FROM m
"""

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = rf"regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_BENCH_WORDS} AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, w, array_to_string(words[i:i + w - 1], ' ') AS win
  FROM (SELECT item_id, words, least(10, len(words)) AS w,
      unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
dw AS (
  SELECT doc_id, w, i, array_to_string(words[i:i + w - 1], ' ') AS win
  FROM (SELECT doc_id, words, w, unnest(range(1, len(words) - w + 2)) AS i
    FROM d, (SELECT DISTINCT w FROM bw) WHERE len(words) >= w)),
hits AS (SELECT doc_id, item_id, i, w FROM dw JOIN bw USING (w, win)),
marked AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT doc_id, i, unnest(range(w)) AS k FROM (SELECT DISTINCT doc_id, i, w FROM hits)) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)),
reached AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON links.x = reached.other)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""

_CRC_TABLE = """
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM (SELECT unnest(range(256)) AS i)"""
_CRC = """xor(4294967295::BIGINT, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(length(hex(w)) // 2), lambda j: ('0x' || substr(hex(w), 2 * j + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])))"""
_FLOOR_MEAN = "CAST(({s} - (({s} % {n} + {n}) % {n})) // {n} AS BIGINT)"

RESAMPLING = rf"""
WITH crc_table AS MATERIALIZED ({_CRC_TABLE}),
d AS (SELECT doc_id, {_BENCH_WORDS} AS words FROM documents),
dw AS (SELECT doc_id, unnest(words) AS w FROM d),
bw AS (SELECT unnest({_BENCH_WORDS}) AS w FROM benchmark),
hashed AS MATERIALIZED (
  SELECT w, {_CRC} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc_table),
corpus AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
whole AS (SELECT (SELECT count(*) FROM dw) AS s_all, (SELECT count(*) FROM bw) AS t_all),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE)
      / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM corpus FULL JOIN target USING (bucket), whole),
sums AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS n, CAST(sum(gain) AS BIGINT) AS total
  FROM dw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words) AS n_words, CAST(len(words) AS BIGINT) AS n_features,
    coalesce({_FLOOR_MEAN.format(s="total", n="n")}, 0) AS weight,
    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums USING (doc_id)),
final AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM final WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM final LEFT JOIN ranked USING (doc_id)
"""


def _clustering(k: int = 8, dims: int = 64, rounds: int = 10) -> str:
    """The rounds written out one after the other."""
    far = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (p[i] - c[i]) * (p[i] - c[i])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
  SELECT v.rid, v.vec_id, v.p, arg_min(number, (far, number)) AS cluster, min(far) AS distance
  FROM (SELECT v.*, c.number, {far} AS far FROM v, c{r} c) v GROUP BY v.rid, v.vec_id, v.p)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT number, coalesce(moved, c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster AS number, list(m ORDER BY i) AS moved FROM (
      SELECT cluster, i, {_FLOOR_MEAN.format(s="sum(p[i])", n="count(*)")} AS m
      FROM near{r}, range(1, {dims + 1}) AS dim(i) GROUP BY cluster, i) GROUP BY cluster) USING (number))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS p
  FROM embeddings WHERE len(embedding) = {dims}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, p) - 1 AS number, p AS c
  FROM (SELECT p, sha256('3:' || vec_id) AS h FROM v ORDER BY h, p LIMIT {k})),
{", ".join(steps)}
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN c{rounds} ON cluster = number
"""


CLUSTERING = _clustering()
