"""DuckDB statements for the queries that SQL can express on whole tables."""

from __future__ import annotations

# shared by the mix and the sharding; CRC-32 has no DuckDB function, so the
# sharding is tested against zlib instead of SQL (tests/llm)
MIX = """
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(concat('mix:', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS BIGINT) AS weight
  FROM sizes),
levels AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM sizes) - coalesce(sum(3 * source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE)) AS level
  FROM weighed
  WINDOW up AS (ORDER BY CAST(3 * source_size AS DOUBLE) / CAST(weight AS DOUBLE), source IS NULL, source)),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), (SELECT max(level) FROM levels) * weight) AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CAST(floor(CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END) AS BIGINT) AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN 2 * before + size <= 2 * (target - epochs * source_size)
                                   AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

# each rule: pieces between matches and the matches alternate; running lengths
# give the spans
_RULE = """
pieces_{kind} AS (
  SELECT doc_id, unnest(list_zip(string_split_regex(t, {re}), regexp_extract_all(t, {re}))) AS p,
         generate_subscripts(string_split_regex(t, {re}), 1) AS i
  FROM docs WHERE regexp_matches(t, {re})),
spans_{kind} AS (
  SELECT doc_id, p[2] AS hit,
         sum(length(p[1]) + coalesce(length(p[2]), 0)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
  FROM pieces_{kind}),
found_{kind} AS (
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, CAST(stop - length(hit) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
  FROM spans_{kind} WHERE hit IS NOT NULL AND length({counted}) >= {least})"""

_ASSIGN = (r"""'([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'""")

SECRETS = ("WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)," + ",".join([
    _RULE.format(kind="assign", re=_ASSIGN, rank=0, counted=f"regexp_extract(hit, {_ASSIGN}, 2)", least=12),
    _RULE.format(kind="access", re="'AKIA[A-Z0-9]+'", rank=1, counted="hit", least=18),
    _RULE.format(kind="hex", re="'[0-9a-f]+'", rank=2, counted="hit", least=16)]) + """,
found AS (SELECT * FROM found_assign UNION ALL SELECT * FROM found_access UNION ALL SELECT * FROM found_hex),
per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
         count(*) FILTER (kind = 'hex') AS h,
         string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(k, 0) AS BIGINT) AS n_access,
       CAST(coalesce(h, 0) AS BIGINT) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM docs d LEFT JOIN per_doc USING (doc_id)""")

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS last
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM d
"""

DECONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
ip AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM iw WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS k FROM ip),
dp AS (SELECT doc_id, w, s.n, unnest(range(0, len(w) - s.n + 1)) AS i
       FROM dw, (SELECT DISTINCT n FROM windows) s WHERE len(w) >= s.n),
hits AS (
  SELECT d.doc_id, d.i, d.n, x.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS k FROM dp) d JOIN windows x ON x.n = d.n AND x.k = d.k),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

# k-means in whole numbers: one CTE for each distance, choice and mean
def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    steps = [f"""
WITH flat AS (
  SELECT vec_id, label, len(embedding) // {parts} AS width, CAST(unnest(embedding) AS DOUBLE) AS y,
         generate_subscripts(embedding, 1) - 1 AS pos
  FROM embeddings),
whole AS (
  SELECT vec_id FROM flat GROUP BY vec_id
  HAVING count(*) = count(y) AND count(*) FILTER (isnan(y) OR isinf(y)) = 0),
cells AS MATERIALIZED (
  SELECT vec_id, label, pos // width AS part, pos % width AS place, CAST(floor({scale} * y) AS BIGINT) AS x
  FROM flat WHERE vec_id IN (SELECT vec_id FROM whole)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT {entries}),
book0 AS MATERIALIZED (SELECT part, entry, place, x AS c FROM cells JOIN seeds USING (vec_id))"""]
    for i in range(rounds + 1):
        steps.append(f"""
far{i} AS (
  SELECT vec_id, part, entry, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
  FROM cells JOIN book{i} USING (part, place) GROUP BY vec_id, part, entry),
near{i} AS MATERIALIZED (
  SELECT vec_id, part, min(d * {entries} + entry) % {entries} AS entry, min(d) AS d FROM far{i} GROUP BY vec_id, part)""")
        if i < rounds:
            steps.append(f"""
mean{i} AS (
  SELECT part, entry, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS m
  FROM cells JOIN near{i} USING (vec_id, part) GROUP BY part, entry, place),
book{i + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(m, c) AS c FROM book{i} LEFT JOIN mean{i} USING (part, entry, place))""")
    return ",".join(steps) + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
labelled AS (SELECT DISTINCT vec_id, label FROM cells),
digest AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN labelled USING (vec_id) CROSS JOIN digest
"""


ORACLE: dict[str, str] = {
    "op3_mix": MIX,
    "op4_secret_ledger": SECRETS,
    "op7_warc_salvage": WARC,
    "op8_decontaminate": DECONTAMINATION,
    "op10_exact_dedup": EXACT,
    "op13_vector_codes": _vector_codes(),
}
