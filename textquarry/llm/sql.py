"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, row_number() OVER (ORDER BY source NULLS LAST) AS idx FROM d GROUP BY source),
w AS (SELECT source, size, idx, CAST((idx - 1) % 3 + 1 AS DOUBLE) AS weight, 3.0::DOUBLE * size AS stop FROM s),
o AS (SELECT *, (SELECT sum(size) FROM s)::DOUBLE - coalesce(sum(stop) OVER e, 0) AS left_words, sum(weight) OVER () - coalesce(sum(weight) OVER e, 0) AS left_weight
      FROM w WINDOW e AS (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, stop * left_weight <= weight * left_words AS stopped FROM o),
t AS (SELECT source, size, CASE WHEN stopped THEN stop ELSE weight * ((SELECT sum(size) FROM s)::DOUBLE - (SELECT coalesce(sum(stop), 0) FROM c WHERE stopped)) / (SELECT sum(weight) FROM c WHERE NOT stopped) END AS target FROM c),
p AS (SELECT source, size AS source_size, target, CASE WHEN size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // size ELSE 0 END AS passes, CASE WHEN size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) % size ELSE 0 END AS rest FROM t),
r AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.passes, p.rest,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || CAST(d.size AS VARCHAR)), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(passes * size + least(size, greatest(0, rest - before)) AS BIGINT) AS taken FROM r
"""


def _op9(rounds: int = 100) -> str:
    """Rules, then both walks for so many rounds, after which 0.85 ** rounds of their mass is still on its way."""

    def host(x: str) -> str:
        return f"coalesce(translate(regexp_extract(CASE WHEN instr({x}, '://') > 0 THEN substr({x}, instr({x}, '://') + 3) ELSE '' END, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"

    def path(x: str) -> str:
        return f"coalesce(regexp_extract(CASE WHEN instr({x}, '://') > 0 THEN substr({x}, instr({x}, '://') + 3) ELSE '' END, '^[^/?#]*([^?#]*)', 1), '')"

    def hit(h: str, p: str) -> str:
        return f"(SELECT max_by([rhost || rpath, action], length(rhost || rpath)) FROM rules WHERE ({h} = rhost OR ends_with({h}, '.' || rhost)) AND starts_with({p}, rpath))"

    return rf"""
WITH RECURSIVE p AS MATERIALIZED (SELECT page_id, {host('url')} AS host, {path('url')} AS path, html FROM pages),
rules(action, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
j AS MATERIALIZED (SELECT page_id, host, path, {hit('host', 'path')} AS hit FROM p),
l0 AS (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"''\s<>]+)', 1))) AS link FROM p),
l1 AS (SELECT src, CASE WHEN starts_with(link, '//') THEN ':' || link ELSE link END AS link FROM l0),
l2 AS (SELECT src, {host('link')} AS dst, {path('link')} AS path FROM l1),
l AS MATERIALIZED (SELECT src, dst, {hit('dst', 'path')} AS hit FROM l2 WHERE src <> dst AND src <> '' AND dst <> ''),
h0 AS (SELECT host, TRUE AS own, count(*) AS n, count(*) FILTER (hit[2] = 'allow') - count(*) FILTER (hit[2] = 'block') AS lean FROM j GROUP BY host
  UNION ALL SELECT dst, FALSE, count(*), count(*) FILTER (hit[2] = 'allow') - count(*) FILTER (hit[2] = 'block') FROM l WHERE dst NOT IN (SELECT host FROM j) GROUP BY dst),
h AS MATERIALIZED (SELECT host, own, greatest(lean / n, 0) AS good, greatest(-lean / n, 0) AS bad FROM h0),
k AS (SELECT src, dst, count(*) AS links FROM l GROUP BY ALL),
w AS (SELECT 1 AS kind, src AS f, dst AS t, links FROM k UNION ALL SELECT 2, dst, src, links FROM k),
ways AS MATERIALIZED (SELECT kind, f, t, links / sum(links) OVER (PARTITION BY kind, f) AS part FROM w),
seeds AS MATERIALIZED (SELECT 1 AS kind, host, coalesce(good / nullif((SELECT sum(good) FROM h), 0), 0) AS seed FROM h UNION ALL SELECT 2, host, coalesce(bad / nullif((SELECT sum(bad) FROM h), 0), 0) FROM h),
walk(round, kind, host, mass) AS (SELECT 0, kind, host, CAST(seed AS DOUBLE) FROM seeds WHERE seed > 0
  UNION ALL SELECT walk.round + 1, ways.kind, ways.t, CAST(sum(0.85::DOUBLE * walk.mass * ways.part) AS DOUBLE) FROM walk JOIN ways ON ways.kind = walk.kind AND ways.f = walk.host WHERE walk.round < {rounds} GROUP BY walk.round, ways.kind, ways.t),
s AS MATERIALIZED (SELECT kind, host, sum(mass) / sum(sum(mass)) OVER (PARTITION BY kind) AS score FROM walk GROUP BY kind, host),
v AS (SELECT host, sum(CASE WHEN kind = 2 THEN score ELSE -score END) > 1.0 / (SELECT count(*) FROM h WHERE own) AND host <> '' AS bad FROM s GROUP BY host)
SELECT page_id, j.host, path, hit[1] AS rule, coalesce(hit[2], CASE WHEN v.bad THEN 'block' ELSE 'allow' END) AS verdict FROM j LEFT JOIN v ON v.host = j.host
"""


OP4 = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS MATERIALIZED (SELECT r, unnest(ws) AS w, unnest(list_prepend(NULL, ws[:-2])) AS c FROM d),
w1 AS MATERIALIZED (SELECT w, count(*) AS n FROM t GROUP BY w), w1d AS MATERIALIZED (SELECT r, w, count(*) AS n FROM t GROUP BY r, w),
x1 AS MATERIALIZED (SELECT c, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY c), x1d AS MATERIALIZED (SELECT r, c, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY r, c),
b AS MATERIALIZED (SELECT c, w, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY c, w), bd AS MATERIALIZED (SELECT r, c, w, count(*) AS n FROM t WHERE c IS NOT NULL GROUP BY r, c, w),
k AS (SELECT t.r, t.c, b.n - bd.n AS pairs, x1.n - x1d.n AS contexts, w1.n - w1d.n AS words
  FROM t JOIN w1 ON w1.w = t.w JOIN w1d ON w1d.r = t.r AND w1d.w = t.w LEFT JOIN x1 ON x1.c = t.c LEFT JOIN x1d ON x1d.r = t.r AND x1d.c = t.c
  LEFT JOIN b ON b.c = t.c AND b.w = t.w LEFT JOIN bd ON bd.r = t.r AND bd.c = t.c AND bd.w = t.w),
s AS (SELECT r, coalesce(pairs, 0) = 0 AS alone, CASE WHEN coalesce(pairs, 0) > 0 THEN round(1e6 * (ln(pairs) - ln(contexts)))
  ELSE CASE WHEN words > 0 THEN round(1e6 * ln(words)) ELSE round(1e6 * ln(0.4)) END + CASE WHEN c IS NULL THEN 0 ELSE round(1e6 * ln(0.4)) END END AS v FROM k),
g AS (SELECT r, sum(v) AS v, count(*) FILTER (alone) AS a FROM s GROUP BY r),
f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(a, 0) AS n_backoff, (coalesce(v, 0) - coalesce(a, 0) * round(1e6 * ln(greatest((SELECT sum(len(ws)) FROM d) - len(ws), 1)))) / 1e6 AS log_score FROM d LEFT JOIN g ON g.r = d.r)
SELECT *, CASE WHEN n_words > 0 THEN log_score / n_words END AS mean_log_score FROM f
"""

OP5 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
t AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM t WHERE rank <= 5
"""

OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s FROM pages),
m AS (SELECT s, max(page_id) AS big FROM p GROUP BY s)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (CAST('0x' || substr(p.s, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) % 32 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN big IS NULL OR page_id = big THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN big IS NULL OR page_id = big THEN NULL ELSE big END AS refers_to
FROM p JOIN m ON m.s = p.s
"""

OP7 = """
WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, CASE WHEN embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS q FROM embeddings),
p AS MATERIALIZED (SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.r <> b.r AND a.q IS NOT NULL AND b.q IS NOT NULL WHERE list_cosine_similarity(a.q, b.q) >= 0.9),
n AS (SELECT x, count(*) AS n FROM p GROUP BY x),
c(x, y) AS (SELECT r, r FROM v UNION SELECT c.x, p.y FROM c JOIN p ON p.x = c.y),
m AS (SELECT c.x, min(v.vec_id) AS component_id FROM c JOIN v ON v.r = c.y GROUP BY c.x)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, m.component_id, coalesce(v.vec_id = m.component_id, FALSE) AS kept FROM v JOIN m ON m.x = v.r LEFT JOIN n ON n.x = v.r
"""

OP8 = r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT rid, doc_id, CASE WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3])) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
e AS MATERIALIZED (SELECT rid, len(sh) AS n, unnest(sh) AS g FROM s),
p AS MATERIALIZED (SELECT a.rid AS x, b.rid AS y FROM e a JOIN e b ON a.g = b.g AND a.rid < b.rid GROUP BY a.rid, b.rid HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
l AS MATERIALIZED (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r(x, y) AS (SELECT rid, rid FROM s UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
c AS (SELECT r.x, min(s.doc_id) AS component_id FROM r JOIN s ON s.rid = r.y GROUP BY r.x)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON c.x = s.rid
"""

ORACLES: dict[str, str] = {"op1_source_mix": OP1, "op4_backoff_scores": OP4, "op5_top_products": OP5, "op6_capture_index": OP6, "op7_near_vectors": OP7, "op8_shingle_join": OP8, "op9_url_verdicts": _op9()}
