"""DuckDB SQL for the queries that SQL can express, written as set operations on
the whole tables (the Spark side never builds these intermediate rows)."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({t}, ''), '[^\x20\x09-\x0D]+')"
MATCH = r"list_filter(string_split(regexp_replace(lower(coalesce({t}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def containment(size: int = 5, percent: int = 80) -> str:
    runs = "list_distinct(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')))"
    return f"""WITH iw AS (SELECT DISTINCT item_id, {MATCH.format(t='text')} AS w FROM benchmark),
it AS (SELECT item_id, n, {runs} AS s FROM (SELECT *, least(len(w), {size}) AS n FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, {MATCH.format(t='text')} AS w FROM documents),
ds AS (SELECT doc_id, n, unnest({runs}) AS g FROM dw, (SELECT DISTINCT n FROM it) WHERE len(w) >= n),
hit AS (SELECT doc_id, item_id, len(any_value(s)) AS n_shingles, count(*) AS n_found
        FROM ds JOIN (SELECT item_id, n, s, unnest(s) AS g FROM it) USING (n, g) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(n_shingles AS INTEGER) AS n_shingles, CAST(n_found AS INTEGER) AS n_found, n_found / n_shingles AS containment
FROM hit WHERE 100 * n_found >= {percent} * n_shingles"""


def repeats(length: int = 20) -> str:
    return f"""WITH d AS (SELECT doc_id, {WORDS.format(t='text')} AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + {length - 1}], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS s FROM d)),
late AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + {length})) AS p FROM late),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def jaccard(size: int = 3, percent: int = 90) -> str:
    return f"""WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(t=LOWER.format(t='text'))} AS w FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM g),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
         AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
         GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM g UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM g JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) ON doc_id = a"""


def mixing(shares: dict[str, int], block_rows: int = 32, seed: str = "mix") -> str:
    share = "CASE source " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in shares.items()) + " ELSE 1 END"
    return f"""WITH RECURSIVE sh AS (SELECT DISTINCT source, {share} AS a FROM documents),
al AS (SELECT list(source ORDER BY source) AS src, list(a ORDER BY source) AS a, CAST(sum(a) AS BIGINT) AS m FROM sh),
edf(t, done, i) AS (
  SELECT CAST(0 AS BIGINT), list_transform(a, lambda x: CAST(0 AS BIGINT)), CAST(0 AS BIGINT) FROM al
  UNION ALL
  SELECT t + 1, list_transform(done, lambda x, j: x + CASE WHEN j = k THEN 1 ELSE 0 END), k FROM (
    SELECT t, done, list_sort(list_filter(list_transform(range(1, len(a) + 1), lambda j: CASE
             WHEN done[j] < a[j] AND done[j] * m // a[j] <= t THEN {{'d': ((done[j] + 1) * m + a[j] - 1) // a[j], 'j': j}} END),
             lambda c: c IS NOT NULL))[1].j AS k FROM edf, al WHERE t < m)),
frame AS (SELECT src[i] AS source, t - 1 AS spot, row_number() OVER (PARTITION BY i ORDER BY t) - 1 AS nth FROM edf, al WHERE i > 0),
s AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('{seed}' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS q FROM documents),
b AS (SELECT s.*, q // {block_rows} AS blk, sh.a, al.m FROM s JOIN sh USING (source), al)
SELECT doc_id, b.source, CAST(blk AS BIGINT) AS mix_block, CAST(q % {block_rows} AS INTEGER) AS mix_pos,
       CAST(blk // a * m + (blk % a) * m // a AS BIGINT) AS mix_release,
       CAST(blk // a * m + ((blk % a + 1) * m + a - 1) // a AS BIGINT) AS mix_deadline, CAST(blk // a * m + spot AS BIGINT) AS mix_slot
FROM b JOIN frame ON b.source = frame.source AND blk % a = nth"""


def turn_links() -> str:
    call = ("'{\"arguments\":{\"text\":' || to_json(text) || '},\"id\":\"' || call_id || '\",\"kind\":\"call\",\"name\":\"reply\",\"role\":\"user\","
            "\"status\":\"' || status || '\"}'")
    other = ("'{\"content\":' || to_json(text) || CASE WHEN kind = 'result' THEN ',\"id\":\"' || call_id || '\"' ELSE '' END || "
             "',\"kind\":\"' || kind || '\",\"role\":' || to_json(role) || ',\"status\":\"' || status || '\"}'")
    return f"""WITH e AS (SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
  CASE role WHEN 'user' THEN conv_id || ':' || turn WHEN 'assistant' THEN conv_id || ':' || (turn - 1) END AS call_id FROM conversations),
p AS (SELECT conv_id, call_id, min(turn) FILTER (WHERE kind = 'call') AS c, min(turn) FILTER (WHERE kind = 'result') AS r
      FROM e WHERE call_id IS NOT NULL GROUP BY ALL),
x AS (SELECT e.*, CASE WHEN kind = 'call' THEN r ELSE c END AS partner_turn,
  CASE WHEN kind = 'message' THEN 'message' WHEN turn <> (CASE WHEN kind = 'call' THEN c ELSE r END) THEN 'duplicate'
       WHEN c IS NOT NULL AND r IS NOT NULL THEN 'linked' WHEN kind = 'call' THEN 'unanswered' ELSE 'orphan' END AS status
  FROM e LEFT JOIN p USING (conv_id, call_id))
SELECT conv_id, turn, 0 AS sub, kind, call_id, status, partner_turn, turn AS order_turn, 0 AS order_phase,
       CASE WHEN kind = 'call' THEN text <> '' END AS valid, CASE WHEN kind = 'call' AND text = '' THEN '$.text: minLength' END AS errors,
       CASE WHEN kind = 'call' THEN {call} ELSE {other} END AS json FROM x"""


def archives(least_bytes: int = 0) -> str:
    code = ("array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
            "1 + ((CAST('0x' || substr(h, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31), 1)), '')")
    return f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, CASE WHEN n >= {least_bytes} THEN row_number() OVER (PARTITION BY h, n ORDER BY page_id) ELSE 1 END AS k,
        first(page_id) OVER (PARTITION BY h, n ORDER BY page_id) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {code} AS payload_digest, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN f END AS refers_to FROM r"""


def divergence(min_docs: int = 10, top: int = 10) -> str:
    p = "(1 + CAST(1000000000 AS HUGEINT) * ({c} + 2) // ({n} + 2 * v))"
    return rf"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  unnest(regexp_extract_all({LOWER.format(t="coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
kept AS (SELECT lang, term, count(*) AS ln FROM d GROUP BY lang, term HAVING count(DISTINCT i) >= {min_docs}),
c AS (SELECT lang, source, term, count(*) AS c FROM d SEMI JOIN kept USING (lang, term) GROUP BY ALL),
lv AS (SELECT lang, count(*) AS v, sum(ln) AS ln FROM kept GROUP BY lang),
g AS (SELECT g.*, coalesce(n, 0) AS n, coalesce(v, 0) AS v, l.ln FROM (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents) g
      LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN lv l USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, {p.format(c='coalesce(c.c, 0)', n='g.n')} AS p, {p.format(c='k.ln', n='g.ln')} AS q
      FROM g JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM k WHERE part = 'pair' OR rank <= {top}"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    near = ("SELECT * FROM (SELECT p.vec_id, p.part, p.x, c.entry, list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - e[j]) * (x[j] - e[j]))) AS d "
            "FROM p JOIN c{r} c USING (part)) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1")
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(r=r)})")
        steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM (
    SELECT part, entry, j, sum(v) AS s, count(*) AS n FROM (SELECT part, entry, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS j FROM a{r}) GROUP BY ALL)
  GROUP BY part, entry) m USING (part, entry))""")
    return f"""WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor({scale} * CAST(y AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, x[part * (len(x) // {parts}) + 1:(part + 1) * (len(x) // {parts})] AS x FROM k, (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, entry, x AS e FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k) USING (vec_id) WHERE entry < {entries}),
{','.join(steps)},
f AS MATERIALIZED ({near.format(r=rounds)}),
v AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM f GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256 FROM v JOIN k USING (vec_id)"""
