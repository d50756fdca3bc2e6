"""The results of the operators' queries in plain DuckDB SQL, each by the direct way."""

from __future__ import annotations

from slotledger.llm import clustering, mixing, search

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

HOST_RULES = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3),
windows AS (SELECT doc_id, i, w[i:i + 2] AS g FROM places),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
    [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 10 * word_chars, n_dup_lines > 3] AS rules FROM m),
h AS (
  SELECT source, rule, count(*) AS n, sum(failed::INT) AS bad, avg(failed::INT) AS r
  FROM (SELECT source, unnest(rules) AS failed, generate_subscripts(rules, 1) AS rule FROM f) GROUP BY source, rule),
prior AS (SELECT rule, avg(r) AS mean, var_pop(r) AS var FROM h GROUP BY rule),
k AS (
  SELECT source, n, bad, mean, CASE WHEN var > 0 THEN greatest(mean * (1 - mean) / var - 1, 0.001) ELSE 1e6 END AS weight FROM h JOIN prior USING (rule)),
p AS (SELECT source, mean, n + weight AS total, (bad + mean * weight) / (n + weight) AS rate FROM k),
bad AS (
  SELECT source, bool_or(rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) > least(2 * mean, (1 + mean) / 2)) AS bad FROM p GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
  NOT (short OR repeats) AND NOT bad AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""

POSITIONAL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(pos.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)
"""

REPEATS = rf"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS n FROM s) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM again),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS line FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN '={name}' THEN {w}" for name, w in mixing.WEIGHTS.get(level, {}).items())
    return f"CAST(CASE {level} {cases} ELSE 1 END AS HUGEINT)"


def _hand_down(rows: str, parents: str, by: str) -> str:
    """Shares of `above` among `rows` (cap, w, above)."""
    order = f"(PARTITION BY {parents} ORDER BY CASE WHEN w > 0 THEN CAST(cap AS DOUBLE) / w ELSE 'inf' END, {by} ROWS BETWEEN"
    return f"""
  SELECT * EXCLUDE (filled, above), CAST(CASE WHEN filled THEN cap
      WHEN coalesce(sum(CASE WHEN NOT filled THEN w END) OVER (PARTITION BY {parents}), 0) > 0
      THEN (w * (above - coalesce(sum(CASE WHEN filled THEN cap END) OVER (PARTITION BY {parents}), 0))) // sum(CASE WHEN NOT filled THEN w END) OVER (PARTITION BY {parents})
      ELSE 0 END AS HUGEINT) AS got
  FROM (SELECT *, w > 0 AND cap * sum(w) OVER {order} CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= w * (above - (sum(cap) OVER {order} UNBOUNDED PRECEDING AND CURRENT ROW) - cap)) AS filled FROM ({rows}))"""


_E = mixing.MAX_EPOCHS
MIXING = rf"""
WITH u AS (
  SELECT doc_id, CASE WHEN digits = '' THEN '=other' ELSE '=d' || CAST(CAST(digits AS BIGINT) % 4 AS VARCHAR) END AS domain,
    coalesce('=' || lang, '') AS lang, coalesce('=' || source, '') AS source, CAST(len({WORDS.format("coalesce(text, '')")}) AS HUGEINT) AS n
  FROM (SELECT *, regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1) AS digits FROM documents)),
leaf AS (SELECT domain, lang, source, sum(n) AS tokens, count(*) AS docs, sum(n) * {_E} AS cap FROM u GROUP BY ALL),
top AS ({_hand_down(f"SELECT domain, sum(cap) AS cap, {_weight('domain')} AS w, 0 AS root, (SELECT least(sum(tokens) * {mixing.BUDGET_PERCENT} // 100, sum(cap)) FROM leaf) AS above FROM leaf GROUP BY domain", "root", "domain")}),
mid AS ({_hand_down(f"SELECT * FROM (SELECT domain, lang, sum(cap) AS cap, {_weight('lang')} AS w FROM leaf GROUP BY domain, lang) JOIN (SELECT domain, got AS above FROM top) USING (domain)", "domain", "lang")}),
low AS ({_hand_down(f"SELECT leaf.*, {_weight('source')} AS w, above FROM leaf JOIN (SELECT domain, lang, got AS above FROM mid) USING (domain, lang)", "domain, lang", "source")}),
budget AS (
  SELECT *, CASE WHEN whole < {_E} THEN got - whole * tokens ELSE -1 END AS rest
  FROM (SELECT *, CASE WHEN tokens > 0 THEN least(got // tokens, {_E}) ELSE 0 END AS whole FROM low)),
run AS (
  SELECT u.*, whole, rest, sum(n) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('{mixing.SEED}:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)) ROWS UNBOUNDED PRECEDING) AS upto
  FROM u JOIN budget USING (domain, lang, source))
SELECT doc_id, nullif(domain[2:], '') AS domain, nullif(lang[2:], '') AS lang, nullif(source[2:], '') AS source, CAST(n AS BIGINT) AS n_tokens,
  CAST(unnest(generate_series(0, CAST(whole AS BIGINT) + (upto <= rest)::INT - 1)) AS INT) AS epoch
FROM run
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest AND n >= 1000
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWERED)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * pairs.n >= 90 * (x.n + y.n - pairs.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(any_value(size.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN size USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""


def _centroids() -> str:
    """Rounds written out one after another: assignment by all squared distances, then floored means."""
    rounds = []
    for r in range(clustering.ROUNDS + 1):
        rounds.append(f"""
n{r} AS MATERIALIZED (
  SELECT rid, least[1] AS d, least[2] AS k FROM (
    SELECT rid, min([d, k]) AS least FROM (
      SELECT v.rid, c{r}.k, CAST(sum((v.x - c{r}.x) * (v.x - c{r}.x)) AS BIGINT) AS d FROM v JOIN c{r} ON v.j = c{r}.j GROUP BY v.rid, c{r}.k)
    GROUP BY rid)),
s{r} AS (SELECT n{r}.k, v.j, sum(v.x) AS s, count(*) AS n FROM v JOIN n{r} USING (rid) GROUP BY n{r}.k, v.j),
c{r + 1} AS MATERIALIZED (
  SELECT c{r}.k, c{r}.j, CAST(CASE WHEN n IS NULL THEN c{r}.x ELSE (s - ((s % n) + n) % n) // n END AS BIGINT) AS x
  FROM c{r} LEFT JOIN s{r} ON c{r}.k = s{r}.k AND c{r}.j = s{r}.j)""")
    last = clustering.ROUNDS
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {clustering.COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {clustering.COMPONENTS}),
v AS MATERIALIZED (
  SELECT rid, j, CAST(floor({clustering.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT rid, unnest(embedding) AS x, unnest(generate_series(1, {clustering.COMPONENTS})) AS j FROM e)),
f AS (SELECT rid, row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || CAST(vec_id AS VARCHAR)), rid) - 1 AS k FROM e),
c0 AS MATERIALIZED (SELECT k, j, x FROM f JOIN v USING (rid) WHERE k < {clustering.CENTROIDS}),
{",".join(rounds)},
t AS (SELECT k, CAST(sum(d) AS BIGINT) AS cluster_inertia, CAST(sum(sum(d)) OVER () AS BIGINT) AS inertia FROM n{last} GROUP BY k),
h AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INT) AS cluster, d AS distance, cluster_inertia, inertia, centroid_sha256
FROM n{last} JOIN e USING (rid) JOIN t USING (k) JOIN h USING (k)
"""


SEARCH = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
z AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
q AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, z GROUP BY term, docs),
m AS (SELECT rid, doc_id, 100 - 75 + (75 * CAST(len(w) AS BIGINT) * docs) // length AS m FROM d, z),
s AS (
  SELECT item_id, rid, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {search.TOP}
"""

ORACLES: dict[str, str] = {
    "op4_host_rules": HOST_RULES,
    "op5_positional_index": POSITIONAL,
    "op6_recompression": REPEATS,
    "op7_hierarchical_mixing": MIXING,
    "op9_warc_chain": WARC,
    "op10_partition_jaccard": JACCARD,
    "op11_incremental_centroids": _centroids(),
    "op13_geometric_blocks": SEARCH,
}
