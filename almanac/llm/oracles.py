"""DuckDB SQL of the queries that SQL expresses."""

from __future__ import annotations

URL_REPUTATION = r"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
outcomes AS (
  SELECT host, count(*) AS n, sum(quality) AS good
  FROM parsed JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL GROUP BY host),
hosts AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         string_split(host, '.')[-1] AS suffix,
         coalesce(n, 0) AS n, coalesce(good, 0) AS good
  FROM (SELECT DISTINCT host FROM parsed) LEFT JOIN outcomes USING (host)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY suffix),
strengths AS (
  SELECT level, coalesce(CASE WHEN spread - chance > 0 THEN least(1000.0, greatest(2.0,
             mean * (1 - mean) / (spread - chance) - 1)) ELSE 1000.0 END, 1000.0) AS m,
         coalesce(mean, 0.5) AS mean
  FROM (
    SELECT level, sum(good)::DOUBLE / sum(n) AS mean,
           sum(good::DOUBLE * good / n) / sum(n) - (sum(good)::DOUBLE / sum(n)) ^ 2 AS spread,
           (sum(good)::DOUBLE / sum(n)) * (1 - sum(good)::DOUBLE / sum(n)) * (count(*) - 1)
             / sum(n) AS chance
    FROM (SELECT 1 AS level, n, good FROM suffixes UNION ALL
          SELECT 2, n, good FROM domains UNION ALL SELECT 3, n, good FROM hosts)
    WHERE n > 0 GROUP BY level)),
m AS (SELECT coalesce(max(m) FILTER (level = 1), 1000.0) AS m1,
             coalesce(max(m) FILTER (level = 2), 1000.0) AS m2,
             coalesce(max(m) FILTER (level = 3), 1000.0) AS m3,
             coalesce(max(mean) FILTER (level = 1), 0.5) AS overall FROM strengths),
shrunk AS (
  SELECT host, m3 + h.n + 1 AS size,
         (m3 * (m2 * ((m1 * overall + s.good) / (m1 + s.n)) + d.good) / (m2 + d.n) + h.good)
           / (m3 + h.n) AS mean
  FROM hosts h JOIN domains d USING (domain) JOIN suffixes s ON s.suffix = h.suffix, m),
judged AS (
  SELECT page_id, host, path, mean - 1.645 * sqrt(mean * (1 - mean) / size) AS bound,
         CASE WHEN starts_with(path, '/de/') AND ('.' || host) LIKE '%.example.com'
                THEN 'example.com/de/'
              WHEN starts_with(path, '/en/') AND ('.' || host) LIKE '%.example.net'
                THEN 'example.net/en/'
              WHEN starts_with(path, '/fr/') AND ('.' || host) LIKE '%.org' THEN 'org/fr/'
              WHEN starts_with(path, '/') AND ('.' || host) LIKE '%.net' THEN 'net/' END AS rule
  FROM parsed JOIN shrunk USING (host))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
            WHEN rule IS NOT NULL OR bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict,
       round(bound, 9) AS posterior_bound
FROM judged
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER () - (sum(2 * source_size) OVER before
               - 2 * source_size)::DOUBLE) / (sum(weight) OVER after)::DOUBLE AS level
  FROM sources
  WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                    ROWS UNBOUNDED PRECEDING),
         after AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
targets AS (
  SELECT source, source_size,
         least(2.0 * source_size, max(level) OVER () * weight)::DOUBLE AS target
  FROM levels),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
  FROM targets),
groups AS (
  SELECT source, place, doc_id, size, count(*) AS copies, count(*) * size AS words
  FROM sized GROUP BY source, place, doc_id, size),
filled AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place, doc_id, size
                             ROWS UNBOUNDED PRECEDING) - words AS before
  FROM groups)
SELECT s.doc_id, s.size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (whole * s.size + floor(greatest(0, least(words,
          floor(target - whole * source_size) - before)) / copies))::BIGINT AS taken
FROM sized s
JOIN plans p ON s.source IS NOT DISTINCT FROM p.source
JOIN filled f ON s.source IS NOT DISTINCT FROM f.source AND s.place = f.place
  AND s.doc_id IS NOT DISTINCT FROM f.doc_id AND s.size = f.size
"""

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
queries AS (SELECT DISTINCT vec_id AS query_id, v AS q FROM vectors WHERE vec_id % 50 = 0),
scored AS (
  SELECT query_id, vec_id, list_inner_product(q, v)::BIGINT AS score
  FROM queries JOIN vectors ON vec_id <> query_id AND len(q) = len(v)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

WORD_RUNS = r"""
WITH hashed AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text,
         xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(
             string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda crc, byte: list_reduce(
             list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
             lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
           4294967295)::BIGINT AS h
  FROM documents),
split AS (
  SELECT doc_id, row, h, h // 10 AS g,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM hashed),
drawn AS (SELECT *, len(words) AS n, g % nullif(len(words), 0) AS a FROM split),
periods AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM drawn),
texts AS (
  SELECT doc_id, row, n,
         CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(
           range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
         ELSE words END AS words
  FROM periods),
placed AS (
  SELECT row, n, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS word FROM texts),
equal AS (
  SELECT x.row, x.i, y.i - x.i AS q,
         x.i - row_number() OVER (PARTITION BY x.row, y.i - x.i ORDER BY x.i) AS island
  FROM placed x JOIN placed y
    ON x.row = y.row AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretches AS (
  SELECT row, min(i) AS start, count(*) + q AS length, q
  FROM equal GROUP BY row, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT row, start, length, min(q) AS period FROM stretches GROUP BY ALL),
per_text AS (
  SELECT row, count(*) AS n_runs,
         max(struct_pack(length := length, back := -start, least := -period)) AS longest,
         string_agg(start || ',' || length || ',' || period || chr(10), ''
                    ORDER BY start, period) AS lines
  FROM runs GROUP BY row),
dropped AS (
  SELECT row, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM placed ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-longest.back)::BIGINT AS start,
       longest.length::BIGINT AS length, (-longest.least)::BIGINT AS period,
       (1000 * longest.length // -longest.least)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN per_text USING (row) LEFT JOIN kept USING (row)
"""

DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row, lang, source,
         unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
vocabulary AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
langs AS (SELECT lang, count(*) AS terms, sum(n) AS n FROM vocabulary GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN vocabulary USING (lang, term)
  GROUP BY ALL),
groups AS (
  SELECT lang, source, coalesce(sum(counts.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source)
  GROUP BY ALL),
priced AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + l.terms)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (v.n + 1) // (l.n + l.terms)::HUGEINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN vocabulary v USING (lang)
  LEFT JOIN counts c USING (lang, source, term)),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
valued AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN sums s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM priced
  WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
                               ORDER BY value DESC, item COLLATE "binary")::INT AS rank
  FROM valued)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES = {
    "op5_url_reputation": URL_REPUTATION,
    "op8_top_k": TOP_K,
    "op9_source_mix": MIX,
    "op11_word_runs": WORD_RUNS,
    "op12_source_divergence": DIVERGENCE,
}
