"""DuckDB SQL for the queries that SQL can express (written out from the
contract, with no constant shared with the code)."""

OP2 = r"""
WITH parts AS (
  SELECT page_id, url, coalesce(strpos(url, '://'), 0) AS place FROM pages
), cut AS (
  SELECT page_id, CASE WHEN place > 0 THEN substr(url, place + 3) ELSE '' END AS rest FROM parts
), addr AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), lab AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), split AS (
  SELECT a.host, string_split(regexp_replace(a.host, ':[0-9]*$', ''), '.') AS l, count(lab.doc_id) AS n, coalesce(sum(lab.bad), 0) AS bad
  FROM addr a LEFT JOIN lab ON lab.doc_id = a.page_id GROUP BY 1, 2
), named AS (
  SELECT host, n, bad, l, len(l) AS k,
         array_to_string(l[greatest(len(l) - 1, 1):], '.') AS two, array_to_string(l[greatest(len(l) - 2, 1):], '.') AS three
  FROM split
), hosts AS (
  SELECT host, n::DOUBLE AS n, bad::DOUBLE AS bad,
         CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in', 'co.za') THEN two ELSE l[-1] END AS suffix,
         CASE WHEN two IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'co.jp', 'com.br', 'co.nz', 'co.in', 'co.za') THEN three ELSE two END AS domain
  FROM named
), domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), top AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS m FROM suffixes
), r1 AS (
  SELECT least(0.9::DOUBLE, greatest(0.001::DOUBLE, coalesce(sum(pow(bad - n * m, 2) - n * m * (1 - m)) / nullif(sum(n * (n - 1) * m * (1 - m)), 0), 0.5))) AS rho
  FROM suffixes, top
), p1 AS (SELECT suffix, (m * (1 / rho - 1) + bad) / (1 / rho - 1 + n) AS m FROM suffixes, top, r1
), r2 AS (
  SELECT least(0.9::DOUBLE, greatest(0.001::DOUBLE, coalesce(sum(pow(d.bad - d.n * m, 2) - d.n * m * (1 - m)) / nullif(sum(d.n * (d.n - 1) * m * (1 - m)), 0), 0.5))) AS rho
  FROM domains d JOIN p1 USING (suffix)
), p2 AS (SELECT d.suffix, d.domain, (m * (1 / rho - 1) + d.bad) / (1 / rho - 1 + d.n) AS m FROM r2, domains d JOIN p1 USING (suffix)
), r3 AS (
  SELECT least(0.9::DOUBLE, greatest(0.001::DOUBLE, coalesce(sum(pow(h.bad - h.n * m, 2) - h.n * m * (1 - m)) / nullif(sum(h.n * (h.n - 1) * m * (1 - m)), 0), 0.5))) AS rho
  FROM hosts h JOIN p2 USING (suffix, domain)
), p3 AS (
  SELECT host, (m * (1 / rho - 1) + h.bad) / (1 / rho - 1 + h.n) AS rate, 1 / rho - 1 + h.n AS total FROM r3, hosts h JOIN p2 USING (suffix, domain)
), judged AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule,
    rate, rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (total + 1)) AS bound
  FROM addr JOIN p3 USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       round(rate * 1e6)::BIGINT AS bad_rate_ppm, round(bound * 1e6)::BIGINT AS bound_ppm
FROM judged
"""

OP4 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS l, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 13, 0) + 2)) AS i FROM b WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, i, l, array_to_string(words[i:i + l - 1], ' ') AS win
  FROM (SELECT doc_id, words, l, unnest(range(1, len(words) - l + 2)) AS i FROM w, (SELECT DISTINCT l FROM bw) WHERE len(words) >= l)
), hits AS (SELECT doc_id, i, dw.l, item_id FROM dw JOIN bw USING (win)
), marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM hits) GROUP BY 1
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS list FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY 1
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '\x3cs>'), '</s>', '\x3c/s>'), '[INST]', '\x5bINST]'), '[/INST]', '\x5b/INST]') AS body,
            replace(replace(replace(replace(replace(replace(role, '\', '\\'), '<s>', '\x3cs>'), '</s>', '\x3c/s>'), '[INST]', '\x5bINST]'), '[/INST]', '\x5b/INST]'), chr(10), '\n') AS name
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(name) + length(body) + 9)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


OP12 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""
