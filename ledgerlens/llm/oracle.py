"""DuckDB SQL of the training-data queries that SQL can express, over whole tables."""

OP8 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host,
         coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM docs),
windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM words WHERE len(ws) >= 8)),
repeated AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM windows) w,
       (SELECT unnest(range(0, 8)) AS k) o
  WHERE c >= 2 GROUP BY rid),
lines AS (
  SELECT rid, host, t, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
         len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n
  FROM (SELECT rid, host, t, unnest(ls) AS line FROM words)),
texts AS (SELECT host, count(DISTINCT t) AS texts FROM docs GROUP BY host),
frequent AS (
  SELECT l.host, l.line FROM (
    SELECT host, line, count(DISTINCT t) AS n FROM lines GROUP BY host, line) l
  JOIN texts USING (host) WHERE n >= 20 AND 100 * n > 2 * texts),
removed AS (
  SELECT rid, sum(n) AS n FROM lines JOIN frequent USING (host, line) GROUP BY rid),
counted AS (
  SELECT rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(x.n, 0) AS n_removed
  FROM words LEFT JOIN repeated r USING (rid) LEFT JOIN removed x USING (rid)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_removed <= 80 * n_words AS kept
FROM judged
"""

OP5 = r"""
WITH split AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
outcome AS (
  SELECT host, CASE WHEN quality IS NULL OR toxic IS NULL THEN NULL
                    ELSE quality = 1 AND toxic = 0 END AS good
  FROM split LEFT JOIN labels
    ON doc_id = try_cast(regexp_extract(path, '/([0-9]{1,18})([^0-9]|$)', 1) AS BIGINT)),
counted AS (
  SELECT host, count(good) AS n, count(*) FILTER (WHERE good) AS k FROM outcome GROUP BY host),
cut AS (
  SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS p FROM counted),
hosts AS (
  SELECT host, n, k,
         CASE WHEN array_to_string(p[-2:], '.') IN ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'co.jp',
                                                    'com.au', 'com.br', 'co.nz')
              THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix,
         CASE WHEN array_to_string(p[-2:], '.') IN ('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'co.jp',
                                                    'com.au', 'com.br', 'co.nz')
              THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain
  FROM cut),
top AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS mean FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix),
s1 AS (SELECT s0.*, mean AS prior FROM s0, top),
sm AS (SELECT (1 - rho) / rho AS m FROM (SELECT least(greatest(coalesce(
  (sum(pow(k / n - prior, 2) * n / (prior * (1 - prior))) FILTER (WHERE n > 0)
   - count(*) FILTER (WHERE n > 0)) / sum(n - 1) FILTER (WHERE n > 1), 0), 1e-3), 0.5) AS rho
  FROM s1)),
s2 AS (SELECT suffix, (k + m * prior) / (n + m) AS mean FROM s1, sm),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
d1 AS (SELECT d0.*, mean AS prior FROM d0 JOIN s2 USING (suffix)),
dm AS (SELECT (1 - rho) / rho AS m FROM (SELECT least(greatest(coalesce(
  (sum(pow(k / n - prior, 2) * n / (prior * (1 - prior))) FILTER (WHERE n > 0)
   - count(*) FILTER (WHERE n > 0)) / sum(n - 1) FILTER (WHERE n > 1), 0), 1e-3), 0.5) AS rho
  FROM d1)),
d2 AS (SELECT domain, (k + m * prior) / (n + m) AS mean FROM d1, dm),
h1 AS (SELECT hosts.*, mean AS prior FROM hosts JOIN d2 USING (domain)),
hm AS (SELECT (1 - rho) / rho AS m FROM (SELECT least(greatest(coalesce(
  (sum(pow(k / n - prior, 2) * n / (prior * (1 - prior))) FILTER (WHERE n > 0)
   - count(*) FILTER (WHERE n > 0)) / sum(n - 1) FILTER (WHERE n > 1), 0), 1e-3), 0.5) AS rho
  FROM h1)),
h2 AS (SELECT host, n, k, (k + m * prior) / (n + m) AS mean, k + m * prior AS a,
              n - k + m * (1 - prior) AS b FROM h1, hm),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1')
      THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/')
      THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN mean + 2.0 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) < 0.5 THEN 'block'
            ELSE 'allow' END AS verdict,
       CAST(n AS BIGINT) AS labelled, CAST(k AS BIGINT) AS good
FROM ruled JOIN h2 USING (host)
"""

# Integer arithmetic throughout but for the logarithm; only A-Z are lower-cased.
OP13 = r"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents WHERE text IS NOT NULL
),
asked AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL) x
),
lengths AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths),
counted AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * max(docs) + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term
),
impacts AS (
  SELECT doc_id, term,
         (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // all_terms)) AS impact
  FROM counted JOIN lengths USING (doc_id), totals
),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) JOIN weights USING (term)
  GROUP BY item_id, doc_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""
