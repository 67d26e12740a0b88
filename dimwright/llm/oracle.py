"""SQL twins of the text queries that SQL can express."""

from __future__ import annotations

from dimwright.llm.licenses import TEMPLATES, template_bigrams, window_bounds

# The method's list: addresses fetched under several URLs. Rules as in the query contract.
URL_FILTER = r"""
WITH parts AS (
  SELECT page_id, url,
    coalesce(lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
    || regexp_replace(path, '(/index)?(\.html?)?/*$', '') END AS canonical
  FROM parts),
traps AS (SELECT canonical FROM named WHERE canonical IS NOT NULL
  GROUP BY canonical HAVING count(DISTINCT url) > 1),
ruled AS (
  SELECT n.*, t.canonical IS NOT NULL AS listed,
    CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM named n LEFT JOIN traps t ON n.canonical = t.canonical)
SELECT page_id, host, path, rule, canonical, listed,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
       WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def license_dice(bar: float = 0.75) -> str:
    rows = []
    for rank, (name, notice) in enumerate(sorted(TEMPLATES.items())):
        grams = template_bigrams(notice)
        low, high = window_bounds(len(grams), bar)
        rows += [f"({rank}, '{name}', {len(grams)}, {low}, {high}, '{g}')" for g in grams]
    return rf"""
WITH words AS (
  SELECT row_number() OVER () AS id, doc_id, string_split_regex(trim(regexp_replace(regexp_replace(
      regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}.]+', ' ', 'g'),
      '\.+( |$)', ' ', 'g'), '\.{{2,}}', ' .', 'g')), ' +') AS w
  FROM documents),
places AS (SELECT id, w, unnest(range(0, greatest(len(w) - 1, 0))) AS pos FROM words),
templates(rank, license, n, low, high, gram) AS (VALUES {", ".join(rows)}),
hits AS (
  SELECT p.id, p.pos, t.*, lag(p.pos) OVER (PARTITION BY p.id, t.rank, t.gram ORDER BY p.pos) AS before
  FROM places p JOIN templates t ON t.gram = w[pos + 1] || ' ' || w[pos + 2]),
reached AS (
  SELECT a.id, a.rank, a.license, a.n, a.low, a.pos, b.pos - a.pos + 1 AS m,
    row_number() OVER (PARTITION BY a.id, a.rank, a.pos ORDER BY b.pos) AS shared
  FROM hits a JOIN hits b ON a.id = b.id AND a.rank = b.rank AND b.pos BETWEEN a.pos AND a.pos + a.high - 1
    AND coalesce(b.before, -1) < a.pos),
best AS (
  SELECT id, rank, license, n, pos, m, 2e0 * shared / (m + n) AS dice FROM reached
  WHERE m >= low AND 2e0 * shared / (m + n) >= {bar}
  QUALIFY row_number() OVER (PARTITION BY id, rank, pos ORDER BY 2e0 * shared / (m + n) DESC, m) = 1)
SELECT w.doc_id, x.pos + 1 AS first_word, x.m + 1 AS n_words, x.license, round(x.dice, 6) AS dice
FROM best x JOIN words w ON w.id = x.id
WHERE NOT EXISTS (SELECT 1 FROM best y WHERE y.id = x.id AND y.pos <= x.pos + x.m AND x.pos <= y.pos + y.m
  AND (y.dice > x.dice OR y.dice = x.dice AND (y.n > x.n OR y.n = x.n AND (y.pos < x.pos OR y.pos = x.pos AND y.rank < x.rank))))
"""


_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex({_AZ}, '[.,;:!?\x0A-\x0D]') AS p FROM documents),
pieces AS (SELECT lang, unnest(p) AS piece FROM texts),
numbered AS (SELECT lang, piece, row_number() OVER () AS id FROM pieces),
words AS (
  SELECT lang, id, unnest(w) AS a, generate_subscripts(w, 1) AS pos FROM (
    SELECT lang, id, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM numbered)),
near AS (
  SELECT lang, a, lead(a, 1) OVER (PARTITION BY id ORDER BY pos) AS b, lead(a, 2) OVER (PARTITION BY id ORDER BY pos) AS c
  FROM words),
runs AS (
  SELECT lang, 1 AS k, a AS phrase FROM near
  UNION ALL SELECT lang, 2, a || ' ' || b FROM near WHERE b IS NOT NULL
  UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM near WHERE c IS NOT NULL),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY lang, k, phrase),
total AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, p.cut, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM candidates c JOIN (VALUES (1), (2)) p(cut) ON p.cut < c.k
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:p.cut], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[p.cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3)
  GROUP BY lang, phrase),
kept AS (
  SELECT s.* FROM lowest s LEFT JOIN longer g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE s.k = 3 OR g.a IS NULL OR 100 * g.a < 50 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

VECTOR_TOPK = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

# Checksums come from the rule: a table entry is eight shifts of its number.
IMPORTANCE = rf"""
WITH entries AS (
  SELECT list(e ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS e
    FROM range(256) numbers(i))),
words AS (
  SELECT doc_id, unnest(regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents),
goals AS (SELECT unnest(regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(
      list_transform(range(length(hex(encode(word))) // 2), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295)) % 10000 AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM goals), entries),
raw AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
goal AS (SELECT bucket, count(*) AS t FROM goals JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM words)::DOUBLE AS s_all, (SELECT count(*) FROM goals)::DOUBLE AS t_all),
gains AS (
  SELECT b.bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all + 10000)
      / ((coalesce(s, 0)::DOUBLE + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM range(10000) b(bucket) LEFT JOIN raw USING (bucket) LEFT JOIN goal USING (bucket), sums),
weights AS (
  SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS drawn
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM scored s LEFT JOIN ranked r ON r.doc_id = s.doc_id
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op7_url_filter": URL_FILTER,
        "op9_license_dice": license_dice(),
        "op11_collocations": COLLOCATIONS,
        "op12_vector_topk": VECTOR_TOPK,
        "op13_importance_resampling": IMPORTANCE,
    }
