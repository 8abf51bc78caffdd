"""DuckDB SQL of the corpus queries that SQL can express."""

STATEMENTS: dict[str, str] = {}

STATEMENTS["op1_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank,
         ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]
           AS weight,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget
  FROM per_source),
leveled AS (
  SELECT *, max((budget - coalesce(used, 0)) / onward) OVER () AS level FROM (
    SELECT *, sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::DOUBLE AS used,
           sum(weight) OVER (ORDER BY 2 * source_size / weight, rank
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
    FROM ranked)),
targets AS (
  SELECT source, rank, source_size, budget,
         least((2 * source_size)::DOUBLE, weight * level) AS target FROM leveled),
placed AS (
  SELECT s.*, t.rank, t.source_size, t.budget, t.target,
         sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id NULLS FIRST, size
                         ROWS UNBOUNDED PRECEDING)::BIGINT AS reached
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
queued AS (
  SELECT p.*, (reached + e * source_size)::DOUBLE / target AS time
  FROM placed p, (VALUES (0), (1)) AS rounds(e) WHERE size > 0 AND target > 0),
cut AS (
  SELECT *, sum(size) OVER (ORDER BY time, rank, key, doc_id NULLS FIRST, size
                            ROWS UNBOUNDED PRECEDING) <= budget AS fits
  FROM queued),
taken AS (
  SELECT doc_id, rank, reached, sum(size) FILTER (fits) AS words FROM cut GROUP BY ALL)
SELECT p.doc_id, p.source, p.size::BIGINT AS size, p.source_size, p.target,
       coalesce(t.words, 0)::BIGINT AS taken
FROM placed p LEFT JOIN taken t
  ON p.doc_id IS NOT DISTINCT FROM t.doc_id AND p.rank = t.rank AND p.reached = t.reached AND p.size > 0
"""

STATEMENTS["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER best AS kept, text_sha256
FROM d
WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id ASC NULLS LAST)
"""

STATEMENTS["op10_url_filters"] = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
urls AS (SELECT DISTINCT host, path FROM parts),
judged AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN judged USING (host, path)
"""

#: Base 32 of a SHA-1, five hexadecimal digits at a time.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[{i + 1}] // {1 << shift}) % 32 + 1)::INT, 1)"
    for i in range(8)
    for shift in (15, 10, 5, 0)
)

STATEMENTS["op3_warc"] = rf"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS h FROM pages),
coded AS (
  SELECT *, [('0x' || substr(h, i, 5))::BIGINT FOR i IN [1, 6, 11, 16, 21, 26, 31, 36]] AS v FROM hashed),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS first FROM coded)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM kept
"""

STATEMENTS["op11_lexical_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
per_term AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM per_term GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM per_term, whole GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT
           AS score
  FROM asked JOIN weights USING (term) JOIN per_term USING (term) JOIN lengths USING (doc_id), whole
  GROUP BY item_id, doc_id),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM placed WHERE rank <= 20
"""

STATEMENTS["op12_line_dedup"] = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '')) AS kept_sha256
FROM (SELECT k.*, r.keeper IS NOT NULL AND r.keeper <> doc_id AS goes FROM keyed k LEFT JOIN repeated r USING (key))
GROUP BY doc_id
"""

#: CRC-32 of a number's decimal text, a byte at a time and eight bits a byte.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, [ascii(d)::BIGINT FOR d IN string_split(conv_id::VARCHAR, '')]),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0::BIGINT FOR i IN range(8)]),
      lambda c, i: xor(c >> 1, 3988292384 * (c % 2)))))"""

STATEMENTS["op13_conversation_trie"] = rf"""
WITH turns AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, list(said ORDER BY place) AS own FROM turns GROUP BY conv_id),
shared AS (SELECT *, {_CRC32} % 4 AS h FROM convs),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS said
  FROM shared c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
  SELECT conv_id, said[1:d] AS prefix, d AS depth, len(said) AS size
  FROM rebuilt, LATERAL (SELECT unnest(range(len(said) + 1)) AS d)),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth > 0 THEN len(regexp_extract_all(prefix[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256
  FROM prefixes GROUP BY prefix, depth),
families AS (SELECT prefix[1:depth - 1] AS parent, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(f.n, 0) AS n_children FROM nodes n LEFT JOIN families f ON f.parent = n.prefix),
above AS (
  SELECT prefix[1:k] AS top, n_children, (n_convs - 1) * words AS saved
  FROM counted, LATERAL (SELECT unnest(range(depth + 1)) AS k)),
inside AS (
  SELECT top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM above GROUP BY top)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, i.n_leaves, i.saved_tokens, c.ends_sha256
FROM counted c JOIN inside i ON i.top = c.prefix
LEFT JOIN nodes p ON c.depth > 0 AND p.depth = c.depth - 1 AND p.prefix = c.prefix[1:c.depth - 1]
"""
