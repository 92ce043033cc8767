"""SQL of the registered queries that SQL can express, for DuckDB.

The other queries are tested against brute force: their methods (hashes, trained
weights, automata, tokenizers) have no SQL form.
"""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op6_url_filter": """
WITH rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
                         THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), rules (verdict, rule, rule_host, rule_path) AS (
    VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
           ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), best AS (
    SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) urls
    JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
              AND starts_with(path, rule_path)
    GROUP BY host, path
)
SELECT page_id, parts.host AS host, parts.path AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best ON parts.host = best.host AND parts.path = best.path
""",
    "op11_exact_dedup": """
WITH texts AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents
)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256
FROM texts JOIN (
    SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256
) classes USING (text_sha256)
""",
    # CRC-32 by its rule: a table of 256 entries from the polynomial, then byte by byte.
    # Runs hold ASCII letters and U+00C0 to U+00FF only, which are two bytes 195, code - 64.
    "op12_spelling_variants": """
WITH RECURSIVE shifted AS (
    SELECT range AS byte, 0 AS k, range AS crc FROM range(256)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    FROM shifted WHERE k < 8
), crcs AS (
    SELECT list(crc ORDER BY byte) AS crc_of FROM shifted WHERE k = 8
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, run, count(*) AS n
    FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents
    ) found
    WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(list_reduce(
        flatten(list_transform(string_split(head || run, ''), lambda c:
            CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c) - 64] END)),
        lambda crc, byte: xor(crc >> 8, crc_of[xor(crc & 255, byte) + 1]), 4294967295),
        4294967295) AS h
    FROM runs, crcs
), counted AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1
), words AS (
    SELECT word, n FROM counted WHERE length(word) >= 7 AND n >= 2
), gaps AS (
    SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS gap
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words) places
), near AS (
    SELECT DISTINCT a.word AS word, b.word AS other, b.n AS other_n
    FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.place = b.place AND a.word <> b.word
    UNION
    SELECT gaps.word, words.word, words.n FROM gaps JOIN words ON gap = words.word
    UNION
    SELECT words.word, gaps.word, gaps.n FROM gaps JOIN words ON gap = words.word
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word
), forms AS (
    SELECT words.word, n, n_near, CASE WHEN top >= 10 * n THEN top END AS form_n,
           CASE WHEN top >= 10 * n THEN
               (SELECT min(encode(other)) FROM near WHERE near.word = words.word AND other_n = top)
           END AS form_bytes
    FROM words LEFT JOIN best ON words.word = best.word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, form_n, decode(form_bytes) AS form FROM forms
), chain AS (
    SELECT word, word AS reached, 0 AS k FROM formed
    UNION ALL
    SELECT chain.word, form, k + 1 FROM chain JOIN formed ON reached = formed.word WHERE form IS NOT NULL
)
SELECT formed.word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(reached, k) AS root FROM chain GROUP BY word) roots
     ON formed.word = roots.word
""",
    "op13_filter_audit": """
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), judged AS (
    SELECT doc_id, part,
           (len(words) < 200)::INT
           + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT
           + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE)::INT AS fails
    FROM texts
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
    FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM judged LEFT JOIN marks ON judged.doc_id = marks.doc_id GROUP BY part, fails
), letters (letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, k::INT AS step, bit AS now,
           (SELECT coalesce(sum(x.bit), 0)::INT FROM letters x
            WHERE strpos(filter_order, x.letter) < k) AS before
    FROM orders, range(1, 6) numbers (k) JOIN letters ON letter = substr(filter_order, k, 1)
), counted AS (
    SELECT part, filter_order, step, now,
           coalesce(sum(n) FILTER (fails & (before | now) = 0), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (fails & now > 0 AND fails & before = 0), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails & now > 0 AND fails & before > 0), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails = now), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (fails & now > 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (fails & now > 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, now
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, now)::BIGINT AS shapley
FROM counted
""",
}
