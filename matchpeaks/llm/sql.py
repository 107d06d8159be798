"""DuckDB text of the queries that SQL can express."""

NGRAM_JOIN = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) >= 5
               THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
               WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
    FROM cut
), each AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS other FROM sets
    UNION SELECT doc_id, b FROM reached JOIN links ON other = a
)
SELECT doc_id, CAST(len(any_value(shingles)) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM sets JOIN reached USING (doc_id) GROUP BY doc_id
"""

SUFFIX_DEDUP = r"""
WITH bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), places AS (
    SELECT doc_id, n, p, substr(digits, CAST(2 * p + 1 AS BIGINT), 2) AS byte,
           CASE WHEN p + 100 <= n THEN md5(substr(digits, CAST(2 * p + 1 AS BIGINT), 200)) END AS string
    FROM bytes, unnest(range(n)) AS r(p)
), marked AS (
    SELECT *, string IS NOT NULL AND row_number() OVER (PARTITION BY string ORDER BY doc_id, p) > 1 AS repeated FROM places
), judged AS (
    SELECT doc_id, p, byte, coalesce(p - max(CASE WHEN repeated THEN p END) OVER (PARTITION BY doc_id ORDER BY p) < 100, false) AS gone
    FROM marked
), runs AS (
    SELECT *, gone AND NOT lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY p) AS starts FROM judged
), kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
           string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS digits
    FROM runs GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.digits, ''))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH cut AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS content
    FROM cut, unnest(range(1, CAST(len(words) AS BIGINT) - 11)) AS r(p)
), repeated AS (
    SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY content) AS least FROM windows) WHERE least < doc_id
), gone AS (
    SELECT DISTINCT doc_id, p + k AS p FROM repeated, range(13) AS r(k)
), placed AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM cut
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(cut.words) AS BIGINT) AS n_words, CAST(len(cut.words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""

IMPORTANCE_RESAMPLING = r"""
WITH bits AS (
    SELECT list(c ORDER BY i) AS entries FROM (
        SELECT i, list_reduce([CAST(i AS BIGINT)] || [CAST(0 AS BIGINT) FOR k IN range(8)],
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))
), every AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
), cut AS (
    SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM every
), runs AS (
    SELECT side, id, array_to_string(words[p:p + k], ' ') AS feature
    FROM cut, unnest(range(1, CAST(len(words) AS BIGINT) + 1)) AS r(p), range(3) AS s(k) WHERE p + k <= len(words)
), sums AS (
    SELECT feature, (4294967295 - list_reduce([CAST(4294967295 AS BIGINT)] ||
               [CAST(('0x' || substr(hex(encode(feature)), CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT) FOR i IN range(octet_length(encode(feature)))],
               lambda c, b: xor(c >> 8, entries[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM runs), bits
), buckets AS (
    SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM runs JOIN sums USING (feature) GROUP BY bucket
), totals AS (
    SELECT sum(s) AS all_s, sum(t) AS all_t FROM buckets
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(((CAST(t AS DOUBLE) + 1) * (CAST(all_s AS DOUBLE) + 10000))
               / ((CAST(s AS DOUBLE) + 1) * (CAST(all_t AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM buckets, totals
), weights AS (
    SELECT id, count(*) AS n_features, sum(gain) AS weight FROM runs JOIN sums USING (feature) JOIN gains USING (bucket)
    WHERE side = 'd' GROUP BY id
), scored AS (
    SELECT id AS doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('42:' || id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM cut LEFT JOIN weights USING (id) WHERE side = 'd'
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) FILTER (WHERE n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN CAST(place AS BIGINT) END AS rank FROM ranked
"""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), places AS (
    SELECT doc, lang, source, unnest(words) AS term FROM docs
), kept AS (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS n_lang FROM places GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM places GROUP BY lang, source, term
), grouped AS (
    SELECT lang, source, count(*) AS n_docs FROM docs GROUP BY lang, source
), cells AS (
    SELECT g.lang, g.source, k.term, CAST(coalesce(c.n, 0) AS HUGEINT) AS n, n_lang
    FROM grouped g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), shares AS (
    SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER w + 2 * count(*) OVER w) AS p,
           1 + 1000000000 * (n_lang + 2) // (sum(n_lang) OVER w + 2 * count(*) OVER w) AS q
    FROM cells WINDOW w AS (PARTITION BY lang, source)
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM grouped a JOIN grouped b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found
QUALIFY part = 'pair' OR rank <= 10
"""
