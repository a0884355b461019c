"""SQL for the queries that SQL can state, written for DuckDB over the same tables."""

from __future__ import annotations

# The records of the pages: the digest's 40 hexadecimal digits, five at a time, are four
# characters of base32.
_WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), digits AS (
    SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS holder,
           list_transform(range(8), lambda g: CAST('0x' || substr(sha1(payload), 5 * g + 1, 5) AS BIGINT)) AS parts
    FROM payloads
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((parts[i // 4 + 1] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM digits
"""

# Every string of 400 bytes by its place, in hexadecimal; those in two places; the bytes
# they cover, as stretches; what is between the stretches.
_SUFFIX = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
), windows AS (
    SELECT doc_id, i, md5(substr(t, 2 * i + 1, 800)) AS w
    FROM (SELECT doc_id, t, unnest(range(greatest(n - 399, 0))) AS i FROM texts)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1
), cut AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400, true) AS fresh FROM repeated
), numbered AS (
    SELECT doc_id, i, count(*) FILTER (WHERE fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM cut
), spans AS (
    SELECT doc_id, run, min(i) AS first, max(i) + 400 AS last FROM numbered GROUP BY ALL
), gaps AS (
    SELECT doc_id, coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY first), 0) AS first, first AS last FROM spans
    UNION ALL
    SELECT t.doc_id, coalesce(max(s.last), 0), any_value(t.n) FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id
), kept AS (
    SELECT g.doc_id, string_agg(substr(t.t, 2 * g.first + 1, 2 * (g.last - g.first)), '' ORDER BY g.first, g.last) AS rest
    FROM gaps g JOIN texts t USING (doc_id) GROUP BY g.doc_id
), removed AS (
    SELECT doc_id, sum(last - first) AS bytes, count(*) AS runs FROM spans GROUP BY doc_id
)
SELECT t.doc_id, t.n AS n_bytes, CAST(coalesce(r.bytes, 0) AS BIGINT) AS n_removed,
       coalesce(r.runs, 0) AS n_spans, sha256(unhex(k.rest)) AS kept_sha256,
       r.doc_id IS NOT NULL AS has_repeats
FROM texts t JOIN kept k USING (doc_id) LEFT JOIN removed r USING (doc_id)
"""

_NEGATIVES = """
WITH items AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
    FROM items a JOIN items b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                               ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

# The words as the contract changes them; every pair of equal words of a text by its
# distance, up to half the text; stretches of such pairs; of equal stretches the one of
# the smallest period. The CRC-32 goes byte by byte through a table of 256 steps.
_RUNS = """
WITH RECURSIVE steps(b, k, v) AS (
    SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
    UNION ALL
    SELECT b, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8
), crc AS (
    SELECT list(v ORDER BY b) AS steps FROM steps WHERE k = 8
), split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_transform(range(len(CAST(doc_id AS VARCHAR))),
                          lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER) + 1, 1)) AS BIGINT)) AS digits
    FROM documents
), hashed AS (
    SELECT doc_id, w, len(w) AS n,
           xor(list_reduce(list_prepend(4294967295, digits),
                           lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) AS h
    FROM split, crc
), planned AS (
    SELECT doc_id, w, n, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, (h // 10) % 8 AS g FROM hashed
), texts AS (
    SELECT doc_id, n, CASE WHEN planted THEN
               list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g)) END + 1])
           ELSE w END AS w
    FROM planned
), words AS (
    SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS word FROM texts
), pairs AS (
    SELECT x.doc_id, y.i - x.i AS p, x.i
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 2
), islands AS (
    SELECT doc_id, p, min(i) AS s, count(*) + p AS l
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs)
    GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(12, 2 * p)
), runs AS (
    SELECT doc_id, s, l, min(p) AS p FROM islands GROUP BY doc_id, s, l
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
           string_agg(s || ',' || l || ',' || p || chr(10), '' ORDER BY s, p) AS rows,
           min(struct_pack(l := -l, s := s, p := p)) AS longest
    FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest
    FROM words v WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = v.doc_id AND v.i >= r.s + r.p AND v.i < r.s + r.l)
    GROUP BY doc_id
)
SELECT t.doc_id, coalesce(b.n_runs, 0) AS n_runs, b.longest.s AS start, -b.longest.l AS length, b.longest.p AS period,
       1000 * -b.longest.l // b.longest.p AS exponent_milli,
       sha256(coalesce(b.rows, '')) AS runs_sha256, sha256(coalesce(k.rest, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_warc": _WARC,
    "op8_suffix_dedup": _SUFFIX,
    "op12_hard_negatives": _NEGATIVES,
    "op13_periodic_runs": _RUNS,
}
