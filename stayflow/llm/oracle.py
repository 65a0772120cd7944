"""SQL twins of the text queries that SQL can express."""

from __future__ import annotations

from .common import LOWER, UPPER
from .decontaminate import WINDOW
from .license_join import PHRASES, TEMPLATES, THRESHOLD
from .minhash import LINK_PERCENT, SHINGLE
from .mixing import LEVEL_BITS, LEVELS, MAX_REPEATS, WEIGHTS
from .run_index import LENGTH
from .spelling import LETTERS, MIN_COUNT, MIN_LENGTH, RATIO, SLIP

LOWERED = f"translate(text, '{UPPER}', '{LOWER}')"
WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH item_words AS (
    SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item_id, len(p) AS n, array_to_string(p, ' ') AS win
    FROM (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1),
                                                lambda i: list_slice(w, i, i + {WINDOW - 1}))) AS p
          FROM item_words WHERE len(w) > 0)
), doc_words AS (
    SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents
), places AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM doc_words, (SELECT DISTINCT n FROM item_windows))
), hits AS (
    SELECT doc_id, item_id, i, n FROM places JOIN item_windows USING (win, n)
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

BITS = LEVEL_BITS * LEVELS
MIX = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, {BITS // 4}))::BIGINT AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::DOUBLE AS source_size, {MAX_REPEATS} * sum(size)::DOUBLE AS cap,
           sum(sum(size)) OVER ()::DOUBLE AS total,
           list_extract({[float(w) for w in WEIGHTS]},
                        ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT) AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), targets AS (
    SELECT source, source_size,
           least(cap, coalesce(max(level) OVER (), 0) * w) AS target
    FROM levels
), plans AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), by_hash AS (
    SELECT source, h, sum(size) AS words, count(*) AS rows, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto
    FROM sized GROUP BY source, h
), edges AS (
    SELECT p.source, min(struct_pack(h := h, rest := target - whole * source_size - (upto - words), each := words / rows)) AS edge
    FROM plans p JOIN by_hash b ON p.source IS NOT DISTINCT FROM b.source
    WHERE upto > target - whole * source_size GROUP BY p.source
), cuts AS (
    SELECT p.*, coalesce(edge.h, {1 << BITS}) AS cut,
           floor(edge.rest / edge.each) + (2 * (edge.rest - floor(edge.rest / edge.each) * edge.each) >= edge.each)::INT AS extra
    FROM plans p LEFT JOIN edges e ON p.source IS NOT DISTINCT FROM e.source
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source, h) AS n FROM sized
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (least(whole + (h < cut OR (h = cut AND n <= extra))::INT, {MAX_REPEATS}) * size)::BIGINT AS taken
FROM numbered s JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""

REVISIT = r"""
WITH bare AS (
    SELECT page_id, '"' || md5(html) || '"' AS tag, '"' || md5(html || '2') || '"' AS changed,
           regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b
    FROM pages
), parts AS (
    SELECT page_id, tag, changed,
           regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^(www|m)\.|:(80|443)$', '', 'g') AS host,
           regexp_replace(regexp_replace(regexp_extract(regexp_replace(b, '^[^/?]*', ''), '^[^?]*'),
                                         '(/index)?\.html?$', ''), '/+$', '') AS path,
           list_filter(string_split(regexp_extract(regexp_replace(b, '^[^/?]*', ''), '\?(.*)$', 1), '&'),
                       lambda p: NOT regexp_full_match(p, '(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?') AND p <> '') AS kept
    FROM bare
), keyed AS (
    SELECT page_id, tag, changed, host || path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url_key
    FROM parts
), records AS (
    SELECT page_id * 7 + n AS record_id, url_key, page_id + later AS captured_at, kind, page_id,
           CASE n WHEN 1 THEN 'W/' || tag WHEN 3 THEN changed WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE tag END AS etag,
           CASE WHEN n IN (3, 4, 5) THEN page_id END AS day
    FROM keyed, (VALUES ('response', 0, 0), ('revisit', 1, 50), ('revisit', 2, -7), ('response', 3, 100), ('revisit', 4, 150),
                        ('revisit', 5, 160), ('revisit', 6, 170)) AS k(kind, n, later)
), sourced AS (
    SELECT r.*, s.record_id AS source_id, s.captured_at AS source_at, s.etag AS source_tag, s.day AS source_day
    FROM records r LEFT JOIN LATERAL (
        SELECT record_id, captured_at, etag, day FROM records x
        WHERE x.kind = 'response' AND x.url_key = r.url_key AND x.captured_at < r.captured_at AND r.kind = 'revisit'
        ORDER BY x.captured_at DESC, x.record_id DESC LIMIT 1) s ON true
), judged AS (
    SELECT *, CASE WHEN kind = 'response' THEN 'response' WHEN source_id IS NULL THEN 'no_earlier'
                   WHEN etag IS NOT NULL AND source_tag IS NOT NULL
                   THEN CASE WHEN replace(etag, 'W/', '') = replace(source_tag, 'W/', '') THEN 'resolved' ELSE 'mismatch' END
                   WHEN day IS NOT NULL AND source_day IS NOT NULL THEN CASE WHEN day = source_day THEN 'resolved' ELSE 'mismatch' END
                   ELSE 'unverified' END AS status FROM sourced
)
SELECT record_id, url_key, captured_at, kind, status, source_id, source_at,
       CASE WHEN status IN ('response', 'resolved')
            THEN 'cache-control=max-age=60;content-type=text/html;date=' || captured_at || ';etag=' || coalesce(etag, '-')
            ELSE 'content-type=text/plain;date=' || captured_at || ';etag=' || coalesce(etag, '-') || ';set-cookie=' || page_id END AS headers
FROM judged
"""

REPEATED = f"""
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
    SELECT doc_id, i, substr(h, 2 * i - 1, {2 * LENGTH}) AS s
    FROM (SELECT doc_id, h, unnest(range(1, len(h) // 2 - {LENGTH - 2})) AS i FROM texts WHERE doc_id IS NOT NULL)
), firsts AS (
    SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)
), marked AS (
    SELECT doc_id, i, i > lag(i, 1, -{LENGTH}) OVER (PARTITION BY doc_id ORDER BY i) + {LENGTH} AS new
    FROM strings JOIN firsts USING (s) WHERE doc_id > first
), numbered AS (
    SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked
), runs AS (
    SELECT doc_id, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, b AS a, lead(a, 1, 1000000000) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM runs
    UNION ALL SELECT doc_id, 1, min(a) FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * a - 1, 2 * (b - a)), '' ORDER BY a) AS h
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
), sums AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT t.doc_id, (len(t.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.h, t.h))) AS kept_sha256
FROM texts t LEFT JOIN sums USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {SHINGLE - 1}), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * c >= {LINK_PERCENT} * (x.n + y.n - c)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON w.a = r.b
), named AS (
    SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, low) AS component_id,
       doc_id = least(doc_id, low) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, i - 1 AS pos, '{label}' AS label FROM (SELECT doc_id, w, unnest(range(1, len(w) - {len(p.split()) - 1} + 1)) AS i "
    f"FROM words) WHERE list_slice(w, i, i + {len(p.split()) - 1}) = {p.split()}"
    for p, label in PHRASES
)
_TEMPLATES = ", ".join(f"({i}, '{label}', '{text}')" for i, (text, label) in enumerate(TEMPLATES))
LICENSES = f"""
WITH words AS (
    SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents
), places AS (
    {_PLACES}
), base AS (
    SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS found
    FROM places GROUP BY doc_id
), templates AS (
    SELECT tid, label, list_distinct({WORDS}) AS w FROM (VALUES {_TEMPLATES}) AS t(tid, label, text)
), blocks AS (
    SELECT doc_id, {WORDS} AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents)
), shares AS (
    SELECT doc_id, label, len(list_intersect(t.w, b.w)) / len(t.w) AS share FROM blocks b, templates t
), finds AS (
    SELECT doc_id, list(DISTINCT label) AS found, max(share) AS best FROM shares
    WHERE share >= {THRESHOLD} - 1e-9 GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.found), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base.found, finds.found))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN finds USING (doc_id)
"""

# The checksum is computed byte by byte with the usual table of the reversed polynomial.
SPELLING = f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b:
               CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS tab
), runs AS (
    SELECT doc_id, run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h
    FROM (SELECT doc_id, unnest(regexp_extract_all({LOWERED}, '{LETTERS}')) AS run FROM documents) GROUP BY ALL
), checked AS (
    SELECT run, c, xor(list_reduce(list_transform(range(len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::BIGINT),
               lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS k
    FROM runs, crc
), slipped AS (
    SELECT CASE WHEN k % {SLIP} = 0 THEN substr(run, 1, k % length(run)) || substr(run, k % length(run) + 2) ELSE run END AS word, c
    FROM checked
), words AS (
    SELECT word, sum(c)::BIGINT AS n FROM slipped WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(c) >= {MIN_COUNT}
), cut AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
    SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS r
    FROM pairs JOIN words w ON w.word = b
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN r.n >= {RATIO} * w.n THEN b END AS form,
           CASE WHEN r.n >= {RATIO} * w.n THEN r.n END::BIGINT AS form_n
    FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.r = 1
), chain AS (
    SELECT word, word AS at FROM words
    UNION SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
), ends AS (
    SELECT c.word, c.at AS root FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

LLM_ORACLE = {
    "op1_decontaminate": DECONTAMINATE,
    "op2_mix_sources": MIX,
    "op4_run_index_dedup": REPEATED,
    "op6_minhash_bbit": NEAR,
    "op9_license_join": LICENSES,
    "op10_revisit_resolution": REVISIT,
    "op12_spelling_variants": SPELLING,
}
