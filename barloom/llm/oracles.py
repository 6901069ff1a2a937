"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

#: CRC-32 of a decimal id, bit by bit.
CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(
        list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END
    )
), 4294967295::BIGINT)"""

PREFIX_TRIE = f"""
WITH plain AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), owned AS (
    SELECT conv_id, list([role, text] ORDER BY turn NULLS FIRST, md5(strlen(role)::VARCHAR || ':' || role || text)) AS own, {CRC} % 9 AS h
    FROM plain GROUP BY conv_id
), rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.own, []::VARCHAR[][])[1 : a.h], a.own[a.h + 1 :]) AS path
    FROM owned a LEFT JOIN owned b ON b.conv_id = a.conv_id - a.conv_id % 5
), members AS (
    SELECT conv_id, len(path) AS total, d, path[1 : d] AS node FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT
        node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = d), '')) AS ends_sha256
    FROM members GROUP BY node, d
), kids AS (
    SELECT node[1 : d - 1] AS up, d - 1 AS ud, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (
    SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * strlen(node[d][2]) ELSE 0 END AS saved
    FROM nodes LEFT JOIN kids ON up = node AND ud = d
), below AS (
    SELECT node[1 : k] AS top, k, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM counted) GROUP BY ALL
)
SELECT
    c.conv_id, c.d::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children::BIGINT AS n_children,
    b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c
JOIN below b ON b.top = c.node AND b.k = c.d
LEFT JOIN nodes p ON c.d > 0 AND p.d = c.d - 1 AND p.node = c.node[1 : c.d - 1]
"""

HARD_NEGATIVES = """
WITH vectors AS (
    SELECT
        vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON b.vec_id <> a.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM pairs WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT
    p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SPACED_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

PHRASES = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {ALNUM_WORDS} AS words FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {ALNUM_WORDS} AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item, words[k : least(k + 9, len(words))] AS win
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM items WHERE len(words) > 0)
), sizes AS (
    SELECT DISTINCT len(win) AS size FROM windows
), grams AS (
    SELECT r, k, size, words[k : k + size - 1] AS win
    FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM docs, sizes WHERE len(words) >= size)
), hits AS (
    SELECT r, k, size, item FROM grams JOIN windows USING (win)
), counted AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS place FROM hits) GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT
    doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counted USING (r) LEFT JOIN found USING (r)
"""

PASSAGES = f"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, {SPACED_WORDS} AS words FROM documents
), windows AS (
    SELECT r, doc_id, k, array_to_string(words[k : k + 19], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(words) - 18)) AS k FROM docs WHERE len(words) >= 20)
), later AS (
    SELECT r, k FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, k) > 1
), gone AS (
    SELECT r, list(DISTINCT place) AS places FROM (SELECT r, unnest(range(k, k + 20)) AS place FROM later) GROUP BY r
), marked AS (
    SELECT docs.r, doc_id, words, coalesce(places, []::BIGINT[]) AS places FROM docs LEFT JOIN gone USING (r)
), split AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT hit) AS kept
    FROM (
        SELECT w.r, w.place, w.word, g.place IS NOT NULL AS hit
        FROM (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs) w
        LEFT JOIN (SELECT r, unnest(places) AS place FROM gone) g ON g.r = w.r AND g.place = w.place
    ) GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(places)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM marked LEFT JOIN split USING (r)
"""

SQL = {"op7_phrases": PHRASES, "op10_passages": PASSAGES, "op12_hard_negatives": HARD_NEGATIVES, "op13_prefix_trie": PREFIX_TRIE}
