"""The results of the operators that plain SQL can express, as DuckDB states them from their definitions."""

# Removal of repeated 50-byte strings.  Texts are cut into pieces of 500 starting places first, as taking a part of a long
# string is not done in constant time.
REPEATS = """
WITH texts AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS h FROM documents ),
chunks AS (SELECT doc_id, start, h[2 * start + 1:2 * start + 1098] AS piece
           FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49, 500)) AS start FROM texts)),
places AS (SELECT doc_id, start + i AS pos, piece[2 * i + 1:2 * i + 100] AS s
           FROM (SELECT *, unnest(range(0, least(500, len(piece) // 2 - 49))) AS i FROM chunks)),
again AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, MIN(doc_id) OVER (PARTITION BY s) AS earliest FROM places)
          WHERE earliest < doc_id),
runs AS (SELECT doc_id, pos, SUM(CASE WHEN pos <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run
         FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM again)),
spans AS (SELECT doc_id, MIN(pos) AS low, MAX(pos) + 50 AS high FROM runs GROUP BY doc_id, run),
removed AS (SELECT doc_id, SUM(high - low) AS n_removed, COUNT(*) AS n_spans, list(low ORDER BY low) AS lows,
                   list(high ORDER BY low) AS highs FROM spans GROUP BY doc_id)
SELECT t.doc_id, (len(h) // 2)::BIGINT AS n_bytes, COALESCE(n_removed, 0)::BIGINT AS n_removed,
       COALESCE(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN lows IS NULL THEN h ELSE array_to_string(
           list_prepend(h[1:2 * lows[1]],
                        [h[2 * highs[i] + 1:2 * COALESCE(lows[i + 1], len(h) // 2)] FOR i IN range(1, len(lows) + 1)]), '')
           END)) AS kept_sha256
FROM texts t LEFT JOIN removed r ON r.doc_id = t.doc_id
"""

# All pairs that share a shingle, and what can be reached over links.
JACCARD = """
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents ),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])) END AS shingles
    FROM words ),
texts AS (SELECT row_number() OVER () AS vertex, MIN(doc_id) AS doc, shingles FROM sets GROUP BY shingles ),
items AS (SELECT vertex, len(shingles) AS n, unnest(shingles) AS shingle FROM texts ),
links AS (
    SELECT a.vertex AS a, b.vertex AS b
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.vertex <> b.vertex AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
    GROUP BY a.vertex, b.vertex, a.n, b.n HAVING 100 * COUNT(*) >= 75 * (a.n + b.n - COUNT(*)) ),
reach AS (SELECT vertex AS a, vertex AS b FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a ),
ids AS (SELECT r.a AS vertex, MIN(t.doc) AS component_id FROM reach r JOIN texts t ON t.vertex = r.b GROUP BY r.a )
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles,
       CASE WHEN len(s.shingles) = 0 THEN s.doc_id ELSE i.component_id END AS component_id
FROM sets s LEFT JOIN texts t ON t.shingles = s.shingles LEFT JOIN ids i ON i.vertex = t.vertex
"""

# Integer BM25 of every document for every item; the terms' letters A to Z are lowered first.
LEXICAL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents ),
asked AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark ),
items AS (SELECT item_id, term, COUNT(*) AS times FROM asked GROUP BY item_id, term ),
sizes AS (SELECT COUNT(*)::BIGINT AS docs, SUM(len(w))::BIGINT AS total FROM words WHERE len(w) > 0 ),
tf AS (SELECT doc_id, n, term, COUNT(*)::BIGINT AS tf
       FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM words) GROUP BY doc_id, n, term ),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
            FROM (SELECT term, COUNT(*)::BIGINT AS df FROM tf GROUP BY term), sizes ),
scores AS (
    SELECT i.item_id, t.doc_id,
           SUM(i.times * w.weight * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (75 + (25 * t.n * s.docs) // s.total))))::BIGINT AS score
    FROM items i JOIN tf t ON t.term = i.term JOIN weights w ON w.term = i.term CROSS JOIN sizes s
    GROUP BY i.item_id, t.doc_id ),
ranked AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
           FROM scores WHERE score > 0 )
SELECT * FROM ranked WHERE rank <= 20
"""

# Every anchor's product with every row.
NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 ),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS alike, list_inner_product(a.v, r.v)::BIGINT AS score
    FROM vectors a JOIN vectors r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id ),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score
    FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scores WHERE alike)
    WHERE place <= 5 ),
ranked AS (
    SELECT p.anchor_id, positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
           id AS negative_id, positive_score, score AS negative_score
    FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT alike
         AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score )
SELECT * FROM ranked WHERE rank <= 3
"""
