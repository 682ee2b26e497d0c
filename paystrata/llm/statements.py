"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

_COMPONENTS = """
reach AS (
    SELECT node, node AS other FROM nodes
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other
)
"""

#: CRC-32 of the decimal text of ``c``, bit by bit.
_CRC32_OF_C = """
xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, x: list_reduce(
        [xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))))
"""

STATEMENTS: dict[str, str] = {
    "op1_warc": """
        WITH captures AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), kept AS (
            SELECT payload, max(page_id) AS largest FROM captures
            WHERE octet_length(payload) >= 1000 GROUP BY payload
        )
        SELECT page_id, octet_length(c.payload)::BIGINT AS payload_bytes, sha1(c.payload) AS payload_digest,
               CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < largest THEN largest END AS refers_to
        FROM captures c LEFT JOIN kept k ON c.payload = k.payload
    """,
    "op3_lattice": f"""
        WITH RECURSIVE nodes AS (
            SELECT vec_id AS node, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
        ), usable AS (
            SELECT * FROM nodes WHERE v IS NOT NULL
              AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT x.node AS a, y.node AS b FROM usable x JOIN usable y
            ON x.node <> y.node AND list_cosine_similarity(x.v, y.v) >= 0.9
        ), {_COMPONENTS}, components AS (
            SELECT node, min(other) AS component_id FROM reach GROUP BY node
        ), degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT node AS vec_id, coalesce(n, 0) AS n_links, component_id, node = component_id AS kept
        FROM components LEFT JOIN degrees ON a = node
    """,
    "op4_topk": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_jaccard": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id AS node, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), nodes AS (SELECT node FROM words), shingles AS (
            SELECT DISTINCT node, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                   ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
            FROM (SELECT node, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node), shared AS (
            SELECT x.node AS a, y.node AS b, count(*) AS c
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.node <> y.node GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.node = a JOIN sizes q ON q.node = b
            WHERE 100 * c >= 90 * (p.n + q.n - c)
        ), {_COMPONENTS}
        SELECT r.node AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
        FROM reach r LEFT JOIN sizes s ON s.node = r.node GROUP BY r.node
    """,
    "op5_suffixes": """
        WITH texts AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), starts AS (
            SELECT doc_id, unnest(range(0, len(h) // 2 - 399)) AS p, h FROM texts WHERE len(h) >= 800
        ), keyed AS (
            SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 800)) AS k FROM starts
        ), repeated AS (
            SELECT doc_id, p FROM keyed WHERE k IN (SELECT k FROM keyed GROUP BY k HAVING count(*) > 1)
        ), marked AS (
            SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh
            FROM repeated
        ), runs AS (
            SELECT doc_id, run, min(p) AS b, max(p) + 400 AS e
            FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked) GROUP BY ALL
        ), gaps AS (
            SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before FROM runs
        ), cut AS (
            SELECT t.doc_id, t.h, sum(e - b)::BIGINT AS removed, count(b) AS spans,
                   string_agg(substr(t.h, (2 * before + 1)::BIGINT, (2 * (b - before))::BIGINT), '' ORDER BY b) AS heads, max(e) AS last
            FROM texts t LEFT JOIN gaps g ON g.doc_id = t.doc_id GROUP BY t.doc_id, t.h
        )
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, spans::BIGINT AS n_spans,
               sha256(unhex(coalesce(heads, '') || substr(h, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
        FROM cut
    """,
    "op11_negatives": """
        WITH whole AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
            FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY rank <= 3
    """,
    "op12_prefix_trie": f"""
        WITH turns AS (
            SELECT conv_id AS c, turn, length(coalesce(text, '')) AS n,
                   sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d
            FROM conversations WHERE conv_id IS NOT NULL
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, d) AS p FROM turns
        ), ids AS (
            SELECT c, c - c % 100 AS b, {_CRC32_OF_C} % 6 AS h FROM (SELECT DISTINCT c FROM turns)
        ), said AS (
            SELECT ids.c, p, d, n FROM ids JOIN placed ON placed.c = ids.c WHERE p > h
            UNION ALL
            SELECT ids.c, p, d, n FROM ids JOIN placed ON placed.c = ids.b WHERE p <= h
        ), steps AS (
            SELECT c, row_number() OVER w AS depth, n, string_agg(d, '') OVER w AS path FROM said WINDOW w AS (PARTITION BY c ORDER BY p)
        ), keyed AS (
            SELECT c, depth, n, sha256(path) AS node, coalesce(lag(sha256(path)) OVER (PARTITION BY c ORDER BY depth), 'root') AS parent,
                   depth = max(depth) OVER (PARTITION BY c) AS is_end
            FROM steps
            UNION ALL
            SELECT c, 0, 0, 'root', NULL, c NOT IN (SELECT c FROM said) FROM ids
        ), nodes AS (
            SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * any_value(n) AS saved,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
            FROM keyed GROUP BY node
        ), children AS (
            SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
        ), below AS (
            SELECT DISTINCT a.node AS top, b.node FROM keyed a JOIN keyed b ON a.c = b.c AND a.depth <= b.depth
        ), sums AS (
            SELECT top AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
            FROM below JOIN nodes ON nodes.node = below.node LEFT JOIN children ON children.node = below.node GROUP BY top
        )
        SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
               n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
        FROM nodes n JOIN sums ON sums.node = n.node LEFT JOIN children k ON k.node = n.node LEFT JOIN nodes p ON p.node = n.parent
    """,
}
