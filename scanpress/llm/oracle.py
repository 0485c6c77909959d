"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes, bit by bit."""
    return f"""xor(list_reduce(
            list_concat([4294967295::UBIGINT], list_transform(range(1, 2 * octet_length(encode({text})), 2),
                lambda i: ('0x' || substr(hex(encode({text})), i, 2))::UBIGINT)),
            lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[]),
                lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)),
            4294967295::UBIGINT)::BIGINT"""


SQL: dict[str, str] = {
    "op1_voronoi_topk": """
        WITH e AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
            FROM e q JOIN e d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op2_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        e AS (
            SELECT *, regexp_replace(text, '<(\\*)(turn |/turn>|part/>)', '<\\\1\2', 'g') AS esc,
                   replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '>', '%3E'), chr(10), '%0A') AS r
            FROM t),
        l AS (
            SELECT *, lag(r) OVER w AS prev FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn, r, esc))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, r, esc)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, r, esc) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               (sum(length(esc)) + sum(CASE WHEN prev IS NULL OR prev <> r THEN 16 + length(r) ELSE 7 END))::BIGINT
                   AS formatted_chars
        FROM l GROUP BY conv_id""",
    "op5_warc_bundles": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                   sha1(coalesce(html, '')) AS d FROM pages),
        k AS (
            SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS keep FROM p)
        SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
               CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN keep = page_id THEN NULL ELSE keep END AS refers_to
        FROM k""",
    "op10_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
        k AS (
            SELECT doc_id, body, first(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size FROM t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k""",
    "op11_prefix_trie": f"""
        WITH o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS p
            FROM (SELECT conv_id, turn, t, left(sha256(length(r) || ':' || r || t), 32) AS d
                  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
                        WHERE conv_id IS NOT NULL))),
        c AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h
            FROM (SELECT DISTINCT conv_id FROM o)),
        t AS (
            SELECT c.conv_id, 0 AS part, o.p, o.d, o.t FROM c JOIN o ON o.conv_id = c.base AND o.p <= c.h
            UNION ALL SELECT c.conv_id, 1, o.p, o.d, o.t FROM c JOIN o ON o.conv_id = c.conv_id AND o.p > c.h),
        u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth FROM t),
        x AS (
            SELECT conv_id, depth, length(t) AS n, sha256(string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS k
            FROM u
            UNION ALL SELECT conv_id, 0, 0, '' FROM c),
        e AS (
            SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
            FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS deepest FROM x) WHERE depth = deepest GROUP BY k),
        g AS (SELECT k, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n FROM x GROUP BY k, depth),
        w AS (
            SELECT g.*, a.k AS up, b.conv_id AS parent_conv_id
            FROM g LEFT JOIN x a ON a.conv_id = g.conv_id AND a.depth = g.depth - 1 LEFT JOIN g b ON b.k = a.k),
        m AS (SELECT up AS k, count(*) AS n_children FROM w WHERE up IS NOT NULL GROUP BY up),
        s AS (
            SELECT a.k, count(*) FILTER (WHERE m.k IS NULL) AS n_leaves, sum((g.n_convs - 1) * g.n) AS saved
            FROM g LEFT JOIN m ON m.k = g.k JOIN x a ON a.conv_id = g.conv_id AND a.depth <= g.depth GROUP BY a.k)
        SELECT w.conv_id, w.depth::BIGINT AS depth, w.parent_conv_id, w.n_convs, coalesce(m.n_children, 0) AS n_children,
               s.n_leaves, s.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
        FROM w JOIN s ON s.k = w.k LEFT JOIN m ON m.k = w.k LEFT JOIN e ON e.k = w.k""",
    "op12_importance_resampling": f"""
        WITH f AS (
            SELECT 0 AS target, doc_id, row_number() OVER () AS i, text FROM documents
            UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
        w AS (
            SELECT target, i, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM f),
        b AS (SELECT word, {_crc32("word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM w)),
        n AS (SELECT target, i, bucket, count(*) AS n FROM w JOIN b USING (word) GROUP BY ALL),
        t AS (SELECT coalesce(sum(n) FILTER (WHERE target = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE target = 1), 0)::DOUBLE AS t FROM n),
        c AS (
            SELECT bucket, coalesce(sum(n) FILTER (WHERE target = 0), 0)::DOUBLE AS s,
                   coalesce(sum(n) FILTER (WHERE target = 1), 0)::DOUBLE AS t FROM n GROUP BY bucket),
        g AS (
            SELECT bucket, floor(1000 * ln((c.t + 1) * (t.s + 10000) / ((c.s + 1) * (t.t + 10000))))::BIGINT AS gain FROM c, t),
        d AS (SELECT i, sum(n) AS n_features, sum(n * gain) AS weight FROM n JOIN g USING (bucket) WHERE target = 0 GROUP BY i),
        r AS (
            SELECT f.doc_id, coalesce(d.n_features, 0)::BIGINT AS n_features, coalesce(d.weight, 0)::BIGINT AS weight,
                   coalesce(d.weight, 0)::BIGINT + floor(-1000 * ln(-ln((
                       ('0x' || left(sha256('2024:' || coalesce(f.doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
            FROM f LEFT JOIN d USING (i) WHERE f.target = 0),
        k AS (
            SELECT *, n_features >= 20 AS may, sum((n_features >= 20)::INT) OVER () AS many,
                   row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM r)
        SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= many * 10 // 100 THEN place END AS rank FROM k""",
}
