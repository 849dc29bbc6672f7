"""SQL of the longer queries."""

from __future__ import annotations

#: The CRC-32 of a text: a byte at a time, eight shifts each.
_CRC32 = """xor(list_reduce(list_transform(string_split(CAST({text} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), CAST(4294967295 AS BIGINT)), 4294967295)"""

#: Each prefix as the digests of its turns; a node's subtree is the nodes that begin with it.
TRIE_SQL = f"""
    WITH t AS (
        SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, '')) AS n, coalesce(role, '') AS role
        FROM conversations WHERE conv_id IS NOT NULL
    ), l AS (
        SELECT conv_id, list({{'d': digest, 'n': n}} ORDER BY turn NULLS FIRST, role, digest) AS own, {_CRC32.format(text="conv_id")} % 6 AS h FROM t GROUP BY conv_id
    ), r AS (
        SELECT l.conv_id, list_concat(list_slice(coalesce(b.own, []), 1, l.h), list_slice(l.own, l.h + 1, len(l.own))) AS turns
        FROM l LEFT JOIN l b ON b.conv_id = l.conv_id - l.conv_id % 100
    ), p AS (
        SELECT conv_id, d, len(turns) AS depth, coalesce(turns[d].n, 0) AS n, array_to_string(list_transform(list_slice(turns, 1, d), lambda x: x.d), '') AS key
        FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM r)
    ), nodes AS (
        SELECT key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(n) * (count(*) - 1) AS saved,
            sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE d = depth), '')) AS ends_sha256
        FROM p GROUP BY key, d
    ), c AS (
        SELECT left(key, 32 * (depth - 1)::INT) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
    ), u AS (
        SELECT left(key, 32 * up::INT) AS key, saved, leaf
        FROM (SELECT n.key, n.saved, c.key IS NULL AS leaf, unnest(range(n.depth + 1)) AS up FROM nodes n LEFT JOIN c ON n.key = c.key)
    ), s AS (
        SELECT key, count(*) FILTER (WHERE leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM u GROUP BY key
    )
    SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM nodes n JOIN s ON s.key = n.key LEFT JOIN c ON c.key = n.key LEFT JOIN nodes q ON n.depth > 0 AND q.key = left(n.key, 32 * (n.depth - 1)::INT)
"""


def _codes_sql() -> str:
    """Six rounds are six steps of the same two queries."""
    near = """
        SELECT row, x.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d, any_value(x.x) AS x
        FROM (SELECT p.row, p.part, p.x, entry, CAST(list_sum(list_transform(list_zip(p.x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM parts p JOIN c{r} c ON c.part = p.part) x
        GROUP BY row, x.part"""
    mean = """
        SELECT c.part, c.entry, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
            SELECT part, entry, list((s - ((s % k) + k) % k) // k ORDER BY place) AS e
            FROM (SELECT part, entry, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS k FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS place FROM a{r}) GROUP BY part, entry, place)
            GROUP BY part, entry
        ) m ON m.part = c.part AND m.entry = c.entry"""
    steps = [f"a{r} AS MATERIALIZED ({near.format(r=r)}), c{r + 1} AS MATERIALIZED ({mean.format(r=r)})" for r in range(6)]
    return f"""
    WITH kept AS (
        SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), parts AS MATERIALIZED (
        SELECT row, vec_id, part, list_slice(q, part * (len(q) // 8) + 1, (part + 1) * (len(q) // 8)) AS x FROM (SELECT row, vec_id, q, unnest(range(8)) AS part FROM kept)
    ), c0 AS (
        SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e
        FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
    ), {", ".join(steps)}, final AS ({near.format(r=6)}),
    codes AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM final GROUP BY row),
    books AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c6)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM codes JOIN kept USING (row), books
    """


CODES_SQL = _codes_sql()

#: Every string of 100 bytes by its digest; the first of each stays, the others cover what goes.
REPEATS_SQL = """
    WITH d AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
    ), o AS (
        SELECT n, c, substr(h, 2 * c + 1, 1198) AS piece FROM (SELECT n, h, unnest(range(0, len(h) // 2 - 99, 500)) AS c FROM d WHERE len(h) >= 200)
    ), g AS (
        SELECT n, c + p AS p, md5(substr(piece, 2 * p + 1, 200)) AS m FROM (SELECT n, c, piece, unnest(range(len(piece) // 2 - 99)) AS p FROM o)
    ), f AS (
        SELECT m, min((n, p)) AS first FROM g GROUP BY m
    ), r AS (
        SELECT n, p, coalesce(p > lag(p) OVER (PARTITION BY n ORDER BY p) + 100, true) AS fresh FROM g JOIN f USING (m) WHERE (n, p) <> first
    ), i AS (
        SELECT n, p, sum(fresh::INT) OVER (PARTITION BY n ORDER BY p) AS island FROM r
    ), s AS (
        SELECT n, min(p) AS a, max(p) + 100 AS b FROM i GROUP BY n, island
    ), k AS (
        SELECT s.n, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, sum(b - a) AS n_removed, count(*) AS n_spans
        FROM (SELECT n, a, b, lag(b, 1, 0) OVER (PARTITION BY n ORDER BY a) AS before FROM s) s JOIN d USING (n) GROUP BY s.n
    )
    SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM d LEFT JOIN k USING (n)
"""
