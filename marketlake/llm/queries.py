"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import rotate_perspectives
from .decontaminate import find_contamination
from .html_extract import extract_pages
from .language_id import identify_languages
from .line_dedup import drop_boilerplate_lines
from .packing import pack
from .prefix_trie import prefix_trie
from .quality import classify_quality
from .secret_scan import scan_secrets
from .simhash import near_duplicates
from .sql import CODES_SQL, REPEATS_SQL, TRIE_SQL
from .suffix_dedup import drop_repeats
from .topk import exact_top_k
from .vector_codes import compress


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rotate_perspectives(_table(spark, sf_dir, "conversations"))
    shown = F.array_join(F.transform("loss_spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return out.withColumn("loss_spans", shown)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate_lines(_table(spark, sf_dir, "documents")).select("doc_id", "source", "text")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(_table(spark, sf_dir, "embeddings")).drop("label")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(_table(spark, sf_dir, "documents")).drop("kept", "spans")


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_secret_scan, op3_language_id, op4_quality, op5_decontaminate, op6_exact_topk, op7_line_dedup, op8_simhash, op9_html_extract, op10_packing,
        op11_prefix_trie, op12_vector_codes, op13_suffix_dedup,
    )
}

ORACLE_SQL = {
    "op11_prefix_trie": TRIE_SQL,
    "op12_vector_codes": CODES_SQL,
    "op13_suffix_dedup": REPEATS_SQL,
    "op1_chat_format": """
        WITH t AS (
            SELECT DISTINCT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations
        ), c AS (
            SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker NULLS FIRST, md5(content)) - 1) // 512 AS part FROM t
        ), s AS (
            SELECT DISTINCT conv_id AS of, speaker AS perspective FROM t WHERE speaker IS DISTINCT FROM 'system'
        ), r AS (
            SELECT conv_id, perspective, turn, speaker, content, part,
                '<|im_start|>' || CASE WHEN speaker IS NOT DISTINCT FROM perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
                    WHEN speaker IS NULL THEN 'user' ELSE 'user name=' || replace(replace(replace(speaker, '<|', '< |'), chr(13), ' '), chr(10), ' ') END
                    || chr(10) || content || '<|im_end|>' || chr(10) AS seg
            FROM c JOIN s ON conv_id IS NOT DISTINCT FROM of
        ), o AS (
            SELECT *, sum(length(seg)) OVER (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, speaker NULLS FIRST, md5(content)) AS upto
            FROM r
        ), p AS (
            SELECT conv_id, perspective, part, count(*) AS n_turns, sum(length(seg)) AS size,
                string_agg(seg, '' ORDER BY turn NULLS FIRST, speaker NULLS FIRST, md5(content)) AS text,
                coalesce(string_agg((upto - 11 - length(content)) || ':' || (upto - 1), ',' ORDER BY turn NULLS FIRST, speaker NULLS FIRST, md5(content))
                    FILTER (WHERE speaker IS NOT DISTINCT FROM perspective), '') AS loss_spans
            FROM o GROUP BY ALL
        )
        SELECT conv_id, perspective, CAST(part AS BIGINT) AS part,
            CAST(coalesce(sum(size) OVER (PARTITION BY conv_id, perspective ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS part_start,
            n_turns, text, loss_spans
        FROM p
    """,
    "op2_secret_scan": """
        WITH rules(k, kind, pattern, least, base) AS (VALUES
            (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12, true),
            (1, 'access', 'AKIA([A-Z0-9]+)', 14, true),
            (2, 'hex', '([0-9a-f]+)', 16, true),
            (3, 'private_key', '-----BEGIN ([A-Z ]{0,40})PRIVATE KEY-----', 0, false),
            (4, 'code_host', 'gh[pousr]_([A-Za-z0-9]{36,})', 0, false),
            (5, 'chat_bot', 'xox[abprs]-([A-Za-z0-9-]{10,})', 0, false),
            (6, 'signed_token', 'eyJ([A-Za-z0-9_-]{10,})\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}', 0, false)
        ), d AS (
            SELECT row_number() OVER () AS n_row, doc_id, coalesce(text, '') AS text FROM documents
        ), m AS (
            SELECT n_row, k, kind, least, base, text, pattern, regexp_extract_all(text, pattern) AS hits,
                regexp_extract_all(text, pattern, CASE WHEN k = 0 THEN 2 ELSE 1 END) AS groups
            FROM d CROSS JOIN rules WHERE regexp_matches(text, pattern)
        ), e AS (
            SELECT n_row, k, kind, least, base, text, unnest(hits) AS hit, unnest(groups) AS part, unnest(range(len(hits))) AS i, hits FROM m
        ), g AS (
            SELECT m.n_row, m.k, unnest(regexp_split_to_array(m.text, m.pattern)) AS gap,
                unnest(range(len(hits) + 1)) AS i FROM m
        ), s AS (
            SELECT e.n_row, e.k, e.kind, e.base, e.least, length(e.part) AS n, e.i,
                sum(length(g.gap)) OVER w + sum(length(e.hit)) OVER w AS until, length(e.hit) AS size
            FROM e JOIN g ON e.n_row = g.n_row AND e.k = g.k AND e.i = g.i
            WINDOW w AS (PARTITION BY e.n_row, e.k ORDER BY e.i)
        ), f AS (
            SELECT n_row, k, kind, base, CAST(until - size AS BIGINT) AS started, kind || ':' || CAST(until - size AS BIGINT) || ':' || CAST(until AS BIGINT) AS span
            FROM s WHERE n >= least
        ), a AS (
            SELECT n_row, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
                string_agg(span, ',' ORDER BY started, k) FILTER (WHERE base) AS base_spans, string_agg(span, ',' ORDER BY started, k) AS spans
            FROM f GROUP BY n_row
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
            sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN a USING (n_row)
    """,
    "op6_exact_topk": """
        WITH v AS (
            SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.n, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.n <> b.n
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 5
    """,
    "op7_line_dedup": """
        WITH p AS (
            SELECT row_number() OVER () AS page, source, text FROM documents WHERE source IS NOT NULL
        ), n AS (
            SELECT source, count(*) AS host_pages FROM p GROUP BY source
        ), l AS (
            SELECT source, line, count(*) AS pages
            FROM (SELECT DISTINCT page, source, unnest(string_split(text, chr(10))) AS line FROM p)
            WHERE trim(line, ' ') <> '' GROUP BY source, line
        ), b AS (
            SELECT l.source, list(line) AS lines FROM l JOIN n USING (source)
            WHERE pages >= 2 AND pages > host_pages * CAST(0.05 AS DOUBLE) GROUP BY l.source
        )
        SELECT doc_id, d.source, CASE WHEN text IS NULL OR lines IS NULL THEN text ELSE
            array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') = '' OR NOT list_contains(lines, x)), chr(10)) END AS text
        FROM documents d LEFT JOIN b ON d.source = b.source
    """,
}
