"""The registered queries of this subpackage and, where SQL can say it, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    centroid_clustering,
    exact_search,
    jaccard_join,
    language_id,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    source_divergence,
    suffix_dedup,
    twins,
    url_filter,
    warc,
)
from landfall.plans.bindings import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "rejected"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_documents(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op8_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_search.search_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("n_distances")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit_sources(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_line_dedup": op4_line_dedup,
    "op5_mixing": op5_mixing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_warc": op7_warc,
    "op8_exact_search": op8_exact_search,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_url_filter": op11_url_filter,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS row_no, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), lines AS (
            SELECT row_no, doc_id, doc, pos, line,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT row_no, doc_id, doc, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM rows)
        ), firsts AS (
            SELECT key, min(doc) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key
            HAVING count(DISTINCT doc) >= 2
        ), judged AS (
            SELECT row_no, doc_id, pos, line, coalesce(first_doc <> doc, false) AS gone
            FROM lines LEFT JOIN firsts USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, cast(sum(cast(gone AS int)) AS bigint) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY row_no, doc_id""",
    "op6_jaccard_join": r"""
        WITH RECURSIVE rows AS (
            SELECT row_number() OVER () AS row_no, doc_id, list_filter(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[ \t\n\x0b\f\r]+'), lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT row_no, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 1),
                    lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
            FROM rows
        ), tokens AS (
            SELECT row_no, len(s) AS n, unnest(s) AS token FROM sets
        ), pairs AS (
            SELECT a.row_no AS a, b.row_no AS b FROM tokens a JOIN tokens b USING (token)
            WHERE a.row_no < b.row_no AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.row_no, b.row_no, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), links AS (
            SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
        ), reach AS (
            SELECT row_no, row_no AS seen FROM sets UNION SELECT reach.row_no, links.b FROM reach JOIN links ON reach.seen = links.a
        )
        SELECT s.doc_id, cast(len(s.s) AS bigint) AS n_shingles, min(t.doc_id) AS component_id
        FROM sets s JOIN reach USING (row_no) JOIN sets t ON reach.seen = t.row_no
        GROUP BY s.row_no, s.doc_id, len(s.s)""",
    "op7_warc": """
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ), roles AS (
            SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_page FROM payloads
        ), bits AS (
            SELECT *, string_split(hex, '') AS digits FROM roles
        ), numbers AS (
            SELECT *, list_transform(digits, lambda d: strpos('0123456789abcdef', d) - 1) AS n FROM bits
        )
        SELECT page_id, cast(payload_bytes AS bigint) AS payload_bytes,
               -- five hexadecimal digits hold four base32 digits
               array_to_string(list_transform(range(32), lambda i:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
                       ((n[(i // 4) * 5 + 1] * 65536 + n[(i // 4) * 5 + 2] * 4096 + n[(i // 4) * 5 + 3] * 256
                         + n[(i // 4) * 5 + 4] * 16 + n[(i // 4) * 5 + 5]) >> cast(15 - 5 * (i % 4) AS integer)) & 31
                   AS integer), 1)), '') AS payload_digest,
               CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_page THEN first_page END AS refers_to
        FROM numbers""",
    "op8_exact_search": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS double)) AS bigint)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, cast(list_inner_product(q.v, c.v) AS bigint) AS score
            FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ), ranked AS (
            SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS integer) AS rank
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op11_url_filter": twins.url_filter(),
    "op12_centroid_clustering": twins.centroid_clustering(),
    "op13_source_divergence": twins.SOURCE_DIVERGENCE,
}
