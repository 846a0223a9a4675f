"""The queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import impact, licenses, mixing, ogg, packing, shared, simhash, tokenfile, toxicity, urlrules, warc


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(shared.read(spark, sf_dir, "documents"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.verdicts(shared.read(spark, sf_dir, "pages"), shared.read(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: source, language, thousands and hundreds of ids stand for
    directories, and files lie at all of these levels."""
    docs = shared.read(spark, sf_dir, "documents")
    levels = ["source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string")]
    depth = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)).cast("int") + 1
    path = F.concat_ws("/", F.array_join(F.slice(F.array(*levels), F.lit(1), F.coalesce(depth, F.lit(1))), "/"), F.col("doc_id").cast("string"))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op4_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.media_features(ogg.media_column(shared.read(spark, sf_dir, "documents")))


def op5_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.top_k(shared.read(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = shared.read(spark, sf_dir, "documents"), shared.read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~toxicity.held_out()))
    score = F.col("__score")
    return toxicity.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out().alias("held_out"), score.alias("score"), F.when(score >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted")
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(shared.read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op8_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read_tokens(tokenfile.write_tokens(shared.read(spark, sf_dir, "documents")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    return mixing.mixed(docs.select("doc_id", "source"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(warc.write_archives(warc.resolved(shared.read(spark, sf_dir, "pages"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing, op2_url_rules, op3_licenses, op4_ogg, op5_impact_search, op6_toxicity, op7_simhash, op8_token_file,
        op9_mixing, op10_warc,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_impact_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op9_mixing": """
        WITH RECURSIVE
        n AS (SELECT coalesce('s:' || source, 'null') AS s, (count(*) + 15) // 16 AS blocks FROM documents GROUP BY 1),
        w AS (SELECT s, blocks, CAST(ceil(round(100 * power(blocks / CAST((SELECT max(blocks) FROM n) AS DOUBLE), 0.5), 6)) AS BIGINT) AS w FROM n),
        step AS (
            SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS phase, CAST(0 AS BIGINT) AS start,
                   list(struct_pack(s := s, w := w, n := blocks, before := CAST(0 AS BIGINT), k := CAST(0 AS BIGINT)) ORDER BY s) AS st,
                   CAST(NULL AS STRUCT(d BIGINT, r BIGINT, s VARCHAR, b BIGINT)) AS pick, CAST(0 AS BIGINT) AS was_phase, CAST(0 AS BIGINT) AS was_start
            FROM w HAVING count(*) > 0
            UNION ALL
            SELECT slot, CASE WHEN over THEN phase + 1 ELSE phase END, CASE WHEN over THEN slot + 1 ELSE start END,
                   CASE WHEN over THEN list_transform(list_filter(next, lambda x: x.n > 0),
                        lambda x: struct_pack(s := x.s, w := x.w, n := x.n, before := x.before + x.k, k := CAST(0 AS BIGINT))) ELSE next END,
                   pick, phase, start
            FROM (
                SELECT *, len(list_filter(next, lambda x: x.n = 0)) > 0 AS over
                FROM (
                    SELECT slot, phase, start, pick, list_transform(st, lambda x: CASE WHEN x.s = pick.s
                        THEN struct_pack(s := x.s, w := x.w, n := x.n - 1, before := x.before, k := x.k + 1) ELSE x END) AS next
                    FROM (
                        SELECT slot + 1 AS slot, phase, start, st, list_sort(list_transform(
                                list_filter(st, lambda x: (x.k * total) // x.w <= slot + 1 - start),
                                lambda x: struct_pack(d := ((x.k + 1) * total + x.w - 1) // x.w, r := (x.k * total) // x.w, s := x.s, b := x.before + x.k)
                            ))[1] AS pick
                        FROM (SELECT *, CAST(list_sum(list_transform(st, lambda x: x.w)) AS BIGINT) AS total FROM step WHERE len(st) > 0)
                    )
                )
            )
        ),
        d AS (
            SELECT doc_id, source, coalesce('s:' || source, 'null') AS s,
                   row_number() OVER (PARTITION BY source ORDER BY substr(md5(CAST(doc_id AS VARCHAR)), 1, 15), doc_id) - 1 AS r
            FROM documents
        )
        SELECT doc_id, source, CAST(was_phase AS INTEGER) AS phase, pick.b AS block, was_start + pick.r AS release,
               was_start + pick.d AS deadline, slot, slot * 16 + r % 16 AS mix_position
        FROM d JOIN step ON step.pick.s = d.s AND step.pick.b = d.r // 16
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) ELSE page_id END AS first FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM f
    """,
}
