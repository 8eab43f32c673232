"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import bpe, embeddings, exact, lines, lm, minhash, mixing, quality, spelling, suffix, toxicity, whitening
from weir.llm.common import documents


def op1_mix_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_minhash_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), size=2, percent=80)


def op3_line_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_units(documents(spark, sf_dir))


def op4_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup_substrings(documents(spark, sf_dir))


def op5_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), bpe.vocabulary())


def op6_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.robust_quality(documents(spark, sf_dir), carry=["doc_id"], widen=True)


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op9_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_segment_edit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_near_lines(documents(spark, sf_dir))


def op11_spelling_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), typo=31)


def op12_gramian_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_streaming_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup_exact(spark, f"{sf_dir}/documents.parquet")


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_pivotal, op2_minhash_bottom_k, op3_line_hash, op4_suffix_family, op5_bpe_tree, op6_robust_quality, op7_nn_descent, op8_ppm_score,
        op9_factorization_toxicity, op10_segment_edit_lines, op11_spelling_dictionaries, op12_gramian_whitening, op13_streaming_exact,
    )
}
ORACLE: dict[str, str] = {
    "op2_minhash_bottom_k": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END) AS x FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        e AS MATERIALIZED (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 80 * (a.n + b.n - i)),
        r AS (SELECT u AS doc_id, u AS c FROM e UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.doc_id),
        c AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.c, d.doc_id) AS component_id, coalesce(c.c, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
    """,
    "op7_nn_descent": """
        WITH RECURSIVE x AS (
            SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda z: z * z))) AS l FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0
        ), e AS MATERIALIZED (
            SELECT a.vec_id AS u, b.vec_id AS v FROM x a JOIN x b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND a.l > 0 AND b.l > 0
            WHERE list_dot_product(a.v, b.v) >= 0.9::DOUBLE * a.l * b.l
        ), r AS (SELECT u AS vec_id, u AS c FROM e UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.vec_id),
        c AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id), n AS (SELECT u AS vec_id, count(*) AS n FROM e GROUP BY u)
        SELECT m.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, m.vec_id) AS component_id, coalesce(c.c, m.vec_id) = m.vec_id AS kept
        FROM embeddings m LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
    """,
    "op3_line_hash": r"""
        WITH p AS (
            SELECT doc_id, regexp_extract_all(text, '[^\n.!?]*[\n.!?]+|[^\n.!?]+') AS p FROM documents
        ), u AS (
            SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k FROM p
        ), x AS (
            SELECT *, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g')) AS x,
                   (coalesce(sum(strlen(piece)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s
            FROM u
        ), w AS (
            SELECT doc_id, k, x, length(x) - length(replace(x, ' ', '')) + 1 AS n, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS r FROM x WHERE x <> ''
        ), c AS (
            SELECT *, (sum(n) OVER (PARTITION BY doc_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS c FROM w
        ), y AS (
            SELECT doc_id, k, coalesce(sum(CASE WHEN contains(piece, chr(10)) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM x
        ), e AS (
            SELECT a.doc_id, a.r AS a, min(b.r) AS b, '' AS mark FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.r BETWEEN a.r AND a.r + 29
            WHERE b.c - a.c + a.n >= 30 GROUP BY a.doc_id, a.r
            UNION SELECT c.doc_id, min(c.r), max(c.r), '' FROM c JOIN y ON y.doc_id = c.doc_id AND y.k = c.k GROUP BY c.doc_id, y.line HAVING sum(c.n) >= 30
            UNION SELECT doc_id, min(r), max(r), chr(1) FROM c GROUP BY doc_id HAVING sum(n) < 30
        ), t AS (
            SELECT e.doc_id, e.a, e.b, e.mark || string_agg(c.x, chr(10) ORDER BY c.r) AS t FROM e JOIN c ON c.doc_id = e.doc_id AND c.r BETWEEN e.a AND e.b GROUP BY e.doc_id, e.a, e.b, e.mark
        ), d AS (
            SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, a, b) AS rank FROM t
        ), g AS (
            SELECT DISTINCT c.doc_id, c.k FROM d JOIN c ON c.doc_id = d.doc_id AND c.r BETWEEN d.a AND d.b WHERE d.rank > 1
        ), f AS (
            SELECT x.doc_id, count(*) AS n_units, count(g.k) AS n_removed,
                   coalesce(string_agg(x.s || '-' || (x.s + strlen(x.piece)), ',' ORDER BY x.k) FILTER (WHERE g.k IS NOT NULL), '') AS removed,
                   md5(coalesce(string_agg(x.piece, '' ORDER BY x.k) FILTER (WHERE g.k IS NULL), '')) AS kept_md5
            FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.k = g.k GROUP BY x.doc_id
        )
        SELECT o.doc_id, coalesce(f.n_units, 0)::BIGINT AS n_units, coalesce(f.n_removed, 0)::BIGINT AS n_removed,
               coalesce(f.removed, '') AS removed, coalesce(f.kept_md5, md5('')) AS kept_md5
        FROM documents o LEFT JOIN f USING (doc_id)
    """,
    "op13_streaming_exact": """
        WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g USING (t)
    """,
}
