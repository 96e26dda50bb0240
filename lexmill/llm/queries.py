"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import langid, line_dedup, mixing, ngram_join, packing, quality_rules, secret_scan, token_files, vector_join, window_dedup
from lexmill.llm._common import table
from lexmill.llm.tokens import public_file


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digest(table(spark, sf_dir, "documents"), public_file("word_bpe_49k.json"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.ids_digest(table(spark, sf_dir, "documents"), public_file("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_digest(table(spark, sf_dir, "documents"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_digest(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op4_vector_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.similar_vectors(table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.window_digest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_ngram_join, op2_language_id, op3_best_fit_packing, op4_vector_range_join, op5_source_mixing, op6_line_dedup, op7_token_files, op8_secret_scan, op9_quality_rules, op10_repeated_windows)
}
#: The closure of links: every node reachable from each linked node.
CLOSURE = """ends AS (SELECT x AS a, y AS b FROM e UNION SELECT y, x FROM e), r(a, b) AS (SELECT a, b FROM ends UNION SELECT r.a, ends.b FROM r JOIN ends ON r.b = ends.a)"""

OP1 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) >= 5 THEN list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
""" + CLOSURE + """
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY 1) m ON m.a = w.doc_id"""

OP4 = """
WITH RECURSIVE u AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
""" + CLOSURE + """
SELECT u.vec_id, coalesce(d.k, 0) AS n_links, least(u.vec_id, coalesce(m.b, u.vec_id)) AS component_id, coalesce(m.b, u.vec_id) >= u.vec_id AS kept
FROM u LEFT JOIN (SELECT a, count(*) AS k FROM ends GROUP BY 1) d ON d.a = u.vec_id LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY 1) m ON m.a = u.vec_id"""

ORACLE: dict[str, str] = {"op1_ngram_join": OP1, "op4_vector_range_join": OP4, "op5_source_mixing": mixing.ORACLE, "op8_secret_scan": secret_scan.ORACLE}
