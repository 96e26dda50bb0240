"""Every query of the engine by name, and the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.cites import enriched
from lexmill.functions.status import flipped
from lexmill.operators.chunk import chunk_rows
from lexmill.plans import more_queries, record_queries, relation_queries, text_queries, unit_queries  # noqa: F401
from lexmill.plans.recipe import ORACLE, QUERIES, relation


def sections_to_chunks(docs: DataFrame) -> DataFrame:
    """The flagship: sections enriched over their whole text, then cut into chunks with content-addressed ids."""
    rows = docs.withColumn("e", enriched(F.col("text"))).withColumn("act_status", flipped(F.lit("in_force"), F.col("text")))
    rows = chunk_rows(rows, F.concat(F.lit("DOC_"), F.col("doc_id")))
    return rows.select("point_id", "act_id", "chunk_index", "total_chunks", "chunk", "word_count", "act_status", "parent_chunk_id", "full_text_sha1", "e.*")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections_to_chunks(relation(spark, sf_dir, "SELECT doc_id, text FROM {documents}"))


QUERIES["sections_to_chunks"] = entry

__all__ = ["ORACLE", "QUERIES", "entry"]
