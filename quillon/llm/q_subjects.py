"""Queries of problem 9: subject areas of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.subjects import MAX_SUBJECTS, SHARE, subject_shares
from quillon.sources.tables import table


def shares(spark: SparkSession, d: str) -> DataFrame:
    """``doc_id, subject_code, share`` for the documents of a folder."""
    codes = [r.subject_code for r in table(spark, d, "subject_area").select("subject_code").dropna().distinct().orderBy("subject_code").limit(MAX_SUBJECTS + 1).collect()]
    return subject_shares(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "doc_label"), codes)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Each subject that at least a fifth of a document deals with, by its passages or a trusted label."""
    return shares(spark, d).filter((F.col("share") >= SHARE) | F.col("labelled")).select("doc_id", "subject_code")


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    """The corpus by subject: documents that deal with it and their characters in its passages."""
    sizes = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"))
    found = shares(spark, d).join(sizes, "doc_id")
    return found.groupBy("subject_code").agg(F.count(F.when((F.col("share") >= SHARE) | F.col("labelled"), 1)).alias("n_documents"), F.round(F.sum(F.col("share") * F.col("n"))).cast("bigint").alias("n_characters"))


QUERIES = {f.__name__: f for f in (p9_found, p9_composition)}
SQL: dict = {}
