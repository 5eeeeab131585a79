"""Queries of problem 4: visually identical text with different characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.lookalike import canonical_forms, vocabulary_of
from quillon.sources.tables import table


def _forms(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = vocabulary_of(table(spark, d, "lab_term"), "term_id", ["standard_name", "abbreviation"], ["aliases"])
    return canonical_forms(table(spark, d, "wbc_supplement"), "canonical_id", "canonical_name", "aliases", vocabulary)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Records with a text that only looks like a text of a term."""
    return _forms(spark, d).filter("how = 'look_alike'").select(F.col("key").alias("canonical_id"), "term_id").distinct()


def p4_canonical(spark: SparkSession, d: str) -> DataFrame:
    """Every text of every record in its consistent form."""
    return _forms(spark, d).select(F.col("key").alias("canonical_id"), "text", "canonical", "term_id", "how")


QUERIES = {f.__name__: f for f in (p4_found, p4_canonical)}
SQL: dict = {}
