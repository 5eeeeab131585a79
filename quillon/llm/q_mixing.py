"""Queries of problem 8: sources mixed to target shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.mixing import mix, shares_reached
from quillon.llm.q_subjects import shares
from quillon.llm.storage import stored
from quillon.llm.tokens import token_count
from quillon.sources.tables import table


def _uses(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", token_count("text").alias("n_tokens"))
    topics = shares(spark, d).groupBy("doc_id").agg(F.max(F.struct("share", "subject_code")).alias("b")).select("doc_id", F.col("b.subject_code").alias("topic"))
    return mix(stored(docs.join(topics, "doc_id", "left"), "mix"), table(spark, d, "mix_target"))


def p8_uses(spark: SparkSession, d: str) -> DataFrame:
    """How often each document of a target source is used."""
    return _uses(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share each source reaches, and whether it falls short."""
    return shares_reached(stored(_uses(spark, d), "uses"), table(spark, d, "mix_target"))


QUERIES = {f.__name__: f for f in (p8_uses, p8_shares)}
SQL: dict = {}
