"""Queries of problem 1: noise in text from scanned pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm.page_noise import page_noise, repaired_paragraphs
from quillon.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Every noisy line with each kind of its noise."""
    return page_noise(table(spark, d, "page_text"))


def p1_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """The continuous paragraphs of every page."""
    return repaired_paragraphs(table(spark, d, "page_text"))


QUERIES = {f.__name__: f for f in (p1_found, p1_paragraphs)}
SQL: dict = {}
