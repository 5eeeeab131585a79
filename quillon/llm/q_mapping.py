"""Queries of problem 6: freely typed names to the entries of the term list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.lookalike import vocabulary_of
from quillon.llm.mapping import MAX_ENTRIES, map_values
from quillon.operators.joins import lookup_join
from quillon.session import broadcast_if_small
from quillon.sources.tables import table


def _open_rows(spark: SparkSession, d: str) -> DataFrame:
    """Observations without a standard name of the list, once each."""
    known = table(spark, d, "lab_term").select("standard_name").distinct()
    obs = table(spark, d, "observation").select("obs_id", "raw_name", "standard_name")
    return obs.join(broadcast_if_small(known, MAX_ENTRIES), "standard_name", "left_anti").select("obs_id", "raw_name").distinct()


def _mapping(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    entries = vocabulary_of(table(spark, d, "lab_term"), "term_id", ["standard_name", "abbreviation"], ["aliases"])
    return map_values(rows.select(F.col("raw_name").alias("value")), entries)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The term that each open observation means, or ``none``."""
    rows = _open_rows(spark, d)
    mapped = lookup_join(rows, _mapping(spark, d, rows), ["raw_name"], ["value"])
    return mapped.select("obs_id", F.coalesce("key", F.lit("none")).alias("term_id")).distinct()


def p6_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Typed names that stand for no entry, with their number of observations and best score."""
    rows = _open_rows(spark, d)
    counts = rows.groupBy("raw_name").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(_mapping(spark, d, rows).filter("key is null"), F.col("raw_name").eqNullSafe(F.col("value")), "inner").select("raw_name", "n_rows", F.round("score", 6).alias("best_score"))


QUERIES = {f.__name__: f for f in (p6_found, p6_unmatched)}
SQL: dict = {}
