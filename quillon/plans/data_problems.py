"""Queries of the general data problems: units (3) and orphan references (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.operators.quantities import converted, normalize_quantities
from quillon.operators.references import orphan_references
from quillon.sources.tables import table


def _normalized(spark: SparkSession, d: str, distinct: bool = True) -> DataFrame:
    return normalize_quantities(table(spark, d, "observation"), table(spark, d, "lab_term"), table(spark, d, "unit_conversion"), distinct)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Observations whose unit makes the factor to the default unit differ from 1."""
    return converted(_normalized(spark, d, distinct=False))


def p3_normalized(spark: SparkSession, d: str) -> DataFrame:
    """Each value and interval in the default unit, with where the unit came from."""
    return _normalized(spark, d).drop("standard_name")


def p3_unit_origins(spark: SparkSession, d: str) -> DataFrame:
    """Per term: how many rows state their unit where, and how many are converted."""
    off = F.abs(F.col("factor") - 1) > 1e-9
    return _normalized(spark, d).groupBy("term_id", "unit_origin").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(off, 1)).alias("n_converted"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    edges, nodes = table(spark, d, "edges"), table(spark, d, "nodes")
    parts = [
        orphan_references(edges, [c], nodes, ["node_id"], "triple_id", "created_at", "created_at", "deleted_at")
        .select(F.lit("edges").alias("ref_table"), F.lit(c).alias("ref_field"), "row_key", "period", "reason")
        for c in ("subject_id", "object_id")
    ]
    vectors = orphan_references(table(spark, d, "vectors"), ["chunk_id"], table(spark, d, "evidence_chunk"), ["chunk_id"], "chunk_id", "indexed_at", "ingested_at", "deleted_at")
    parts.append(vectors.select(F.lit("vectors").alias("ref_table"), F.lit("chunk_id").alias("ref_field"), "row_key", "period", "reason"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Every orphan reference of edges and vectors."""
    return _orphans(spark, d)


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, field, month and reason."""
    return _orphans(spark, d).groupBy("ref_table", "ref_field", "period", "reason").agg(F.count(F.lit(1)).alias("n_orphans"))


_P5 = """
with refs as (
  select 'edges' ref_table, 'subject_id' ref_field, triple_id row_key, subject_id k, created_at t_at from edges
  union all select 'edges', 'object_id', triple_id, object_id, created_at from edges
  union all select 'vectors', 'chunk_id', chunk_id, chunk_id, indexed_at from vectors),
targets as (
  select 'edges' ref_table, node_id k, bool_or(deleted_at is null) live, min(created_at) first_at from nodes group by 2
  union all select 'vectors', chunk_id, bool_or(deleted_at is null), min(ingested_at) from evidence_chunk group by 2),
judged as (
  select distinct ref_table, ref_field, row_key, strftime(t_at, '%Y-%m') as period,
    case when live is null then 'missing' when not live then 'deleted' when not coalesce(first_at <= t_at, false) then 'late' end as reason
  from refs left join targets using (ref_table, k) where k is not null)
"""
SQL = {
    "p5_found": _P5 + "select ref_table, ref_field, row_key, period, reason from judged where reason is not null",
    "p5_report": _P5 + "select ref_table, ref_field, period, reason, count(*) as n_orphans from judged where reason is not null group by all",
}
QUERIES = {f.__name__: f for f in (p3_found, p3_normalized, p3_unit_origins, p5_found, p5_report)}
