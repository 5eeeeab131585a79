"""Queries of problem 2: oversized items cut at natural boundaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.splitting import split_items
from quillon.sources.tables import table

_ITEMS = {"page_text": "page_id", "evidence_chunk": "chunk_id"}


def _pieces(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    limits = table(spark, d, "size_limit").filter("measure = 'code_points'").distinct().orderBy("item_table").limit(len(_ITEMS) + 1).collect()
    if len({r.item_table for r in limits}) < len(limits) or not {r.item_table for r in limits} <= set(_ITEMS):
        raise ValueError(f"code_points limits are expected for {sorted(_ITEMS)}, one each")
    parts = []
    for r in limits:
        items = table(spark, d, r.item_table).select(F.col(_ITEMS[r.item_table]).alias("item_id"), F.col(r.item_field).alias("text"))
        if with_text:
            items = items.filter(F.length("text") > r.max_size).distinct()
        parts.append(split_items(items, r.max_size, r.overlap, with_text).withColumn("item_table", F.lit(r.item_table)))
    return reduce(DataFrame.unionByName, parts)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Items that come out in more than one piece."""
    return _pieces(spark, d, with_text=False).filter("piece_no = 1").select("item_table", "item_id").distinct()


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The ordered pieces of every oversized item."""
    return _pieces(spark, d, with_text=True)


def p2_boundaries(spark: SparkSession, d: str) -> DataFrame:
    """How many cuts fall on which kind of boundary."""
    return _pieces(spark, d, with_text=False).filter("boundary <> 'end'").distinct().groupBy("item_table", "boundary").agg(F.count(F.lit(1)).alias("n_cuts"))


QUERIES = {f.__name__: f for f in (p2_found, p2_pieces, p2_boundaries)}
SQL = {
    "p2_found": """
select distinct l.item_table, i.item_id from (
  select 'page_text' item_table, page_id item_id, length(cleaned_text) n from page_text
  union all select 'evidence_chunk', chunk_id, length(text) from evidence_chunk) i
join size_limit l on l.item_table = i.item_table and l.measure = 'code_points' and i.n > l.max_size""",
}
