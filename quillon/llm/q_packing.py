"""Queries of problem 7: texts of documents in containers of fixed capacity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.packing import pack
from quillon.llm.storage import stored
from quillon.llm.tokens import token_count
from quillon.sources.tables import table

#: Each capacity is a packing of all documents.
MAX_CAPACITIES = 100


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"), "text").filter("text is not null")
    return stored(docs.select("key", token_count("text").alias("size")), "sizes")


def _contents(spark: SparkSession, d: str) -> DataFrame:
    capacities = sorted(r.max_size for r in table(spark, d, "size_limit").filter("measure = 'tokens' and item_table = 'documents'").select("max_size").distinct().limit(MAX_CAPACITIES + 1).collect())
    if len(capacities) > MAX_CAPACITIES:
        raise ValueError(f"more than {MAX_CAPACITIES} capacities")
    sizes = _sizes(spark, d)
    return reduce(DataFrame.unionByName, [pack(sizes, c).withColumn("capacity", F.lit(c)) for c in capacities])


def p7_contents(spark: SparkSession, d: str) -> DataFrame:
    """What each container holds: documents or parts of documents, with their place in the document in tokens."""
    return _contents(spark, d).select("capacity", "container_id", "bucket", "stage", F.col("key").alias("doc_id"), "part", F.col("start").alias("token_start"), F.col("size").alias("n_tokens"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each container with its number of items, its fill and the room left."""
    boxes = _contents(spark, d).groupBy("capacity", "container_id").agg(F.count(F.lit(1)).alias("n_items"), F.sum("size").alias("fill"))
    return boxes.withColumn("room", F.col("capacity") - F.col("fill"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: the containers used, the fewest possible, and the share of the room that is filled."""
    c = _contents(spark, d).groupBy("capacity", "container_id").agg(F.sum("size").alias("fill"))
    out = c.groupBy("capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("fill").alias("n_tokens"))
    return out.withColumn("fewest", F.ceil(F.col("n_tokens") / F.col("capacity"))).withColumn("filled", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6))


QUERIES = {f.__name__: f for f in (p7_contents, p7_containers, p7_fill)}
SQL: dict = {}
