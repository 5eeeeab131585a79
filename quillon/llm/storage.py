"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one only where none is set, as in tests."""
    sc = spark.sparkContext
    if not (base := spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")):
        base = getattr(sc, "_quillon_folder", None) or tempfile.mkdtemp(prefix="quillon-shared-")
        sc._quillon_folder = base
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/quillon-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
