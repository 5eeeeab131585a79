"""Incremental runs: units are done once per content and configuration.

:func:`pending` is the batch form over a progress table, :func:`run_stream` the Structured Streaming form. There each
micro-batch has a folder of its own for its results and its identities, which a repeated batch overwrites.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def identity(config: str):
    """The identity of a unit: its id, the hash of its content and the configuration."""
    return F.sha2(F.concat_ws("|", "unit_id", "content_sha256", F.lit(config)), 256)


def pending(units: DataFrame, done: DataFrame, config: str) -> DataFrame:
    """Units (``unit_id, content_sha256``) without a row in ``done`` (``identity``); repeated units count once."""
    return units.withColumn("identity", identity(config)).dropDuplicates(["identity"]).join(done.select("identity").distinct(), "identity", "left_anti")


def run_stream(source: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, progress: str, checkpoint: str, config: str):
    """Process a stream of units once each; returns the started query.

    ``out`` and ``progress`` (the identities) are parquet tables partitioned by ``run`` (of a checkpoint) and ``batch``. A batch that ended between its
    two writes, or is tried again for another reason, looks at the progress of other batches only, so it does the same
    units and replaces what it wrote: every unit has its results once.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def batch(df: DataFrame, number: int) -> None:
        spark: SparkSession = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(progress)
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        schema = "identity string, run string, batch long"
        done = spark.read.schema(schema).parquet(progress) if there else spark.createDataFrame([], schema)
        todo = pending(df, done.filter((F.col("run") != run) | (F.col("batch") != number)), config).persist()
        work(todo).write.mode("overwrite").parquet(f"{out}/run={run}/batch={number}")
        todo.select("identity").write.mode("overwrite").parquet(f"{progress}/run={run}/batch={number}")
        todo.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
