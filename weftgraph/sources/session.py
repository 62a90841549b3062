"""Settings that the operators rely on, and the place for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# One node may hold a large share of all edges: let a skewed join be split even where
# that costs a shuffle for the aggregate after it.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # what a task sorts or hashes is many times the compressed bytes that it reads: the number of
    # tasks grows with the input, not what each of them holds
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "600",
    "spark.sql.files.maxPartitionBytes": "32m",
    # stored moments are seconds since the epoch in UTC; values without a zone are UTC
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; a new one only where all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="weftgraph-checkpoint-")


def checkpointed(frame: DataFrame) -> DataFrame:
    """Writes a frame to the reliable checkpoint folder and cuts its lineage there."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint(eager=True)
