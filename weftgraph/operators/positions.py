"""Exact positions of rows within groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.graph import col
from ..sources.session import checkpointed

POSITION = "~position"


def numbered(frame: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds the position from 0 of each row in its group (all rows without keys).

    Rows are laid out in order over many tasks, which number what they hold. A group that spans
    several tasks goes on, in each, after the number of its rows in those before it: one count
    for each group and task is summed. Rows are read once, and kept in the checkpoint folder.
    """
    width = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = [col(k).asc_nulls_last() for k in keys] + order
    laid = frame.repartitionByRange(width, *wanted).sortWithinPartitions(*wanted)
    at = F.monotonically_increasing_id()
    laid = checkpointed(
        laid.withColumn("~task", F.spark_partition_id()).withColumn(
            "~row", at.bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    named = [f"~k{i}" for i in range(len(keys))]
    counts = laid.groupBy(*[col(k).alias(n) for k, n in zip(keys, named, strict=True)], "~task").agg(
        F.count(F.lit(1)).alias("~n"), F.min("~row").alias("~first")
    )
    before = Window.partitionBy(*[col(n) for n in named]).orderBy("~task")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[col(n) for n in named],
        col("~task").alias("~of"),
        (F.coalesce(F.sum("~n").over(before), F.lit(0)) - col("~first")).alias("~shift"),
    )
    same = col("~task") == col("~of")
    for k, n in zip(keys, named, strict=True):
        same = same & col(k).eqNullSafe(col(n))
    known = [col(c) for c in frame.columns]
    return laid.join(starts, same).select(*known, (col("~row") + col("~shift")).alias(POSITION))
