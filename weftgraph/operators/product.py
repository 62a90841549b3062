"""Every row of one side with every row of the other, spread over a grid of tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pairs that one task makes, and the most tasks of a join of pairs (more pairs make them longer).
PAIRS = 4_000_000
TASKS = 4_096


def tasks_for(pairs: int) -> int:
    """Tasks of a join that makes so many pairs. Inputs may be small: their bytes tell nothing."""
    return max(1, min(TASKS, -(-pairs // PAIRS)))


def met(a: DataFrame, b: DataFrame, keys: list[str], tasks: int) -> DataFrame:
    """The rows that agree in the keys, joined in so many tasks (left to Spark for one).

    Spark would make as few tasks as the bytes of the inputs ask for, or broadcast one side to those
    of the other.
    """
    if tasks > 1:
        a, b = (x.repartition(tasks, *keys) for x in (a, b))
        b = b.hint("merge")
    return a.join(b, keys)


def product(
    left: DataFrame, right: DataFrame, on: Column | None = None, side: int | None = None
) -> DataFrame:
    """Pairs of rows (that satisfy ``on``), as a keyed join over a grid of cells.

    Without a given side both are counted, for about as many cells as the pairs need tasks; the
    larger side is cut into more, so that few copies are made.

    A left row belongs to one grid row and is copied to all its cells; a right row
    belongs to one grid column. Every pair meets in exactly one cell, no side is
    collected or broadcast whole, and all cells have about the same size whatever the
    values are.
    """
    if side is None:
        m, n = left.count(), right.count()
        tasks = tasks_for(m * n)
        down = min(tasks, max(1, round(math.sqrt(tasks * m / max(1, n)))))
        across = -(-tasks // down)
    else:
        tasks, down, across = 1, side, side
    at, to = _share(left, down), _share(right, across)
    a = left.withColumn("~row", at.cast("int")).withColumn("~col", F.explode(_cells(across)))
    b = right.withColumn("~col", to.cast("int")).withColumn("~row", F.explode(_cells(down)))
    pairs = met(a, b, ["~row", "~col"], tasks).drop("~row", "~col")
    return pairs if on is None else pairs.where(on)


def _cells(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _share(frame: DataFrame, side: int) -> Column:
    # the partition counts too: many equal rows are spread as well
    values = [F.col(f"`{c}`") for c in frame.columns]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *values), F.lit(side))
