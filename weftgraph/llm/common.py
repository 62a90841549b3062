"""Pieces that several operators share: tables between steps, keys of rows, ranks, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between steps: `spark.checkpoint.dir`, or a new one in local mode.

    A cluster without the setting is refused, since its executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-tables-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """The same rows read from a table in the shared folder: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), a key of two longs without nulls, and `rest`: all other columns.

    The key is the same for rows of the same doc_id and text. Rows that repeat share it: what
    is found for one of them holds for all, and joins by it start from one row a key.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(others or [F.lit(True).alias("none")]))
    return docs.select("doc_id", text.alias("text"), rest.alias("rest")).select(
        "doc_id",
        "text",
        "rest",
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("key_id"),
        F.xxhash64("doc_id", "text").alias("key_hash"),
    )


KEY = ["key_id", "key_hash"]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of batches, a few at a time: what a task makes of texts then stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def tasks_for(spark: SparkSession, rows: int, rows_a_task: int) -> int:
    """Partitions so that each has about rows_a_task rows, and no fewer than shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_a_task))


def cut_points(df: DataFrame, order: str, pieces: int) -> list:
    """At most `pieces` - 1 values of a column that split its rows about evenly (small sketch)."""
    found = df.agg(
        F.percentile_approx(order, [i / pieces for i in range(1, pieces)], 100 * pieces)
    ).head()[0]
    return sorted({x for x in found or [] if x is not None})


def piece_of(order: str, cuts: list) -> Column:
    """Number of cut points below a value: rows of one piece are neighbours in the order."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*[F.lit(x) for x in cuts])
    return F.coalesce(F.size(F.filter(listed, lambda x: x < F.col(order))), F.lit(0))


def ranked(df: DataFrame, group: str, order: str, name: str, pieces: int) -> DataFrame:
    """Adds a gapless position from 0 within each group, by an integer column and then by ties.

    Rows are numbered in pieces of the order, and each piece starts at the number of rows before
    it. No task holds a whole group; only one count for each piece and group is summed. The input
    must be stored, as it is read three times.
    """
    others = [c for c in df.columns if c not in (group, order)]
    cut = df.withColumn("piece", piece_of(order, cut_points(df, order, pieces)))
    counts = cut.groupBy(group, "piece").agg(F.count("*").alias("in_piece"))
    before = Window.partitionBy(group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("start_group"),
        F.col("piece").alias("start_piece"),
        F.coalesce(F.sum("in_piece").over(before), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy(group, "piece").orderBy(order, *others)
    return (
        cut.withColumn("inside", F.row_number().over(inside) - 1)
        .join(
            starts,
            F.col(group).eqNullSafe(F.col("start_group")) & (F.col("piece") == F.col("start_piece")),
        )
        .select(*df.columns, (F.col("start") + F.col("inside")).alias(name))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for each node that has an edge.

    Alternates two steps on (a, b) edges: every node hands its larger neighbours to its smallest
    neighbour, then its smaller ones. The number of rounds grows with the logarithm of a
    component's length. Each round is a table in the shared folder.
    """
    spark = edges.sparkSession

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        smallest = pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        kept = F.col("b") > F.col("a") if large else F.col("b") <= F.col("a")
        moved = pairs.where(kept).join(smallest, "a")
        out = moved.select(F.col("b").alias("a"), F.col("root").alias("b"))
        if not large:
            out = out.union(smallest.select("a", F.col("root").alias("b")))
        return out.where("a != b").distinct()

    pairs = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct()
    )
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = stored(star(large, False))
        state = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).head()
        if state == before:
            break
        before = state
    if not before[0]:
        return spark.createDataFrame([], "node long, root long")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


#: Of UTF-8 bytes: A-Z in lower case, a-z, digits and all beyond ASCII kept, the rest blank.
WORD_BYTES = bytes(
    c + 32
    if 65 <= c <= 90
    else c
    if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
    else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a whole text, as UTF-8: runs of letters, digits and characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose bits all depend on all bits of the given ones."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
