"""Sharding: balanced label propagation over links between documents.

Every document starts in a shard by its rank. In each round a document moves to the shard that
most of its neighbours are in, by joins of links with labels, while a quota on linked documents
keeps the shard within its share. The most linked document of a neighbourhood stays, so that labels
spread from it instead of changing places. At last shards over their size give away documents,
those without links first, until all sizes differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import ranked, stored

SHARDS = 16
ROUNDS = 8
#: Rows of a piece of an order.
PIECE = 1_000_000


def pieces_for(rows: int) -> int:
    return max(4, min(1_000, rows // PIECE))


def of_shard(values: dict[int, int], shard: str) -> Column:
    """A number of each shard, looked up by a column."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col(shard)]


def propagated(edges: DataFrame, nodes: int, shards: int, rounds: int) -> DataFrame:
    """id and shard of the nodes of edges (a, b), ids from 0 to nodes - 1.

    A node starts in shard id mod shards. At most nodes / shards linked nodes are in a shard.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    room = nodes // shards
    degree = both.groupBy("a").agg(F.count("*").alias("degree"))
    rank = F.struct("degree", "a")
    higher = (
        both.join(degree.select(F.col("a").alias("b"), F.struct("degree", F.col("a")).alias("other")), "b")
        .groupBy("a")
        .agg(F.max("other").alias("other"))
    )
    stays = degree.join(higher, "a").select(
        F.col("a").alias("id"),
        (rank > F.struct(F.col("other.degree"), F.col("other.a"))).alias("stays"),
    )
    state = stored(
        stays.select("id", "stays", F.pmod("id", F.lit(shards)).cast("int").alias("shard"))
    )
    for _ in range(rounds):
        votes = (
            both.join(state.select(F.col("id").alias("b"), F.col("shard").alias("to")), "b")
            .groupBy("a", "to")
            .agg(F.count("*").alias("votes"), F.min("b").alias("by"))
        )
        full = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        free = {s: max(0, room - full.get(s, 0)) for s in range(shards)}
        here = state.where("NOT stays").select(F.col("id").alias("a"), "shard")
        wish = (
            votes.join(here, "a")
            .where((F.col("to") == F.col("shard")) | (of_shard(free, "to") > 0))
            .groupBy("a", "shard")
            .agg(
                F.max_by(
                    F.struct("to", "votes", "by"),
                    F.struct("votes", (F.col("to") == F.col("shard")), -F.col("to")),
                ).alias("go"),
            )
            .where("go.to != shard")
            .select(F.col("a").alias("id"), F.col("go.to").alias("to"), F.col("go.by").alias("by"))
        )
        wish = stored(wish)
        demand = {r["to"]: r["count"] for r in wish.groupBy("to").count().collect()}
        if not demand:
            break
        placed = ranked(wish, "to", "by", "place", pieces_for(sum(demand.values())))
        accepted = placed.where(F.col("place") < of_shard(free, "to")).select("id", "to")
        state = stored(
            state.join(accepted, "id", "left").select(
                "id", "stays", F.coalesce("to", "shard").alias("shard")
            )
        )
    return state.select("id", "shard")


def balanced(rows: DataFrame, edges: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """The columns of rows with shard and slot; rows have `id` from 0 without gaps.

    Slots count from 0 without gaps in each shard, and shards' numbers of rows differ by one at
    most. An empty table gives none; rows without links fill up whatever shards need them.
    """
    n = rows.count()
    moved = propagated(edges, n, shards, rounds)
    state = stored(
        rows.select("id").join(moved.withColumn("linked", F.lit(True)), "id", "left").select(
            "id",
            F.coalesce("shard", F.pmod("id", F.lit(shards)).cast("int")).alias("shard"),
            # those that stay longest come first
            (F.when(F.col("linked"), 0).otherwise(1) * F.lit(max(1, n)) + F.col("id")).alias("order"),
        )
    )
    placed = stored(ranked(state, "shard", "order", "slot", pieces_for(n)))
    size = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
    wanted = {s: n // shards + (s < n % shards) for s in range(shards)}
    surplus = placed.where(F.col("slot") >= of_shard(wanted, "shard")).select(
        "id", F.lit(0).alias("all"), "order"
    )
    surplus = ranked(stored(surplus), "all", "order", "turn", pieces_for(n))
    gaps, at = [], 0
    for s in range(shards):
        short = max(0, wanted[s] - size.get(s, 0))
        gaps.append((s, at, at + short, size.get(s, 0)))
        at += short
    target = F.coalesce(
        *[
            F.when(
                (F.col("turn") >= a) & (F.col("turn") < b),
                F.struct(F.lit(s).alias("shard"), (F.col("turn") - a + had).cast("long").alias("slot")),
            )
            for s, a, b, had in gaps
        ]
    )
    given = surplus.select("id", target.alias("given"))
    final = placed.join(given, "id", "left").select(
        "id",
        F.coalesce("given.shard", "shard").alias("shard"),
        F.coalesce("given.slot", "slot").cast("long").alias("slot"),
    )
    return rows.join(final, "id")


def numbered(docs: DataFrame) -> DataFrame:
    """id (gapless, by doc_id and text), doc_id, size, text_crc32 and text_hash of each row.

    The size is the text's UTF-8 bytes plus one; a null text has none and counts as empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.xxhash64(text).alias("text_hash"),
            F.lit(0).alias("all"),
        )
    )
    return stored(ranked(rows, "all", "doc_id", "id", pieces_for(rows.count())).drop("all"))


def copy_links(rows: DataFrame) -> DataFrame:
    """(a, b): each row of an equal text beside the first of them."""
    same = ["text_hash", "text_crc32", "size"]
    first = rows.groupBy(*same).agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1")
    return rows.join(stored(first), same).where("id != b").select(F.col("id").alias("a"), "b")
