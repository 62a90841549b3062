"""WARC fixity audit: Merkle trees over records and ordered offset ranges of two replicas.

A record's digest is the SHA-256 of its fields. A leaf has all records at one offset, an inner
node a fixed number of neighbouring offset ranges, so that both replicas cut the same ranges even
where records are missing. Roots are compared first; below, only the children of nodes that differ
are joined, level by level, down to the records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import stored

FANOUT = 16


def content(fields: list[str]) -> Column:
    """Fields as one text that no other fields give: each with its length, nulls marked."""
    parts = []
    for name in fields:
        text = F.col(name).cast("string")
        parts += [F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    return F.concat(*parts)


def records(pages: DataFrame, offset: str, fields: list[str]) -> DataFrame:
    """offset (null: -1), the record's id as given, its bytes and digest."""
    own = content(fields)
    return pages.select(
        F.coalesce(F.col(offset).cast("long"), F.lit(-1)).alias("offset"),
        F.col(offset).cast("long").alias("record_id"),
        F.octet_length(own).cast("long").alias("bytes"),
        F.sha2(own.cast("binary"), 256).alias("digest"),
    )


@dataclass
class Tree:
    """Records, and nodes (place, digest) from the leaves to the root."""

    records: DataFrame
    levels: list[DataFrame]


def leaves(found: DataFrame, first: int) -> DataFrame:
    """One node for each offset, counted from the first: the number of its records and sums of the words of their digests.

    The sums don't depend on an order, so that equal offsets, however many, are added up before
    the shuffle.
    """
    words = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long") for i in range(8)]
    sums = [F.sum(w).alias(f"s{i}") for i, w in enumerate(words)]
    totals = [F.col(f"s{i}") for i in range(8)]
    return (
        found.groupBy((F.col("offset") - first).alias("place"))
        .agg(F.count("*").alias("n"), *sums)
        .select("place", F.sha2(F.concat_ws(",", "place", "n", *totals), 256).alias("digest"))
    )


def above(nodes: DataFrame, fanout: int) -> DataFrame:
    """Parents: the digest of at most `fanout` children in order."""
    children = F.array_sort(F.collect_list(F.struct("place", "digest")))
    line = F.array_join(
        F.transform(children, lambda x: F.concat(x["place"].cast("string"), F.lit("="), x["digest"])),
        ";",
    )
    return nodes.groupBy(F.floor(F.col("place") / fanout).alias("place")).agg(
        F.sha2(line, 256).alias("digest")
    )


def tree(found: DataFrame, fanout: int, first: int, height: int) -> Tree:
    """The nodes of all levels, each a table in the shared folder."""
    found = stored(found)
    levels = [stored(leaves(found, first))]
    for _ in range(height):
        levels.append(stored(above(levels[-1], fanout)))
    return Tree(found, levels)


def bounds(frames: list[DataFrame], fanout: int) -> tuple[int, int]:
    """The first offset, and the levels until the ranges of all offsets are in one node."""
    ends = [f.agg(F.min("offset"), F.max("offset")).head() for f in frames]
    known = [x for e in ends for x in e if x is not None]
    last, height = max(known, default=0) - min(known, default=0), 0
    while last:
        last, height = last // fanout, height + 1
    return min(known, default=0), height


def audit(
    pages: DataFrame,
    replica: DataFrame,
    offset: str,
    fields: list[str],
    fanout: int = FANOUT,
) -> DataFrame:
    """record_id, kind, bytes, replica_bytes, digest and replica_digest of records that differ.

    kind: `changed` where each replica has one record at an offset, else `missing` (from the
    replica) or `added` for each record that the other side has fewer times. A null offset counts
    as -1, null fields differ from empty ones, repeated records are counted, equal replicas and
    empty tables give no rows; only the offset and the fields are read.
    """
    if fanout < 2:
        raise ValueError("a node needs at least two children")
    sides = [records(x, offset, fields) for x in (pages, replica)]
    first, height = bounds(sides, fanout)
    one, two = (tree(x, fanout, first, height) for x in sides)
    places: DataFrame | None = None
    for level in range(height, -1, -1):
        a, b = one.levels[level], two.levels[level]
        if places is not None:
            inside = F.floor(F.col("place") / fanout) == F.col("parent")
            parents = places.withColumnRenamed("place", "parent")
            a, b = (x.join(parents, inside, "left_semi") for x in (a, b))
        other = b.select(F.col("place").alias("there"), F.col("digest").alias("other"))
        places = stored(
            a.join(other, F.col("place") == F.col("there"), "full")
            .where(~F.col("digest").eqNullSafe(F.col("other")))
            .select(F.coalesce("place", "there").alias("place"))
        )
    columns = ["offset", "record_id", "bytes", "digest"]
    suspect = [
        t.records.join(places, F.col("offset") - first == F.col("place"), "left_semi")
        .groupBy(*columns)
        .agg(F.count("*").alias("n"))
        for t in (one, two)
    ]
    theirs = suspect[1].select(*[F.col(c).alias(f"replica_{c}") for c in [*columns, "n"]])
    same = [F.col(c).eqNullSafe(F.col(f"replica_{c}")) for c in columns]
    both = suspect[0].join(theirs, same, "full")
    fewer = F.coalesce("n", F.lit(0)) - F.coalesce("replica_n", F.lit(0))
    differ = stored(
        both.where(fewer != 0).select(
            F.coalesce("offset", "replica_offset").alias("offset"),
            F.coalesce("record_id", "replica_record_id").alias("record_id"),
            F.coalesce("bytes", "replica_bytes").alias("bytes"),
            F.coalesce("digest", "replica_digest").alias("digest"),
            fewer.alias("fewer"),
        )
    )
    counts = differ.groupBy("offset").agg(
        F.sum(F.greatest("fewer", F.lit(0))).alias("lost"),
        F.sum(F.greatest(-F.col("fewer"), F.lit(0))).alias("gained"),
        F.min_by(F.struct("bytes", "digest"), "fewer").alias("gained_record"),
    )
    pair = (F.col("lost") == 1) & (F.col("gained") == 1)
    return (
        differ.join(counts, "offset")
        .where(~pair | (F.col("fewer") > 0))
        .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("fewer"))))
        .select(
            "record_id",
            F.when(pair, "changed").when(F.col("fewer") > 0, "missing").otherwise("added").alias("kind"),
            F.when(F.col("fewer") > 0, F.col("bytes")).alias("bytes"),
            F.when(pair, F.col("gained_record.bytes"))
            .when(F.col("fewer") < 0, F.col("bytes"))
            .alias("replica_bytes"),
            F.when(F.col("fewer") > 0, F.col("digest")).alias("digest"),
            F.when(pair, F.col("gained_record.digest"))
            .when(F.col("fewer") < 0, F.col("digest"))
            .alias("replica_digest"),
        )
    )
