"""Document fingerprints: one-permutation MinHash with optimal densification, in low-order bits.

Each shingle is hashed once. The top bits of a hash name a bin and the least hash of a bin stands
for it. An empty bin borrows from a full one, which a hash of both bins picks evenly and in the
same way for every text. Of each bin the low-order bits are kept; that unequal hashes agree in
them by chance is taken off the estimate. All of it is expressions: no Python runs in tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import KEY, cut_points, keyed, piece_of, stored, tasks_for

WORDS = 5
BINS_LOG = 7
BINS = 1 << BINS_LOG
BITS = 8
#: Rows of a piece in which ids are put in order, and the most pieces (each cut is compared).
ORDERED = 100_000
PIECES = 1_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, words: int) -> Column:
    """Hashes of all runs of words (lower case, cut at white space); of a shorter text one."""
    found = F.array_remove(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), "")

    def runs(hashes: Column) -> Column:
        last = F.size(hashes) - words
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(*[hashes[i + k] for k in range(words)]),
            ),
        ).otherwise(
            F.when(F.size(hashes) > 0, F.array(F.xxhash64(hashes))).otherwise(
                F.array().cast("array<bigint>")
            )
        )

    return let(F.transform(found, lambda w: F.xxhash64(w)), runs)


def bin_of(x: Column) -> Column:
    return F.shiftright(x, 64 - BINS_LOG) + F.lit(BINS // 2)


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """array<int>: BITS low-order bits of each of BINS bins; empty for a text without words."""

    def least(hashes: Column) -> Column:
        # in order, the first hash of each bin is its least
        return F.filter(
            hashes,
            lambda x, i: (i == 0)
            | (bin_of(x) != bin_of(hashes[F.greatest(i - 1, F.lit(0))])),
        )

    def filled(firsts: Column) -> Column:
        def with_bins(bins: Column) -> Column:
            def one(j: Column) -> Column:
                def borrowed() -> Column:
                    # a multiple of the full bin by one of the empty bin, modulo a prime
                    rank = F.transform(
                        bins,
                        lambda b, i: F.shiftleft(
                            (b + 1) * (j * 2654435761 + 1013904223) % 1048573, BINS_LOG
                        )
                        + i,
                    )
                    return F.array_min(rank).bitwiseAND(F.lit(BINS - 1)).cast("int")

                def value(at: Column) -> Column:
                    place = F.when(at > 0, (at - 1).cast("int")).otherwise(borrowed())
                    return firsts[place].bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

                return let(F.array_position(bins, j), value)

            return F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(BINS - 1).cast("bigint")), one)

        return F.when(
            F.size(firsts) > 0, let(F.transform(firsts, bin_of), with_bins)
        ).otherwise(F.array().cast("array<int>"))

    return let(let(F.sort_array(shingle_hashes(text, words)), least), filled)


def packed(bins: Column) -> Column:
    """The low-order bits as hexadecimal digits, bin after bin."""
    return F.array_join(F.transform(bins, lambda x: F.lower(F.lpad(F.hex(x), BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles, 0 to 1; two texts without words are alike."""
    chance = 1.0 / (1 << BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(BINS)
    found = F.greatest(F.lit(0.0), (same - F.lit(chance)) / F.lit(1 - chance))
    none_a, none_b = F.size(a) == 0, F.size(b) == 0
    return F.when(none_a | none_b, F.when(none_a & none_b, 1.0).otherwise(0.0)).otherwise(found)


def following(ids: DataFrame) -> DataFrame:
    """key, next_id and next_hash of distinct (doc_id, key) in descending order; the last is
    followed by the first, a null doc_id comes after all others.

    Ids are cut into pieces of the order. The greatest id of a piece also closes the piece above,
    and that of the top piece the lowest, so that every id sees the next one in its own piece.
    """
    pieces = min(PIECES, tasks_for(ids.sparkSession, ids.count(), ORDERED))
    cuts = cut_points(ids, "doc_id", pieces)
    top = ids.orderBy(F.desc_nulls_last("doc_id"), *KEY).select("doc_id", *KEY).head()
    if top is None:
        return ids.select(*KEY, *[F.col(k).alias(f"next_{k}") for k in KEY])
    piece = piece_of("doc_id", cuts) if cuts else F.lit(0)
    own = ids.select("doc_id", *KEY, piece.alias("piece"), F.lit(0).alias("after"))
    closes = (
        own.where(F.col("doc_id").isin(cuts)).withColumn("piece", F.col("piece") + 1)
        if cuts
        else own.where("false")
    )
    wrap = own.where(
        F.col("doc_id").eqNullSafe(F.lit(top.doc_id)) & (F.col("key_hash") == top.key_hash)
    ).withColumn("piece", F.lit(0))
    order = Window.partitionBy("piece").orderBy("after", F.desc_nulls_last("doc_id"), *KEY)
    rows = own.union(closes.withColumn("after", F.lit(1))).union(wrap.withColumn("after", F.lit(2)))
    return rows.select(
        *KEY, "after", *[F.lead(k).over(order).alias(f"next_{k}") for k in KEY]
    ).where("after = 0 AND next_key_hash IS NOT NULL").drop("after")


def with_edits(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_chars, edited, bins, edited_bins, next_bins, next_doc_id: each text beside its edited one, whose
    last third is replaced by the first characters of the next document in descending doc_id.

    A null text counts as empty; rows that repeat count as one document and get a row each; the
    only document is followed by itself; other columns are not read.
    """
    rows = keyed(docs.select("doc_id", "text"))
    ids = stored(rows.select("doc_id", *KEY).distinct())
    following_ids = stored(following(ids))
    # where all columns are used, both joins share one exchange of the texts
    made = rows.select(
        "doc_id", *KEY, "text", F.length("text").alias("n"), fingerprint(F.col("text"), words).alias("bins")
    )
    sizes = rows.select(*KEY, F.floor(F.length("text") / 3).cast("int").alias("take")).distinct()
    wanted = following_ids.join(sizes, KEY).select(
        F.col("next_key_id").alias("key_id"),
        F.col("next_key_hash").alias("key_hash"),
        F.col("key_id").alias("of_id"),
        F.col("key_hash").alias("of_hash"),
        "take",
    )
    heads = (
        made.join(wanted, KEY)
        .select(
            F.col("of_id").alias("key_id"),
            F.col("of_hash").alias("key_hash"),
            F.col("text").substr(F.lit(1), F.least("take", "n")).alias("head"),
            F.col("bins").alias("next_bins"),
            F.col("doc_id").alias("next_doc_id"),
        )
        .dropDuplicates(KEY)
    )
    edited = F.concat(
        F.col("text").substr(F.lit(1), (F.col("n") - F.floor(F.col("n") / 3)).cast("int")), "head"
    )
    return (
        made.join(heads, KEY)
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_chars"),
            edited.alias("edited"),
            "bins",
            "next_bins",
            "next_doc_id",
        )
        .withColumn("edited_bins", fingerprint(F.col("edited"), words))
    )
