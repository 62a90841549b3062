"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Words are runs of letters (ASCII and the Latin-1 letters' block) of whole texts, counted over all
documents. One edit changes the counts of at most two letters. Letters fall into four sets, so that
two words one edit apart agree in the counts of two whole sets: for each choice of two sets, words
of the same counts there form a block. Within a block, words of one length are multiplied with
those of the same length and of the next: the Gram matrix of their letter counts gives all squared
distances, and only pairs at two or less have their edits verified. A pair that several blocks hold
is taken from the first of them.

A block of over `BLOCK` words is dealt in tiles of (length, hash), and pairs of tiles are jobs of
their own, so that no task holds a block whole. A word of length n has at most about 130 (n + 1)
words near it, whatever the corpus, so no group of links grows without bound.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced, stored

#: Words have at least so many letters and occurrences; a form at least so many times the word's.
LETTERS = 5
LEAST = 3
RATIO = 2
#: A run's letter is dropped where this divides the hash of its document and the run.
DROPPED = 97
#: Words that a task counts before it hands on.
COUNTED = 400_000
#: Words of a block that one job takes, and rows that are multiplied at once.
BLOCK = 8_192
ROWS = 4_096
#: Dimensions of a row of letter counts: sharing one only lowers distances, so nothing is lost.
WIDTH = 32
#: Squared counts of words below this length are exact in single precision.
EXACT = 2_048
#: Letters of pairs that are compared at once.
COMPARED = 1 << 22
SETS = 4
CHOICES = [(a, b) for a in range(SETS) for b in range(a + 1, SETS)]

#: Of Latin-1: A-Z in lower case, a-z and U+00C0 to U+00FF kept, the rest blank.
RUNS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256)
)


def runs_of(text: str) -> list[bytes]:
    """The lower-cased runs of a whole text, in Latin-1: a character beyond it ends a run."""
    return text.encode("latin-1", "replace").translate(RUNS).split()


def misspelt(run: bytes, prefix: int) -> bytes:
    """The run as it counts: one letter less where DROPPED divides the crc32 of `<doc_id>:<run>`.

    prefix is the crc32 of `<doc_id>:`.
    """
    data = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(data, prefix)
    if h % DROPPED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word (Latin-1 bytes) and n, of all words with enough letters and occurrences.

    Counts cover all rows, repeated ones too; a null doc_id is numbered by the text `null`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for found, times in Counter(runs_of(text)).items():
                    if len(found) >= LETTERS:
                        word = misspelt(found, prefix)
                        if len(word) >= LETTERS:
                            held[word] += times
            if len(held) >= COUNTED:
                yield flushed()
        if held:
            yield flushed()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    parts = rows.mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def histogram(words: list[bytes]) -> np.ndarray:
    """Letter counts in WIDTH dimensions, of the smallest floats whose products are exact."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64) % WIDTH
    row = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(row * WIDTH + flat, minlength=len(words) * WIDTH)
    kind = np.float32 if sizes.max() < EXACT else np.float64
    return counts.reshape(len(words), WIDTH).astype(kind)


def block_keys(words: list[bytes]) -> np.ndarray:
    """For each choice of two sets of letters, a hash of the counts of all letters in them.

    Equal counts have equal hashes. Unequal ones may share a hash: that only adds pairs to verify.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    weight = (flat + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    weight = (weight ^ (weight >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    starts = np.cumsum(sizes) - sizes
    sums = np.stack(
        [
            np.add.reduceat(np.where(flat % np.uint64(SETS) == s, weight, np.uint64(0)), starts)
            for s in range(SETS)
        ]
    )
    keys = []
    for turn, (a, b) in enumerate(CHOICES):
        key = sums[a] * np.uint64(0xD6E8FEB86659FD93) + sums[b] + np.uint64(turn)
        keys.append((key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB))
    return np.stack(keys)


def one_edit(
    flat: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, longer: int
) -> np.ndarray:
    """Whether words that start at a and b of flat differ by one replaced or one added letter.

    Words at a have `size` letters, those at b `longer` more (0 or 1).
    """
    out = np.zeros(len(a), bool)
    step = max(1, COMPARED // size)
    reach = np.arange(size)
    for i in range(0, len(a), step):
        here = flat[a[i : i + step, None] + reach]
        starts = b[i : i + step, None] + reach
        ahead = here == flat[starts]
        if not longer:
            out[i : i + step] = ahead.sum(axis=1) == size - 1
            continue
        # letters that agree from the left, and from the right, up to the first that differs
        behind = here == flat[starts + 1]
        left = np.cumprod(ahead, axis=1, dtype=bool).sum(axis=1)
        right = np.cumprod(behind[:, ::-1], axis=1, dtype=bool).sum(axis=1)
        out[i : i + step] = left + right >= size
    return out


def near_rows(words: list[bytes], group: np.ndarray, turn: np.ndarray) -> Iterator[np.ndarray]:
    """Pairs (rows a, rows b) of words one edit apart within a group, each from its first choice.

    Words of each length are multiplied with those of the same and of the next length.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    at = np.cumsum(sizes) - sizes
    counts, keys = histogram(words), block_keys(words)
    half = (counts * counts).sum(axis=1, keepdims=True) / 2
    one = np.ones_like(half)
    # the product of these two is minus half the squared distance
    first, second = np.hstack([counts, -half, one]), np.hstack([counts, one, -half])
    order = np.argsort(sizes, kind="stable")
    lengths, starts = np.unique(sizes[order], return_index=True)
    where = dict(zip(lengths.tolist(), np.split(order, starts[1:]), strict=True))
    for length, rows in where.items():
        for others in (rows, where.get(length + 1)):
            if others is None:
                continue
            for i in range(0, len(rows), ROWS):
                for j in range(i if others is rows else 0, len(others), ROWS):
                    x, y = rows[i : i + ROWS], others[j : j + ROWS]
                    p, q = np.nonzero(first[x] @ second[y].T > -1.25)
                    a, b = x[p], y[q]
                    if others is rows:
                        a, b = a[a < b], b[a < b]
                    take = group[a] == group[b]
                    a, b = a[take], b[take]
                    agreed = (keys[:, a] == keys[:, b]).argmax(axis=0)
                    take = agreed == turn[a]
                    a, b = a[take], b[take]
                    take = one_edit(flat, at[a], at[b], length, int(others is not rows))
                    if take.any():
                        yield np.stack([a[take], b[take]])


def jobs_of(words: DataFrame) -> DataFrame:
    """job, part (0 or 1), block, turn, word and n: each word under the jobs it takes part in.

    Small blocks are one job. In a large one, tiles of words of one length meet tiles of the same
    and of the next length; `part` tells the sides of such a meeting apart (null: one tile alone).
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 8_192):
            found = batch.column(0).to_pylist()
            for turn, keys in enumerate(block_keys(found)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64)),
                        pa.array(np.full(len(found), turn, np.int32)),
                        batch.column(0),
                        batch.column(1),
                    ],
                    ["block", "turn", "word", "n"],
                )

    rows = words.mapInArrow(keyed, "block long, turn int, word binary, n long")
    rows = stored(rows.withColumn("size", F.octet_length("word")))
    by_size = stored(rows.groupBy("block", "size").agg(F.count("*").alias("here")))
    total = by_size.groupBy("block").agg(F.sum("here").alias("all"))
    small = total.where((F.col("all") > 1) & (F.col("all") <= BLOCK)).select("block")
    large = by_size.join(total.where(F.col("all") > BLOCK), "block").select(
        "block", "size", F.ceil(F.col("here") / (BLOCK // 2)).cast("int").alias("tiles")
    )
    own = large.select("block", "size", "tiles")
    for step, name in ((1, "after"), (-1, "before")):
        beside = large.select("block", (F.col("size") - step).alias("size"), F.col("tiles").alias(name))
        own = own.join(beside, ["block", "size"], "left")
    tile = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")

    def meetings() -> Column:
        """(size, tile) of the one side and (size, tile) of the other, with the word's side."""

        def pair(size_a, a, size_b, b, part):
            return F.struct(
                size_a.cast("int").alias("size_a"), a.cast("int").alias("a"),
                size_b.cast("int").alias("size_b"), b.cast("int").alias("b"),
                part.cast("int").alias("part"),
            )

        def turns(count):
            # a size that no word has gives no meetings
            return F.filter(
                F.sequence(F.lit(0), F.greatest(F.coalesce(count, F.lit(0)), F.lit(1)) - 1),
                lambda i: i < F.coalesce(count, F.lit(0)),
            )

        size, me = F.col("size"), F.col("tile")
        same = F.transform(
            turns(F.col("tiles")),
            lambda i: pair(
                size, F.least(i, me), size, F.greatest(i, me),
                F.when(i == me, F.lit(None)).otherwise(F.when(me < i, 0).otherwise(1)),
            ),
        )
        after = F.transform(turns(F.col("after")), lambda i: pair(size, me, size + 1, i, F.lit(0)))
        before = F.transform(turns(F.col("before")), lambda i: pair(size - 1, i, size, me, F.lit(1)))
        return F.concat(same, after, before)

    alone = rows.join(small, "block").select(
        F.col("block").alias("job"), F.lit(None).cast("int").alias("part"), "block", "turn", "word", "n"
    )
    dealt = (
        rows.join(own, ["block", "size"])
        .withColumn("tile", tile)
        .withColumn("meeting", F.explode(meetings()))
        .select(
            F.xxhash64(
                "block", "meeting.size_a", "meeting.a", "meeting.size_b", "meeting.b"
            ).alias("job"),
            F.col("meeting.part").alias("part"),
            "block",
            "turn",
            "word",
            "n",
        )
    )
    return alone.union(dealt)


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other and other_n: each pair of words one edit apart, once (a table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def paired(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            jobs = rows["job"].to_numpy()
            found = rows["word"].to_pylist()
            part = rows["part"].fill_null(2).to_numpy()
            turn, n = rows["turn"].to_numpy(), rows["n"].to_numpy()
            for a, b in near_rows(found, jobs, turn):
                # two sides of a meeting: a tile's own pairs belong to its own job
                take = (part[a] == 2) | (part[a] != part[b])
                a, b = a[take], b[take]
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([found[i] for i in a], pa.binary()), pa.array(n[a]),
                            pa.array([found[i] for i in b], pa.binary()), pa.array(n[b]),
                        ],
                        ["word", "n", "other", "other_n"],
                    )

        last = None
        for batch in batches:
            jobs = batch.column(0).to_numpy()
            # whole jobs are multiplied together once there are enough rows of them
            ends = np.flatnonzero(jobs[1:] != jobs[:-1]) + 1
            first = 0
            if last is not None and len(jobs) and jobs[0] != last and count >= ROWS:
                yield from paired(pa.Table.from_batches(held))
                held, count = [], 0
            for end in ends.tolist():
                if count + end - first >= ROWS:
                    held.append(batch.slice(first, end - first))
                    yield from paired(pa.Table.from_batches(held))
                    held, count, first = [], 0, end
            if first < len(jobs):
                held.append(batch.slice(first))
                count += len(jobs) - first
            if len(jobs):
                last = jobs[-1]
        if held:
            yield from paired(pa.Table.from_batches(held))

    dealt = jobs_of(words).repartition("job").sortWithinPartitions("job")
    return stored(dealt.mapInArrow(run, "word binary, n long, other binary, other_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, of (word, form) rows without nulls: the last word that forms lead to.

    A form has at least RATIO times its word's occurrences, so there are no circles. Each round
    doubles the steps taken, so their number is the logarithm of the longest way.
    """
    state = stored(forms.select("word", F.col("form").alias("at"), F.lit(True).alias("open")))
    while not state.where("open").isEmpty():
        further = state.select(F.col("word").alias("at"), F.col("at").alias("next"))
        moved = state.where("open").join(further, "at", "left").select(
            "word", F.coalesce("next", "at").alias("at"), F.col("next").isNotNull().alias("open")
        )
        state = stored(state.where("NOT open").union(moved))
    return state.select("word", F.col("at").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of documents.

    form is the near word of the most occurrences (ties: the first in code-point order) if it has
    RATIO times the word's, else null; root is where forms lead to, the word itself if nowhere.
    Null and empty texts have no words, an empty table gives no rows.
    """
    words = stored(word_counts(docs))
    pairs = near_pairs(words)
    both = pairs.union(pairs.select("other", "other_n", "word", "n"))
    best = both.groupBy("word", "n").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other"))).alias("best"),
    )
    enough = -F.col("best.order") >= RATIO * F.col("n")
    found = stored(
        best.select(
            "word",
            "n_near",
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.order")).alias("form_n"),
        )
    )
    last = roots(found.where("form IS NOT NULL").select("word", "form"))

    def text(name: str) -> Column:
        return F.decode(name, "ISO-8859-1")

    return (
        words.join(found, "word", "left")
        .join(last, "word", "left")
        .select(
            text("word").alias("word"),
            text("form").alias("form"),
            F.coalesce(text("root"), text("word")).alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.col("form_n").cast("long").alias("form_n"),
        )
    )
