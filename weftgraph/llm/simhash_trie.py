"""SimHash near duplicates: a self-join of binary tries of fingerprints.

Fingerprints that differ in at most r bits agree in one of r + 1 blocks of bits. Each fingerprint
is turned so that each block leads once; those that share a leading block form a trie, in which
node pairs descend together, add up the bits in which they differ, and are dropped when these
exceed the budget. Pairs whose members are already connected are dropped too: a task emits links
that connect what is within the budget, not all pairs, so a large group gives few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import KEY, components, keyed, mixed, sliced, stored, tasks_for

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
WORDS = 4
BUDGET = 4
ROWS_A_TASK = 2_000_000
#: Shingle bits and pairs that are unfolded at once.
CHUNK = 1 << 18
PAIRS = 1 << 21


#: Near duplicates by similarity: 64-bit words of a fingerprint, turns, leading bits of each turn.
WIDE = 4
TURNS = 64
LEAD = 13
#: Members of a block of a group of candidates, and shingles of one; cells of a matrix at once.
MEMBERS = 256
MASS = 1 << 19
CELLS = 1 << 23


def shingle_hashes(text: str, words: int) -> list[int]:
    found = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)] if found else []
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [
        digest(joined[a:b], SEED)
        for a, b in zip(begins[: 1 - words].tolist(), ends[words - 1 :].tolist(), strict=True)
    ]


def majority_bits(hashes: list[int] | np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; none: 0."""
    if not len(hashes):
        return 0
    all_hashes = np.array(hashes, dtype=">u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(all_hashes), CHUNK):
        part = all_hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(part, axis=1), axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(all_hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and the 64-bit fingerprint of each row's whole text, as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [
                majority_bits(shingle_hashes(text.as_py() or "", words)) for text in batch.column(1)
            ]
            bits = np.array(made, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit from the top, number of bits) of budget + 1 blocks of about the same size."""
    edges = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class Forest:
    """Smallest connected index of each of n items, in arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Joins a[i] with b[i]; returns which of the links are enough to do so."""
        used = np.zeros(len(a), bool)
        while True:
            x, y = self.root[a], self.root[b]
            high, low = np.maximum(x, y), np.minimum(x, y)
            open_ = np.flatnonzero(high != low)
            if not len(open_):
                return used
            # one link for each higher root: its lowest partner, the first of equals
            order = open_[np.lexsort((low[open_], high[open_]))]
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            self.root[high[first]] = low[first]
            used[first] = True
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def trie_links(
    keys: np.ndarray,
    lead: int,
    budget: int,
    rest: list[np.ndarray] | None = None,
    whole_budget: int = 0,
    sizes: np.ndarray | None = None,
    similar: float = 0.0,
    forest: Forest | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Links (indexes) that connect the sorted keys which agree in the first `lead` bits and
    differ in at most `budget` others; and with `rest`, further words of the fingerprints, in at
    most `whole_budget` bits in all; and with `sizes`, of sets whose sizes allow the similarity.

    `forest` has what is connected before, and gets the links."""
    n, forest = len(keys), forest or Forest(len(keys))
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        differ = np.bitwise_count(keys[x] ^ keys[y]).astype(np.int64)
        hit = differ <= budget
        if rest:
            at = np.flatnonzero(hit)
            for word in rest:
                differ[at] += np.bitwise_count(word[x[at]] ^ word[y[at]])
            hit &= differ <= whole_budget
        if sizes is not None:
            few, many = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
            hit &= few >= similar * many - 1e-9
        return hit

    def link(a: np.ndarray, b: np.ndarray) -> None:
        used = forest.link(a, b)
        out_a.append(a[used])
        out_b.append(b[used])

    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = keys[1:] >> np.uint64(64 - lead) == keys[:-1] >> np.uint64(64 - lead)
    before = np.flatnonzero(same)
    before = before[near(before, before + 1)]
    link(before, before + 1)
    start = np.concatenate([[0], np.flatnonzero(~same) + 1])
    end = np.concatenate([start[1:], [n]])
    # frontiers of node pairs: ranges a and b of the keys, and the bits in which they differ
    stack = [(lead, start, end, start, end, np.zeros(len(start), np.int64))]
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        changes = np.concatenate([[0], np.cumsum(forest.root[1:] != forest.root[:-1])])
        joined = (changes[ahi - 1] == changes[alo]) & (changes[bhi - 1] == changes[blo])
        joined &= forest.root[alo] == forest.root[blo]
        keep = ~joined & ~((alo == blo) & (ahi - alo < 2))
        alo, ahi, blo, bhi, err = (x[keep] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        if len(alo) > PAIRS:
            half = len(alo) // 2
            for part in (slice(half, None), slice(None, half)):
                stack.append((depth, *(x[part] for x in (alo, ahi, blo, bhi, err))))
            continue
        size = (ahi - alo) * (bhi - blo)
        small = (size <= 64) | (depth >= 64)
        which = np.flatnonzero(small)
        ends = np.cumsum(size[which])
        for first in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            flat = np.arange(first, min(first + PAIRS, int(ends[-1])))
            pair = np.searchsorted(ends, flat, "right")
            at, of = flat - (ends - size[which])[pair], which[pair]
            width = bhi[of] - blo[of]
            x, y = alo[of] + at // width, blo[of] + at % width
            x, y = x[x < y], y[x < y]
            hit = near(x, y)
            link(x[hit], y[hit])
        alo, ahi, blo, bhi, err = (x[~small] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        bit = np.uint64(1 << (63 - depth))
        above = ~np.uint64((1 << (64 - depth)) - 1)

        def split(lo: np.ndarray, hi: np.ndarray, bit=bit, above=above) -> np.ndarray:
            return np.clip(np.searchsorted(keys, (keys[lo] & above) | bit), lo, hi)

        amid, bmid, own = split(alo, ahi), split(blo, bhi), alo == blo
        children = [
            (alo, amid, blo, bmid, err, slice(None)),
            (amid, ahi, bmid, bhi, err, slice(None)),
            (alo, amid, bmid, bhi, err + 1, slice(None)),
            (amid, ahi, blo, bmid, err + 1, ~own),
        ]
        parts = [
            np.concatenate([(c[i] if i < 5 else None)[c[5]] for c in children]) for i in range(5)
        ]
        live = (parts[0] < parts[1]) & (parts[2] < parts[3]) & (parts[4] <= budget)
        stack.append((depth + 1, *(x[live] for x in parts)))
    return np.concatenate(out_a), np.concatenate(out_b)


def near_links(distinct: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b) fingerprints: links that connect all `bits` within the budget of each other."""
    cuts = blocks(budget)
    count = distinct.count()
    lead = [
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("bits", 64 - first - n).bitwiseAND((1 << n) - 1).alias("lead"),
        )
        for i, (first, n) in enumerate(cuts)
    ]
    tasks = tasks_for(distinct.sparkSession, count * len(cuts), ROWS_A_TASK)
    dealt = distinct.select("bits", F.explode(F.array(*lead)).alias("at")).select(
        "bits", "at.block", "at.lead"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = [
            (np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches
        ]
        if not held:
            return
        bits = np.concatenate([x[0] for x in held]).view(np.uint64)
        block = np.concatenate([x[1] for x in held])
        for i, (first, n) in enumerate(cuts):
            own = bits[block == i]
            if first:
                own = (own << np.uint64(first)) | (own >> np.uint64(64 - first))
            own = np.sort(own)
            a, b = trie_links(own, n, budget)
            if first:
                own = (own >> np.uint64(first)) | (own << np.uint64(64 - first))
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[a].view(np.int64)), pa.array(own[b].view(np.int64))], ["a", "b"]
                )

    return dealt.repartition(tasks, "block", "lead").select("bits", "block").mapInArrow(
        run, "a long, b long"
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, bits and component_id, one row for each row of docs.

    The component is named by its smallest doc_id (null if all its doc_ids are null). A null text
    counts as empty, texts without words have fingerprint 0 and are linked like any other,
    repeated rows each get their row, and an empty table gives none.
    """
    rows = stored(fingerprints(docs, words))
    distinct = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("least_id")))
    roots = components(near_links(distinct.select("bits"), budget))
    member = distinct.join(roots, distinct.bits == roots.node, "left").select(
        "bits", "least_id", F.coalesce("root", "bits").alias("root")
    )
    member = stored(member)
    least = member.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = member.join(least, "root").select("bits", "component_id")
    return rows.join(named, "bits").select("doc_id", "bits", "component_id")


# Near duplicates by similarity. Texts of similarity s (Jaccard, of shingle sets much alike in
# size) have fingerprints that differ in about acos(2 s / (1 + s)) / pi of their bits: 15 % at 0.8,
# too many for blocks that must agree. So fingerprints have several words, and each turn orders
# the bits of one word anew; two of them meet if they agree in the leading bits of some turn.
# Fingerprints only name candidates: what links texts is the similarity of their shingles.


def differing_bits(similar: float) -> float:
    """Share of bits that is expected to differ at a similarity of sets."""
    return float(np.arccos(2 * similar / (1 + similar)) / np.pi)


def set_hash(hashes: np.ndarray) -> int:
    """A signed 64-bit hash of sorted distinct hashes; of none, 0."""
    found = xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0
    return found - (1 << 64) if found >> 63 else found


def distinct_shingles(text: str, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def wide_fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """key, node, n and WIDE longs w0, w1, ... of each row: hash and number of its distinct
    shingles, and the majority of the first word of their hashes, and of hashes mixed anew."""

    def more(first: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(WIDE):
            yield first if not i else mixed(first + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = np.zeros((batch.num_rows, WIDE), np.uint64)
            of = np.zeros((batch.num_rows, 2), np.int64)
            for i, text in enumerate(batch.column("text")):
                hashes = distinct_shingles(text.as_py(), words)
                of[i] = set_hash(hashes), len(hashes)
                if len(hashes):
                    made[i] = [majority_bits(x) for x in more(hashes)]
            columns = [pa.array(of[:, i].copy()) for i in range(2)]
            columns += [pa.array(made[:, i].copy().view(np.int64)) for i in range(WIDE)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in KEY), *columns], [*KEY, "node", "n", *WORD_NAMES]
            )

    fields = ", ".join(f"{w} long" for w in WORD_NAMES)
    return docs.select("text", *KEY).mapInArrow(
        run, f"key_id long, key_hash long, node long, n long, {fields}"
    )


WORD_NAMES = [f"w{i}" for i in range(WIDE)]


def turned(word: np.ndarray, turn: int) -> np.ndarray:
    """The bits of 64-bit words in the order of a turn."""
    order = np.random.default_rng(turn).permutation(64)
    bits = np.unpackbits(word.astype(">u8").view(np.uint8)).reshape(-1, 64)[:, order]
    packed = np.ascontiguousarray(np.packbits(bits, axis=1))
    return packed.view(">u8").ravel().astype(np.uint64)


def candidate_links(distinct: DataFrame, similar: float) -> DataFrame:
    """(a, b): links that connect all nodes whose fingerprints are as near as the similarity may
    leave them.

    distinct: node, n and the words. A word and the whole fingerprint may differ in three standard
    deviations more bits than expected. Each task gives only links that connect what it finds: a
    group of thousands gives a few for each of its members, not its pairs.
    """
    share = differing_bits(similar)
    budget, most = (
        int(np.ceil(bits * share + 3 * np.sqrt(bits * share * (1 - share))))
        for bits in (64, 64 * WIDE)
    )
    tasks = tasks_for(distinct.sparkSession, distinct.count() * TURNS, ROWS_A_TASK)
    fields = ", ".join(f"{w} long" for w in WORD_NAMES)
    names = ["node", "n", *WORD_NAMES]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for turn in range(TURNS):
                word = np.asarray(batch.column(2 + turn % WIDE)).view(np.uint64)
                lead = (turned(word, turn) >> np.uint64(64 - LEAD)).astype(np.int32)
                bucket = pa.array(lead + np.int32(turn << LEAD))
                yield pa.RecordBatch.from_arrays([bucket, *batch.columns], ["bucket", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[np.asarray(c) for c in b.columns] for b in batches]
        if not held:
            return
        buckets, nodes, sizes, *words = (np.concatenate(c) for c in zip(*held, strict=True))
        for turn in range(TURNS):
            own = np.flatnonzero(buckets >> LEAD == turn)
            keys = turned(words[turn % WIDE][own].view(np.uint64), turn)
            order = np.argsort(keys)
            own, keys = own[order], keys[order]
            rest = [w[own].view(np.uint64) for i, w in enumerate(words) if i != turn % WIDE]
            a, b = trie_links(keys, LEAD, budget, rest, most, sizes[own], similar)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[own[x]]) for x in (a, b)], ["a", "b"]
                )

    dealt = distinct.select(*names).mapInArrow(deal, f"bucket int, node long, n long, {fields}")
    links = dealt.repartition(tasks, "bucket").mapInArrow(run, "a long, b long")
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common members of all pairs of sets: products of blocks of an indicator matrix."""
    n = len(sets)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(first) - 1
    # members of one set alone are common to none
    several = np.bincount(column)[column] > 1
    row, column = row[several], column[several]
    if not len(row):
        return np.zeros((n, n), np.float32)
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
    out = np.zeros((n, n), np.float32)
    step = max(1, CELLS // n)
    for low in range(0, int(column[-1]) + 1, step):
        at = slice(*np.searchsorted(column, [low, low + step]))
        part = np.zeros((n, step), np.float32)
        part[row[at], column[at] - low] = 1
        out += part @ part.T
    return out


def similar_links(distinct: DataFrame, rows: DataFrame, words: int, similar: float) -> DataFrame:
    """(a, b) nodes: links of at least the exact similarity, enough to connect all that have it
    within each group that candidates connect.

    distinct: node, n, the words, and the key of a row of `rows`. A group is dealt in blocks of
    nodes; every two blocks meet in a job that has the shingles of both, and gives a forest of
    the links it finds true. So no pair is a row, and no task holds more than two blocks.
    """
    group = components(stored(candidate_links(distinct, similar)))
    group = stored(group.join(distinct, "node").select("node", "root", "n", *KEY))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [distinct_shingles(x.as_py(), words).tobytes() for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "root")), pa.array(made, pa.binary())],
                ["node", "root", "shingles"],
            )

    texts = rows.select("text", *KEY).join(group.select("node", "root", *KEY), KEY)
    texts = texts.dropDuplicates(["node"]).select("node", "root", "text")
    sets = texts.mapInArrow(shingled, "node long, root long, shingles binary")
    sums = group.groupBy("root").agg(F.count("*").alias("nodes"), F.sum("n").alias("all"))
    size = F.greatest(F.ceil(F.col("nodes") / MEMBERS), F.ceil(F.col("all") / MASS)).cast("int")
    large = stored(sums.select("root", size.alias("blocks")).where("blocks > 1"))
    number = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("node"), number).cast("int")
    dealt = (
        sets.join(large, "root", "left")
        .withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
        .select(
            F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("job"),
            F.when(F.col("block") == F.col("other"), F.lit(2))
            .otherwise((F.col("block") > F.col("other")).cast("int"))
            .alias("side"),
            "node",
            "shingles",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches):
            side = np.asarray(rows["side"])
            # a block's own pairs have a job of their own
            if len(side) < 2 or len(np.unique(side)) < 2 and side[0] < 2:
                continue
            members = [np.frombuffer(x, np.uint64) for x in rows["shingles"].to_pylist()]
            count = np.fromiter(map(len, members), np.int64, len(members))
            both = shared_counts(members) if count.sum() else np.zeros((len(count),) * 2)
            near = both >= similar * (count[:, None] + count[None, :] - both) - 1e-9
            a, b = np.nonzero(np.triu(near, 1))
            forest = Forest(len(members))
            used = forest.link(a, b)
            nodes = np.asarray(rows["node"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[a[used]]), pa.array(nodes[b[used]])], ["a", "b"]
            )

    placed = dealt.repartition("job").sortWithinPartitions("job")
    return placed.mapInArrow(run, "a long, b long")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column, of rows in its order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = np.asarray(batch.column(0))
        if held and len(value) and np.asarray(held[-1].column(0))[-1] != value[0]:
            yield pa.Table.from_batches(held)
            held = []
        first = 0
        for end in (np.flatnonzero(value[1:] != value[:-1]) + 1).tolist():
            yield pa.Table.from_batches([*held, batch.slice(first, end - first)])
            held, first = [], end
        if first < len(value):
            held.append(batch.slice(first))
    if held:
        yield pa.Table.from_batches(held)


def without_near_duplicates(docs: DataFrame, words: int = 5, similar: float = 0.8) -> DataFrame:
    """The rows of docs, one of each group of near duplicates: that of the smallest doc_id.

    Groups connect texts whose shingles are as similar as asked, exactly; fingerprints only say where
    to look, and may miss a pair near the threshold. Of rows that repeat one stays, a null doc_id comes
    before all others, and texts without words are copies of each other.
    """
    rows = keyed(docs)
    prints = stored(wide_fingerprints(rows, words))
    distinct = stored(
        prints.groupBy("node", "n", *WORD_NAMES)
        .agg(F.min(F.struct(*KEY)).alias("key"))
        .select("node", "n", *WORD_NAMES, "key.*")
    )
    roots = components(similar_links(distinct, rows, words, similar))
    ids = keyed(docs).select(*KEY, F.struct("doc_id", *KEY).alias("first"))
    first = ids.groupBy(*KEY).agg(F.min("first").alias("first"))
    kept = (
        prints.join(first, KEY)
        .groupBy("node")
        .agg(F.min("first").alias("first"))
        .join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(*[F.col(f"first.{k}").alias(f"kept_{k}") for k in KEY])
    )
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce("doc_id", F.lit(0)).cast("long").alias("kept_key_id"),
        F.xxhash64("doc_id", F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(
            "kept_key_hash"
        ),
    )
    keys = [f"kept_{k}" for k in KEY]
    return own.dropDuplicates(keys).join(kept, keys, "left_semi").select("row.*")
