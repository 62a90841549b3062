"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

The counts of all n-grams of all training texts are added up over the corpus. A count is quantised
to a level, the logarithm of it to a base, and an n-gram is put into the filter once for each level
up to its own, by hashes of the n-gram and the level. A worker finds a count by repeated membership
probes, level by level until one fails. Probabilities are smoothed over the orders:

    p(w) = (low(w) + 1) / (Z + V + 1)
    p(w | h) = (low(h w) + MASS p(w | h')) / (high(h) + MASS)

where low and high are the least and the greatest count of a level, Z the sum of low(w), V the
number of training tokens and h' the context without its first token. As low never exceeds a count
and high never falls below one, the probabilities of a context's words sum to one at most (but for
false members of the filter, about one in a hundred probes). All bits of one entry lie in one word
of 64 bits, so that a probe reads one place of the filter.

The filter is broadcast. Its size follows the corpus until `BITS`, the bound; beyond it the rarest
levels of the order that takes most are left out, as far as needed and nowhere else. With `whole`,
as in the query, n-grams that the filter does not have then get their level from the exact counts;
without it they count as unseen and fall back on the shorter context. Counts themselves are never
cut.

Exact counts of single tokens are a table. Tokens that have at least one in `HOT` of all tokens, of
which there are at most HOT, are broadcast; all others are asked for.

What is asked for travels packed: a task asks for the different n-grams of some megabytes of texts
at once, each part of the hashes meets its counts, and the answers go back to those texts, of which
only levels and places of answers were kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm.common import mixed, sliced, stored

ORDER = 2
#: Base of the logarithm that makes levels, and the weight of the shorter context.
BASE = 1.5
MASS = 500.0
#: Greatest size of the broadcast filter, its bits for each entry of a level, and those set by it.
BITS = 1 << 29
ENTRY_BITS = 12
HASHES = 5
#: A token is broadcast with its exact count if it is one of so many tokens of the corpus.
HOT = 1 << 20
#: Tokens that a task counts before it hands on, and text bytes of a part of all n-grams.
COUNTED = 1_200_000
PART_BYTES = 1 << 23
#: Rows of texts that are taken at once.
ROWS = 512
#: Bytes of texts whose n-grams are asked for together, and n-grams that are probed at once.
ASKED_BYTES = 1 << 23
PROBED = 1 << 17

#: Hashes of the tokens that end and that begin a text: of no word, as words have no blanks.
END = np.uint64(xxhash.xxh64_intdigest(b" end"))
BEGIN = np.uint64(xxhash.xxh64_intdigest(b" begin"))
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
HALF = np.uint64(32)
#: Different words of set bits, a power of two.
MASKS = 1 << 14


def least_counts(base: float, levels: int = 100) -> np.ndarray:
    """The least count of each level from 0: level i has the counts [i] to [i + 1] - 1."""
    edges = [0]
    for i in range(levels):
        edges.append(max(edges[-1] + 1, int(np.ceil(base**i - 1e-9))))
    return np.array(edges, np.int64)


EDGES = least_counts(BASE)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(EDGES, counts, "right") - 1


@dataclass
class Texts:
    """Tokens of some texts in one row: each text behind its beginnings, its end as the last."""

    tokens: np.ndarray
    #: The text of each token, and False where a token is a beginning.
    text: np.ndarray
    real: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes | None], order: int) -> Texts:
        """Words are runs without blanks, with A-Z in lower case; a null text counts as empty."""
        begins, parts, sizes = np.full(max(1, order - 1), BEGIN), [], []
        for text in texts:
            found = (text or b"").lower().split()
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
            parts += [begins, hashes, np.array([END])]
            sizes.append(len(found) + len(begins) + 1)
        tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return cls.laid(tokens, np.array(sizes, np.int64), order)

    @classmethod
    def laid(cls, tokens: np.ndarray, sizes: np.ndarray, order: int) -> Texts:
        """Texts of these sizes, with their beginnings and ends."""
        at = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return cls(tokens, np.repeat(np.arange(len(sizes)), sizes), at >= max(1, order - 1))

    def sizes(self, texts: int) -> np.ndarray:
        return np.bincount(self.text, minlength=texts)

    def grams(self, order: int) -> list[np.ndarray]:
        """For 1 to order: hash of the n-gram that ends at each token (over texts' bounds too)."""
        out = [self.tokens]
        for n in range(2, order + 1):
            longer = self.tokens + np.uint64(n)
            longer[1:] += out[-1][:-1] * GOLDEN
            out.append(mixed(longer))
        return out

    def inside(self, order: int) -> np.ndarray:
        """Whether the n-gram that ends at each token begins in the same text."""
        same = np.zeros(len(self.text), bool)
        same[order - 1 :] = self.text[order - 1 :] == self.text[: len(self.text) - order + 1]
        return same


def slots(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash, by its upper bits; parts is a power of two."""
    return (hashes >> np.uint64(32)).astype(np.int64) * parts >> 32


def tags(hashes: np.ndarray, parts: int) -> np.ndarray:
    """What tells the n-grams of one part apart: the 32 bits below those of the part.

    With some 10 ** 6 n-grams a part, one in some thousands shares its tag with another.
    """
    return (hashes >> np.uint64(33 - parts.bit_length())).astype(np.uint32)


def bit_masks() -> np.ndarray:
    """Words of 64 bits with HASHES of them set: a hash chooses one for an entry."""
    chosen = np.random.default_rng(1).random((MASKS, 64)).argsort(axis=1)[:, :HASHES]
    return np.left_shift(np.uint64(1), chosen.astype(np.uint64)).sum(axis=1, dtype=np.uint64)


def entry_hashes(tag: np.ndarray, level: int) -> np.ndarray:
    """Hash of an n-gram at a level: the upper half chooses the word, the lower the bits."""
    salt = np.uint64((level + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
    return mixed((tag.astype(np.uint64) + np.uint64(1)) * GOLDEN + salt)


def word_places(h: np.ndarray, size: np.ndarray | np.uint64) -> np.ndarray:
    """The word of an entry among those of its part."""
    return ((h >> HALF) * size >> HALF).astype(np.int64)


def packed(counts: np.ndarray) -> bytes:
    """Counts in a byte each, with those of 255 and more behind them."""
    large = counts[counts >= 255].astype("<i8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=n)
    return counts


def planes(values: np.ndarray) -> bytes:
    """Whole numbers with bytes of equal weight together, so that they pack well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind: type, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    rows = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
    return np.ascontiguousarray(rows.T).reshape(-1).view(kind)


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as what each is more than the one before it."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return zstandard.compress(planes(steps), 3)


def unpacked_keys(data: bytes, kind: type) -> np.ndarray:
    data = zstandard.decompress(data)
    return np.cumsum(from_planes(data, kind, len(data) // np.dtype(kind).itemsize), dtype=kind)


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different keys in order, and the sums of their counts; without counts, how often each is there."""
    if counts:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    else:
        keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    if not counts:
        return keys[first], np.diff(np.r_[first, len(keys)])
    return keys[first], *(np.add.reduceat(c[order], first) if len(first) else c for c in counts)


PARTS_SCHEMA = "gram int, part int, keys binary, learnt binary, whole binary"
PARTS = ["gram", "part", "keys", "learnt", "whole"]
PART_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def part_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in PARTS]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, PART_TYPES, strict=True)], PARTS
    )


def counted(docs: DataFrame, learn: Column, order: int, parts: int) -> DataFrame:
    """A table of counts: a row for each order and part of the n-grams' hashes.

    Rows of order 1 have tokens' hashes, their counts in rows to learn from and in all rows; the
    others have tags of n-grams in rows to learn from. Each task adds up what it read before it
    hands on, and the rows of a part are added up in one task: parts grow in number, not in size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[Texts, np.ndarray]] = []
        n = 0

        def flushed() -> pa.RecordBatch:
            rows = []
            tokens = np.concatenate([t.tokens for t, _ in held])
            learnt = np.concatenate([x for _, x in held]).astype(np.int32)
            keys, some, every = summed(tokens, learnt, np.ones(len(tokens), np.int32))
            del tokens, learnt
            ends = np.searchsorted(slots(keys, parts), np.arange(parts + 1))
            for part in np.flatnonzero(np.diff(ends)).tolist():
                cut = slice(ends[part], ends[part + 1])
                rows.append((1, part, packed_keys(keys[cut]), packed(some[cut]), packed(every[cut])))
            for gram in range(2, order + 1):
                found = [t.grams(gram)[-1][t.inside(gram) & x] for t, x in held]
                keys, some = summed(np.concatenate(found))
                ends = np.searchsorted(slots(keys, parts), np.arange(parts + 1))
                small = tags(keys, parts)
                for part in np.flatnonzero(np.diff(ends)).tolist():
                    cut = slice(ends[part], ends[part + 1])
                    rows.append((gram, part, packed_keys(small[cut]), packed(some[cut]), None))
            held.clear()
            return part_rows(rows)

        for batch in sliced(batches, ROWS):
            texts = Texts.of(batch.column(0).to_pylist(), order)
            used = np.array(batch.column(1).to_pylist(), bool)
            held.append((texts, used[texts.text]))
            n += len(texts.tokens)
            if n >= COUNTED:
                yield flushed()
                n = 0
        if held:
            yield flushed()

    def merge(table: pa.Table) -> pa.Table:
        gram, part = table["gram"][0].as_py(), table["part"][0].as_py()
        kind = np.uint64 if gram == 1 else np.uint32
        blobs = [unpacked_keys(x, kind) for x in table["keys"].to_pylist()]

        def counts(name: str) -> np.ndarray:
            both = zip(table[name].to_pylist(), blobs, strict=True)
            return np.concatenate([unpacked(x, len(b)) for x, b in both])

        keys = np.concatenate(blobs)
        if gram == 1:
            keys, some, every = summed(keys, counts("learnt"), counts("whole"))
            row = (gram, part, packed_keys(keys), packed(some), packed(every))
        else:
            keys, some = summed(keys, counts("learnt"))
            row = (gram, part, packed_keys(keys), packed(some), None)
        return pa.Table.from_batches([part_rows([row])])

    text = F.col("text").cast("string").cast("binary")
    rows = docs.select(text.alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    found = rows.mapInArrow(count, PARTS_SCHEMA)
    return stored(found.groupBy("gram", "part").applyInArrow(merge, PARTS_SCHEMA))


def arrays_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Keys and counts of a row of `counted`."""
    keys = unpacked_keys(row["keys"], np.uint64 if row["gram"] == 1 else np.uint32)
    whole = None if row["whole"] is None else unpacked(row["whole"], len(keys))
    return keys, unpacked(row["learnt"], len(keys)), whole


def token_rows(counts: DataFrame) -> DataFrame:
    """token (hash), learnt and whole: exact counts of single tokens, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            keys, learnt, whole = arrays_of(batch.to_pylist()[0])
            take = keys != BEGIN
            columns = [keys.view(np.int64)[take], learnt[take], whole[take]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["token", "learnt", "whole"]
            )

    return counts.where("gram = 1").mapInArrow(run, "token long, learnt long, whole long")


def level_sums(counts: DataFrame) -> list:
    """For each order and level (100 at most): n-grams, and the sums of their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            row = batch.to_pylist()[0]
            keys, learnt, whole = arrays_of(row)
            # the beginning of texts is a context, not a token to be predicted
            apart = (keys == BEGIN) if row["gram"] == 1 else np.zeros(len(keys), bool)
            whole = learnt if whole is None else whole
            table: list[tuple] = []
            for begin in (False, True):
                take = apart == begin
                level = levels_of(learnt[take])
                n = np.bincount(level)
                sums = [np.bincount(level, x[take]) for x in (learnt, whole)]
                table += [
                    (row["gram"], begin, int(i), int(n[i]), *(int(s[i]) for s in sums))
                    for i in np.flatnonzero(n)
                ]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, x, strict=True)) for x in table], schema
            )

    names = ["gram", "begin", "level", "n", "learnt", "whole"]
    kinds = [pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    rows = counts.mapInArrow(
        run, "gram int, begin boolean, level int, n long, learnt long, whole long"
    )
    sums = [F.sum(x).alias(x) for x in ("n", "learnt", "whole")]
    return rows.groupBy("gram", "begin", "level").agg(*sums).collect()


def thresholds(sums: list, order: int, bits: int, lowest: int = 1) -> dict[int, int]:
    """The least level of each order that the filter has, so that it keeps within its bits.

    It is `lowest` at least for n-grams of two tokens and more.
    """
    entries = {g: {} for g in range(1, order + 1)}
    for r in sums:
        if r["level"]:
            entries[r["gram"]][r["level"]] = entries[r["gram"]].get(r["level"], 0) + r["n"]
    least = {g: lowest if g > 1 else 1 for g in entries}

    def needed(gram: int) -> int:
        from_here = least[gram] - 1
        return ENTRY_BITS * sum(n * (i - from_here) for i, n in entries[gram].items() if i > from_here)

    while sum(map(needed, entries)) > bits:
        least[max(entries, key=needed)] += 1
    return least


def filter_rows(counts: DataFrame, parts: int, least: dict[int, int]) -> DataFrame:
    """gram, part and bits: the filter's piece for each part of the n-grams, whole words."""
    masks = bit_masks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            row = batch.to_pylist()[0]
            keys, learnt, _ = arrays_of(row)
            tag = tags(keys, parts) if row["gram"] == 1 else keys
            level, low = levels_of(learnt), least[row["gram"]]
            entries = int(np.maximum(level - low + 1, 0).sum())
            size = -(-entries * ENTRY_BITS // 64)
            bits = np.zeros(size, np.uint64)
            for i in range(low, int(level.max(initial=0)) + 1):
                h = entry_hashes(tag[level >= i], i)
                np.bitwise_or.at(bits, word_places(h, np.uint64(size)), masks[h & np.uint64(MASKS - 1)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["gram"]], pa.int32()), pa.array([row["part"]], pa.int32()),
                    pa.array([bits.tobytes()], pa.binary()),
                ],
                ["gram", "part", "bits"],
            )

    return counts.mapInArrow(run, "gram int, part int, bits binary")


@dataclass
class Filter:
    """The filter of all orders: words of bits, where each part of an order begins, and its size."""

    parts: int
    least: dict[int, int]
    bits: np.ndarray
    starts: dict[int, np.ndarray]
    sizes: dict[int, np.ndarray]
    masks: np.ndarray

    def levels(self, gram: int, hashes: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 if the filter does not have it: probed level by level."""
        out = np.zeros(len(hashes), np.int64)
        part, tag = slots(hashes, self.parts), tags(hashes, self.parts)
        size, start = self.sizes[gram][part], self.starts[gram][part]
        alive = np.flatnonzero(size)
        for level in range(self.least[gram], len(EDGES) - 1):
            if not len(alive):
                break
            h = entry_hashes(tag[alive], level)
            mask = self.masks[h & np.uint64(MASKS - 1)]
            word = self.bits[start[alive] + word_places(h, size[alive])]
            alive = alive[word & mask == mask]
            out[alive] = level
        return out


@dataclass
class Model:
    """Small numbers and the filter (to broadcast), and the exact counts as tables."""

    order: int
    #: Tokens learnt from, distinct ones, and the sum of the least counts of their levels: of those
    #: that the filter has, and of all.
    tokens: int
    distinct: int
    mass: int
    whole_mass: int
    filter: Filter
    #: Hashes of hot tokens in order and their exact counts, and those of all n-grams (`counted`).
    hot: np.ndarray
    hot_counts: np.ndarray
    counts: DataFrame | None = field(repr=False)

    def tables(self) -> dict:
        names = ("order", "tokens", "distinct", "mass", "whole_mass", "hot", "hot_counts")
        return {name: getattr(self, name) for name in names} | {"filter": vars(self.filter)}

    @classmethod
    def of(cls, tables: dict) -> Model:
        return cls(**tables | {"filter": Filter(**tables["filter"])}, counts=None)


def gathered(counts: DataFrame, parts: int, least: dict[int, int]) -> Filter:
    """The filter in one piece on the driver; the pieces that came are let go at once."""
    sizes = {g: np.zeros(parts, np.uint64) for g in least}
    starts = {g: np.zeros(parts, np.int64) for g in least}
    at, held = 0, [np.zeros(0, np.uint64)]
    for r in filter_rows(counts, parts, least).collect():
        held.append(np.frombuffer(r["bits"], np.uint64))
        sizes[r["gram"]][r["part"]], starts[r["gram"]][r["part"]] = len(held[-1]), at
        at += len(held[-1])
    return Filter(parts, least, np.concatenate(held), starts, sizes, bit_masks())


def fitted(
    docs: DataFrame, learn: Column, order: int = ORDER, bits: int = BITS, lowest: int = 1
) -> Model:
    """Counts the rows of docs for which learn holds, and builds the filter.

    With `lowest` 2, n-grams of two tokens and more are in the filter from the second level on: those
    that are there once take most of it. Only `scored` with `whole` then has all of them.

    To the driver come the filter (`bits` at most), at most HOT tokens, and sums of each level.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).head()[0] or 0
    parts = 1 << (size // PART_BYTES).bit_length()
    counts = counted(docs, learn, order, parts)
    sums = level_sums(counts)
    own = [r for r in sums if r["gram"] == 1 and not r["begin"]]
    least = thresholds(sums, order, bits, lowest)
    whole = sum(r["whole"] for r in own)
    tokens = token_rows(counts)
    hot = tokens.where(F.col("whole") * HOT >= whole).select("token", "learnt").toArrow()
    hashes = hot["token"].to_numpy().astype(np.int64).view(np.uint64)
    in_order = np.argsort(hashes)
    return Model(
        order,
        sum(r["learnt"] for r in own),
        sum(r["n"] for r in own if r["level"]),
        sum(int(EDGES[r["level"]]) * r["n"] for r in own if r["level"] >= least[1]),
        sum(int(EDGES[r["level"]]) * r["n"] for r in own),
        gathered(counts, parts, least),
        hashes[in_order],
        hot["learnt"].to_numpy().astype(np.int64)[in_order],
        counts,
    )


def smoothed(levels: list[np.ndarray], model: Model, whole: bool) -> np.ndarray:
    """Smoothed probability of each token, from the levels of each order's n-grams that end there.

    With `whole`, no level is missing because the filter had no room.
    """
    least = dict.fromkeys(model.filter.least, 1) if whole else model.filter.least
    mass = model.whole_mass if whole else model.mass
    p = (EDGES[levels[0]] + 1) / (mass + model.distinct + 1)
    for n in range(2, model.order + 1):
        unseen = EDGES[least[n - 1]] - 1
        high = np.where(levels[n - 2], EDGES[levels[n - 2] + 1] - 1, unseen)
        context = np.r_[0, high[:-1]][: len(high)]
        p = np.minimum((EDGES[levels[n - 1]] + MASS * p) / (context + MASS), 1.0)
    return p


def probabilities(texts: Texts, model: Model) -> np.ndarray:
    """Probabilities by the filter alone (those of beginnings have no meaning)."""
    grams = enumerate(texts.grams(model.order), 1)
    return smoothed([model.filter.levels(n, hashes) for n, hashes in grams], model, False)


def hot_places(tokens: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each token among the hot ones, and whether it is one."""
    if not len(hot):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    return at, hot[at] == tokens


CHUNK_SCHEMA = "chunk long, gram int, part long, data binary"
CHUNK = ["chunk", "gram", "part", "data"]
CHUNK_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def chunk_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in CHUNK]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, CHUNK_TYPES, strict=True)], CHUNK
    )


#: Of a text in a chunk: its doc_id and whether it has one, its tokens with beginnings and end, how
#: many of them are hot and known, and the sum of their logarithms.
TEXT = np.dtype([("doc_id", "<i8"), ("valid", "?"), ("size", "<i8"), ("known", "<i8"), ("log", "<f8")])


#: Marks the level of an n-gram that is asked for.
ASKED = 128


def kept_bytes(texts: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> bytes:
    """What is kept of a chunk: its texts, and for each order levels (with marks), numbers of what
    was asked for before (else 0), and the parts that were asked, in order of the first places."""
    out = [np.array([len(texts)], "<i8").tobytes(), texts.tobytes()]
    for level, number, part in grams:
        out += [level.astype(np.uint8).tobytes(), planes(number.astype("<u4")), planes(part.astype("<u4"))]
    return zstandard.compress(b"".join(out), 3)


def kept_arrays(data: bytes, order: int) -> tuple[np.ndarray, Texts, list[tuple]]:
    """The texts and their layout, and for each order: which tokens, levels and numbers of what was
    asked for (0: nothing), and the parts."""
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    rows = np.frombuffer(data, TEXT, n, 8)
    at, size = 8 + rows.nbytes, int(rows["size"].sum())
    texts = Texts.laid(np.zeros(size, np.uint64), rows["size"], order)
    grams = []
    for gram in range(1, order + 1):
        inside = texts.inside(gram)
        m = int(inside.sum())
        level = np.frombuffer(data, np.uint8, m, at)
        marked = level >= ASKED
        number = from_planes(data, "<u4", int(marked.sum()), at + m)
        first = number == 0
        part = from_planes(data, "<u4", int(first.sum()), at + m + number.nbytes)
        place = np.zeros(m, np.int64)
        place[marked] = np.where(first, np.cumsum(first), number)
        grams.append((inside, level.astype(np.int64) % ASKED, place, part))
        at += m + number.nbytes + part.nbytes
    return rows, texts, grams


def asked(rows: DataFrame, model: Model, shared, whole: bool) -> DataFrame:
    """For each chunk of texts: what is kept of it (gram 0), and the keys that each part is asked for.

    Asked for are the different tokens that are not hot and, with `whole`, n-grams that the filter
    does not have where it had no room for all.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of(shared.value)
        parts = own.filter.parts
        chunk = TaskContext.get().partitionId() << 32
        ids, held, n = [], [], 0

        def flushed() -> pa.RecordBatch:
            texts = Texts.of(held, own.order)
            kept = np.zeros(len(ids), TEXT)
            kept["doc_id"], kept["valid"] = [x or 0 for x in ids], [x is not None for x in ids]
            kept["size"] = texts.sizes(len(ids))
            grams, out = [], []
            for gram, hashes in enumerate(texts.grams(own.order), 1):
                different, place, back = np.unique(
                    hashes[texts.inside(gram)], return_index=True, return_inverse=True
                )
                level = np.zeros(len(different), np.uint8)
                for first in range(0, len(different), PROBED):
                    cut = slice(first, first + PROBED)
                    level[cut] = own.filter.levels(gram, different[cut])
                wanted = np.zeros(len(different), bool)
                if gram == 1:
                    at, is_hot = hot_places(different, own.hot)
                    count = np.where(is_hot, own.hot_counts[at] if len(own.hot) else 0, 0)
                    text, real = texts.text[texts.real], back[texts.real]
                    kept["known"] = np.bincount(text, (count > 0)[real], len(ids))
                    kept["log"] = np.bincount(text, np.log10(count + 1.0)[real], len(ids))
                    wanted = ~is_hot
                    if whole:
                        level = np.where(level == 0, levels_of(count), level)
                elif whole and own.filter.least[gram] > 1:
                    wanted = level == 0
                # what is wanted, in order of the places where it stands first
                own_order = np.flatnonzero(wanted)
                own_order = own_order[np.argsort(place[own_order])]
                number = np.zeros(len(different), np.int64)
                number[own_order] = np.arange(1, len(own_order) + 1)
                marked = wanted[back]
                again = np.where(place[back] == np.arange(len(back)), 0, number[back])[marked]
                keys = different[own_order]
                part_of = slots(keys, parts)
                grams.append((level[back] + ASKED * marked, again, part_of))
                by_part = np.argsort(part_of, kind="stable")
                ends = np.searchsorted(part_of[by_part], np.arange(parts + 1))
                keys = (keys if gram == 1 else tags(keys, parts))[by_part]
                for part in np.flatnonzero(np.diff(ends)).tolist():
                    out.append((chunk, gram, part, keys[ends[part] : ends[part + 1]].tobytes()))
            out.append((chunk, 0, chunk, kept_bytes(kept, grams)))
            ids.clear()
            held.clear()
            return chunk_rows(out)

        for batch in sliced(batches, ROWS):
            both = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for doc_id, text in both:
                ids.append(doc_id)
                held.append(text)
                n += len(text or b"") + 16
                if n >= ASKED_BYTES:
                    yield flushed()
                    chunk, n = chunk + 1, 0
        if held:
            yield flushed()

    return rows.mapInArrow(ask, CHUNK_SCHEMA)


def answer(key: tuple, questions: pa.Table, counts: pa.Table) -> pa.Table:
    """Counts of the tokens, or levels of the n-grams, that the chunks ask of a part, in their order."""
    gram = key[0].as_py()
    if gram == 0 or not questions.num_rows:
        return questions.select(CHUNK)
    known, learnt = np.zeros(0, np.uint64 if gram == 1 else np.uint32), np.zeros(0, np.int64)
    for row in counts.to_pylist():
        known, learnt, _ = arrays_of(row)
    out = []
    for row in questions.to_pylist():
        wanted = np.frombuffer(row["data"], known.dtype)
        at, there = hot_places(wanted, known)
        found = np.where(there, learnt[at] if len(known) else 0, 0)
        if gram == 1:
            data = np.array([len(found)], "<i8").tobytes() + packed(found)
        else:
            data = levels_of(found).astype(np.uint8).tobytes()
        out.append((row["chunk"], gram, row["part"], zstandard.compress(data, 3)))
    return pa.Table.from_batches([chunk_rows(out)])


def answers_of(rows: list[dict], gram: int, part: np.ndarray) -> np.ndarray:
    """All answers to a chunk by their numbers, behind a zero for what was not asked."""
    blobs = [r for r in sorted(rows, key=lambda r: r["part"]) if r["gram"] == gram]
    blobs = [zstandard.decompress(r["data"]) for r in blobs]
    if gram == 1:
        found = [unpacked(x[8:], int(np.frombuffer(x, "<i8", 1)[0])) for x in blobs]
    else:
        found = [np.frombuffer(x, np.uint8).astype(np.int64) for x in blobs]
    out = np.zeros(len(part) + 1, np.int64)
    out[1 + np.argsort(part, kind="stable")] = np.concatenate([np.zeros(0, np.int64), *found])
    return out


def scored(docs: DataFrame, model: Model, whole: bool = False) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score, a row for each of docs.

    With `whole`, n-grams that did not fit into the filter have their levels in the score too.

    score is the log10 probability of the text and its end under the model; base_score that of its
    tokens alone by exact counts, each raised by one. A null text counts as empty: its end alone.
    """
    spark: SparkSession = docs.sparkSession
    tables = model.tables()
    shared = spark.sparkContext.broadcast(tables)
    none = np.zeros(0, np.uint64)
    small = tables | {"hot": none, "hot_counts": none, "filter": tables["filter"] | {"bits": none}}

    def finish(table: pa.Table) -> pa.Table:
        own = Model.of(small)
        rows = table.to_pylist()
        (kept,) = (r["data"] for r in rows if r["gram"] == 0)
        docs, texts, grams = kept_arrays(kept, own.order)
        real, text, n = texts.real, texts.text[texts.real], len(docs)
        levels = []
        for gram, (inside, level, place, part) in enumerate(grams, 1):
            found = answers_of(rows, gram, part)[place]
            if gram == 1:
                known = docs["known"] + np.bincount(text, found[real] > 0, n).astype(np.int64)
                log = docs["log"] + np.bincount(text, np.log10(found[real] + 1.0), n)
                found = levels_of(found) if whole else 0 * found
            levels.append(np.zeros(len(inside), np.int64))
            levels[-1][inside] = np.where(level == 0, found, level)
        p = smoothed(levels, own, whole)[real]
        columns = [
            pa.array(docs["doc_id"], mask=~docs["valid"]),
            pa.array(np.bincount(text, minlength=n)),
            pa.array(known),
            pa.array(log),
            pa.array(np.bincount(text, np.log10(p), n)),
        ]
        return pa.table(columns, ["doc_id", "n_tokens", "n_known", "log", "score"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    counts = model.counts.select("gram", F.col("part").cast("long").alias("part"), "keys", "learnt", "whole")
    if not whole or max(model.filter.least.values()) == 1:
        counts = counts.where("gram = 1")
    # what a part has in all rows is of no use here
    counts = counts.withColumn("whole", F.lit(None).cast("binary"))
    questions = asked(rows, model, shared, whole).groupBy("gram", "part")
    answers = questions.cogroup(counts.groupBy("gram", "part")).applyInArrow(answer, CHUNK_SCHEMA)
    found = answers.groupBy("chunk").applyInArrow(
        finish, "doc_id long, n_tokens long, n_known long, log double, score double"
    )
    each = float(np.log10(model.tokens + model.distinct + 1))
    return found.select(
        "doc_id",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("log") - F.col("n_tokens") * each).alias("base_score"),
        "score",
    )
