"""Benchmark decontamination: SimHash of item-sized windows, found by multi-index Hamming blocks and
verified by exact weighted-shingle similarity.

A window of as many words as an item has the fingerprint of its shingles, weighted by how rare
they are among the items. Fingerprints are cut into blocks; two that differ in at most RADIUS bits
differ in at most BLOCK_RADIUS bits of one block, so items are listed by every value that near to
their blocks. What the index finds is verified by the Jaccard similarity of shingles, weighted or
plain, whichever is higher: an edit in the rare part of a passage counts more by weight, one in a part
that many items share counts less. So there are fingerprints of both kinds. Weights are counted over
all items, whatever block they are in.

Only windows that share a shingle with an item of their size are fingerprinted: all others have
similarity 0. An item of fewer words than a shingle is one shingle, so that a window of its size is
the same or has similarity 0: these are looked up. Items are taken in blocks of a fixed number, each
against all documents.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced, words_of

WORDS = 5
SIMILAR = 0.8
RADIUS = 23
BLOCKS = 8
BLOCK_RADIUS = RADIUS // BLOCKS
#: Items that one pass over the documents looks for.
ITEMS = 5_000


def shingles(words: list[bytes], size: int) -> list[int]:
    """Hashes of all runs of `size` words; of fewer words, of the whole sequence; of none, none."""
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words))] if words else []
    return [digest(b" ".join(words[i : i + size])) for i in range(len(words) - size + 1)]


class Index:
    """Items with their fingerprints, weights of shingles, and the blocks' lists."""

    def __init__(
        self,
        items: list[tuple[int | None, list[bytes]]],
        size: int,
        counted: tuple[int, dict[int, int]] | None = None,
    ) -> None:
        """counted: the number of items with words, and of those that have each shingle that
        several of them have; by default of these items."""
        self.size = size
        self.items = [(i, w, shingles(w, size)) for i, w in items if w]
        if counted is None:
            found = Counter(s for _, _, found in self.items for s in set(found))
            counted = len(self.items), {s: c for s, c in found.items() if c > 1}
        n = max(1, counted[0])
        self.weights = {s: math.log(1 + n / c) for s, c in counted[1].items()}
        self.rare = math.log(1 + n)  # of a shingle that one item has, or none
        self.vocabulary: dict[bytes, int] = {}
        for _, words, _ in self.items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        #: sizes of items that have a shingle, and the items of each size
        self.sizes: dict[int, set[int]] = defaultdict(set)
        self.short: dict[bytes, list[int]] = defaultdict(list)
        self.counts = [Counter(found) for _, _, found in self.items]
        self.totals = [sum(self.weight(s) for s in found) for _, _, found in self.items]
        #: by weight, and plain
        self.prints = [np.zeros(len(self.items), np.uint64) for _ in range(2)]
        self.blocks: list[dict[int, list[dict[int, list[int]]]]] = [{}, {}]
        near = [
            sum(1 << b for b in bits)
            for r in range(BLOCK_RADIUS + 1)
            for bits in combinations(range(64 // BLOCKS), r)
        ]
        for k, (_, words, found) in enumerate(self.items):
            if len(words) < size:
                self.short[b" ".join(words)].append(k)
                continue
            for s in found:
                self.sizes[s].add(len(words))
            made = self.fingerprints(found, len(found))
            for print_, prints, blocks in zip(made, self.prints, self.blocks, strict=True):
                prints[k] = print_[0]
                own = blocks.setdefault(len(words), [defaultdict(list) for _ in range(BLOCKS)])
                for b in range(BLOCKS):
                    value = int(print_[0]) >> (b * 64 // BLOCKS) & (1 << 64 // BLOCKS) - 1
                    for flip in near:
                        own[b][value ^ flip].append(k)
        #: codes of the runs that are looked for, by their number of words
        codes: dict[int, set[int]] = defaultdict(set)
        for _, words, _ in self.items:
            n = min(len(words), size)
            codes[n].update(self._code(words[i : i + n]) for i in range(len(words) - n + 1))
        self.keys = {n: np.array(sorted(found), np.int64) for n, found in sorted(codes.items())}

    def _code(self, words: list[bytes]) -> int:
        code = 0
        for word in words:
            code = (code * 0x5851F42D4C957F2D + self.vocabulary[word]) & (1 << 64) - 1
        return code - (1 << 64) if code >> 63 else code

    def weight(self, shingle: int) -> float:
        return self.weights.get(shingle, self.rare)

    def fingerprints(self, hashes: list[int], count: int) -> list[np.ndarray]:
        """Of each run of `count` shingles, by weight and plain: bit 1 where ones outweigh zeros.

        Where all weights are the same, the two are."""
        weights = np.array([self.weight(s) for s in hashes])
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)

        def majority(values: np.ndarray) -> np.ndarray:
            sums = np.zeros((len(hashes) + 1, 64))
            np.cumsum((2.0 * bits - 1.0) * values[:, None], axis=0, out=sums[1:])
            ones = sums[count:] - sums[: len(hashes) - count + 1] > 1e-9
            return np.packbits(ones, axis=1).view(">u8").ravel().astype(np.uint64)

        weighted = majority(weights)
        even = (weights == weights[0]).all()
        return [weighted, weighted if even else majority(np.ones(len(hashes)))]

    def hits(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """Places of runs of `size` words that some item has (or, rarely, look so)."""
        n = len(numbers) - size + 1
        if n < 1 or size not in self.keys:
            return np.zeros(0, np.int64)
        code, known = np.zeros(n, np.uint64), np.ones(n, bool)
        for i in range(size):
            part = numbers[i : i + n]
            code = code * np.uint64(0x5851F42D4C957F2D) + part
            known &= part > 0
        at = np.flatnonzero(known)
        signed = code[at].view(np.int64)
        keys = self.keys[size]
        place = np.minimum(np.searchsorted(keys, signed), len(keys) - 1)
        return at[keys[place] == signed]

    def similarity(self, item: int, window: Counter, total: float) -> float:
        """The weighted similarity, or the plain one if that is higher."""
        own = self.counts[item]
        few, many = (own, window) if len(own) < len(window) else (window, own)
        shared = [(s, min(c, many[s])) for s, c in few.items() if s in many]
        both, plain = sum(c * self.weight(s) for s, c in shared), sum(c for _, c in shared)
        return max(
            both / (total + self.totals[item] - both),
            plain / (window.total() + own.total() - plain),
        )

    def search(self, words: list[bytes], similar: float) -> list[tuple[int, int, int, int, float]]:
        """(item, first word, words, differing bits, similarity) of each item's best window."""
        best: dict[int, tuple] = {}
        get = self.vocabulary.get
        numbers = np.array([get(w, 0) for w in words], np.int64).view(np.uint64)
        for n in self.keys:
            for at in self.hits(numbers, n).tolist() if n < self.size else ():
                for item in self.short.get(b" ".join(words[at : at + n]), ()):
                    best.setdefault(item, (at, n, 0, 1.0))
        by_size: dict[int, list[int]] = defaultdict(list)
        for at in self.hits(numbers, self.size).tolist():
            hashed = xxhash.xxh64_intdigest(b" ".join(words[at : at + self.size]))
            for n in self.sizes.get(hashed, ()):
                by_size[n].append(at)
        for n, places in by_size.items():
            last, ranges = max(0, len(words) - n), []
            for at in places:
                lo, hi = min(last, max(0, at - n + self.size)), min(last, at)
                if ranges and lo <= ranges[-1][1] + 1:
                    ranges[-1][1] = max(ranges[-1][1], hi)
                else:
                    ranges.append([lo, hi])
            for lo, hi in ranges:
                self._windows(words, n, lo, hi, similar, best)
        return [(self.items[k][0], *x) for k, x in sorted(best.items())]

    def _windows(
        self, words: list[bytes], n: int, lo: int, hi: int, similar: float, best: dict
    ) -> None:
        found = shingles(words[lo : hi + n], self.size)
        count = min(len(found), n - self.size + 1)
        weights = np.concatenate([[0.0], np.cumsum([self.weight(s) for s in found])])
        made = [x.tolist() for x in self.fingerprints(found, count)]
        for i, prints in enumerate(zip(*made, strict=True)):
            near: set[int] = set()
            for print_, blocks in zip(prints, self.blocks, strict=True):
                for b, lists in enumerate(blocks[n]):
                    near.update(
                        lists.get(print_ >> (b * 64 // BLOCKS) & (1 << 64 // BLOCKS) - 1, ())
                    )
            window = None
            for item in near:
                differ = min(
                    (print_ ^ int(own[item])).bit_count()
                    for print_, own in zip(prints, self.prints, strict=True)
                )
                if differ > RADIUS:
                    continue
                if window is None:
                    window = Counter(found[i : i + count])
                value = self.similarity(item, window, float(weights[i + count] - weights[i]))
                if value >= similar - 1e-9 and value > best.get(item, (0, 0, 0, 0.0))[3] + 1e-9:
                    best[item] = (lo + i, min(n, len(words)), differ, min(1.0, value))


def counted(items: DataFrame, size: int) -> tuple[int, dict[int, int]]:
    """Number of items with words, and of those with each shingle that several of them have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for text in batch.column("text"):
                # None stands for the item, so that one pass counts both
                found = set(shingles(words_of(text.as_py()), size))
                if found:
                    made = pa.array(np.array(list(found), np.uint64).view(np.int64))
                    made = pa.concat_arrays([made, pa.nulls(1, pa.int64())])
                    yield pa.RecordBatch.from_arrays([made], ["shingle"])

    own = items.select("text").mapInArrow(run, "shingle long")
    rows = own.groupBy("shingle").count().where("shingle IS NULL OR count > 1").collect()
    several = {x["shingle"] % (1 << 64): x["count"] for x in rows if x["shingle"] is not None}
    return sum(x["count"] for x in rows if x["shingle"] is None), several


def leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = WORDS, similar: float = SIMILAR
) -> DataFrame:
    """doc_id, item_id, first_word, n_words, differing_bits, similarity: each document and item
    with a window of at least the similarity, once, with the best (then first) window.

    Items of fewer words than a shingle match where their words stand one after the other. Null or
    empty texts and items match nothing, equal items all match, and repeated rows give their matches
    each; items with a null item_id are items like any other, and match with a null item_id.
    Documents of fewer words than an item are one window.
    """
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    blocks = max(1, -(-items.count() // ITEMS))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    weights = counted(items, size)

    def one(block: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        found = [(x.item_id, words_of(x.text)) for x in own.collect()]
        index = Index(
            sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[1])), size, weights
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                made = [
                    (doc.as_py(), *found)
                    for doc, text in zip(batch.column(0), batch.column(1), strict=True)
                    for found in index.search(words_of(text.as_py()), similar)
                ]
                columns = list(zip(*made, strict=True)) or [()] * 6
                kinds = [pa.int64()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "first_word", "n_words", "differing_bits", "similarity"],
                )

        return rows.mapInArrow(
            run,
            "doc_id long, item_id long, first_word long, n_words long, differing_bits long,"
            " similarity double",
        )

    return reduce(DataFrame.union, (one(b) for b in range(blocks)))
