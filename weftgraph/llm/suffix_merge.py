"""Repeats of whole texts by a distributed merge sort of suffixes that never re-compares prefixes.

A string of `length` bytes that occurs twice has the same anchor in both places: the byte run of
`GRAM` bytes with the smallest hash in it. So only suffixes at anchors are sorted, each with the
bytes from its anchor on and, as a second key, those before it in reverse. Suffixes whose anchor
occurs once are left out by a count of hashes.

Tasks sort the suffixes of their texts and exchange them as front-coded runs: each string is the
number of bytes it shares with the one before it and the rest. A run is cut by anchor, so that
suffixes with the same anchor meet. Loser trees merge the runs: a contender carries the common
prefix it has with the last output; unequal ones decide a match without reading a byte, and equal
ones are compared from there on. The merged order and its common prefixes tell which strings of
`length` bytes around an anchor occur twice.

Strings of a number of words are found by the same sort: a text is then the row of its words'
64-bit hashes, and spans are taken back to the bytes of the words that lie whole in them.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.common import KEY, keyed, mixed, sliced, stored, tasks_for

LENGTH = 400
GRAM = 128
#: Bytes of text that are hashed at once, and that a run holds before it is sorted.
CHUNK = 500_000
RUN_BYTES = 12_000_000
#: Anchors that a task packs at once, bytes of texts whose anchors one bucket gets, and how often an
#: anchor must be in a batch to be known to repeat.
FLUSHED = 500_000
BUCKET_BYTES = 1 << 25
OFTEN = 8
#: Suffixes that one merge gets on average.
MERGED = 20_000
#: An anchor with more places than this is not merged in one task: its strings are counted apart.
HOT = 4_096
#: Keys of documents that are sent to all tasks (16 bytes each), so that other texts stay where they are.
LISTED = 500_000
#: Suffixes of anchors with several contexts whose strings are compared at once.
COMPARED = 50_000
#: Places of such anchors whose strings are counted in one bucket, on average.
PLACES = 5_000

FACTOR = 0x9E3779B97F4A7C15
SECOND = 0xC2B2AE3D27D4EB4F
#: Bytes of a word's hash. With words as units, GRAM is so many times fewer words.
CODE = 8
#: What bytes.split() takes for blank.
BLANK = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def bytes_of(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def codes_of(text: str) -> bytes:
    """The hashes of a text's words in a row."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in bytes_of(text).split()], np.uint64).tobytes()


@dataclass(frozen=True)
class Unit:
    """What strings are made of: bytes of a text, strings' length, and where one may begin."""

    length: int
    of: Callable[[str], bytes] = bytes_of
    step: int = 1


def bytes_of_words(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of the words' hashes as spans of the text's bytes, from whole words only."""
    solid = np.concatenate([[False], ~BLANK[np.frombuffer(data, np.uint8)], [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    words = [(-(-lo // CODE), hi // CODE) for lo, hi in spans]
    return [(int(edges[2 * a]), int(edges[2 * b - 1])) for a, b in words if a < b]


class Rolling:
    """Hashes of all byte strings of a length: prefix sums of c * factor**i, shifted to i = 0."""

    def __init__(self, factor: int) -> None:
        self.factor = factor
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:

            def powers(x: int) -> np.ndarray:
                steps = np.full(n, x, np.uint64)
                steps[0] = 1
                return np.multiply.accumulate(steps)

            self.up, self.down = powers(self.factor), powers(pow(self.factor, -1, 1 << 64))
        out = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, size: int) -> np.ndarray:
        n = len(sums) - size
        return mixed((sums[size:] - sums[:-size]) * self.down[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    cut = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(cut, axis=1).ravel()
    back = np.minimum.accumulate(cut[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def pieces(
    texts: list[bytes], length: int, step: int = 1
) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Bytes of at most about CHUNK with (text number, its offset there, size) of what they hold.

    A long text is cut into pieces that overlap by length - step, so that each string is in one.
    """
    held, where, size = [], [], 0
    for number, text in enumerate(texts):
        for first in range(0, max(1, len(text) - length + 1), CHUNK):
            part = text[first : first + CHUNK + length - step]
            if len(part) < length:
                continue
            if size and size + len(part) > CHUNK:
                yield b"".join(held), where
                held, where, size = [], [], 0
            held.append(part)
            where.append((number, first, len(part)))
            size += len(part)
    if size:
        yield b"".join(held), where


def anchors_of(texts: list[bytes], length: int, rolling: Rolling, step: int = 1) -> Iterator[tuple]:
    """(text number, hash of the anchor, its place, first and last start of strings it stands for),
    as arrays, for each piece. Strings and anchors begin at whole units of `step` bytes."""
    for data, where in pieces(texts, length, step):
        sums = rolling.sums(np.frombuffer(data, np.uint8))
        grams = rolling.hashes(sums, GRAM)[::step]
        order = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
        width = (length - GRAM) // step + 1
        place = (sliding_least(order, width) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        sizes = np.array([n for _, _, n in where]) // step
        ends = np.cumsum(sizes)
        begins = ends - sizes
        owner = np.repeat(np.arange(len(where)), sizes)[: len(place)]
        starts = np.flatnonzero(np.arange(len(place)) + length // step <= ends[owner])
        new = np.ones(len(starts), bool)
        new[1:] = (place[starts][1:] != place[starts][:-1]) | (np.diff(starts) != 1)
        first = starts[new]
        last = starts[np.concatenate([np.flatnonzero(new)[1:], [len(starts)]]) - 1]
        of = owner[first]
        shift = np.array([x for _, x, _ in where])[of] - begins[of] * step
        at = place[first]
        yield (
            np.array([x for x, _, _ in where])[of],
            grams[at].view(np.int64),
            at * step + shift,
            first * step + shift,
            last * step + shift,
        )


#: One anchor: its hash, the document's key, its place, and the strings' first and last start
#: before and after that.
ANCHOR = np.dtype(
    [("gram", "<i8"), ("key_id", "<i8"), ("key_hash", "<i8"), ("place", "<i4"), ("back", "<u2"), ("more", "<u2")]
)


def packed_anchors(units: list[Unit], buckets: int):
    """Anchors of all texts of a task, dealt by their hash, in few binary values.

    Of an anchor that is often in a batch already, which tells that it repeats, only the count is
    dealt by its hash, and the places by the document: no bucket gets them all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling(FACTOR)
        held: list[list[np.ndarray]] = [[] for _ in units]

        def flushed(unit: int) -> Iterator[tuple]:
            every = np.concatenate(held[unit])
            held[unit].clear()
            every = every[np.argsort(every["gram"], kind="stable")]
            first = np.flatnonzero(np.r_[True, every["gram"][1:] != every["gram"][:-1]])
            count = np.diff(np.r_[first, len(every)])
            often = count >= OFTEN
            known = np.repeat(often, count)
            sums = np.stack([every["gram"][first[often]], count[often]], axis=1).astype("<i8")
            few, many = every[~known], every[known]
            for kind, rows, by in (
                ("few", few, few["gram"]),
                ("many", many, many["key_hash"]),
                ("sum", sums, sums[:, 0]),
            ):
                at = (mixed(by.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0, True]) if len(at) else []
                for i, j in pairwise(cuts):
                    part = rows[order[i:j]]
                    if kind != "sum":  # a column after the other packs better
                        data = b"".join(np.ascontiguousarray(part[c]).tobytes() for c in ANCHOR.names)
                    else:
                        data = part.tobytes()
                    yield unit, kind, int(at[order[i]]), zstandard.compress(data, 1)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary()]
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["unit", "kind", "bucket", "data"],
            )

        for batch in sliced(batches):
            ids, hashes = (np.asarray(batch.column(k)) for k in KEY)
            for u, unit in enumerate(units):
                texts = [unit.of(x.as_py()) for x in batch.column("text")]
                for number, gram, place, first, last in anchors_of(texts, unit.length, rolling, unit.step):
                    rows = np.zeros(len(gram), ANCHOR)
                    rows["gram"], rows["key_id"], rows["key_hash"] = gram, ids[number], hashes[number]
                    rows["place"], rows["back"], rows["more"] = place, place - first, last - first
                    held[u].append(rows)
                if sum(map(len, held[u])) >= FLUSHED:
                    yield batch_of(list(flushed(u)))
        for u in range(len(units)):
            if held[u]:
                yield batch_of(list(flushed(u)))

    return run


KEPT = "unit int, gram long, key_id long, key_hash long, place long, first long, end long, n long"


def repeated_anchors(units: list[Unit]):
    """Of one bucket of one unit: the anchors that stand twice or more, a row each; n is null where
    the count is not known here, and rows without a key tell such counts."""

    def run(table: pa.Table) -> pa.Table:
        unit = table["unit"][0].as_py()
        found: dict[str, list[np.ndarray]] = {"few": [], "many": [], "sum": []}
        for kind, data in zip(table["kind"].to_pylist(), table["data"].to_pylist(), strict=True):
            data = zstandard.decompress(data)
            if kind == "sum":
                found[kind].append(np.frombuffer(data, "<i8").reshape(-1, 2))
                continue
            n, at = len(data) // ANCHOR.itemsize, 0
            rows = np.zeros(n, ANCHOR)
            for name in ANCHOR.names:
                kind_of = ANCHOR[name]
                rows[name] = np.frombuffer(data, kind_of, n, at)
                at += n * kind_of.itemsize
            found[kind].append(rows)
        few = np.concatenate([np.zeros(0, ANCHOR), *found["few"]])
        many = np.concatenate([np.zeros(0, ANCHOR), *found["many"]])
        sums = np.concatenate([np.zeros((0, 2), np.int64), *found["sum"]])
        grams = np.concatenate([few["gram"], sums[:, 0]])
        different, which = np.unique(grams, return_inverse=True)
        weight = np.concatenate([np.ones(len(few), np.int64), sums[:, 1]])
        total = np.bincount(which, weight, len(different)).astype(np.int64)
        n = total[which[: len(few)]]
        few, n = few[n > 1], n[n > 1]
        told = np.unique(which[len(which) - len(sums) :])
        rows = np.concatenate([few, many])
        place = rows["place"].astype(np.int64)
        first = place - rows["back"]
        k, m = len(rows), len(told)
        none = np.r_[np.zeros(k, bool), np.ones(m, bool)]

        def column(values: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
            return pa.array(np.r_[values, np.zeros(k + m - len(values), np.int64)], mask=mask)

        return pa.table(
            [
                pa.array(np.full(k + m, unit, np.int32)),
                pa.array(np.r_[rows["gram"], different[told]].astype(np.int64)),
                *(column(rows[c], none) for c in KEY),
                column(place),
                column(first),
                column(first + rows["more"] + units[unit].length),
                pa.array(
                    np.r_[n, np.zeros(len(many), np.int64), total[told]],
                    mask=np.r_[np.zeros(len(n), bool), np.ones(len(many), bool), np.zeros(m, bool)],
                ),
            ],
            ["unit", "gram", *KEY, "place", "first", "end", "n"],
        )

    return run


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes are known to be equal."""
    most = min(len(a), len(b))
    step = 16
    while known < most and a[known : known + step] == b[known : known + step]:
        known += step
        step *= 2
    if known >= most:
        return most
    low, high = known, min(known + step, most)
    while low < high:
        middle = (low + high + 1) // 2
        if a[known:middle] == b[known:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Run:
    """A sorted run: strings with the sizes of their forward part, and the places that have them."""

    def __init__(self, strings: dict[tuple[bytes, int], list[tuple[int, int, int]]]) -> None:
        order = sorted(strings)
        shared, rest, before = [], [], b""
        for string, _ in order:
            n = shared_prefix(before, string, 0)
            shared.append(n)
            rest.append(string[n:])
            before = string
        self.parts = [
            np.array(shared, np.int32),
            np.array([len(x) for x in rest], np.int32),
            np.array([n for _, n in order], np.int32),
            np.array([len(strings[x]) for x in order], np.int32),
            np.array([p for x in order for p in strings[x]], np.int64).reshape(-1, 3).T,
            np.frombuffer(b"".join(rest), np.uint8),
        ]

    def packed(self) -> bytes:
        head = np.array([len(self.parts[0]), self.parts[4].shape[1]], np.int64).tobytes()
        return zstandard.compress(head + b"".join(x.tobytes() for x in self.parts), 6)


def unpacked(blob: bytes) -> Iterator[tuple[int, bytes, int, np.ndarray]]:
    """(bytes shared with the string before it, string, size of its forward part, places)."""
    data = zstandard.decompress(blob)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    head = np.frombuffer(data, np.int32, 4 * n, 16).reshape(4, n)
    shared, rest, forward, count = head.tolist()
    places = np.frombuffer(data, np.int64, 3 * m, 16 + 16 * n).reshape(3, m).T
    at, seen, before = 16 + 16 * n + 24 * m, 0, b""
    for i in range(n):
        before = before[: shared[i]] + data[at : at + rest[i]]
        at += rest[i]
        yield shared[i], before, forward[i], places[seen : seen + count[i]]
        seen += count[i]


def merged(runs: list[Iterator[tuple[int, bytes, int, np.ndarray]]]) -> Iterator[tuple]:
    """The items of sorted runs in order, each with the prefix it shares with the one before it."""
    k = 1
    while k < len(runs):
        k *= 2
    runs = runs + [iter(())] * (k - len(runs))
    shared, item = [0] * k, [None] * k
    for i, run in enumerate(runs):
        item[i] = next(run, None)
        if item[i] is None:
            shared[i] = -1

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's shared prefix then is the one with the winner."""
        p, q = shared[x], shared[y]
        if p != q:
            return (x, y) if p > q else (y, x)
        if p < 0:
            return x, y
        a, b = item[x][1], item[y][1]
        n = shared_prefix(a, b, p)
        if n == len(a) or n == len(b):
            first = (len(a), item[x][2], x) < (len(b), item[y][2], y)
        else:
            first = a[n] < b[n]
        loser = y if first else x
        shared[loser] = n
        return (x, y) if first else (y, x)

    losers, level = [0] * k, list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        ups = []
        for i in range(0, len(level), 2):
            up, down = play(level[i], level[i + 1])
            losers[node + i // 2] = down
            ups.append(up)
        level = ups
    winner = level[0]
    while shared[winner] >= 0:
        yield (shared[winner], *item[winner][1:])
        found = next(runs[winner], None)
        if found is None:
            shared[winner], item[winner] = -1, None
        else:
            shared[winner], item[winner] = found[0], found
        at = (winner + k) // 2
        while at:
            winner, losers[at] = play(winner, losers[at])
            at //= 2


def repeated_offsets(
    shared: np.ndarray,
    forward: np.ndarray,
    back: list[bytes],
    times: np.ndarray,
    length: int,
    step: int = 1,
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest number of bytes before the anchor at which a repeated string starts, in
    whole units of `step`.

    Items stand in merged order; shared[i] is the common prefix of i and i - 1, and under GRAM
    where another anchor begins. No such string: the least is over the greatest.

    A string that starts o bytes before the anchor is the pair of a reversed prefix of o bytes and
    a forward prefix of length - o bytes. Equal prefixes are neighbours in the two sorted orders,
    so both are class numbers from the common prefixes, and the pairs are counted for each o.
    """
    n = len(forward)
    group = np.cumsum(shared < GRAM)
    order = sorted(range(n), key=lambda i: (group[i], back[i]))
    position = np.empty(n, np.int64)
    position[order] = np.arange(n)
    back_shared = np.full(n, -1, np.int64)
    for i in range(1, n):
        x, y = order[i - 1], order[i]
        if group[x] == group[y]:
            back_shared[i] = shared_prefix(back[x], back[y], 0)
    sizes = np.array([len(x) for x in back])
    ahead = np.maximum(shared, np.append(shared[1:], -1))
    behind = np.maximum(back_shared, np.append(back_shared[1:], -1))[position]
    many = times > 1
    least = np.where(many, length - forward, length + 1)
    most = np.where(many, sizes, -1)
    low = np.maximum(length - forward, length - ahead)
    high = np.minimum(sizes, behind)
    for o in range(-(-max(0, int(low.min())) // step) * step, int(high.max()) + 1 if n else 0, step):
        own = np.flatnonzero((low <= o) & (o <= high))
        if not len(own):
            continue
        f = np.cumsum(shared < length - o)[own]
        b = np.cumsum(back_shared < o)[position[own]]
        _, which = np.unique(f * (n + 1) + b, return_inverse=True)
        hit = own[np.bincount(which, times[own])[which] > 1]
        least[hit] = np.minimum(least[hit], o)
        most[hit] = np.maximum(most[hit], o)
    return least, most


def merge_task(units: list[Unit], parts: int):
    """For all runs of one part: key and spans (unit, lo, hi) of repeated bytes around anchors."""

    def run(table: pa.Table) -> pa.Table:
        unit = table["part"][0].as_py() // parts
        length, step = units[unit].length, units[unit].step
        out: list[np.ndarray] = []
        held: list[tuple] = []

        def emit(items: list[tuple], least: np.ndarray, most: np.ndarray) -> None:
            for (_, string, forward, places), a, b in zip(items, least, most, strict=True):
                if a <= b:
                    middle = places[:, 2] + (len(string) - forward)
                    out.append(
                        np.column_stack([places[:, :2], middle - b, middle - a + length])
                    )

        def close(items: list[tuple]) -> None:
            if items:
                least, most = repeated_offsets(
                    np.array([x[0] for x in items]),
                    np.array([x[2] for x in items]),
                    [x[1][x[2] :] for x in items],
                    np.array([len(x[3]) for x in items]),
                    length,
                    step,
                )
                emit(items, least, most)

        group: list[tuple] = []

        def close_group() -> None:
            if len(group) > 1:
                held.extend(group)
            elif group and len(group[0][3]) > 1:
                _, string, forward, _ = group[0]
                emit(group, np.array([length - forward]), np.array([len(string) - forward]))
            group.clear()
            if len(held) > COMPARED:
                close(held)
                held.clear()

        runs = [unpacked(x.as_py()) for x in table.column("run")]
        for n, string, forward, places in merged(runs):
            if n < GRAM:
                close_group()
            last = group[-1] if group else None
            if last and n == len(string) == len(last[1]) and forward == last[2]:
                group[-1] = (*last[:3], np.concatenate([last[3], places]))
            else:
                group.append((n if group else 0, string, forward, places))
        close_group()
        close(held)
        spans = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 4), np.int64)
        new = (spans[1:, :2] != spans[:-1, :2]).any(axis=1)
        first = np.flatnonzero(np.r_[True, new]) if len(spans) else np.zeros(0, np.int64)
        fields = [np.full(len(spans), unit, np.int32), spans[:, 2].copy(), spans[:, 3].copy()]
        lists = pa.ListArray.from_arrays(
            pa.array(np.r_[first, len(spans)].astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(x) for x in fields], ["unit", "lo", "hi"]),
        )
        return pa.table([*(pa.array(spans[first, i]) for i in range(2)), lists], [*KEY, "spans"])

    return run


def run_task(parts: int, units: list[Unit]):
    """Sorted front-coded runs of the anchors' contexts of each task's texts, cut by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            blobs = [Run(x).packed() for x in held.values()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array(blobs, pa.binary())], ["part", "run"]
            )

        for batch in sliced(batches):
            for text, *key, found in zip(*map(batch.column, ("text", *KEY, "found")), strict=True):
                key, found = (key[0].as_py(), key[1].as_py()), found.as_py()
                data_of = {u: units[u].of(text.as_py()) for u in {x["unit"] for x in found}}
                for x in found:
                    data = data_of[x["unit"]]
                    string = data[x["place"] : x["end"]]
                    forward = len(string)
                    string += data[x["first"] : x["place"]][::-1]
                    part = held.setdefault(x["unit"] * parts + x["part"], {})
                    places = part.get((string, forward))
                    if places is None:
                        part[(string, forward)] = [(*key, x["first"])]
                        size += len(string) + 200
                    else:
                        places.append((*key, x["first"]))
                        size += 80
                if size > RUN_BYTES:
                    yield flush()
                    held, size = {}, 0
        if held:
            yield flush()

    return run


#: One string of a context: two hashes, the context's number in its batch, the string's offset in
#: it, and how often the batch has the context.
ENTRY = np.dtype([("one", "<u8"), ("two", "<u8"), ("context", "<i4"), ("offset", "<i4"), ("times", "<i4")])
REACH = np.dtype([("context", "<i4"), ("least", "<i4"), ("most", "<i4")])


def counted_task(units: list[Unit], buckets: int):
    """For anchors with very many places: contexts with their places, and their strings' hashes.

    A batch is some texts of a task, and equal contexts of it are one. A row with a key names a
    document's places of a context; a row with a bucket has the strings whose hash falls into it, of
    all contexts of the batch, in one binary value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(FACTOR), Rolling(SECOND)
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        kinds += [pa.int32(), pa.binary()]
        names = ["batch", "context", "unit", *KEY, "firsts", "bucket", "strings"]

        def rows(columns: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
            )

        def flush(held: dict[tuple[int, bytes], dict]) -> Iterator[pa.RecordBatch]:
            number = int.from_bytes(os.urandom(8), "little", signed=True)
            places, parts = [], []
            for context, ((u, data), found) in enumerate(held.items()):
                step = units[u].step
                for key, firsts in found.items():
                    places.append((number, context, u, *key, firsts, None, None))
                sums = np.frombuffer(data, np.uint8)
                a, b = (x.hashes(x.sums(sums), units[u].length) for x in (one, two))
                # every context begins where a string may: at a whole unit
                at = np.arange(-next(iter(found.values()))[0] % step, len(a), step)
                part = np.zeros(len(at), ENTRY)
                part["one"], part["two"], part["offset"] = a[at], b[at], at
                part["context"], part["times"] = context, sum(map(len, found.values()))
                parts.append(part)
            if not places:
                return
            yield rows([list(c) for c in zip(*places, strict=True)])
            every = np.concatenate(parts)
            bucket = (every["one"] >> np.uint64(32)).astype(np.int64) * buckets >> 32
            order = np.argsort(bucket, kind="stable")
            every, bucket = every[order], bucket[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(every) else []
            packed = [
                (number, None, None, None, None, None, int(bucket[i]), every[i:j].tobytes())
                for i, j in pairwise(cuts)
            ]
            if packed:
                yield rows([list(c) for c in zip(*packed, strict=True)])

        held: dict[tuple[int, bytes], dict] = {}
        size = 0
        for batch in sliced(batches):
            for text, *key, found in zip(*map(batch.column, ("text", *KEY, "found")), strict=True):
                key, found = (key[0].as_py(), key[1].as_py()), found.as_py()
                data_of = {u: units[u].of(text.as_py()) for u in {x["unit"] for x in found}}
                for x in found:
                    string = data_of[x["unit"]][x["first"] : x["end"]]
                    context = held.setdefault((x["unit"], string), {})
                    context.setdefault(key, []).append(x["first"])
                    size += len(string) + 100
                if size > RUN_BYTES:
                    yield from flush(held)
                    held, size = {}, 0
        yield from flush(held)

    return run


def strings_task(table: pa.Table) -> pa.Table:
    """For all strings of a bucket: where contexts of each batch have one that occurs twice."""
    every = [np.frombuffer(x, ENTRY) for x in table["strings"].to_pylist()]
    batch = np.repeat(np.arange(len(every)), [len(x) for x in every])
    every = np.concatenate(every)
    order = np.lexsort((every["two"], every["one"]))
    one, two, times = every["one"][order], every["two"][order], every["times"][order]
    new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
    total = np.add.reduceat(times.astype(np.int64), np.flatnonzero(new))
    twice = order[total[np.cumsum(new) - 1] > 1]
    out = []
    for number in np.unique(batch[twice]).tolist():
        own = every[twice[batch[twice] == number]]
        out.append((table["batch"][number].as_py(), reach_of(own["context"], own["offset"], own["offset"])))
    columns = zip(*out, strict=True) if out else ([], [])
    return pa.table(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary()), strict=True)],
        ["batch", "reach"],
    )


def reach_of(context: np.ndarray, least: np.ndarray, most: np.ndarray) -> bytes:
    """The least and the greatest offset of each context."""
    order = np.argsort(context, kind="stable")
    first = np.flatnonzero(np.r_[True, context[order][1:] != context[order][:-1]])
    out = np.zeros(len(first), REACH)
    out["context"] = context[order][first]
    out["least"] = np.minimum.reduceat(least[order], first)
    out["most"] = np.maximum.reduceat(most[order], first)
    return out.tobytes()


def reach_task(table: pa.Table) -> pa.Table:
    """Of the contexts of one batch, what all buckets found of them."""
    every = np.concatenate([np.frombuffer(x, REACH) for x in table["reach"].to_pylist()])
    found = np.frombuffer(reach_of(every["context"], every["least"], every["most"]), REACH)
    return pa.table(
        [
            pa.array(np.full(len(found), table["batch"][0].as_py(), np.int64)),
            *(pa.array(found[c].astype(k)) for c, k in zip(REACH.names, ("i4", "i8", "i8"), strict=True)),
        ],
        ["batch", *REACH.names],
    )


def hot_spans(rows: DataFrame, units: list[Unit], places: int) -> DataFrame:
    """key and spans (unit, lo, hi) around anchors with very many places, from counts of their strings' hashes.

    No task gets all places of an anchor: the strings of many contexts travel in one value, dealt
    by their hash (128 bits), and are counted in arrays, so that rows follow the places alone."""
    buckets = tasks_for(rows.sparkSession, places, PLACES)
    names = "batch long, context int, unit int, key_id long, key_hash long, firsts array<long>, "
    names += "bucket int, strings binary"
    found = stored(rows.mapInArrow(counted_task(units, buckets), names))
    strings = found.where("bucket IS NOT NULL").select("bucket", "batch", "strings")
    reach = (
        strings.groupBy("bucket")
        .applyInArrow(strings_task, "batch long, reach binary")
        .groupBy("batch")
        .applyInArrow(reach_task, "batch long, context int, least long, most long")
    )
    member = found.where("bucket IS NULL").select("batch", "context", "unit", *KEY, "firsts")
    length = F.element_at(F.array(*[F.lit(u.length) for u in units]), F.col("unit") + 1)
    return member.join(reach, ["batch", "context"]).select(
        *KEY,
        F.transform(
            "firsts",
            lambda x: F.struct(
                F.col("unit").alias("unit"),
                (x + F.col("least")).alias("lo"),
                (x + F.col("most") + length).alias("hi"),
            ),
        ).alias("spans"),
    )


def repeated_spans(rows: DataFrame, units: list[Unit]) -> DataFrame:
    """key and `spans` (unit, lo, hi; may overlap): all of every string of a unit that occurs twice.

    rows: from `keyed`. lo and hi are bytes of what the unit makes of a text. Rows that repeat count
    as other documents; texts shorter than a unit's length have no spans of it. The texts meet their
    anchors with all columns of rows: a join of rows and spans then reads the same exchange.
    """
    if min(u.length for u in units) <= GRAM:
        raise ValueError(f"strings must be longer than {GRAM} bytes")
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = tasks_for(spark, size, BUCKET_BYTES)
    packed = rows.select("text", *KEY).mapInArrow(
        packed_anchors(units, buckets), "unit int, kind string, bucket int, data binary"
    )
    found = stored(packed.groupBy("unit", "bucket").applyInArrow(repeated_anchors(units), KEPT))
    hottest = stored(found.where("key_id IS NULL").where(F.col("n") > HOT).select("unit", "gram"))
    marked = found.where("key_id IS NOT NULL").join(
        hottest.withColumn("listed", F.lit(True)), ["unit", "gram"], "left"
    )
    hot = F.col("n") > HOT
    marked = marked.withColumn("hot", F.coalesce(hot, F.lit(False)) | F.col("listed").isNotNull())
    kept = marked.select("unit", "gram", *KEY, "place", "first", "end", "hot")
    places, all_kept = kept.agg(F.count_if("hot"), F.count("*")).head()
    parts = tasks_for(spark, all_kept - places, MERGED)
    part = F.pmod("gram", F.lit(parts)).cast("int").alias("part")

    def with_text(which: str, texts: DataFrame) -> DataFrame:
        lists = kept.where(which).groupBy(*KEY).agg(
            F.collect_set(F.struct("unit", part, "place", "first", "end")).alias("found")
        )
        return texts.join(lists, KEY)

    def hot_texts() -> DataFrame:
        """At least the texts with hot anchors: if these are few, no other text travels."""
        texts, few = rows.select("text", *KEY), kept.where("hot").select(*KEY).distinct()
        if few.count() > LISTED:
            return texts
        return texts.join(F.broadcast(few), KEY, "left_semi")

    runs = with_text("NOT hot", rows).mapInArrow(run_task(parts, units), "part int, run binary")
    spans = runs.groupBy("part").applyInArrow(
        merge_task(units, parts),
        "key_id long, key_hash long, spans array<struct<unit: int, lo: long, hi: long>>",
    )
    if places:
        spans = spans.union(hot_spans(with_text("hot", hot_texts()), units, places))
    return spans.groupBy(*KEY).agg(F.flatten(F.collect_set("spans")).alias("spans"))


def union_of(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((x["lo"], x["hi"]) for x in spans or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    texts: bool = True,
    words: int | None = None,
    cut_words: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the text, or null if not asked for),
    n_passage and rest (the other columns, of all rows that texts are asked for), one row for each
    of docs.

    With `words`, n_passage counts the bytes of strings of so many words that occur twice, whatever
    their bytes and the blanks between them (else it is null); they are cut too unless `cut_words`
    is false. A null text counts as empty; repeated rows are copies of each other; a span that cuts a
    character leaves bytes that `kept` drops and `kept_sha256` has.
    """
    rows = keyed(docs if texts else docs.select("doc_id", "text"))
    units = [Unit(length)] + ([Unit(words * CODE, codes_of, CODE)] if words else [])
    spans = repeated_spans(rows, units)
    # a type, not its text: the other columns may have any names
    kinds = {"doc_id": T.LongType(), "rest": rows.schema["rest"].dataType}
    kinds |= dict.fromkeys(("n_bytes", "n_removed", "n_spans"), T.LongType())
    kinds |= {"kept_sha256": T.StringType(), "kept": T.StringType(), "n_passage": T.LongType()}
    schema = T.StructType([T.StructField(n, k) for n, k in kinds.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                data, found = bytes_of(text.as_py()), found.as_py() or []
                spans = [x for x in found if not x["unit"]]
                coded = [x for x in found if x["unit"]]
                passage = 0 if words else None
                if coded:
                    of_words = bytes_of_words(data, union_of(coded))
                    passage = sum(hi - lo for lo, hi in of_words)
                    if cut_words:
                        spans = spans + [{"lo": lo, "hi": hi} for lo, hi in of_words]
                cut = union_of(spans)
                edges = [0, *(x for span in cut for x in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                made.append(
                    (
                        len(data),
                        len(data) - len(kept),
                        len(cut),
                        hashlib.sha256(kept).hexdigest(),
                        kept.decode("utf-8", "ignore") if texts else None,
                        passage,
                    )
                )
            columns = list(zip(*made, strict=True)) if made else [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in ("doc_id", "rest")]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "rest", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "n_passage"],
            )

    return (
        rows.join(spans, KEY, "left")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "rest", "text", "spans")
        .mapInArrow(run, schema)
    )
