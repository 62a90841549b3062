"""Fill-in-middle: content-defined chunks whose token counts are remembered locate the cuts.

A rolling hash of the last bytes cuts a text into chunks, so that a passage which many texts share
gives the same chunks in all of them. A task remembers a summary of each chunk under its content:
its tokens, its characters, and whether it begins and ends with a letter. Summaries combine over
neighbouring chunks (a run of letters that crosses the boundary counts once), so that the chunk of
a cut follows from sums, and only that chunk is read token by token.

Tokens are runs of ASCII letters and all other characters one by one. A null text counts as empty;
a null doc_id is numbered by the text `null`. Rows that repeat are transformed each for itself,
alike. Texts that are empty or hold a marker stay plain, as do the rest of `SHARE` per cent.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Per cent of texts that are transformed, and of these the ones that begin with the suffix.
SHARE = 90
SUFFIX_FIRST = 20
SEED = "1"
#: Bytes that the rolling hash sees, the mean and the largest size of a chunk.
WINDOW = 16
CHUNK = 256
LARGEST = 4096
#: Bytes of chunks that a task remembers (twice as many for a moment).
REMEMBERED = 32 << 20

#: Letters as `a`, other characters by their first byte, later bytes of a character left out.
KIND = bytes(97 if 65 <= (c & 0xDF) <= 90 and c < 128 else 32 for c in range(256))
LATER = bytes(range(0x80, 0xC0))
LETTERS = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
TOKEN = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xBF]")
#: Multiplier of the rolling hash for a window of one byte; doubled windows square it.
FACTOR = 0x9E3779B1


@dataclass(frozen=True, slots=True)
class Summary:
    """What the counts of a text need to know about one chunk."""

    tokens: int
    characters: int
    begins: bool
    ends: bool


@dataclass
class Chunks:
    """Summaries of chunks by their content, remembered by a task in two generations."""

    memory: dict[bytes, Summary] = field(default_factory=dict)
    older: dict[bytes, Summary] = field(default_factory=dict)
    held: int = 0

    def summary(self, chunk: bytes) -> Summary:
        """The dictionary compares contents, so that equal hashes alone never share a summary."""
        found = self.memory.get(chunk)
        if found is None:
            found = self.older.get(chunk) or summarised(chunk)
            self.held += len(chunk)
            if self.held > REMEMBERED:
                self.older, self.memory, self.held = self.memory, {}, len(chunk)
            self.memory[chunk] = found
        return found


def summarised(chunk: bytes) -> Summary:
    """Tokens (and characters) that begin in a chunk, if no letter is before it."""
    kinds = chunk.translate(KIND, LATER)
    others = kinds.count(b" ")
    return Summary(
        len(kinds.split()) + others, len(kinds), chunk[0] in LETTERS, chunk[-1] in LETTERS
    )


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of a text: where the hash of the last bytes is one of few values."""
    n = len(data)
    if n <= CHUNK:
        return [n]
    rolled = np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(1)
    factor, size = FACTOR, 1
    while size < WINDOW:
        rolled = rolled[:-size] * np.uint32(factor) + rolled[size:]
        factor, size = factor * factor & 0xFFFFFFFF, 2 * size
    rolled ^= rolled >> np.uint32(15)
    rolled *= np.uint32(0x85EBCA6B)
    found = np.flatnonzero(rolled < np.uint32((1 << 32) // CHUNK)) + WINDOW
    ends, last = [], 0
    for end in [*found.tolist(), n]:
        while end - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


class Layout:
    """The chunks of one text with the tokens and characters before each of them."""

    def __init__(self, data: bytes, chunks: Chunks):
        self.data, self.ends = data, boundaries(data) if data else []
        self.tokens, self.characters, self.joined = [0], [0], []
        last, letter = 0, False
        for end in self.ends:
            one = chunks.summary(data[last:end])
            joined = letter and one.begins
            self.joined.append(joined)
            self.tokens.append(self.tokens[-1] + one.tokens - joined)
            self.characters.append(self.characters[-1] + one.characters)
            last, letter = end, one.ends

    def cut(self, tokens: int) -> tuple[int, int]:
        """Bytes and characters before the token of that number (from 0), or of the whole text."""
        if tokens >= self.tokens[-1]:
            return len(self.data), self.characters[-1]
        at = int(np.searchsorted(self.tokens, tokens, "right")) - 1
        first = self.ends[at - 1] if at else 0
        chunk = self.data[first : self.ends[at]]
        skip = tokens - self.tokens[at] + self.joined[at]
        for turn, found in enumerate(TOKEN.finditer(chunk)):
            if turn == skip:
                break
        before = len(chunk[: found.start()].translate(None, LATER))
        return first + found.start(), self.characters[at] + before


def numbers(seed: str, doc_id: int | None) -> list[int]:
    """The first four groups of eight digits of the sha256 of `<seed>:<doc_id>`."""
    name = f"{seed}:{'null' if doc_id is None else doc_id}"
    digits = hashlib.sha256(name.encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain) and output, a row for
    each of docs.

    form is `plain` (output is the text), `psm` (prefix, suffix, middle behind their markers) or
    `spm` (suffix, prefix, middle). The cuts fall on tokens, chosen by the seed and doc_id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in sliced(batches):
            made: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py() or b""
                h1, h2, h3, h4 = numbers(seed, doc_id)
                layout = Layout(data, chunks)
                n = layout.tokens[-1]
                marked = any(m in data for m in (PREFIX, SUFFIX, MIDDLE))
                if not data or marked or h3 % 100 >= SHARE:
                    row = (n, "plain", None, None, data)
                else:
                    a, before = layout.cut(min(h1 % (n + 1), h2 % (n + 1)))
                    b, until = layout.cut(max(h1 % (n + 1), h2 % (n + 1)))
                    prefix, middle, suffix = data[:a], data[a:b], data[b:]
                    if h4 % 100 < SUFFIX_FIRST:
                        out = b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
                        row = (n, "spm", before, until - before, out)
                    else:
                        out = b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
                        row = (n, "psm", before, until - before, out)
                for column, value in zip(made, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(made, kinds, strict=True))],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    return rows.mapInArrow(
        run,
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary",
    ).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone.

    The text holds no marker, and no marker can begin in a part and end in the marker behind it:
    the first place of each is the one that was put in.
    """

    def parts(second: bytes) -> tuple[Column, Column, Column]:
        # all markers are of three characters
        rest = F.substring(output, 4, 2**31 - 1)
        one = F.split(rest, second.decode(), 2)
        two = F.split(F.get(one, 1), MIDDLE.decode(), 2)
        return F.get(one, 0), F.get(two, 0), F.get(two, 1)

    prefix, suffix, middle = parts(SUFFIX)
    after, before, between = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(before, between, after))
        .otherwise(output)
    )
