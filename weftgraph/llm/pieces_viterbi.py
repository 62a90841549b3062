"""SentencePiece encoding and decoding: an Aho-Corasick automaton over pieces drives one Viterbi
pass, and output links relax the best scores at each character.

Blanks become U+2581 and a text gets one in front, as the model expects. A character that no
piece has falls back to its UTF-8 bytes, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Stands for a U+2581 of the text itself; no valid text has a lone surrogate.
LITERAL = "\ud800"
#: A character by its bytes scores this much less than the worst piece.
PENALTY = 10.0
#: Words whose pieces a task remembers.
REMEMBERED = 200_000
#: Letters of the longest word that outlasts its text.
LONG = 64
#: Words that are taken through the automaton side by side.
LANES = 4_096


class Lanes:
    """The automaton as arrays, to run it over many words at once, a character of each per step.

    Transitions are a hash table of (state, character); the pieces that end at a state, along the
    output links, lie next to each other.
    """

    def __init__(self, pieces: Pieces):
        n = len(pieces.piece)
        self.worst = pieces.worst
        self.byte_ids = np.array(pieces.byte_ids, np.int32)
        self.raw_size = np.fromiter(map(len, pieces.raw), np.int64, len(pieces.raw))
        self.fail = np.array(pieces.fail, np.int32)
        keys = np.fromiter(pieces.follow.keys(), np.int64, len(pieces.follow))
        self.bits = max(8, (8 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        left, values = keys, np.fromiter(pieces.follow.values(), np.int32, len(keys))
        at = self.slots(keys)
        while len(left):
            # of several keys for one free slot the last written one stays, the others move on
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = left[free], values[free]
            rest = self.keys[at] != left
            left, values = left[rest], values[rest]
            at = (at[rest] + 1) & ((1 << self.bits) - 1)
        # of equal slots the key and the value may come from different writers: keys decide
        for key, value in pieces.follow.items():
            self.values[self.place(key)] = value
        own = [pieces.outputs(state) for state in range(n)]
        self.count = np.fromiter(map(len, own), np.int32, n)
        self.start = np.cumsum(self.count) - self.count
        flat = [one for found in own for one in found]
        self.size = np.array([one[0] for one in flat], np.int32)
        self.value = np.array([one[1] for one in flat], np.float64)
        self.number = np.array([one[2] for one in flat], np.int32)
        pieces.ending.clear()

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def place(self, key: int) -> int:
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while self.keys[at] != key:
            at = (at + 1) & ((1 << self.bits) - 1)
        return at

    def child(self, keys: np.ndarray) -> np.ndarray:
        """The state behind each (state, character), -1 without one."""
        at = self.slots(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.values[at], -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """States after a character each: along the longest pieces that may still come."""
        out = self.child(state << 21 | code)
        at, open_ = state.copy(), np.flatnonzero(out < 0)
        while len(open_):
            top = at[open_] == 0
            out[open_[top]] = 0
            open_ = open_[~top]
            at[open_] = self.fail[at[open_]]
            out[open_] = self.child(at[open_] << 21 | code[open_])
            open_ = open_[out[open_] < 0]
        return out.astype(np.int64)

    def best(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, numbers of pieces from the end on, and how many (-1: some character by
        several bytes).

        codes are the characters of words in rows; the words come in order, the longest first.
        """
        n, width = codes.shape
        score = np.zeros((n, width + 1))
        back = np.full((n, width + 1), -1, np.int64)
        state = np.zeros(n, np.int64)
        for i in range(1, width + 1):
            live = int(np.searchsorted(-sizes, -i, "right"))
            state = self.step(state[:live], codes[:live, i - 1])
            top, how = score[:live, i - 1] + self.worst, np.full(live, -1, np.int64)
            count, first = self.count[state], self.start[state]
            rows, turn = np.flatnonzero(count), 0
            while len(rows):
                one = first[rows] + turn
                value = score[rows, i - self.size[one]] + self.value[one]
                more = value > top[rows]
                top[rows[more]], how[rows[more]] = value[more], one[more]
                turn += 1
                rows = rows[count[rows] > turn]
            score[:live, i], back[:live, i] = top, how
        at, made = sizes.copy(), np.zeros(n, np.int64)
        numbers = np.zeros((n, width), "<i4")
        open_ = np.flatnonzero(at)
        while len(open_):
            one = back[open_, at[open_]]
            by_bytes = one < 0
            code = codes[open_, at[open_] - 1]
            lost = open_[by_bytes & (code >= 128)]
            numbers[open_, made[open_]] = np.where(
                by_bytes, self.byte_ids[np.minimum(code, 127)], self.number[one]
            )
            made[open_] += 1
            at[open_] -= np.where(by_bytes, 1, self.size[one])
            made[lost], at[lost] = -1, 0
            open_ = open_[at[open_] > 0]
        return score[np.arange(n), sizes], numbers, made


class Remembered(dict):
    """Piece numbers of words (bytes), found by a function where they are not known yet."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> bytes:
        return self.find(word)


@dataclass
class Pieces:
    """The automaton and tables that encoding and decoding need; built once, sent to the tasks."""

    follow: dict[int, int] = field(default_factory=dict)
    fail: list[int] = field(default_factory=lambda: [0])
    #: For a state: its own piece (number, size, score) or None, and the next state that has one.
    piece: list[tuple[int, int, float] | None] = field(default_factory=lambda: [None])
    output: list[int] = field(default_factory=lambda: [0])
    byte_ids: list[int] = field(default_factory=list)
    raw: list[bytes] = field(default_factory=list)
    worst: float = 0.0
    by_word: bool = True
    #: Words met of late and before: their pieces and scores, and those that do not decode to
    #: themselves; the steps and pieces of states met. All of one task.
    memory: Remembered = None
    scores: dict[str, float] = field(default_factory=dict)
    older: tuple[dict[str, bytes], dict[str, float]] = field(default_factory=lambda: ({}, {}))
    broken: set[str] = field(default_factory=set)
    steps: dict[int, int] = field(default_factory=dict)
    ending: dict[int, tuple[tuple[int, float, int], ...]] = field(default_factory=dict)
    lanes: Lanes | None = None

    def __post_init__(self):
        self.memory = Remembered(self.found)

    def tables(self) -> dict:
        """The tables alone, of plain types, whose size the vocabulary bounds: to broadcast."""
        own = ("memory", "scores", "older", "broken", "steps", "ending", "lanes")
        return {name: value for name, value in vars(self).items() if name not in own}

    def words(self, text: str) -> list[str]:
        """The text cut before each run of blanks, if no piece crosses one.

        Each word stands without its first blank: the marked words are these with a blank ahead.
        """
        if not self.by_word:
            return [text]
        parts = text.split(" ")
        if "" not in parts:
            return parts
        out, blanks = [], ""
        for part in parts:
            if part:
                out.append(blanks + part)
                blanks = ""
            else:
                blanks += " "
        if blanks:
            out.append(blanks[1:])
        return out

    def found(self, word: str) -> bytes:
        """Pieces of a word that was not met of late; remembers them, its score and its decoding."""
        ids = self.older[0].get(word)
        if ids is None:
            score, numbers = self.best(BLANK + word.replace(" ", BLANK))
            ids = np.array(numbers, "<i4").tobytes()
            again = b"".join(map(self.raw.__getitem__, numbers))
            if again != (" " + word.replace(LITERAL, BLANK)).encode("utf-8"):
                self.broken.add(word)
        else:
            score = self.older[1][word]
        self.memory[word], self.scores[word] = ids, score
        return ids

    def learn(self, texts: list[list[str]]) -> None:
        """Finds the pieces of all words of some texts that are not remembered, side by side."""
        new = [w for w in set().union(*texts) - self.memory.keys() if len(w) <= LONG]
        known, scores = self.older
        for word in [w for w in new if w in known]:
            self.memory[word], self.scores[word] = known[word], scores[word]
        new = sorted((w for w in new if w not in known), key=len, reverse=True)
        if not new:
            return
        if self.lanes is None:
            self.lanes = Lanes(self)
        for first in range(0, len(new), LANES):
            some = new[first : first + LANES]
            sizes = np.fromiter(map(len, some), np.int64, len(some)) + 1
            width = int(sizes[0])
            codes = np.full((len(some), width), ord(BLANK), np.int64)
            if width > 1:
                joined = "".join([w.ljust(width - 1, "\0") for w in some])
                rest = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
                codes[:, 1:] = rest.reshape(len(some), width - 1)
                codes[codes == 32] = ord(BLANK)
            score, numbers, made = self.lanes.best(codes, sizes)
            whole = np.flatnonzero(made >= 0)
            for row in np.flatnonzero(made < 0).tolist():
                self.found(some[row])
            count = made[whole]
            ends = np.cumsum(count)
            behind = np.repeat(ends, count) - 1 - np.arange(int(count.sum()))
            flat = numbers[np.repeat(whole, count), behind]
            data, cuts = flat.tobytes(), np.r_[0, 4 * ends].tolist()
            kept = [some[row] for row in whole.tolist()]
            self.memory.update(zip(kept, [data[i:j] for i, j in pairwise(cuts)], strict=True))
            self.scores.update(zip(kept, score[whole].tolist(), strict=True))
            self.check(kept, flat, ends)

    def check(self, words: list[str], flat: np.ndarray, ends: np.ndarray) -> None:
        """Decodes the pieces of words, which lie one after the other, and notes what differs.

        If all of it is right and every word's end is in its place, so is every word.
        """
        meant = [(" " + w).replace(LITERAL, BLANK).encode("utf-8") for w in words]
        sizes = np.cumsum(np.fromiter(map(len, meant), np.int64, len(meant)))
        again = b"".join(map(self.raw.__getitem__, flat.tolist()))
        made = np.cumsum(self.lanes.raw_size[flat])[ends - 1] if len(flat) else ends
        if again != b"".join(meant) or not np.array_equal(made, sizes):
            for word, i, j in zip(words, [0, *ends.tolist()], ends.tolist(), strict=False):
                one = b"".join(map(self.raw.__getitem__, flat[i:j].tolist()))
                if one != (" " + word).replace(LITERAL, BLANK).encode("utf-8"):
                    self.broken.add(word)

    def forget(self, words: list[str]) -> None:
        """Drops long words after their text, and turns to a new generation when one is full."""
        for word in words:
            if len(word) > LONG and word in self.memory:
                del self.memory[word], self.scores[word]
        if len(self.memory) >= REMEMBERED:
            self.older = (dict(self.memory), self.scores)
            self.memory, self.scores = Remembered(self.found), {}

    def step(self, state: int, code: int) -> int:
        """The state after a character: along the longest piece that may still come."""
        key, follow = state << 21 | code, self.follow
        while True:
            found = follow.get(state << 21 | code)
            if found is not None or not state:
                break
            state = self.fail[state]
        self.steps[key] = found or 0
        return found or 0

    def outputs(self, state: int) -> tuple[tuple[int, float, int], ...]:
        """(size, score, number) of all pieces that end at a state, along the output links."""
        out, at = [], state if self.piece[state] else self.output[state]
        while at:
            number, size, value = self.piece[at]
            out.append((size, value, number))
            at = self.output[at]
        self.ending[state] = tuple(out)
        return self.ending[state]

    def best(self, word: str) -> tuple[float, list[int]]:
        """Score and numbers of the pieces with the highest sum of scores; of equals the longer."""
        state, worst = 0, self.worst
        score, back = [0.0], [(1, 0.0, -1)]
        steps, ending = self.steps, self.ending
        for character in word:
            code = ord(character)
            after = steps.get(state << 21 | code)
            state = self.step(state, code) if after is None else after
            top, how = score[-1] + worst, None
            found = ending.get(state)
            for one in self.outputs(state) if found is None else found:
                value = score[-one[0]] + one[1]
                if value > top:
                    top, how = value, one
            score.append(top)
            back.append(how)
        ids: list[int] = []
        i = len(word)
        while i:
            how = back[i]
            if how is not None:
                ids.append(how[2])
                i -= how[0]
            else:
                i -= 1
                real = BLANK if word[i] == LITERAL else word[i]
                ids.extend(self.byte_ids[b] for b in reversed(real.encode("utf-8")))
        return score[-1], ids[::-1]

    def encode(self, text: str) -> tuple[float, np.ndarray, bool]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[float, np.ndarray, bool]]:
        """Sum of scores, piece numbers, and whether decoding them gives the text again, of each.

        Pieces decode one by one, so a text is decoded right if each of its words is.
        """
        cut = [
            self.words(text.replace(BLANK, LITERAL) if BLANK in text else text) if text else []
            for text in texts
        ]
        self.learn(cut)
        out = []
        for words in cut:
            ids = b"".join(map(self.memory.__getitem__, words))
            total = sum(map(self.scores.__getitem__, words), 0.0)
            out.append((total, np.frombuffer(ids, "<i4"), self.broken.isdisjoint(words)))
            if words and max(map(len, words)) > LONG:
                self.forget(words)
        self.forget([])
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def loaded(path: str = MODEL) -> Pieces:
    """Reads a model with byte pieces; the driver reads it, the tasks get the tables."""
    from sentencepiece import SentencePieceProcessor

    model, out = SentencePieceProcessor(model_file=path), Pieces()
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    out.byte_ids = [-1] * 256
    scores = []
    depth_first: deque[int] = deque()
    children: list[list[tuple[int, int]]] = [[]]
    for i, name in enumerate(names):
        if model.is_byte(i):
            out.byte_ids[int(name[3:-1], 16)] = i
            out.raw.append(bytes([int(name[3:-1], 16)]))
            continue
        out.raw.append(name.replace(BLANK, " ").encode())
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            out.raw[-1] = b""
            continue
        score = model.get_score(i)
        scores.append(score)
        out.by_word &= BLANK not in name.lstrip(BLANK)
        state = 0
        for character in name:
            key = state << 21 | ord(character)
            if key not in out.follow:
                out.follow[key] = len(out.piece)
                children[state].append((ord(character), len(out.piece)))
                children.append([])
                out.piece.append(None)
            state = out.follow[key]
        out.piece[state] = (i, len(name), score)
    if min(out.byte_ids) < 0:
        raise ValueError("the model needs a piece for each byte")
    out.worst = min(scores) - PENALTY
    out.fail, out.output = [0] * len(out.piece), [0] * len(out.piece)
    depth_first.extend(state for _, state in children[0])
    while depth_first:
        state = depth_first.popleft()
        for code, child in children[state]:
            at = out.fail[state]
            while at and at << 21 | code not in out.follow:
                at = out.fail[at]
            out.fail[child] = out.follow.get(at << 21 | code, 0)
            depth_first.append(child)
        link = out.fail[state]
        out.output[state] = link if out.piece[link] else out.output[link]
    return out


def encoded(docs: DataFrame, model: Pieces) -> DataFrame:
    """doc_id, ids (array of piece numbers), score and round_trip, a row for each of docs.

    round_trip tells whether decoding the ids gives the text again. A null text counts as empty,
    an empty one has no ids, repeated rows are encoded each for itself.
    """
    return _mapped(docs, model, True)


def encoded_digests(docs: DataFrame, model: Pieces) -> DataFrame:
    """As `encoded`, with n_ids, n_byte_ids and ids_sha256 (of 4-byte little-endian ids)."""
    return _mapped(docs, model, False)


def _mapped(docs: DataFrame, model: Pieces, whole: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model.tables())
    if whole:
        names, kinds = ["ids", "score", "round_trip"], [
            pa.list_(pa.int32()), pa.float64(), pa.bool_()
        ]
        schema = "ids array<int>, score double, round_trip boolean"
    else:
        names = ["n_ids", "n_byte_ids", "ids_sha256", "score", "round_trip"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_()]
        schema = "n_ids long, n_byte_ids long, ids_sha256 string, score double, round_trip boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(**shared.value)
        of_bytes = np.zeros(len(pieces.raw), np.int64)
        of_bytes[pieces.byte_ids] = 1
        for batch in sliced(batches):
            made: list[list] = [[] for _ in names]
            texts = [text.as_py() or "" for text in batch.column(1)]
            for score, ids, same in pieces.encode_all(texts):
                if whole:
                    row = (ids, score, same)
                else:
                    digest = hashlib.sha256(ids.tobytes()).hexdigest()
                    row = (len(ids), int(of_bytes[ids].sum()), digest, score, same)
                for column, value in zip(made, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(made, kinds, strict=True))],
                ["doc_id", *names],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, f"doc_id long, {schema}")


def decoded(rows: DataFrame, model: Pieces) -> DataFrame:
    """doc_id and text of rows with ids; null ids count as none."""
    shared = rows.sparkSession.sparkContext.broadcast(model.tables())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(**shared.value)
        for batch in sliced(batches):
            texts = [pieces.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        run, "doc_id long, text string"
    )
