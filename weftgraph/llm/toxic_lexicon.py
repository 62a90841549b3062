"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, with exception phrases.

Folding maps homoglyphs, marked letters and digits that stand for letters to plain letters, so
that disguised words look like themselves. The words of the lexicon and their weights are learned
from labelled rows by a sparse logistic regression; matches inside an exception phrase don't
count; the sum of weights is normalised by the text's length and calibrated to a probability.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import sliced, stored

#: Rows of each label that are learned from (about), words that are weighed, and their least count.
SAMPLE = 10_000
CANDIDATES = 300
LEAST = 5
STEPS = 400
SPARSE = 3e-4
# Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = (
    "white trash can",
    "trash bag",
    "trash can",
    "trash collection",
    "send in the clowns",
    "clown fish",
    "sore loser",
)
# What looks like a letter. The letters l and i, and o and zero, are one class each.
LOOKALIKES = {
    "a": "аα@4",
    "b": "ЬβВ8",
    "c": "сϲ",
    "d": "ԁ",
    "e": "еεє3",
    "g": "ɡ",
    "h": "һн",
    "i": "іιıl1|Ӏ",
    "j": "ј",
    "k": "кκ",
    "m": "м",
    "n": "ո",
    "o": "оοσ0",
    "p": "рρ",
    "q": "ԛ",
    "s": "ѕ5$",
    "t": "тτ7",
    "u": "υս",
    "v": "ν",
    "w": "ԝω",
    "x": "хχ",
    "y": "уүγ",
    "z": "ᴢ",
}
#: Signs that stand for a letter only where a letter or digit follows.
SIGN = re.compile(r"[$@|](?![^\W_])")


def folding() -> dict[int, str | None]:
    """Character to folded character: blanks for ASCII signs, none for what isn't seen."""
    table: dict[int, str | None] = {c: " " for c in range(128) if not chr(c).isalnum()}
    table |= {ord(c): " " for c in "«»“”„‘’…–—¿¡ "}
    table |= dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF], None)
    marked = [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]
    for c in [*marked, *range(0x1D400, 0x1D6A4)]:
        plain = unicodedata.normalize("NFKD", chr(c))[0].lower()
        if plain.isascii() and plain.isalpha():
            table[c] = plain
    for letter, others in LOOKALIKES.items():
        for c in others:
            table[ord(c)] = letter
            table[ord(c.lower())] = letter
    for c, plain in list(table.items()):
        if plain == "l":
            table[c] = "i"
    return table


def folded(text: str | None, table: dict[int, str | None]) -> str:
    """Folded words between single blanks, with one at each end."""
    low = (text or "").lower()
    if "$" in low or "@" in low or "|" in low:
        low = SIGN.sub(" ", low)
    return f" {' '.join(low.translate(table).split())} "


@dataclass
class Lexicon:
    """Weights of folded words, exceptions, and the calibration of the normalised sum."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float = 1.0
    offset: float = 0.0

    def matcher(self) -> ahocorasick.Automaton:
        table, found = folding(), ahocorasick.Automaton()
        for phrase in self.exceptions:
            word = folded(phrase, table)
            found.add_word(word, (0.0, len(word), True))
        for word, weight in self.weights.items():
            known = found.get(f" {word} ", None)
            if known is None:
                found.add_word(f" {word} ", (weight, len(word) + 2, False))
        found.make_automaton()
        return found


def matched(text: str, found: ahocorasick.Automaton) -> tuple[float, int, int]:
    """Sum of weights, matches and exceptions of a folded text."""
    if not len(found):
        return 0.0, 0, 0
    hits = [(end - size + 1, end, w, harmless) for end, (w, size, harmless) in found.iter(text)]
    if not hits:
        return 0.0, 0, 0
    spared = [(a, b) for a, b, _, harmless in hits if harmless]
    total, count, at = 0.0, 0, 0
    spared.sort()
    reach: list[tuple[int, int]] = []
    for a, b in spared:
        if reach and a <= reach[-1][1]:
            reach[-1] = (reach[-1][0], max(reach[-1][1], b))
        else:
            reach.append((a, b))
    for a, b, weight, harmless in sorted(hits):
        while at < len(reach) and reach[at][1] < b:
            at += 1
        if not harmless and not (at < len(reach) and reach[at][0] <= a):
            total += weight
            count += 1
    return total, count, len(spared)


def normalised(total: float, n_words: int) -> float:
    """A sum of weights for its length: longer texts need more to look as bad."""
    return total / math.log2(4 + n_words)


def fitted(
    docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS
) -> Lexicon:
    """Learns from the texts of at most about SAMPLE labelled rows (doc_id, toxic 0 or 1) of each
    label.

    The sample is drawn from the labels, and its bound lets it be broadcast: texts are not
    shuffled. Equal texts count once. Without texts of both labels the lexicon is empty.
    """
    marks = (
        labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .distinct()
    )
    counts = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return Lexicon({}, exceptions, 1.0, -2.0)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / F.lit(1 << 40)
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE / counts[1])).otherwise(
        min(1.0, SAMPLE / counts[0])
    )
    sample = F.broadcast(marks.where(draw < share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = folding()
        for batch in sliced(batches):
            words = [sorted(set(folded(x.as_py(), table).split())) for x in batch.column(1)]
            sizes = [len((x.as_py() or "").split()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(sizes, pa.int64()),
                    pa.array(words, pa.list_(pa.string())),
                ],
                ["toxic", "text_hash", "size", "words"],
            )

    taken = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.col("text").cast("string").alias("text"))
        .join(sample, "doc_id")
        .select("toxic", "text", F.xxhash64("text").alias("text_hash"))
        .mapInArrow(run, "toxic int, text_hash long, size long, words array<string>")
        .dropDuplicates(["text_hash", "toxic"])
    )
    taken = stored(taken)
    n = {r["toxic"]: r["count"] for r in taken.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Lexicon({}, exceptions, 1.0, -2.0)
    by_word = taken.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")
    )
    bad_share = F.col("bad") / n[1]
    good_share = (F.col("n") - F.col("bad")) / n[0]
    both = F.col("n") / (n[0] + n[1])
    strength = (bad_share - good_share) / F.sqrt(both * (1.0001 - both))
    best = (
        by_word.where(F.col("bad") >= LEAST)
        .where(bad_share > 2 * good_share)
        .orderBy(strength.desc(), "word")
        .limit(CANDIDATES)
    )
    candidates = [r["word"] for r in best.collect()]
    if not candidates:
        return Lexicon({}, exceptions, 1.0, -2.0)
    place = {w: i for i, w in enumerate(candidates)}
    has = F.array_intersect("words", F.array(*[F.lit(w) for w in candidates]))
    sample = taken.select("toxic", "size", has.alias("has")).orderBy("text_hash").toArrow()
    truth = np.asarray(sample.column("toxic")).astype(np.float64)
    sizes = sample.column("size").to_pylist()
    x = np.zeros((len(truth), len(candidates)), np.float32)
    for i, own in enumerate(sample.column("has").to_pylist()):
        x[i, [place[w] for w in own]] = 1
    weights = sparse_weights(x, truth)
    kept = weights > 0.05 * weights.max() if weights.max() > 0 else weights > 0
    lexicon = Lexicon({w: float(weights[i]) for w, i in place.items() if kept[i]}, exceptions)
    score = np.array([normalised(t, n) for t, n in zip(x @ (weights * kept), sizes, strict=True)])
    lexicon.slope, lexicon.offset = calibrated(score, truth)
    return lexicon


def sparse_weights(x: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """Logistic regression with weights of 0 or more and a penalty on their sum, by projected
    steps with momentum."""
    truth, n = truth.astype(np.float32), x.shape[1]
    penalty = np.append(np.full(n, SPARSE, np.float32), np.float32(0))
    low = np.append(np.zeros(n, np.float32), np.float32(-np.inf))
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    v = np.ones(n + 1, np.float32)
    for _ in range(20):  # the greatest eigenvalue bounds the step
        v = x.T @ (x @ v) / len(x)
        top = float(np.linalg.norm(v))
        v /= top
    rate = np.float32(4 / top)
    at = before = np.zeros(n + 1, np.float32)
    for step in range(STEPS):
        ahead = at + np.float32(step / (step + 3)) * (at - before)
        wrong = 1 / (1 + np.exp(-(x @ ahead))) - truth
        before, at = at, np.maximum(low, ahead - rate * (x.T @ wrong / len(x) + penalty))
    return at[:n].astype(np.float64)


def calibrated(score: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a slightly regularised logistic curve, by Newton's steps."""
    scale = float(score.std()) or 1.0
    x = np.column_stack([score / scale, np.ones(len(score))])
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ at))
        step = x.T @ (p - truth) + np.array([1e-2, 0]) * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        at -= np.clip(np.linalg.solve(curve, step), -2, 2)
    return max(0.0, float(at[0] / scale)), float(at[1])


def scored(docs: DataFrame, lexicon: Lexicon, flag: Column | None = None) -> DataFrame:
    """doc_id, held_out (the flag, else false), score, predicted, n_matches and n_exceptions.

    A null or empty text has the score of one without matches; repeated rows are scored each for
    itself; other columns are not read.
    """
    table = folding()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lexicon.matcher()
        for batch in sliced(batches):
            made = []
            for text in batch.column(2):
                text = text.as_py()
                total, count, spared = matched(folded(text, table), found)
                value = lexicon.slope * normalised(total, len((text or "").split()))
                made.append((1 / (1 + math.exp(-value - lexicon.offset)), count, spared))
            score, count, spared = zip(*made, strict=True) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score, pa.float64()),
                    pa.array([int(x >= 0.5) for x in score], pa.int32()),
                    pa.array(count, pa.int64()),
                    pa.array(spared, pa.int64()),
                ],
                ["doc_id", "held_out", "score", "predicted", "n_matches", "n_exceptions"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        (F.lit(False) if flag is None else flag).alias("held_out"),
        F.col("text").cast("string"),
    )
    return rows.mapInArrow(
        run,
        "doc_id long, held_out boolean, score double, predicted int, n_matches long,"
        " n_exceptions long",
    )
