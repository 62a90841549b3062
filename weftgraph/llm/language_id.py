"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte strings of 2 to 4 (letters in lower case, one
blank for anything else), hashed to a fixed number of buckets. Embeddings and softmax are trained
by stochastic gradient descent on a bounded sample of labelled rows; a temperature and a rejection
threshold are fitted on a part of it that training does not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftgraph.llm.common import sliced

#: At most about so many rows of a language, and of all together, are learned from (the sample's
#: bound); no language that has more gets fewer than the least.
SAMPLE = 1_000
ROWS = 16_000
LEAST = 25
BUCKETS = 1 << 13
SIZES = (2, 3, 4)
WIDTH = 16
#: Passes over the sample, and the least number of steps of a small one.
EPOCHS = 12
STEPS = 1_500
BATCH = 32
RATE = 20.0
#: Share of wrong labels among the accepted that the threshold may leave, and the standard
#: deviations by which the held-out rows must show more than that before it rises.
ERROR = 0.01
SURE = 1.645
#: Strings that are looked up at once.
CHUNK = 1 << 19
UNKNOWN = "und"

BLANKED = bytes(
    c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
LETTER = regex.compile(r"\p{L}")


def cleaned(text: str) -> bytes:
    data = text.lower().encode("utf-8", "surrogatepass").translate(BLANKED)
    return b" " + b" ".join(data.split()) + b" "


def buckets(data: np.ndarray, size: int) -> np.ndarray:
    """Bucket of each byte string of a size."""
    n = len(data) - size + 1
    out = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for i in range(size):
        out = (out ^ data[i : i + n]) * np.uint32(0x01000193)
    out ^= out >> np.uint32(15)
    return (out * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares of its strings."""
    data, counts = cleaned(text), np.zeros(BUCKETS, np.int64)
    for first in range(0, len(data), CHUNK):
        for size in SIZES:
            part = np.frombuffer(data[first : first + CHUNK + size - 1], np.uint8)
            if len(part) >= size:
                counts += np.bincount(buckets(part, size), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used.astype(np.uint16), (counts[used] / max(1, counts.sum())).astype(np.float32)


def score_sums(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Mean of the table's rows over the strings of each text; independent of its neighbours."""
    sums, counts = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))

    def add(parts: list[tuple[int, bytes]]) -> None:
        data = np.frombuffer(b"".join(x for _, x in parts), np.uint8)
        ends = np.cumsum([len(x) for _, x in parts])
        owner = np.array([i for i, _ in parts])
        for size in SIZES:
            begins = np.concatenate([[0], ends[:-1]])
            n = np.minimum(ends - begins - size + 1, CHUNK)
            full = n > 0
            if not full.any():
                continue
            rows = table[buckets(data, size)]
            edges = np.column_stack([begins[full], begins[full] + n[full]]).ravel()
            if edges[-1] == len(rows):
                edges = edges[:-1]
            np.add.at(sums, owner[full], np.add.reduceat(rows, edges, axis=0)[::2])
            np.add.at(counts, owner[full], n[full])

    held, size = [], 0
    for i, text in enumerate(texts):
        for first in range(0, len(text), CHUNK):
            held.append((i, text[first : first + CHUNK + max(SIZES) - 1]))
            size += len(held[-1][1])
            if size >= CHUNK:
                add(held)
                held, size = [], 0
    if held:
        add(held)
    return sums / np.maximum(counts, 1)[:, None]


@dataclass
class Model:
    """Languages, scores of each bucket, temperature and threshold."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        logits = (means + self.bias) * self.temperature
        powers = np.exp(logits - logits.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)


def trained(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model | None:
    """A model from (language, buckets, shares); None without rows."""
    languages = sorted({x[0] for x in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    wanted = np.array([languages.index(x[0]) for x in rows])
    held = order[: len(rows) // 5] if len(rows) >= 50 else order
    learn = order[len(rows) // 5 :] if len(rows) >= 50 else order
    embedding = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weights = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    # every fourth row is also seen as a tenth of its strings, so that short texts are learned
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(learn)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for first in range(0, len(learn), BATCH):
            batch = learn[first : first + BATCH]
            x = np.zeros((len(batch), BUCKETS), np.float32)
            for i, r in enumerate(batch):
                used, share = rows[r][1], rows[r][2]
                if len(used) > 10 and rng.integers(4) == 0:
                    pick = rng.choice(len(used), max(5, len(used) // 10), p=share / share.sum())
                    used, share = used[pick], np.full(len(pick), 1 / len(pick), np.float32)
                np.add.at(x[i], used, share)
            mean = x @ embedding
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), wanted[batch]] -= 1
            p /= len(batch)
            back = p @ weights.T
            weights -= np.float32(rate / 10) * (mean.T @ p)
            bias -= np.float32(rate / 10) * p.sum(axis=0)
            embedding -= np.float32(rate) * (x.T @ back)
    model = Model(languages, (embedding @ weights).astype(np.float64), bias, 1.0, 0.0)
    means = np.array([model.table[rows[r][1]].T @ rows[r][2] for r in held])
    truth = wanted[held]

    def loss(temperature: float) -> float:
        model.temperature = temperature
        p = model.probabilities(means)[np.arange(len(held)), truth]
        return -np.log(np.maximum(p, 1e-12)).mean()

    # a hotter model than the held-out rows call for would be sure of everything: 4 at most
    model.temperature = min(np.geomspace(0.25, 4, 25), key=loss)
    p = model.probabilities(means)
    sure, right = p.max(axis=1), p.argmax(axis=1) == truth
    model.threshold = threshold(sure, right, len(languages))
    return model


def threshold(sure: np.ndarray, right: np.ndarray, languages: int) -> float:
    """The least score at which the error is not shown to be over ERROR by the rows at or above it.

    Shown is what the lower confidence bound (Wilson's) of the share of wrong rows says: a few wrong
    rows of a small sample reject nothing, and on a large one the bound is the error itself. Where
    it is over at every score, nothing is accepted. Nothing is sure of less than a little over
    chance.
    """
    by = np.argsort(-sure, kind="stable")
    n = np.arange(1, len(by) + 1)
    share, z = np.cumsum(~right[by]) / n, SURE**2 / n
    lower = (share + z / 2 - np.sqrt(z * share * (1 - share) + z**2 / 4)) / (1 + z)
    # rows of the same score are accepted together
    last = np.append(np.diff(sure[by]) != 0, True)
    good = np.flatnonzero(last & (lower <= ERROR))
    floor = 1.2 / languages if languages > 1 else 0.0
    if not len(good):
        return float("inf")
    return floor if good[-1] == len(by) - 1 else max(floor, float(sure[by][good[-1]]))


def fitted(docs: DataFrame, usable: Column, sample: int = SAMPLE, total: int = ROWS) -> Model | None:
    """Learns from about `sample` of the usable rows with text and lang of each language.

    All languages are learned. The more there are, the fewer rows each gives, so that they are about
    `total` together, but LEAST of each. Rows of a language are taken by a hash of doc_id below a
    share of its rows; the texts stay in the tasks, which send the shares of buckets.
    """
    rows = docs.where(usable & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return None
    sample = max(min(sample, LEAST), min(sample, total // len(counts)))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / F.lit(1 << 40)
    share = F.create_map(
        *[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample / r["count"]))]
    )
    taken = rows.where(draw < share[F.col("lang")]).select("lang", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [shares(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.tobytes() for x, _ in made], pa.binary()),
                    pa.array([y.tobytes() for _, y in made], pa.binary()),
                ],
                ["lang", "used", "share"],
            )

    found = taken.mapInArrow(run, "lang string, used binary, share binary").toArrow().to_pylist()
    found.sort(key=lambda x: (x["lang"], x["used"], x["share"]))
    return trained(
        [
            (x["lang"], np.frombuffer(x["used"], np.uint16), np.frombuffer(x["share"], np.float32))
            for x in found
        ]
    )


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs with lang_pred, score (calibrated) and accepted.

    A text that is null or has no letter, and any text without a model, is `und` with score 0 and
    not accepted. `accepted` is false where the score is under the model's threshold. Columns of
    docs with these names give way.
    """
    names = ["lang_pred", "score", "accepted"]
    kept = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [x.as_py() for x in batch.column("text")]
            known = [model is not None and x is not None and bool(LETTER.search(x)) for x in texts]
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            own = [i for i, k in enumerate(known) if k]
            if own:
                p = model.probabilities(score_sums([cleaned(texts[i]) for i in own], model.table))
                score[own] = p.max(axis=1)
                for i, best in zip(own, p.argmax(axis=1), strict=True):
                    lang[i] = model.languages[best]
            accepted = np.array(known, bool) & (score >= (model.threshold if model else 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang), pa.array(score), pa.array(accepted)],
                [*batch.schema.names, *names],
            )

    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    added = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *added]))


def held_out(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves the remainder; false for a null doc_id."""
    part = F.crc32(F.col("doc_id").cast("string")) % modulus
    return F.coalesce(part == remainder, F.lit(False))
