"""The language model against brute force over plain counts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_frames import clashing, documents, odd_texts, words
from pyspark.sql import functions as F

from weftgraph.llm import bloom_lm
from weftgraph.llm.language_id import held_out
from weftgraph.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), " end"]


def plain_base(rows):
    """(n_tokens, n_known, N, base_score) of each row."""
    counts = Counter()
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            counts.update(plain_tokens(text))
    total, each = sum(counts.values()), math.log10(sum(counts.values()) + len(counts) + 1)
    out = []
    for _, text in rows:
        tokens = plain_tokens(text)
        base = math.fsum(math.log10(counts[t] + 1) - each for t in tokens)
        out.append((len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    return out


def plain_scores(rows, order, base=1.5, mass=500.0, least=None):
    """log10 probabilities by the formula of the module, from exact counts in dictionaries."""
    edges = bloom_lm.least_counts(base).tolist()
    grams = [Counter() for _ in range(order + 1)]
    begins = [" begin"] * max(1, order - 1)
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            tokens = [*begins, *plain_tokens(text)]
            for n in range(1, order + 1):
                grams[n].update(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))

    def bounds(n, gram):
        count = grams[n][gram]
        level = max(i for i, e in enumerate(edges) if e <= count)
        lowest = least[n] if least else 1
        if level < lowest:
            return 0, edges[lowest] - 1
        return edges[level], edges[level + 1] - 1

    own = [g for g in grams[1] if g != (" begin",)]
    whole = sum(bounds(1, g)[0] for g in own)
    out = []
    for _, text in rows:
        tokens, total = [*begins, *plain_tokens(text)], []
        for i in range(len(begins), len(tokens)):
            p = (bounds(1, (tokens[i],))[0] + 1) / (whole + len(own) + 1)
            for n in range(2, order + 1):
                high = bounds(n - 1, tuple(tokens[i - n + 1 : i]))[1]
                low = bounds(n, tuple(tokens[i - n + 1 : i + 1]))[0]
                p = min(1.0, (low + mass * p) / (high + mass))
            total.append(math.log10(p))
        out.append(math.fsum(total))
    return out


def texts_of(seed):
    rng = random.Random(seed)
    out = odd_texts()
    for _ in range(60):
        line = " ".join(words(rng, rng.randrange(1, 60), 40))
        out.append(rng.choice([line, line.upper(), line + "\n" + line, "W1 w1\tÉ é ÀB"]))
    return out


def check(found, rows, want, scores):
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert len(found) == len(rows)
    for (doc_id, _), (n, known, total, base), score in zip(rows, want, scores, strict=True):
        r = by[doc_id].pop()
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-5, abs=1e-9)


@pytest.mark.parametrize("order, hot", [(2, 1 << 20), (3, 4), (1, 1)])
def test_scores_are_those_of_brute_force(spark, monkeypatch, order, hot):
    """With many bits hardly a probe is wrong; few hot tokens leave most to the join."""
    monkeypatch.setattr(bloom_lm, "HASHES", 12)
    monkeypatch.setattr(bloom_lm, "ENTRY_BITS", 640)
    monkeypatch.setattr(bloom_lm, "HOT", hot)
    monkeypatch.setattr(bloom_lm, "COUNTED", 500)
    monkeypatch.setattr(bloom_lm, "PART_BYTES", 1 << 17)
    texts = texts_of(order)
    rows = list(zip([None, *range(1, len(texts))], texts, strict=True))
    docs = clashing(documents(spark, texts, [i for i, _ in rows])).withColumnRenamed("part", "a.b")
    docs = docs.withColumn("token", F.lit("x")).withColumn("gram", F.lit("x"))
    model = bloom_lm.fitted(docs, ~held_out(7, 2), order)
    assert model.filter.parts > 1 and len(model.hot) <= hot
    check(
        bloom_lm.scored(docs, model).collect(), rows, plain_base(rows), plain_scores(rows, order)
    )


def test_filter_keeps_within_its_bits(spark, monkeypatch):
    """Levels that do not fit are left out of the score alone, and counts stay exact."""
    monkeypatch.setattr(bloom_lm, "HASHES", 12)
    monkeypatch.setattr(bloom_lm, "ENTRY_BITS", 640)
    texts = texts_of(9)
    rows = list(zip(range(len(texts)), texts, strict=True))
    docs = documents(spark, texts)
    model = bloom_lm.fitted(docs, ~held_out(7, 2), 2, bits=1_200_000)
    assert 64 * len(model.filter.bits) <= 1_200_000 + 128 * model.filter.parts
    assert max(model.filter.least.values()) > 1
    want = plain_scores(rows, 2, least=model.filter.least)
    check(bloom_lm.scored(docs, model).collect(), rows, plain_base(rows), want)


@pytest.mark.parametrize("order, bits", [(2, 1_200_000), (3, 1_200_000), (2, 0), (1, 0)])
def test_what_the_filter_leaves_out_is_joined(spark, monkeypatch, order, bits):
    """With `whole`, scores are those of all counts, whatever fits into the filter."""
    monkeypatch.setattr(bloom_lm, "HASHES", 12)
    monkeypatch.setattr(bloom_lm, "ENTRY_BITS", 640)
    monkeypatch.setattr(bloom_lm, "COUNTED", 500)
    texts = texts_of(9)
    rows = list(zip([None, *range(1, len(texts)), 5, 5], [*texts, texts[5], texts[5]], strict=True))
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    model = bloom_lm.fitted(docs, ~held_out(7, 2), order, bits=bits)
    assert max(model.filter.least.values()) > 1
    found = bloom_lm.scored(docs, model, whole=True).collect()
    check(found, rows, plain_base(rows), plain_scores(rows, order))


@pytest.mark.parametrize("order, hot, lowest", [(2, 4, 2), (3, 1 << 20, 2), (2, 4, 1)])
def test_questions_travel_packed(spark, monkeypatch, order, hot, lowest):
    """Rows follow chunks and parts, not n-grams; bytes are few; scores are those of all counts."""
    monkeypatch.setattr(bloom_lm, "HASHES", 12)
    monkeypatch.setattr(bloom_lm, "ENTRY_BITS", 640)
    monkeypatch.setattr(bloom_lm, "HOT", hot)
    monkeypatch.setattr(bloom_lm, "COUNTED", 500)
    monkeypatch.setattr(bloom_lm, "PART_BYTES", 1 << 17)
    monkeypatch.setattr(bloom_lm, "ASKED_BYTES", 1 << 12)
    texts = texts_of(5)
    rows = list(zip([None, *range(1, len(texts)), 5, 5], [*texts, texts[5], texts[5]], strict=True))
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    model = bloom_lm.fitted(docs, ~held_out(7, 2), order, lowest=lowest)
    assert model.filter.parts > 1 and model.filter.least[1] == 1 and model.filter.least[2] == lowest
    plain = docs.selectExpr("doc_id", "cast(text as binary) as text")
    shared = spark.sparkContext.broadcast(model.tables())
    asked = bloom_lm.asked(plain, model, shared, True).collect()
    chunks = {r.chunk for r in asked}
    assert len(asked) <= len(chunks) * (1 + order * model.filter.parts)
    assert sum(r.gram == 0 for r in asked) == len(chunks) > 4
    n_tokens = sum(len(plain_tokens(t)) for _, t in rows)
    asked_bytes = sum(len(r.data) for r in asked if r.gram > 1)
    assert asked_bytes <= 4 * n_tokens * (order - 1) and (asked_bytes > 0) == (lowest > 1)
    found = bloom_lm.scored(docs, model, whole=True).collect()
    check(found, rows, plain_base(rows), plain_scores(rows, order))


def test_filter_never_misses_and_seldom_errs(spark):
    texts = [" ".join(words(random.Random(i), 400, 3000)) for i in range(30)]
    docs = documents(spark, texts)
    model = bloom_lm.fitted(docs, F.lit(True), 2)
    counts = Counter(t for x in texts for t in plain_tokens(x))
    hashes = [np.uint64(bloom_lm.xxhash.xxh64_intdigest(t.encode())) for t in counts]
    found = model.filter.levels(1, np.array(hashes))
    real = bloom_lm.levels_of(np.array(list(counts.values())))
    assert (found >= real).all() and (found > real).mean() < 0.05
    other = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    assert (model.filter.levels(2, other) > 0).mean() < 0.05


def test_probabilities_of_a_context_sum_to_one_at_most(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "HASHES", 12)
    monkeypatch.setattr(bloom_lm, "ENTRY_BITS", 640)
    texts = [" ".join(words(random.Random(i), 200, 12)) for i in range(20)]
    model = bloom_lm.fitted(documents(spark, texts), F.lit(True), 2)
    vocabulary = sorted({w for t in texts for w in t.split()})
    for context in ["", *vocabulary[:4], "unseen"]:
        some = [f"{context} {w}".encode() for w in [*vocabulary, "new"]] + [context.encode()]
        rows = bloom_lm.Texts.of(some, 2)
        p = bloom_lm.probabilities(rows, model)
        # the token after the context: the last but one, and the end for the context alone
        last = np.flatnonzero(np.r_[rows.text[1:] != rows.text[:-1], True])
        total = p[last[:-1] - 1].sum() + p[last[-1]]
        assert 0.3 < total <= 1 + 1e-9


def test_scores_of_repeated_rows_and_of_none(spark):
    assert bloom_lm.scored(
        documents(spark, []), bloom_lm.fitted(documents(spark, []), F.lit(True))
    ).count() == 0
    rows = [(4, "rare words here"), (4, "rare words here"), (4, "other"), (None, None)]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    model = bloom_lm.fitted(docs, F.lit(False))
    found = bloom_lm.scored(docs, model).collect()
    assert len(found) == 4 and all(r.n_known == 0 and r.base_score == 0 for r in found)
    model = bloom_lm.fitted(docs, ~held_out(7, 2))
    one = [r for r in bloom_lm.scored(docs, model).collect() if r.n_tokens == 4]
    assert len(one) == 2 and one[0] == one[1] and one[0].n_known == 4


def test_query_beats_the_base_on_held_out_rows(spark):
    rows = [
        (r.doc_id, r.text)
        for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    ]
    found = QUERIES["op11_bloom_lm"](spark, FOLDER).collect()
    assert {r.doc_id: r.held_out for r in found} == {i: is_held_out(i) for i, _ in rows}
    for r, (n, known, total, base) in zip(
        sorted(found, key=lambda r: r.doc_id),
        [x for _, x in sorted(zip([i for i, _ in rows], plain_base(rows), strict=True))],
        strict=True,
    ):
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
