"""Spelling variants and fill-in-middle against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import compare, connection
from llm_frames import clashing, documents, odd_texts, words
from pyspark.sql import functions as F

from weftgraph.llm import fill_middle, spelling_variants
from weftgraph.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    # words one edit apart share a word with a gap in the same place, or one is the other's
    holes = {}
    for w in counts:
        for i in range(len(w)):
            holes.setdefault((i, w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in counts}
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    for w in counts:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    out = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(near[w]), counts[form] if form else None)
    final = {}
    for w, (form, *rest) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        final[w] = (form, root, *rest)
    return final


def found_variants(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def misspelt_texts(seed, letters="abcdeghké", n=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 9))) for _ in range(25)]
    out = []
    for _ in range(n):
        some = []
        for _ in range(40):
            w = rng.choice(stems[: 1 + rng.randrange(25)])
            i = rng.randrange(len(w))
            turn = rng.randrange(12)
            if turn == 0:
                w = w[:i] + rng.choice(letters) + w[i + 1 :]
            elif turn == 1:
                w = w[:i] + w[i + 1 :]
            elif turn == 2:
                w = w[:i] + rng.choice(letters) + w[i:]
            some.append(w.upper() if turn == 3 and w.isascii() else w)
        out.append(rng.choice([" ", "-", "\n", "文"]).join(some))
    return out


@pytest.mark.parametrize("block", [spelling_variants.BLOCK, 16])
def test_variants_are_those_of_brute_force(spark, monkeypatch, block):
    """Small blocks, and blocks that are all dealt in tiles."""
    monkeypatch.setattr(spelling_variants, "BLOCK", block)
    monkeypatch.setattr(spelling_variants, "ROWS", 50)
    texts = misspelt_texts(block) + odd_texts() + ["ÀÀÀÀÀ ààààà ×÷×÷× ÿÿÿÿÿÿ " * 4]
    texts += ["ab" * 3000 + " " + "ab" * 3000 + "a " + "ba" * 3000 + " "] * 3
    ids = [None, *range(1, len(texts))]
    docs = clashing(documents(spark, texts, ids)).withColumnRenamed("part", "n.w")
    docs = docs.withColumn("word", F.lit("x"))
    want = plain_variants(zip(ids, texts, strict=True))
    assert sum(v[2] for v in want.values()) > 0 and any(w != v[1] for w, v in want.items())
    assert found_variants(spelling_variants.variants(docs)) == want


def test_variants_query_on_whole_tables(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert found_variants(QUERIES["op12_spelling_variants"](spark, FOLDER)) == plain_variants(rows)


def test_variants_of_repeated_rows_and_of_none(spark):
    assert spelling_variants.variants(documents(spark, [])).count() == 0
    assert spelling_variants.variants(documents(spark, [None, "", "a b c"])).count() == 0
    rows = [(7, "tomato tomatos")] * 5 + [(8, "tomato")]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert found_variants(spelling_variants.variants(docs)) == plain_variants(rows)


def test_block_choices_hold_every_pair():
    rng = random.Random(5)
    letters = [c for c in range(256) if spelling_variants.RUNS[c] == c and c != 32]
    pairs = []
    for _ in range(2000):
        w = bytes(rng.choice(letters) for _ in range(rng.randrange(5, 12)))
        i = rng.randrange(len(w))
        other = rng.choice([w[:i] + bytes([rng.choice(letters)]) + w[i + 1 :], w[:i] + w[i + 1 :]])
        pairs.append((w, other))
    a = spelling_variants.block_keys([p[0] for p in pairs])
    b = spelling_variants.block_keys([p[1] for p in pairs])
    assert (a == b).any(axis=0).all()


TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain_form(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    digits = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def cut_texts():
    rng = random.Random(11)
    shared = " ".join(words(rng, 900))
    out = odd_texts() + ["<P>", "a<S>b", "x <M>", "<", "<S", "<<P", "é", "aé" * 4000, "a" * 20_000]
    for _ in range(80):
        own = "".join(rng.choice("ab <SPM>é文\n1") for _ in range(rng.randrange(400)))
        own = re.sub("<[SPM]>", "<", own)
        out.append(own + shared[rng.randrange(300) :] + own)
    return out


def test_forms_are_those_of_brute_force(spark):
    texts = cut_texts()
    ids = [None, *range(1, len(texts))]
    docs = clashing(documents(spark, texts, ids)).withColumnRenamed("part", "n.form")
    docs = docs.withColumn("output", F.lit("x"))
    rows = fill_middle.transformed(docs).withColumn(
        "back", fill_middle.restored(F.col("output"), F.col("form"))
    )
    found = {r.doc_id: r for r in rows.collect()}
    assert len(found) == len(texts)
    for doc_id, text in zip(ids, texts, strict=True):
        r = found[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_form(doc_id, text)
        assert r.back == (text or "")
    assert {r.form for r in found.values()} == {"plain", "psm", "spm"}


def test_chunks_of_shared_passages_are_remembered(monkeypatch):
    rng = random.Random(12)
    shared = (" ".join(words(rng, 3000))).encode()
    chunks = fill_middle.Chunks()
    fill_middle.Layout(b"one start " + shared, chunks)
    before = set(chunks.memory)
    fill_middle.Layout(b"a quite different beginning, " + shared, chunks)
    new = set(chunks.memory) - before
    assert sum(map(len, new)) < 0.1 * len(shared)
    # a small memory gives the same counts
    monkeypatch.setattr(fill_middle, "REMEMBERED", 1000)
    small = fill_middle.Layout(shared, fill_middle.Chunks())
    assert small.tokens == fill_middle.Layout(shared, chunks).tokens
    assert sum(map(len, fill_middle.Chunks().memory)) == 0
    assert np.all(np.diff(small.ends) <= fill_middle.LARGEST)


def test_forms_of_repeated_rows_and_of_none(spark):
    assert fill_middle.transformed(documents(spark, [])).count() == 0
    docs = documents(spark, ["same words here", "same words here", "other"], ids=[4, 4, 4])
    rows = fill_middle.transformed(docs).collect()
    assert Counter(r.output for r in rows)[plain_form(4, "same words here")[4]] == 2


def test_fill_middle_query_is_that_of_sql(spark):
    name = "op13_fill_middle"
    assert compare(spark, connection(FOLDER), FOLDER, QUERIES[name], ORACLES[name])[0] is None
