"""Sharding, Merkle audits, ranks, components and the pipeline."""

import random
import zlib
from collections import Counter

import pytest
from llm_frames import clashing, documents, odd_texts, words
from pyspark.sql import functions as F

import corpus_pipeline
from weftgraph.llm import label_shards, warc_merkle
from weftgraph.llm.common import components, ranked, stored
from weftgraph.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_ranks_have_no_gaps(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(3), rng.choice([None, *range(50)]), i) for i in range(500)]
    found = ranked(stored(spark.createDataFrame(rows, "g long, o long, i long")), "g", "o", "at", 6)
    by = {}
    for r in found.collect():
        by.setdefault(r.g, []).append((r.at, (r.o is not None, r.o or 0, r.i)))
    for places in by.values():
        assert [p for p, _ in sorted(places)] == list(range(len(places)))
        assert [x for _, x in sorted(places)] == sorted(x for _, x in places)


def test_components_of_long_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert {r.node: r.root for r in found} == want
    assert len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [0, 70])
def test_shards_are_even_and_keep_copies_together(spark, hot):
    rng = random.Random(2)
    texts = [" ".join(words(rng, 5)) for _ in range(150)]
    texts += [t for t in texts[:20] for _ in range(rng.randrange(1, 4))] + odd_texts()[:9]
    texts += ["hot"] * hot
    rows = label_shards.numbered(clashing(documents(spark, texts)))
    found = label_shards.balanced(rows, label_shards.copy_links(rows)).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    sizes = Counter(r.shard for r in found)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    shards = {}
    for r in found:
        shards.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(s) == 1 for t, s in shards.items() if t != "hot")


def test_shards_of_no_rows_and_of_repeated_rows(spark):
    for docs in (documents(spark, []), documents(spark, ["x", "x", None], ids=[None, None, 1])):
        rows = label_shards.numbered(docs)
        assert label_shards.balanced(rows, label_shards.copy_links(rows)).count() == docs.count()


def test_audit_finds_what_differs(spark):
    rng = random.Random(3)
    pages = [(i, f"u{i}", None if i % 7 == 0 else "h" * (i % 5)) for i in range(-5, 300)]
    pages += [(None, "n", "x"), (4, "u4", "twice"), (4, "u4", "twice"), (10**12, "far", "")]
    other = list(pages)
    for _ in range(12):
        at = rng.randrange(len(other))
        other[at] = (other[at][0], other[at][1], "changed")
    for _ in range(5):
        other.pop(rng.randrange(len(other)))
    other += [(1000, "new", None), (4, "u4", "twice")]
    schema = "page_id long, url string, html string"
    one, two = (spark.createDataFrame(x, schema).withColumn("digest", F.lit("x")) for x in (pages, other))
    found = warc_merkle.audit(one, two, "page_id", ["url", "html"], 4).collect()
    a, b = Counter(pages), Counter(other)
    lost, gained = a - b, b - a
    seen = Counter(r.kind for r in found)
    assert 2 * seen["changed"] + seen["missing"] + seen["added"] == lost.total() + gained.total()
    assert {r.record_id for r in found} == {x[0] for x in lost} | {x[0] for x in gained}
    assert all(r.digest != r.replica_digest for r in found)
    assert warc_merkle.audit(one, one, "page_id", ["url", "html"]).count() == 0
    assert warc_merkle.audit(one.limit(0), one.limit(0), "page_id", ["url"]).count() == 0
    assert warc_merkle.audit(one.limit(0), two, "page_id", ["url"]).count() == len(other)


def test_audit_query_is_that_of_sql(spark):
    from compare import compare, connection

    name = "op1_warc_merkle"
    found = compare(spark, connection(FOLDER), FOLDER, QUERIES[name], ORACLES[name])
    assert found[0] is None if isinstance(found, tuple) else found is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rng = random.Random(4)
    passage = " ".join(words(rng, 120))
    leak = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    own = [" ".join(words(rng, 100)) for _ in range(2)]
    extra = [f"{own[0]} {passage}", f"{passage} {own[1]}", f"the {leak} and of", "123 !!"]
    docs = docs.unionByName(documents(spark, extra, ids=range(10_000, 10_004)))
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER))
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 10_003 not in kept["language"]
    assert len(kept["language"]) >= 0.97 * len(before)
    assert all(before[i] == r.text for i, r in kept["near_duplicates"].items())
    texts = [r.text for r in kept["near_duplicates"].values()]
    assert len(texts) == len(set(texts))
    assert set(kept["repeats"]) == set(kept["near_duplicates"])
    for i in (10_000, 10_001):
        assert passage not in kept["repeats"][i].text
    assert 10_002 in kept["repeats"] and 10_002 not in kept["leaks"]
    assert set(kept["tokens"]) == set(kept["leaks"])
    assert all(r.round_trip for r in kept["tokens"].values())


def test_pipeline_stages_keep_columns_of_any_name(spark):
    rng = random.Random(6)
    texts = [" ".join(words(rng, 60, 10**9)) for _ in range(12)]
    docs = documents(spark, [*texts, None, ""], langs=["en"] * 14)
    names = ["score", "lang_pred", "accepted", "leaked", "a.b", "row", "kept", "spans", "n_passage"]
    docs = docs.select("*", *[F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, FOLDER))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names], name
        for row in docs.collect():
            assert [row[n] for n in names] == [f"{n} of {row.doc_id}" for n in names]
    assert docs.count() == 12


def test_every_operator_has_its_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
