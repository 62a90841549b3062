"""Suffix merges, SimHash and MinHash against brute force, and rows out of the ordinary."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_frames import clashing, documents, odd_texts, words
from pyspark.sql import functions as F

import corpus_pipeline
from weftgraph.llm import minhash_bins, queries, simhash_trie, suffix_merge

LENGTH = 200


def brute_cut(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cut = np.zeros(len(d) + 1, int)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                cut[i] += 1
                cut[i + length] -= 1
        gone = np.cumsum(cut)[:-1] > 0 if len(d) else np.zeros(0, bool)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(rng):
    """Texts that share passages, whole, cut and altered, some many times."""
    shared = [" ".join(words(rng, rng.randrange(20, 90))) for _ in range(6)]
    out = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            part = rng.choice(shared) if rng.random() < 0.5 else " ".join(words(rng, 30))
            if rng.random() < 0.5:
                a, b = sorted(rng.sample(range(len(part)), 2))
                part = part[a:b]
            if rng.random() < 0.3 and part:
                at = rng.randrange(len(part))
                part = part[:at] + "é" + part[at + 1 :]
            parts.append(part)
        out.append(" ".join(parts))
    return out + ["ab" * 700, "ab" * 500]


def cut_rows(docs):
    found = suffix_merge.without_repeats(docs, LENGTH, texts=False).collect()
    return {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}, len(found)


def test_repeats_are_those_of_brute_force(spark):
    texts = passages(random.Random(1)) + odd_texts()
    want = {(i, *row) for i, row in enumerate(brute_cut(texts, LENGTH))}
    found, n = cut_rows(clashing(documents(spark, texts)))
    assert n == len(texts)
    assert found == want


def test_repeats_of_hot_anchors_and_small_pieces(spark, monkeypatch):
    for name, value in (("HOT", 2), ("OFTEN", 3), ("CHUNK", 700), ("RUN_BYTES", 5_000), ("COMPARED", 10)):
        monkeypatch.setattr(suffix_merge, name, value)
    texts = passages(random.Random(2))
    want = {(i, *row) for i, row in enumerate(brute_cut(texts, LENGTH))}
    assert cut_rows(documents(spark, texts).repartition(5))[0] == want


def test_repeated_rows_are_copies_and_other_columns_stay(spark):
    text = " ".join(words(random.Random(5), 80))
    docs = documents(spark, [text, text, "short"], ids=[None, None, 7])
    rows = suffix_merge.without_repeats(docs, LENGTH).collect()
    assert sorted(r.kept for r in rows) == ["", "", "short"]
    assert {r.rest.lang for r in rows} == {"en"}
    assert suffix_merge.without_repeats(docs.limit(0), LENGTH).count() == 0


@pytest.mark.parametrize("hot", [suffix_merge.HOT, 1])
def test_pipeline_cuts_repeated_passages_of_51_short_words(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_merge, "HOT", hot)
    rng = random.Random(11)
    texts, shared = [], []
    for n in (50, 51, 55, 60):
        passage = words(rng, n, 900)
        assert len(" ".join(passage)) < 400
        shared.append(passage)
        own = [" ".join(words(rng, 70, 10**9)) for _ in range(2)]
        texts += [f"{own[0]} {' '.join(passage)}", "\n".join(passage) + f"\n{own[1]}"]
    docs = documents(spark, texts + [None, "", "a b"])
    found = {r.doc_id: r for r in corpus_pipeline.repeats(spark, docs, "").collect()}
    assert len(found) == len(texts) + 3
    for i, text in enumerate(texts):
        own, passage = text.split(), shared[i // 2]
        left = own if len(passage) == 50 else own[:-len(passage)] if i % 2 == 0 else own[len(passage):]
        assert found[i].text.split() == left
        assert found[i].n_chars == len(found[i].text)
    told = suffix_merge.without_repeats(docs, texts=False, words=51, cut_words=False)
    for r in told.collect():
        sizes = [0 if len(p) == 50 else len(" ".join(p)) for p in shared for _ in range(2)]
        assert r.n_passage == (sizes[r.doc_id] if r.doc_id < len(texts) else 0)
        assert r.n_removed == 0


@pytest.mark.parametrize("listed", [suffix_merge.LISTED, 0])
def test_query_counts_passages_of_51_words_under_400_bytes(spark, monkeypatch, tmp_path, listed):
    """Around hot anchors and others, whether or not only the texts with hot ones travel."""
    monkeypatch.setattr(suffix_merge, "HOT", 3)
    monkeypatch.setattr(suffix_merge, "LISTED", listed)
    rng = random.Random(21)
    texts, sizes = [], []
    for n, times in ((51, 2), (50, 2), (54, 5), (200, 2)):
        passage = " ".join(words(rng, n, 900))
        texts += [f"{' '.join(words(rng, 60, 10**9))} {passage}" for _ in range(times)]
        sizes += [len(passage) if n > 50 else 0] * times
    documents(spark, texts + [None, "a b"]).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in queries.QUERIES["op5_suffix_merge"](spark, str(tmp_path)).collect()}
    assert [found[i].n_passage for i in range(len(texts) + 2)] == [*sizes, 0, 0]
    cuts = [found[i].n_removed for i in range(len(texts))]
    assert cuts[:-2] == [0] * (len(texts) - 2) and min(cuts[-2:]) >= sizes[-1]


def test_strings_of_words_begin_at_whole_words_in_pieces_too(monkeypatch):
    monkeypatch.setattr(suffix_merge, "CHUNK", 800)
    rng = random.Random(6)
    texts = [suffix_merge.codes_of(" ".join(words(rng, n))) for n in (600, 50, 51, 300)]
    length, step, seen = 51 * suffix_merge.CODE, suffix_merge.CODE, Counter()
    rolling = suffix_merge.Rolling(suffix_merge.FACTOR)
    for piece in suffix_merge.anchors_of(texts, length, rolling, step):
        for number, _, place, first, last in zip(*(x.tolist() for x in piece), strict=True):
            assert place % step == first % step == 0
            assert last <= place <= first + length - suffix_merge.GRAM
            seen.update((number, at) for at in range(first, last + 1, step))
    assert seen == Counter((i, at) for i, t in enumerate(texts) for at in range(0, len(t) - length + 1, step))


def test_merge_gives_sorted_strings_with_their_common_prefixes():
    rng = random.Random(4)
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(1, 12))) for _ in range(400)]
    runs = []
    for i in range(5):
        own = {(s, 0): [(0, 0, j)] for j, s in enumerate(strings) if j % 5 == i}
        runs.append(suffix_merge.unpacked(suffix_merge.Run(own).packed()))
    merged = list(suffix_merge.merged(runs))
    order = [s for _, s, _, _ in merged]
    assert order == sorted(order)
    assert set(order) == set(strings)
    for before, (shared, string, _, _) in zip(order, merged[1:], strict=False):
        assert shared == suffix_merge.shared_prefix(before, string, 0)


def brute_print(text, size):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    runs = runs or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, budget):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_texts(rng):
    out = []
    for _ in range(12):
        base = words(rng, 400)
        for _ in range(rng.randrange(1, 8)):
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = "edit"
            out.append(" ".join(base).replace("w1", "W1"))
    return out


def test_simhash_components_are_those_of_brute_force(spark):
    texts = near_texts(random.Random(6)) + odd_texts()
    want = [brute_print(t, 4) for t in texts]
    found = simhash_trie.near_duplicates(clashing(documents(spark, texts))).collect()
    assert len(found) == len(texts)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].bits % (1 << 64) for i in range(len(texts))] == want
    component = brute_components(want, 4)
    assert [by_id[i].component_id for i in range(len(texts))] == component
    assert len(set(component)) < len(texts) - 5
    assert simhash_trie.near_duplicates(documents(spark, [])).count() == 0


def test_trie_links_all_close_keys_of_dense_groups():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    keys = [c for c in centres.tolist()]
    for c in centres.tolist():
        for _ in range(60):
            for b in rng.choice(64, 3, replace=False):
                c ^= 1 << int(b)
            keys.append(c)
    prints = sorted(set(keys))
    found = [0] * len(prints)
    want = brute_components(prints, 4)
    order = np.array(prints, np.uint64)
    links = []
    for first, n in simhash_trie.blocks(4):
        turned = (order << np.uint64(first)) | (order >> np.uint64(64 - first)) if first else order
        at = np.argsort(turned)
        a, b = simhash_trie.trie_links(turned[at], n, 4)
        links += list(zip(at[a].tolist(), at[b].tolist(), strict=True))
    assert len(links) < 5 * len(prints)
    forest = simhash_trie.Forest(len(prints))
    a, b = (np.array(x) for x in zip(*links, strict=True))
    forest.link(a, b)
    found = forest.root.tolist()
    assert len({(x, y) for x, y in zip(found, want, strict=True)}) == len(set(want)) == len(set(found))


def test_one_of_each_group_of_near_duplicates_stays(spark):
    rng = random.Random(8)
    bases = [words(rng, 150) for _ in range(20)]
    texts, groups = [], []
    for g, base in enumerate(bases):
        for _ in range(4):
            copy = list(base)
            copy[rng.randrange(150)] = "changed"
            texts.append(" ".join(copy))
            groups.append(g)
    texts += [None, "", "lonely text of a few words"]
    docs = clashing(documents(spark, texts)).union(clashing(documents(spark, texts)).limit(3))
    kept = simhash_trie.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids))
    assert sorted(groups[i] for i in ids if i < len(groups)) == list(range(20))
    assert {i for i in ids if i >= len(groups)} == {len(groups), len(groups) + 2}


def jaccard(a, b):
    def runs(text):
        found = text.lower().split()
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def pairs_of(rng, same, other, count):
    """Pairs of texts with `same` shingles of five words in common and `other` not, of each."""
    out = []
    for _ in range(count):
        base = words(rng, same + 4, 10**9)
        out += [" ".join(base + words(rng, other, 10**9)) for _ in range(2)]
    return out


def test_isolated_pairs_are_near_duplicates_by_exact_similarity(spark):
    rng = random.Random(12)
    near = pairs_of(rng, 272, 34, 60)  # 272 of 340: 0.8
    unlike = pairs_of(rng, 266, 34, 30) + pairs_of(rng, 238, 34, 60)  # 0.797, 0.778
    for texts, value in ((near, 0.8), (unlike, 0.798)):
        for x, y in zip(texts[::2], texts[1::2], strict=True):
            assert (jaccard(x, y) >= 0.8) == (value == 0.8)
    docs = documents(spark, near + unlike)
    kept = {r.doc_id for r in simhash_trie.without_near_duplicates(docs).collect()}
    assert set(range(len(near), len(near) + len(unlike))) <= kept
    missed = sum(i + 1 in kept for i in range(0, len(near), 2))
    assert all(i in kept for i in range(0, len(near), 2))
    assert missed <= 1


@pytest.mark.parametrize("members", [256, 5])
def test_groups_of_candidates_are_verified_whole(spark, monkeypatch, members):
    """Of groups of texts of similarity 0.7, with copies at 0.9, in one block and in many."""
    monkeypatch.setattr(simhash_trie, "MEMBERS", members)
    rng = random.Random(13)
    texts = []
    for _ in range(6):
        base = words(rng, 204, 10**9)
        for _ in range(8):
            own = base + words(rng, 40, 10**9)
            texts += [" ".join(own), " ".join(own[:-12] + words(rng, 12, 10**9))]
    docs = documents(spark, texts)
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if i // 16 == j // 16 and jaccard(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    kept = {r.doc_id for r in simhash_trie.without_near_duplicates(docs).collect()}
    assert len(kept) == len(set(root))
    assert {root[i] for i in kept} == set(root)


def test_a_large_group_gives_no_pairs_as_rows(spark):
    """A base with many near copies that are no near copies of each other."""
    rng = random.Random(14)
    base = words(rng, 300, 10**9)
    texts = [" ".join(base)]
    for _ in range(300):
        own = list(base)
        for at in rng.sample(range(0, 300, 10), 6):
            own[at] = f"own{rng.random()}"
        texts.append(" ".join(own))
    assert jaccard(texts[0], texts[1]) > 0.8 > jaccard(texts[1], texts[2])
    docs = documents(spark, texts)
    rows = simhash_trie.keyed(docs)
    prints = simhash_trie.wide_fingerprints(rows, 5)
    distinct = simhash_trie.stored(prints)
    links = simhash_trie.candidate_links(distinct, 0.8).count()
    assert links <= simhash_trie.TURNS * len(texts)
    true = simhash_trie.similar_links(distinct, rows, 5, 0.8)
    assert 300 <= true.count() <= 3 * len(texts)
    assert simhash_trie.without_near_duplicates(docs).count() == 1


def test_shared_counts_are_those_of_sets(monkeypatch):
    monkeypatch.setattr(simhash_trie, "CELLS", 40)
    rng = random.Random(15)
    sets = [sorted(rng.sample(range(60), rng.randrange(40))) for _ in range(12)]
    found = simhash_trie.shared_counts([np.array(x, np.uint64) for x in sets])
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if i != j:
                assert found[i, j] == len(set(x) & set(y))


def test_minhash_estimates_and_edits(spark):
    rng = random.Random(9)
    texts = [" ".join(words(rng, rng.randrange(1, 400))) for _ in range(60)]
    texts += [t for t in odd_texts() if t is not None and len(t) < 4000 and not t.isspace()]
    texts += [None, texts[0]]
    docs = clashing(documents(spark, texts, ids=[3 * i for i in range(len(texts))]))
    found = {
        r.doc_id // 3: r
        for r in minhash_bins.with_edits(docs)
        .withColumn("near", minhash_bins.likeness(F.col("bins"), F.col("edited_bins")))
        .collect()
    }
    assert len(found) == len(texts)
    errors = []
    for i, text in enumerate(texts):
        own, after = text or "", texts[i - 1] or ""
        m = len(own) // 3
        edited = own[: len(own) - m] + after[:m]
        assert found[i].edited == edited
        assert found[i].n_chars == len(own)
        assert found[i].next_doc_id == 3 * ((i - 1) % len(texts))
        errors.append(abs(found[i].near - jaccard(own, edited)))
    assert np.mean(errors) < 0.06
    assert found[0].bins == found[len(texts) - 1].bins
    assert minhash_bins.with_edits(docs.limit(0)).count() == 0
    alone = minhash_bins.with_edits(documents(spark, ["abcdef ghi"], ids=[None])).collect()
    assert [r.edited for r in alone] == ["abcdef " + "abc"]
