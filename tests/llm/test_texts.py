"""Licences, languages, toxicity, pieces and benchmark leaks against brute force."""

import random
import re
from collections import Counter

import pytest
from llm_frames import clashing, documents, odd_texts, words

from weftgraph.llm import (
    benchmark_windows,
    language_id,
    license_automaton,
    pieces_viterbi,
    toxic_lexicon,
)
from weftgraph.llm.common import words_of


def brute_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_licence_places_and_spans(spark):
    rng = random.Random(1)
    phrases = [*license_automaton.BASE, *license_automaton.TEMPLATES, "all rights", "cc", "the mit"]
    texts = odd_texts()
    for _ in range(150):
        parts = words(rng, 5, 40)
        for _ in range(rng.randrange(4)):
            parts.insert(rng.randrange(len(parts)), rng.choice(phrases).upper().replace(" ", "-\n"))
        texts.append(" ".join(parts))
    found = {r.doc_id: r for r in license_automaton.scanned(clashing(documents(spark, texts))).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        own = brute_words(text)
        want = []
        for phrase, label in license_automaton.BASE.items():
            p = phrase.split()
            want += [(j, label) for j in range(len(own)) if own[j : j + len(p)] == p]
        assert found[i].n_words == len(own)
        assert sorted((x.start, x.label) for x in found[i].places) == sorted(want)
        joined = f" {' '.join(own)} "
        labels = {x.label for x in found[i].spans}
        for template, label in license_automaton.TEMPLATES.items():
            if f" {template} " in joined:
                assert label in labels
        assert all(x.covered >= license_automaton.COVERED for x in found[i].spans)
    assert license_automaton.scanned(documents(spark, [])).count() == 0


def test_phrases_of_one_word_are_places(spark):
    base = {"copyright": "notice", "copyright holder": "holder", "copyleft": "left", "": "none"}
    texts = ["Copyright", "x copyright holder copyright", "the COPYLEFT", "", None, "mit licence"]
    docs = clashing(documents(spark, texts))
    for templates in ({}, {"copyright notice and this permission": "mit"}):
        rows = {r.doc_id: r.places for r in license_automaton.scanned(docs, templates, base).collect()}
        assert [sorted((x.start, x.label) for x in rows[i]) for i in range(len(texts))] == [
            [(0, "notice")],
            [(1, "holder"), (1, "notice"), (3, "notice")],
            [(1, "left")],
            [],
            [],
            [],
        ]


def test_a_span_bridges_a_changed_word():
    found = license_automaton.Automaton(license_automaton.TEMPLATES, license_automaton.BASE)
    own = "x this work is freely licensed under the gnu general public license version 3 y".split()
    _, spans = found.scan([w.encode() for w in own])
    assert ("gpl-3.0", 1, 13) in {(label, a, b) for _, label, a, b, _ in spans}


SYLLABLES = {"en": ["the", "ing", "wh", "sh"], "fr": ["eau", "ré", "ou", "qu"], "de": ["sch", "ü", "keit"]}


def spoken(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(n))


def test_language_of_texts_not_learned_from(spark):
    rng = random.Random(2)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(300)]
    texts = [spoken(rng, lang, rng.randrange(5, 60)) for lang in langs]
    odd = odd_texts()
    docs = documents(spark, texts + odd, langs=langs + [None] * len(odd))
    out = language_id.held_out(4, 2)
    model = language_id.fitted(docs, ~out)
    rows = language_id.predicted(clashing(docs).withColumn("held", out), model).collect()
    assert len(rows) == len(texts) + len(odd)
    held = [r for r in rows if r.held and r.doc_id < len(texts)]
    assert len(held) > 40
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    by_id = {r.doc_id - len(texts): r for r in rows}
    for i, text in enumerate(odd):
        letter = text is not None and any(c.isalpha() for c in text)
        assert (by_id[i].lang_pred == "und") == (not letter)
        assert 0 <= by_id[i].score <= 1
        assert letter or not by_id[i].accepted
    assert language_id.fitted(docs.limit(0), ~out) is None
    none = language_id.predicted(docs, None).collect()
    assert {r.lang_pred for r in none} == {"und"}


def brute_bucket(run):
    """The bucket of one byte string, by plain integers."""
    h = len(run) * 0x9E3779B1 & 0xFFFFFFFF
    for byte in run:
        h = (h ^ byte) * 0x01000193 & 0xFFFFFFFF
    h ^= h >> 15
    return (h * 0x85EBCA6B & 0xFFFFFFFF) >> 32 - (language_id.BUCKETS.bit_length() - 1)


def test_predictions_are_those_of_a_plain_forward_pass(spark):
    np, rng = language_id.np, random.Random(21)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(120)]
    texts = [spoken(rng, lang, rng.randrange(1, 30)) for lang in langs] + odd_texts()
    docs = documents(spark, texts, langs=langs + [None] * len(odd_texts()))
    model = language_id.fitted(docs, ~language_id.held_out(4, 2))
    for r in language_id.predicted(docs, model).collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0, False)
            continue
        data = language_id.cleaned(r.text)
        counts = Counter(brute_bucket(data[i : i + n]) for n in (2, 3, 4) for i in range(len(data) - n + 1))
        mean = sum(model.table[b] * c for b, c in counts.items()) / counts.total()
        powers = np.exp((mean + model.bias) * model.temperature)
        share = powers / powers.sum()
        assert r.lang_pred == model.languages[share.argmax()]
        assert r.score == pytest.approx(share.max(), rel=1e-9)
        assert r.accepted == (r.score >= model.threshold)


def test_all_of_many_languages_are_learned(spark):
    rng = random.Random(22)
    names = [f"l{i:03}" for i in range(150)]
    own = {x: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(4)] for x in names}
    langs = names * 12
    texts = [" ".join(rng.choices(own[x], k=15)) for x in langs]
    docs = documents(spark, texts, langs=langs)
    model = language_id.fitted(docs, ~language_id.held_out(4, 2), total=150 * 8)
    assert model.languages == names
    rows = language_id.predicted(docs, model).collect()
    assert sum(r.lang_pred == r.lang for r in rows) > 0.95 * len(rows)


def test_the_threshold_rises_where_the_error_is_shown():
    np = language_id.np
    sure = np.linspace(1, 0.5, 10_000)
    right = np.ones(10_000, bool)
    assert language_id.threshold(sure, right, 4) == pytest.approx(0.3)
    right[9_000::2] = False  # 5 % of all are wrong, all of them among the least sure
    got = language_id.threshold(sure, right, 4)
    accepted = sure >= got
    assert 0.008 < (~right[accepted]).mean() < 0.013
    # one wrong row of forty shows nothing; rows that are never right show it at any score
    few = np.linspace(1, 0.5, 40)
    assert language_id.threshold(few, np.arange(40) != 30, 4) == pytest.approx(0.3)
    assert language_id.threshold(few, np.zeros(40, bool), 4) == float("inf")
    # rows of one score are accepted together
    assert language_id.threshold(np.full(200, 0.9), np.arange(200) >= 100, 4) == float("inf")


def test_scores_do_not_depend_on_neighbours():
    rng = random.Random(3)
    table = language_id.np.random.default_rng(1).normal(size=(language_id.BUCKETS, 3))
    texts = [language_id.cleaned(spoken(rng, "fr", n)) for n in (1, 5, 300)]
    together = language_id.score_sums(texts, table)
    for i, text in enumerate(texts):
        assert language_id.np.allclose(language_id.score_sums([text], table)[0], together[i])


def test_toxic_words_are_learned_and_seen_through_disguise(spark):
    rng = random.Random(4)
    bad = ["vormak", "lopsil"]
    texts, toxic = [], []
    for i in range(400):
        own = words(rng, 30, 300)
        if i % 4 == 0:
            own[rng.randrange(30)] = rng.choice(bad)
        texts.append(" ".join(own))
        toxic.append(int(i % 4 == 0))
    marks = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    lexicon = toxic_lexicon.fitted(documents(spark, texts), marks, exceptions=("vormak tower",))
    assert {"vormak", "iopsii"} <= set(lexicon.weights)
    tries = ["a VORMAK b", "a v0rmаk b", "a lоp5il b", "a vormaker b", "a vormak tower b", "clean", None, ""]
    rows = {r.doc_id: r for r in toxic_lexicon.scored(clashing(documents(spark, tries)), lexicon).collect()}
    assert [rows[i].predicted for i in range(8)] == [1, 1, 1, 0, 0, 0, 0, 0]
    assert rows[4].n_exceptions == 1
    assert rows[6].score == rows[7].score
    assert all(0 <= r.score <= 1 for r in rows.values())
    empty = toxic_lexicon.fitted(documents(spark, []), marks)
    assert toxic_lexicon.scored(documents(spark, odd_texts()), empty).count() == len(odd_texts())


@pytest.fixture(scope="module")
def model():
    return pieces_viterbi.loaded()


def brute_best(model, names, word):
    """The highest sum of scores, by trying all pieces at all places."""
    score = [0.0] + [None] * len(word)
    for i in range(1, len(word) + 1):
        score[i] = score[i - 1] + model.worst
        for j in range(max(0, i - 20), i):
            value = names.get(word[j:i])
            if value is not None:
                score[i] = max(score[i], score[j] + value)
    return score[-1]


def test_viterbi_finds_the_best_score(model):
    from sentencepiece import SentencePieceProcessor

    given = SentencePieceProcessor(model_file=pieces_viterbi.MODEL)
    names = {
        given.id_to_piece(i): given.get_score(i)
        for i in range(given.get_piece_size())
        if not (given.is_byte(i) or given.is_control(i) or given.is_unknown(i))
    }
    rng = random.Random(5)
    pool = ["the", "ing", "é", "中", " ", "  ", "x", "tion", "Ver", "\n", "ß", "12"]
    for _ in range(300):
        text = "".join(rng.choices(pool, k=rng.randrange(1, 12)))
        marked = pieces_viterbi.BLANK + text.replace(" ", pieces_viterbi.BLANK)
        total, ids, same = model.encode(text)
        assert total == pytest.approx(brute_best(model, names, marked), rel=1e-12)
        assert model.decode(ids.tolist()) == text


def test_texts_come_back_exactly(spark, model):
    texts = odd_texts() + ["▁", " ▁ ", "▁x", "tab\there", "🙂 ok", "�"]
    docs = clashing(documents(spark, texts))
    rows = pieces_viterbi.encoded(docs, model)
    assert {r.doc_id: r.text for r in pieces_viterbi.decoded(rows, model).collect()} == {
        i: t or "" for i, t in enumerate(texts)
    }
    assert rows.where("round_trip").count() == len(texts)
    digests = pieces_viterbi.encoded_digests(docs, model)
    assert digests.where("round_trip AND n_ids >= n_byte_ids").count() == len(texts)
    assert pieces_viterbi.encoded(documents(spark, []), model).count() == 0


def brute_leaks(texts, items, index):
    """Best similarity of item-sized windows, over all of them."""
    out = {}
    for d, text in enumerate(texts):
        own = words_of(text)
        for k, (item, known, _) in enumerate(index.items):
            n = min(len(known), len(own))
            for i in range(len(own) - n + 1 if own else 0):
                window = Counter(benchmark_windows.shingles(own[i : i + n], index.size))
                total = sum(index.weight(s) * c for s, c in window.items())
                if not total:
                    continue
                value = index.similarity(k, window, total)
                if value >= 0.8 - 1e-9 and value > out.get((d, item), 0) + 1e-9:
                    out[d, item] = value
    return out


def test_leaks_are_those_of_brute_force(spark):
    rng = random.Random(6)
    items = [" ".join(words(rng, rng.randrange(12, 45), 400)) for _ in range(15)] + ["two words", None, ""]
    texts = odd_texts()[:10] + ["Two, words!", "says TWO words twice: two\nwords", "two wordss", "two"]
    for i in range(200):
        own = words(rng, rng.randrange(10, 120), 400)
        passage = rng.choice(items[:15]).upper().split()
        for _ in range(i % 4):
            passage[rng.randrange(len(passage))] = "edited"
        at = rng.randrange(len(own))
        texts.append(" ".join(own[:at] + (passage if i % 3 else passage[:8]) + own[at:]))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = benchmark_windows.leaks(clashing(documents(spark, texts)), benchmark).collect()
    index = benchmark_windows.Index([(i, words_of(t)) for i, t in enumerate(items)], 5)
    want = brute_leaks(texts, items, index)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in found} == {
        k: round(v, 9) for k, v in want.items()
    }
    assert len(want) > 20
    assert all(r.differing_bits <= benchmark_windows.RADIUS for r in found)
    assert benchmark_windows.leaks(documents(spark, texts), benchmark.limit(0)).count() == 0
    assert benchmark_windows.leaks(documents(spark, []), benchmark).count() == 0


def test_near_copies_of_shared_passages_are_leaks_in_any_block(spark, monkeypatch):
    rng = random.Random(14)
    shared = words(rng, 58, 10**9)
    half = words(rng, 29, 10**9)
    items = [shared] * 30 + [half + words(rng, 29, 10**9) for _ in range(30)]
    items += [words(rng, 58, 10**9) for _ in range(30)]
    benchmark = spark.createDataFrame(
        [(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"
    )
    # one word edited, in what items share, in what only this one has, and in an item of its own
    texts = []
    for item, at in ((0, 29), (30, 12), (31, 45), (60, 29)):
        own = list(items[item])
        own[at] = "edited"
        texts.append(" ".join(words(rng, 30, 10**9) + own + words(rng, 30, 10**9)))
    docs = documents(spark, texts)

    def found():
        rows = benchmark_windows.leaks(docs, benchmark).collect()
        return {(r.doc_id, r.item_id, r.first_word, round(r.similarity, 9), r.differing_bits) for r in rows}

    whole = found()
    assert {x[:2] for x in whole} == {(0, i) for i in range(30)} | {(1, 30), (2, 31), (3, 60)}
    assert all(x[2] == 30 and x[3] >= round(49 / 59, 9) for x in whole)
    monkeypatch.setattr(benchmark_windows, "ITEMS", 7)
    assert found() == whole


def test_short_items_and_items_without_an_id_are_found_inside_texts(spark):
    rng = random.Random(23)
    whole = " ".join(words(rng, 20, 10**9))
    items = [(1, "zeta omega kappa"), (2, "sigma"), (None, whole), (None, "zeta omega"), (None, None), (5, "")]
    items += [(1, "zeta omega kappa")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    long = " ".join(words(rng, 60_000, 10**9))
    texts = [
        f"{long} Zeta, omega; KAPPA {long}",
        "zeta kappa omega",
        "the sigma",
        f"before {whole} after",
        "kappa zeta omega",
        None,
        long,
    ]
    rows = benchmark_windows.leaks(clashing(documents(spark, texts)), benchmark).collect()
    assert sorted((r.doc_id, r.item_id or 0, r.first_word, r.n_words, r.similarity) for r in rows) == [
        (0, 0, 60_000, 2, 1.0),
        (0, 1, 60_000, 3, 1.0),
        (0, 1, 60_000, 3, 1.0),
        (2, 2, 1, 1, 1.0),
        (3, 0, 1, 20, 1.0),
        (4, 0, 1, 2, 1.0),
    ]
