"""Small tables for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns with names that operators use themselves.
CLASHING = ["key_id", "shard", "part", "bits", "score", "spans", "id", "rest", "kept"]


def documents(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [
        (i, t, lang, "s", None if t is None else len(t))
        for i, t, lang in zip(ids, texts, langs, strict=True)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    return docs.selectExpr("*", *[f"'x' AS {name}" for name in CLASHING])


def words(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_texts():
    """Nulls, empty, blank, repeated, one word, signs, other scripts, and a very long text."""
    return [
        None,
        "",
        "   \n\t",
        "one",
        "same text here",
        "same text here",
        "... !!! ###",
        "▁ a  b ▁\n",
        "слово и ещё слово 中文字 ｆｕｌｌ",
        "a" * 3000,
        " ".join(words(random.Random(3), 60_000)),
    ]
