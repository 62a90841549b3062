"""The corpus pipeline: language, near duplicates, repeats, benchmark leaks, tokens.

Each stage takes all rows that the one before it kept, and all but the last give rows with the
columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import (
    benchmark_windows,
    language_id,
    pieces_viterbi,
    simhash_trie,
    suffix_merge,
)
from weftgraph.llm.common import keyed, stored

#: Words of the least passage that is cut where it repeats.
PASSAGE = 51


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is not sure enough."""
    model = language_id.fitted(docs, ~language_id.held_out(4, 2))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = language_id.predicted(docs.select(whole, "text"), model)
    return found.where("accepted").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group whose five-word shingles are alike to 0.8 or more."""
    return simhash_trie.without_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of over 50 words, and every byte of a 400-byte string, that occurs twice;
    all documents stay."""
    found = suffix_merge.without_repeats(docs, words=PASSAGE).withColumn("n_chars", F.length("kept").cast("long"))
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.col("n_chars")}
    return found.select(*[own.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that have a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = keyed(docs).select(F.col("key_hash").alias("doc_id"), "text")
    found = benchmark_windows.leaks(rows, benchmark).select(F.col("doc_id").alias("~leaked"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.join(found, F.xxhash64("doc_id", text) == F.col("`~leaked`"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, score, and whether the ids give back the text."""
    return pieces_viterbi.encoded(docs, pieces_viterbi.loaded())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("leaks", leaks),
    ("tokens", tokens),
]

#: The stages learn, cluster and tokenise: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
