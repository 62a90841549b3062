"""Exact top-k search by vector similarity and by text relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (
    FulltextFilter,
    VectorFilter,
    inverse_document_frequency,
    query_terms,
    saturated,
    term_frequency,
    vector_score,
    word_count,
    words,
)
from ..model import NodeModel
from ..sources.graph import col

SCORE = "~score"


def _threshold(value: object, what: str) -> None:
    if value is not None and not isinstance(value, float):
        raise ValueError(f"{what}: a threshold is a float or left out, not {value!r}")


def _attribute(model: type[NodeModel], name: str):
    try:
        return model.property(name)
    except ValueError as e:
        raise AttributeError(f"{model.__name__} declares no property {name!r}") from e


def vector_topk(frame: DataFrame, model: type[NodeModel], query: VectorFilter) -> DataFrame:
    """The k best rows with their score; the threshold cuts those k afterwards."""
    prop = _attribute(model, query.vector_attribute_name)
    if prop.vector_index is None:
        raise AttributeError(f"{query.vector_attribute_name!r} can't be searched as a vector")
    _threshold(query.threshold, "Vector Filter")
    vector = [float(x) for x in query.candidate_vector]
    score = vector_score(col(prop.name), vector, prop.vector_index.similarity_function)
    best = (
        frame.withColumn(SCORE, score)
        .orderBy(col(SCORE).desc_nulls_last(), col("node_id"))
        .limit(query.topk)
    )
    # rows without a score come last; they are dropped after the limit, where the test
    # does not make the score be computed twice
    least = query.threshold or 0.0
    return best.where(col(SCORE) >= least)


def fulltext_topk(frame: DataFrame, model: type[NodeModel], query: FulltextFilter) -> DataFrame:
    """BM25 over whole texts; the threshold applies before the k best are taken.

    Term counts are computed inside each row, so no token is ever shuffled: one pass
    gathers the collection figures, a second scores and keeps the k best.
    """
    prop = _attribute(model, query.fulltext_attribute_name)
    if prop.fulltext_index is None:
        raise AttributeError(f"{query.fulltext_attribute_name!r} can't be searched as a text")
    _threshold(query.threshold, "Full Text Filter")
    terms = query_terms(query.query_string)
    if not terms:
        return frame.where(F.lit(False)).withColumn(SCORE, F.lit(0.0))
    split = words(col(prop.name))
    figures = (
        frame.where(col(prop.name).isNotNull())
        .select(split.alias("~words"))
        .select(
            word_count(col("~words")).alias("~len"),
            *[F.array_contains("~words", t).alias(f"~has{i}") for i, t in enumerate(terms)],
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("~len").alias("avg"),
            *[F.count_if(col(f"~has{i}")).alias(f"df{i}") for i in range(len(terms))],
        )
        .select(F.struct("*").alias("figures"))
        .scalar()
    )
    # only texts that contain a term at all are split into words again
    lowered = F.lower(col(prop.name))
    possible = lowered.contains(F.lit(terms[0]))
    for term in terms[1:]:
        possible = possible | lowered.contains(F.lit(term))
    counts = [term_frequency(col("~words"), t).alias(f"~tf{i}") for i, t in enumerate(terms)]
    kept = [col(c) for c in frame.columns]
    scored = (
        frame.where(possible)
        .withColumn("~words", split)
        .select(*kept, word_count(col("~words")).alias("~len"), *counts)
        .withColumn("~figures", figures)
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = inverse_document_frequency(col("~figures")["n"], col("~figures")[f"df{i}"])
        score = score + idf * saturated(col(f"~tf{i}"), col("~len"), col("~figures")["avg"])
    best = (
        scored.withColumn(SCORE, score)
        .orderBy(col(SCORE).desc(), col("node_id"))
        .limit(query.topk)
    )
    # rows are taken in order of their score, so that cutting the low scores after the
    # limit gives the same rows as before it, and the score is computed once
    hit = col(SCORE) > 0
    if query.threshold:
        hit = col(SCORE) >= query.threshold
    return best.where(hit).select(*kept, col(SCORE))
