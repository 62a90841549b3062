"""Top-k search by vector similarity and by text relevance."""

from pyspark.sql import functions as F

from .. import FulltextFilter, VectorFilter
from .registry import query
from .tables import Document, Label, Vec, VecByDistance, load

# Fixed value: the vector that is searched for.
QUERY = [1.0, -0.5] * 32
TERMS = ("thing", "ering")
WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def vector_sql(score: str, k: int) -> str:
    q = "[" + ",".join(str(x) for x in QUERY) + "]::DOUBLE[]"
    return f"""(SELECT vec_id, label, {score} AS score FROM
        (SELECT vec_id, label, embedding::DOUBLE[] AS v, {q} AS q FROM embeddings)
        ORDER BY score DESC, vec_id LIMIT {k})"""


COSINE = "(1 + list_dot_product(v, q) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q)))) / 2"
DISTANCE = "1 / (1 + pow(list_distance(v, q), 2))"
TOP20 = vector_sql(COSINE, 20)

BM25 = f"""(WITH d AS (SELECT doc_id, lang, {WORDS} AS w FROM documents),
  c AS (SELECT doc_id, lang, len(w) AS len, len(list_filter(w, lambda x: x = '{TERMS[0]}')) AS a,
               len(list_filter(w, lambda x: x = '{TERMS[1]}')) AS b FROM d),
  f AS (SELECT count(*) AS n, avg(len) AS mean, count(*) FILTER (a > 0) AS da,
               count(*) FILTER (b > 0) AS db FROM c)
  SELECT doc_id, lang,
    ln(1 + (n - da + 0.5) / (da + 0.5)) * a / (a + 1.2 * (0.25 + 0.75 * len / mean))
    + ln(1 + (n - db + 0.5) / (db + 0.5)) * b / (b + 1.2 * (0.25 + 0.75 * len / mean)) AS score
  FROM c, f WHERE a > 0 OR b > 0)"""


def best(threshold: float = 0.0, k: int = 20) -> str:
    return f"""(SELECT * FROM {BM25} WHERE score >= {threshold}
                ORDER BY score DESC, doc_id LIMIT {k})"""


def nearest(g, model=Vec, k=20, threshold=None):
    return g.nodes(model).filter(VectorFilter(k, "embedding", QUERY, threshold))


def matching(g, k=20, threshold=None):
    text = FulltextFilter(" ".join(TERMS), "text", k, threshold)
    return g.nodes(Document).filter(fulltext_filter=text)


def scored(found, **columns):
    rows = found.values(score="score", **columns)
    return rows.withColumn("score", F.round("score", 6))


@query("X1_vector_topk", f"SELECT vec_id AS id, round(score, 6) AS score FROM {TOP20}")
def vector_topk(spark, folder):
    return scored(nearest(load(spark, folder, Vec)), id="id")


@query(
    "X2_vector_threshold",
    f"SELECT vec_id AS id, round(score, 6) AS score FROM {TOP20} WHERE score >= 0.65",
)
def vector_threshold(spark, folder):
    return scored(nearest(load(spark, folder, Vec), threshold=0.65), id="id")


@query(
    "X3_vector_filter",
    f"SELECT vec_id AS id, label, round(score, 6) AS score FROM {TOP20} WHERE label < 5",
)
def vector_filter(spark, folder):
    return scored(nearest(load(spark, folder, Vec)).filter(label__lt=5), id="id", label="label")


@query(
    "X4_vector_path",
    f"""SELECT vec_id AS id, d.doc_id AS document, lang FROM {TOP20}
        JOIN documents d ON d.doc_id = vec_id WHERE lang <> 'fr'""",
)
def vector_path(spark, folder):
    found = nearest(load(spark, folder, Vec, Document)).filter(document__lang__ne="fr")
    return found.values(id="id", document="document__id", lang="document__lang")


@query("X5_fulltext_topk", f"SELECT doc_id AS id, round(score, 6) AS score FROM {best()}")
def fulltext_topk(spark, folder):
    return scored(matching(load(spark, folder, Document)), id="id")


@query(
    "X6_fulltext_threshold",
    f"SELECT doc_id AS id, round(score, 6) AS score FROM {best(threshold=1.5, k=200)}",
)
def fulltext_threshold(spark, folder):
    return scored(matching(load(spark, folder, Document), k=200, threshold=1.5), id="id")


@query(
    "X7_fulltext_filter",
    f"SELECT doc_id AS id, lang, round(score, 6) AS score FROM {best()} WHERE lang = 'en'",
)
def fulltext_filter(spark, folder):
    found = matching(load(spark, folder, Document)).filter(lang="en")
    return scored(found, id="id", lang="lang")


@query(
    "X8_fulltext_path",
    f"""SELECT b.doc_id AS id, quality, toxic FROM {best()} b
        JOIN labels l ON l.doc_id = b.doc_id WHERE quality = 1""",
)
def fulltext_path(spark, folder):
    found = matching(load(spark, folder, Document, Label)).filter(label__quality=1)
    return found.values(id="id", quality="label__quality", toxic="label__toxic")


@query(
    "X9_euclidean",
    f"SELECT vec_id AS id, round(score, 6) AS score FROM {vector_sql(DISTANCE, 20)}",
)
def euclidean(spark, folder):
    return scored(nearest(load(spark, folder, VecByDistance), VecByDistance), id="id")
