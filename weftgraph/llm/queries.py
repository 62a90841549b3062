"""The queries of the operators over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.llm import (
    benchmark_windows,
    bloom_lm,
    fill_middle,
    label_shards,
    language_id,
    license_automaton,
    minhash_bins,
    pieces_viterbi,
    simhash_trie,
    spelling_variants,
    suffix_merge,
    toxic_lexicon,
    warc_merkle,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op10_simhash_trie")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_trie.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op5_suffix_merge")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes of passages of 51 words that occur twice are counted beside the cuts."""
    docs = table(spark, folder, "documents")
    found = suffix_merge.without_repeats(docs, texts=False, words=51, cut_words=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage")


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = language_id.held_out(4, 2)
    model = language_id.fitted(docs, ~out)
    rows = docs.select("doc_id", out.alias("held_out"), "text")
    return language_id.predicted(rows, model).drop("text")


@query("op2_license_automaton")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = license_automaton.scanned(table(spark, folder, "documents"))
    base = F.transform("places", lambda x: x["label"])
    spans = F.transform("spans", lambda x: x["label"])
    starts = F.transform("places", lambda x: x["start"])

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, spans)).alias("labels"),
        F.when(F.size("places") > 0, 1.0)
        .otherwise(
            F.coalesce(F.array_max(F.transform("spans", lambda x: x["covered"])), F.lit(0.0))
        )
        .alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op7_pieces_viterbi")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces_viterbi.loaded()
    return pieces_viterbi.encoded_digests(table(spark, folder, "documents"), model)


@query("op9_benchmark_windows")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return benchmark_windows.leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query("op4_minhash_bins")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash_bins.with_edits(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        minhash_bins.packed(F.col("bins")).alias("fingerprint"),
        minhash_bins.packed(F.col("edited_bins")).alias("edited_fingerprint"),
        minhash_bins.likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        minhash_bins.likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
        "next_doc_id",
    )


@query("op6_toxic_lexicon")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = language_id.held_out(5, 0)
    lexicon = toxic_lexicon.fitted(docs, labels.where(~out))
    return toxic_lexicon.scored(docs, lexicon, out)


@query("op8_label_shards")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rows = label_shards.numbered(table(spark, folder, "documents"))
    found = label_shards.balanced(rows, label_shards.copy_links(rows))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: Content of a record, as warc_merkle.content has it.
RECORD = """coalesce(strlen(url) || ':' || url, '-') || coalesce(strlen(html) || ':' || html, '-')"""


@query(
    "op1_warc_merkle",
    f"""WITH source AS (SELECT page_id, {RECORD} AS body FROM pages),
    replica AS (
        SELECT page_id, CASE page_id % 101 WHEN 1
               THEN coalesce(strlen(url) || ':' || url, '-') || coalesce(
                    strlen(html || ' ') || ':' || html || ' ', '-')
               ELSE {RECORD} END AS body
        FROM pages WHERE page_id % 101 <> 2
        UNION ALL
        SELECT -1 - page_id, {RECORD} FROM pages WHERE page_id % 101 = 3)
    SELECT coalesce(s.page_id, r.page_id) AS record_id,
           CASE WHEN r.page_id IS NULL THEN 'missing' WHEN s.page_id IS NULL THEN 'added'
                ELSE 'changed' END AS kind,
           CAST(strlen(s.body) AS BIGINT) AS bytes, CAST(strlen(r.body) AS BIGINT) AS replica_bytes,
           sha256(s.body) AS digest, sha256(r.body) AS replica_digest
    FROM source s FULL JOIN replica r ON s.page_id = r.page_id
    WHERE s.body IS DISTINCT FROM r.body""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """A replica with damage in known places: pages altered, left out and put in by their number."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    part = F.col("page_id") % 101
    altered = F.when(part == 1, F.concat("html", F.lit(" "))).otherwise(F.col("html"))
    replica = pages.where(part != 2).select("page_id", "url", altered.alias("html")).union(
        pages.where(part == 3).select(-1 - F.col("page_id"), "url", "html")
    )
    return warc_merkle.audit(pages, replica, "page_id", ["url", "html"])


@query(
    "op13_fill_middle",
    """WITH rows AS (SELECT doc_id, coalesce(text, '') AS text,
               sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digits FROM documents),
    cut AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens,
               CAST('0x' || substr(digits, 1, 8) AS BIGINT) AS h1,
               CAST('0x' || substr(digits, 9, 8) AS BIGINT) AS h2,
               CAST('0x' || substr(digits, 17, 8) AS BIGINT) AS h3,
               CAST('0x' || substr(digits, 25, 8) AS BIGINT) AS h4 FROM rows),
    formed AS (SELECT *, len(tokens) AS n,
               least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS a,
               greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                      OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM cut),
    parts AS (SELECT *, coalesce(array_to_string(tokens[1:a], ''), '') AS prefix,
               coalesce(array_to_string(tokens[a + 1:b], ''), '') AS middle,
               coalesce(array_to_string(tokens[b + 1:n], ''), '') AS suffix FROM formed)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                  WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END)
               AS restored_sha256
    FROM parts""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = fill_middle.transformed(table(spark, folder, "documents"))
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


@query("op12_spelling_variants")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(table(spark, folder, "documents"))


@query("op11_bloom_lm")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = language_id.held_out(7, 2)
    found = bloom_lm.scored(docs, bloom_lm.fitted(docs, ~out, lowest=2), whole=True)
    return found.select("doc_id", out.alias("held_out"), *[c for c in found.columns if c != "doc_id"])
