"""The operators as registered queries, with SQL where SQL can state the result."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import documents, fold, show_package
from skyloom.llm.exact_dedup import exact_duplicates
from skyloom.llm.fingerprint import edited_fingerprints
from skyloom.llm.hard_negatives import hard_negatives
from skyloom.llm.html_extraction import extract_main_text
from skyloom.llm.language import identify_language
from skyloom.llm.lm_scoring import score_documents
from skyloom.llm.mixing import mix_sources
from skyloom.llm.near_dedup import near_duplicates
from skyloom.llm.packing import pack_documents
from skyloom.llm.sharding import assign_shards
from skyloom.llm.token_counts import count_tokens_after_edits, document_edits
from skyloom.llm.token_store import store_tokens
from skyloom.llm.word_runs import periodic_runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(documents(spark, folder)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query
def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = fold(F.col("doc_id"), 4) == 2
    return identify_language(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op3_shards(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(documents(spark, folder))


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edited_fingerprints(documents(spark, folder))


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens_after_edits(documents(spark, folder), tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
                                    edits=document_edits())


@query
def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder), tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=0)


@query
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(documents(spark, folder))


@query
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder), shingle=2)


@query
def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(documents(spark, folder), "coalesce(crc32(cast(doc_id AS string)), 0) % 5 <> 1")


@query
def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return store_tokens(documents(spark, folder), tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op11_html_text(spark: SparkSession, folder: str) -> DataFrame:
    show_package(spark)
    text = extract_main_text(spark.read.parquet(f"{folder}/pages.parquet"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one document in ten, word numbers whose tail repeats; both choices follow from the id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


@query
def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(documents(spark, folder), order=repeated_tail)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # One line per run, each ended by a line feed.
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    top = F.col("longest")
    milli = F.call_function("div", top["length"] * 1000, top["period"])
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"),
                        top["period"].alias("period"), milli.alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    show_package(spark)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), F.when(finite, whole).alias("vector")), F.col("vec_id") % 50 == 0)


ORACLES["op13_hard_negatives"] = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, x.vec_id, x.label, list_inner_product(a.e, x.e)::BIGINT AS score
      FROM v a JOIN v x ON a.vec_id <> x.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
      FROM p JOIN s USING (anchor_id) WHERE label <> own AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

ORACLES["op7_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""
