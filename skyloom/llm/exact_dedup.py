"""Exact deduplication with a heavy-hitter split.

A Misra-Gries summary (Spark's ``freqItems``: bounded counters per task, merged) names every digest that may hold more
than ``support`` of the rows. One pass with map-side sums counts these few candidates exactly; the winners that pass
are broadcast, at most 1 / support rows, and their documents are settled where they are. All other digests are
grouped by an ordinary shuffle, in which no group exceeds ``support`` of the rows.

DataFrame operations only; texts are read once and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import SPACES, saved, take_rows


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text with every run of spaces made one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256)


def exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", support: float = 1 / 1024) -> DataFrame:
    """For every row the row that stays of its equal texts.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256. Texts are equal when they agree
    after space runs become one space. The smallest id stays (a null id only if no other is there); among rows that
    repeat the same id and text exactly one stays. Null text is empty text. Empty tables give no rows. Other columns
    are not read.
    """
    digests = saved(docs.select(F.col(doc_id).alias("doc_id"), text_digest(F.col(text)).alias("digest"),
                                F.monotonically_increasing_id().alias("row")), "dedup-digests")
    rows = digests.count()
    candidates = digests.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest")).distinct()
    best = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).alias("best")
    winners = saved(
        digests.join(F.broadcast(candidates), "digest").groupBy("digest")
        .agg(best, F.count(F.lit(1)).alias("group_size")).where(F.col("group_size") >= rows * support), "dedup-winners")
    winners = F.broadcast(winners)

    heavy = digests.join(winners, "digest")
    light = digests.join(winners.select("digest"), "digest", "left_anti")
    group = Window.partitionBy("digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")).over(group)
    light = light.select("*", first.alias("best"), F.count(F.lit(1)).over(group).alias("group_size"))
    return heavy.unionByName(light).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay by :func:`exact_duplicates`, with all their columns."""
    decided = exact_duplicates(docs, doc_id=doc_id, text=text).select(
        F.struct(F.col("doc_id").alias("id"), F.col("text_sha256").alias("digest")).alias("key"), F.col("kept").cast("int").alias("copies"))
    return take_rows(docs, F.struct(F.col(doc_id).alias("id"), text_digest(F.col(text)).alias("digest")), decided)
