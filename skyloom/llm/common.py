"""Helpers the operators share: work tables, folds of a hash, range-ordered numbering."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.session import work_path

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_ROWS = 100_000


def show_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver does; clusters get it by ``--py-files``."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    show_package(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later readers repeat no work, and a lost
    executor costs no recomputation."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(k)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast only while ``rows``, its counted size, is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def take_rows(docs: DataFrame, key: Column, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` in the copies that were decided for them, with all their columns.

    ``decided`` has (key, copies), one row per row of ``docs``. Rows of one key are alike for the decision, so their copies
    differ by one at most: the first of them take the larger number. ``key`` is a struct, in which nulls are equal.
    """
    plan = decided.groupBy("key").agg(F.min("copies").alias("base"), F.sum("copies").alias("all"), F.count(F.lit(1)).alias("n"))
    plan = plan.where("all > 0").select("key", "base", (F.col("all") - F.col("base") * F.col("n")).alias("more"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key")).join(plan, "key")
    place = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    copies = (F.col("base") + F.when(place <= F.col("more"), 1).otherwise(0)).cast("int")
    return rows.select("row", copies.alias("copies")).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def range_parts(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` saved in ascending ranges of ``order``; ``part`` numbers the ranges.

    Every range is one bounded task. The numbers are read back from the written table, so they are fixed.
    """
    n = shuffle_partitions(df.sparkSession)
    return saved(df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), name)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows that hold about ``size`` bytes of ``column``, so memory follows neither rows nor
    batch settings; one longer text is a run of its own."""
    for batch in batches:
        if batch.num_rows:
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            run = np.cumsum(lengths + 64) // size
            edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                yield batch.slice(a, b - a)
