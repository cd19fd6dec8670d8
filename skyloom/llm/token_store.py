"""Token ids in ORC files: integer run-length encoding, row indexes and Bloom filters on document ids.

Documents are dealt in ascending ranges of their ids, encoded where they land, and written as one ORC file per range.
Stripes can be read in parallel; the row index (minimum and maximum per group of rows) and the Bloom filter let a
reader of a few ids skip stripes and row groups. Only the texts are shuffled, once; ids go from encoder to file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import saved, shuffle_partitions, slices
from skyloom.llm.encoding import encoder, ids_crc32
from skyloom.session import work_path

ORC = {"compression": "zstd", "orc.stripe.size": str(64 << 20), "orc.row.index.stride": "1000", "orc.create.index": "true",
       "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str, end_id: int, doc_id: str = "doc_id",
                 text: str = "text") -> None:
    """Writes (part, place, doc_id, ids) as ORC under ``path``, in ascending (part, place).

    Every row gets the ids of its whole text and then ``end_id``; null and empty texts have the end id only. Null ids
    come first; rows of one id stand next to each other in no stated order. An empty table gives an empty folder with
    the schema. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    n = shuffle_partitions(docs.sparkSession)
    rows = (rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
            .withColumn("part", F.spark_partition_id()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, place = encoder(tokenizer), 0
        for batch in slices(batches, "text"):
            ids = tool.encode([t or "" for t in batch.column("text").to_pylist()])
            ends = np.cumsum([len(x) + 1 for x in ids])
            flat = np.full(int(ends[-1]), end_id, np.int32)
            for x, e in zip(ids, ends):
                flat[e - 1 - len(x):e - 1] = x
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), pa.array(np.arange(place, place + batch.num_rows), pa.int64()),
                 batch.column("doc_id"), lists], ["part", "place", "doc_id", "ids"])
            place += batch.num_rows

    out = rows.mapInArrow(encode, f"part int, place bigint, doc_id {kind.simpleString()}, ids array<int>")
    out.write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold, per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    files = spark.read.orc(path).select("part", "place", "doc_id", "ids")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, edges = ids.values.to_numpy(), ids.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("part", "place", "doc_id")), pa.array(np.diff(edges), pa.int64()),
                 pa.array([ids_crc32(flat[a:b]) for a, b in zip(edges, edges[1:])], pa.int64())],
                ["part", "place", "doc_id", "n_tokens", "ids_crc32"])

    kind = files.schema["doc_id"].dataType.simpleString()
    rows = saved(files.mapInArrow(measure, f"part int, place bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint"), "token-rows")
    # one row per written range, a number the session sets
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(F.broadcast(parts), "part")
            .select("doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))


def store_tokens(docs: DataFrame, **options) -> DataFrame:
    """:func:`write_tokens` to a new folder of the shared one, then :func:`read_tokens` from it."""
    path = work_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path)
