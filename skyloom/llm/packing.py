"""Packing documents into sequences of bounded length by the sum-of-squares rule.

Documents are encoded and cut into pieces no longer than a sequence; only lengths and checksums go on. A piece is
placed in the open sequence for which the sum, over all residual gaps, of the squared number of open sequences with
that gap becomes smallest. Pieces are dealt to groups of bounded size that are packed in parallel, long ones first.
The sequences a group leaves open with much room meet those of other groups in a second deal, as blocks that keep
together, so groups cost almost no sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import saved, slices
from skyloom.llm.encoding import encoder, ids_crc32

GROUP = 20_000  # pieces packed in one task


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, taken in the given order.

    With n(g) open bins of gap g, putting length l into gap g changes the sum of squares by 2 n(g-l) - 2 n(g) + 2, by
    1 - 2 n(l) when it fills the bin, and by 2 n(capacity-l) + 1 when it opens one. Ties go to the smallest gap.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n = np.zeros(capacity + 1)
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        best, gap = (2 * n[capacity - length] + 1 if length < capacity else 0.0), capacity
        if length < capacity:
            change = np.where(n[length:capacity] > 0, 2 * (n[:capacity - length] - n[length:capacity]) + 2, np.inf)
            if n[length]:
                change[0] = 1 - 2 * n[length]
            at = int(change.argmin())
            if change[at] <= best:
                best, gap = change[at], length + at
        if gap == capacity:
            b, made = made, made + 1
        else:
            b = open_bins[gap].pop()
            n[gap] -= 1
        bins[i], offsets[i] = b, capacity - gap
        if left := gap - length:
            open_bins[left].append(b)
            n[left] += 1
    return bins, offsets


def encode_pieces(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 2048, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, row (a number of its own)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in slices(batches, "text"):
            owner, out = [], []
            for k, ids in enumerate(tool.encode([t or "" for t in batch.column("text").to_pylist()])):
                ids = np.append(ids, np.int32(end_id))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start:start + capacity]
                    owner.append(k)
                    out.append((piece, start, len(part), ids_crc32(part)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(owner)), *columns],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(pieces, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint").withColumn(
        "row", F.monotonically_increasing_id())


def pack_lengths(items: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """``bin`` and ``at`` for every item (row, length); ``fill`` is what the bin holds in all. Items are dealt by a hash of
    ``row``, so no length and no document crowds a group."""
    groups = max(1, -(-items.count() // group))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        bins, at = sum_of_squares(pdf["length"].to_numpy(), capacity)
        fill = np.bincount(bins, pdf["length"]).astype(np.int64)
        return pd.DataFrame({"row": pdf["row"], "length": pdf["length"], "bin": bins + pdf["group"] * (1 << 32), "at": at,
                             "fill": fill[bins]})

    dealt = items.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInPandas(pack, "row bigint, length bigint, bin bigint, at bigint, fill bigint")


def pack_documents(docs: DataFrame, *, tokenizer: str, end_id: int, capacity: int = 2048, group: int = GROUP,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places all documents in as few sequences of at most ``capacity`` tokens as the rule needs.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A document is the ids of its
    whole text and ``end_id``; only longer ones are cut, and every piece but the last is a full sequence. Null and empty
    texts are one piece of length 1. Repeated rows and null ids are documents of their own. Empty tables give no rows.
    Other columns are not read.
    """
    pieces = saved(encode_pieces(docs, tokenizer=tokenizer, end_id=end_id, capacity=capacity, doc_id=doc_id,
                                 text=text), "pack-pieces")
    first = saved(pack_lengths(pieces, capacity, group), "pack-first")
    # sequences that stay open are packed again, as blocks
    loose = first.where(F.col("fill") < capacity).select(F.col("bin").alias("row"), F.col("fill").alias("length")).distinct()
    again = pack_lengths(saved(loose, "pack-loose"), capacity, group).select(
        F.col("row").alias("bin"), F.col("bin").alias("block_bin"), F.col("at").alias("block_at"))
    placed = first.join(saved(again, "pack-again"), "bin", "left").select(
        "row", F.coalesce(-1 - F.col("block_bin"), F.col("bin")).alias("sequence_id"),
        (F.col("at") + F.coalesce(F.col("block_at"), F.lit(0))).alias("offset"))
    return pieces.join(placed, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
