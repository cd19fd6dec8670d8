"""Hard negatives by angular triangle filtering.

Every vector stores its norm and its angles to a few reference directions. For an anchor a and a row x each reference r
gives ``|angle(a, r) - angle(x, r)| <= angle(a, x) <= angle(a, r) + angle(x, r)`` (and at most two right angles twice
less the sum), so the cosine lies in an interval, and times both norms it bounds the score. The bounds are widened by
more than the rounding of the stored angles, so a row is left out only if it cannot count. Scores themselves are inner
products of whole numbers.

Rows lie in blocks ordered by label, nearest reference and the angle to it. A block is read once by one task: its rows
first, then all anchors that may need it stream past, so memory follows the size of a block and not the number of
anchors. Positives need blocks of the anchor's label only. Then the scores of an anchor's positives give its windows,
and a block answers with its best rows of other labels in each window; a window function keeps the best of all blocks.

Results:

* rows with a null label, a null vector, or a null or non-finite component take no part
* a null id is no anchor; as a positive or negative it sorts after all ids. Rows that repeat an id are rows of their own
* of vectors of unequal length the shorter is padded with zeros; a zero vector scores 0 with all
* an anchor without a positive, or a positive without a row in its window, gives no row; an empty table none
* only the four named columns are read; scores must fit in 64 bits
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import saved, shuffle_partitions

REFERENCES = 8
SAMPLE_ROWS = 1024
BLOCK_ROWS = 65_536
LEAST_BLOCK = 2_048
#: Wider than the rounding of an angle stored in 32 bits and of the arc cosine near 0.
SLACK = 1e-5
LAST = 2**63 - 1  # stands for a null id among the ids


def usable(rows: DataFrame) -> DataFrame:
    """Rows with a label and a vector of finite components, numbered."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def directions(rows: DataFrame, count: int, sample: int) -> np.ndarray:
    """Reference directions: rows of a bounded sample, each the one that is farthest from those before it."""
    picked = rows.orderBy(F.xxhash64("vec_id", "label"), "vec_id").limit(sample).select("vector").toPandas()["vector"]
    width = max((len(v) for v in picked), default=1) or 1
    vectors = padded([np.asarray(v, float) for v in picked], width)
    norms = np.linalg.norm(vectors, axis=1)
    vectors = vectors[norms > 0] / norms[norms > 0, None]
    if not len(vectors):
        return np.eye(1, width)
    chosen, nearest = [0], vectors @ vectors[0]
    while len(chosen) < min(count, len(vectors)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    return vectors[chosen]


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    if all(len(v) == width for v in vectors):
        return np.array(vectors).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width), vectors[0].dtype if vectors else float)
    for row, v in zip(out, vectors):
        row[:len(v)] = v[:width]
    return out


def angles(vectors: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the references; a zero vector gets right angles."""
    width = max(vectors.shape[1], references.shape[1])
    vectors, references = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (vectors.astype(float), references))
    norms = np.linalg.norm(vectors, axis=1)
    cosine = vectors @ references.T / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(cosine, -1, 1))


def with_angles(rows: DataFrame, references: np.ndarray) -> DataFrame:
    schema = rows.select("vec_id", "label", "vector", "anchor").schema.simpleString()[7:-1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v, np.int64) for v in batch.column("vector").to_pylist()]
            norms, theta = angles(padded(vectors, max(map(len, vectors), default=1) or 1), references)
            near = theta.argmin(1)
            table = {n: batch.column(n) for n in ("vec_id", "label", "vector", "anchor")}
            table |= {"norm": pa.array(norms), "theta": pa.array(list(theta.astype(np.float32)), pa.list_(pa.float32())),
                      "near": pa.array(near.astype(np.int32)), "to_near": pa.array(theta.min(1))}
            yield pa.RecordBatch.from_pydict(table)

    return rows.select("vec_id", "label", "vector", "anchor").mapInArrow(add, f"{schema}, norm double, theta array<float>, near int, to_near double")


class Block:
    """The rows of one block, ordered by label."""

    def __init__(self, rows: pa.Table) -> None:
        label = rows["label"].to_numpy()
        order = np.argsort(label, kind="stable")
        self.label = label[order]
        self.key = rows["key"].to_numpy()[order]
        self.id = rows["vec_id"].fill_null(LAST).to_numpy()[order]
        self.norm = rows["norm"].to_numpy()[order]
        self.theta = np.array(rows["theta"].to_pylist(), np.float32)[order]
        vectors = [np.asarray(v, np.int64) for v in rows["vector"].to_pylist()]
        self.width = max(map(len, vectors), default=1) or 1
        self.vectors = padded(vectors, self.width)[order]
        self.largest = int(np.abs(self.vectors).max(initial=0))
        self.doubles = self.vectors.astype(float) if self.largest < 2**52 else None

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.label, label)), int(np.searchsorted(self.label, label, "right"))

    def bounds(self, part: slice, norm: float, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores of the rows in ``part``."""
        least = np.zeros(self.norm[part].shape)
        most = np.full(least.shape, np.pi)
        for r, own in enumerate(theta):
            other = self.theta[part, r]
            least = np.maximum(least, np.abs(other - own))
            most = np.minimum(most, np.minimum(other + own, 2 * np.pi - other - own))
        size = self.norm[part] * norm
        room = size * 1e-9 + 1
        return (np.cos(np.minimum(most + SLACK, np.pi)) * size - room, np.cos(np.maximum(least - SLACK, 0)) * size + room)

    def scores(self, rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Inner products of whole numbers; in doubles where every partial sum is exact in them."""
        width = min(self.width, len(vector))
        most = int(np.abs(vector).max(initial=0))
        if self.doubles is not None and most * self.largest * max(width, 1) < 2**53:
            return (self.doubles[rows, :width] @ vector[:width].astype(float)).astype(np.int64)
        return self.vectors[rows, :width] @ vector[:width]

    def best(self, rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """Positions in ``rows`` of the k best: higher scores first, then smaller ids."""
        if len(score) > k:
            floor = np.partition(score, len(score) - k)[len(score) - k]
            some = np.flatnonzero(score >= floor)
        else:
            some = np.arange(len(score))
        return some[np.lexsort((self.key[rows[some]], self.id[rows[some]], -score[some]))[:k]]

    def positives(self, anchor: dict, k: int) -> list[tuple[int, int, int]]:
        a, b = self.of_label(anchor["label"])
        part = slice(a, b)
        _, high = self.bounds(part, anchor["norm"], np.asarray(anchor["theta"]))
        vector = np.asarray(anchor["vector"], np.int64)
        own = self.key[part] == anchor["key"]
        # The rows with the highest bounds first: their k-th best score rules out rows whose bound is below it.
        first = np.argpartition(-high, min(8 * k, len(high) - 1))[:8 * k] if len(high) else np.zeros(0, np.int64)
        first = first[~own[first]]
        known = np.sort(self.scores(a + first, vector))[::-1]
        floor = known[k - 1] if len(known) >= k else -np.inf
        rows = a + np.flatnonzero((high >= floor) & ~own)
        score = self.scores(rows, vector)
        return [(int(self.key[rows[i]]), int(self.id[rows[i]]), int(score[i])) for i in self.best(rows, score, k)]

    def negatives(self, anchor: dict, k: int) -> list[tuple[int, int, int]]:
        """(position of the window, id, score) of the best rows of other labels in each of the anchor's windows."""
        windows = [(w["low"], w["high"]) for w in anchor["windows"]]
        floor, ceiling = min(w[0] for w in windows), max(w[1] for w in windows)
        a, b = self.of_label(anchor["label"])
        theta, rows = np.asarray(anchor["theta"]), []
        for part in (slice(0, a), slice(b, len(self.label))):
            low, high = self.bounds(part, anchor["norm"], theta)
            rows.append(part.start + np.flatnonzero((high >= floor) & (low <= ceiling)))
        rows = np.concatenate(rows)
        score = self.scores(rows, np.asarray(anchor["vector"], np.int64))
        inside = (score >= floor) & (score <= ceiling)
        rows, score = rows[inside], score[inside]
        out = []
        for n, (least, most) in enumerate(windows):
            some = np.flatnonzero((score >= least) & (score <= most))
            out += [(n, int(self.id[rows[some[i]]]), int(score[some[i]])) for i in self.best(rows[some], score[some], k)]
        return out


def in_blocks(rows: DataFrame, asked: DataFrame, blocks: int, k: int, positives: bool) -> DataFrame:
    """Answers of every block to the anchors ``asked`` of it; both have the column ``block``."""
    shared = ["key", "vec_id", "label", "vector", "norm", "theta"]
    window = "windows array<struct<low:long,high:long,positive_id:long,positive_score:long,positive:int>>"
    side = rows.select("block", F.lit(0).alias("kind"), *shared, F.expr(f"cast(null AS {window[8:]}) AS windows"))
    if positives:
        asked = asked.withColumn("windows", F.expr(f"cast(null AS {window[8:]})"))
    both = side.unionByName(asked.select("block", F.lit(1).alias("kind"), *shared, "windows"))
    # One task per block where possible; a task may also hold several, one after the other.
    both = both.repartition(max(blocks, shuffle_partitions(rows.sparkSession)), "block").sortWithinPartitions("block", "kind")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[pa.RecordBatch] = []
        block, number = None, None
        for batch in batches:
            ids, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(ids) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if ids[a] != number:
                    number, block, gathered = ids[a], None, []
                if kinds[a] == 0:
                    gathered.append(batch.slice(a, b - a))
                    continue
                if block is None:
                    if not gathered:
                        continue
                    block, gathered = Block(pa.Table.from_batches(gathered)), []
                found = []
                for anchor in batch.slice(a, b - a).to_pylist():
                    hits = block.positives(anchor, k) if positives else block.negatives(anchor, k)
                    found += [(anchor["key"], *hit) for hit in hits]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["anchor", "a", "b", "c"])

    return both.mapInArrow(answer, "anchor long, a long, b long, c long")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95),
                   references: int = REFERENCES, sample_rows: int = SAMPLE_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``label`` and ``vector`` (whole numbers); ``anchors`` is a condition on them. An anchor's
    positives are its ``positives`` best other rows of its label. For each of them the ``negatives`` best rows of other labels
    are returned whose score lies between ``window`` per cent of the positive's. Reference directions come from a
    sample of ``sample_rows`` rows; they move the bounds and never a result.
    """
    low, high = window
    spark = rows.sparkSession
    rows = usable(rows).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector",
                               F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = saved(rows, "vectors")
    table = with_angles(rows, directions(rows, references, sample_rows))
    count = rows.count()
    blocks = max(-(-count // block_rows), min(shuffle_partitions(spark), -(-count // LEAST_BLOCK)), 1)
    table = table.repartitionByRange(blocks, "label", "near", "to_near").withColumn("block", F.spark_partition_id())
    table = saved(table.withColumn("key", F.monotonically_increasing_id()), "vectors-by-angle")
    last = table.agg(F.max("block")).first()[0] or 0
    asking = table.where("anchor").drop("anchor", "block")

    # A hot label has many blocks; each of them answers with its own best rows.
    homes = table.groupBy("label", "block").count().select("label", "block")
    near = in_blocks(table, asking.join(homes, "label"), blocks, positives, True)
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.col("c").desc(), "b", "a"))
    near = near.select("*", rank.alias("positive")).where(F.col("positive") <= positives)
    # The shares of a negative score leave an empty window.
    span = F.struct(hundredths_up(F.col("c") * low).alias("low"), hundredths_down(F.col("c") * high).alias("high"),
                    F.col("b").alias("positive_id"), F.col("c").alias("positive_score"), F.col("positive").cast("int").alias("positive"))
    near = near.select("anchor", span.alias("w")).where("w.low <= w.high")
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("w.positive").alias("n"), "w"))).alias("ws"))
    windows = saved(windows.select("anchor", F.col("ws.w").alias("windows")), "windows")

    asking = asking.join(windows, asking["key"] == windows["anchor"]).drop("anchor")
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
    found = in_blocks(table, asking, blocks, negatives, False)
    place = F.row_number().over(Window.partitionBy("anchor", "a").orderBy(F.col("c").desc(), "b"))
    found = found.select("*", place.cast("int").alias("rank")).where(F.col("rank") <= negatives)
    names = table.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    of = F.element_at("windows", (F.col("a") + 1).cast("int"))
    shown = lambda c: F.when(c != LAST, c)
    return (found.join(windows, "anchor").join(names, "anchor")
            .select("anchor_id", shown(of["positive_id"]).alias("positive_id"), "rank", shown(F.col("b")).alias("negative_id"),
                    of["positive_score"].alias("positive_score"), F.col("c").alias("negative_score")))


def hundredths_down(x: Column) -> Column:
    """A whole number of hundredths, rounded down to whole ones without doubles."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def hundredths_up(x: Column) -> Column:
    return -hundredths_down(-x)
