"""Near-duplicates by a multi-index Hamming join of MinHash signatures.

Every distinct shingle set gets a signature of ``chunks * width`` MinHash symbols of 16 bits. Two signatures that differ
in fewer than 2 * ``chunks`` symbols agree, up to one symbol, in at least one of the ``chunks`` chunks (pigeonhole). So each
chunk is indexed ``width`` times, each time with another of its symbols left out: every pair under the distance meets in
at least one bucket. Candidates are confirmed on the full shingle sets.

Equal sets are one node. Large groups are contracted first, in ``ROUNDS`` rounds, each over its own part of the buckets. A node
of a bucket is compared with one other only, the bucket's lead, if that is in another component. The links of a round join
components and the next round skips what they settle, so a linked group costs few pairs per node. Leads are drawn
by hash, in favour of nodes that meet many others: the middle of a group links with most of it. There are ``ORDERS`` draws and a
bucket's key names its own, so the buckets a group shares have few leads. The last round compares what is left: nodes that share a
bucket across components. Near misses of a large group can be many there, so
its pairs must also share one of the rare shingles that a linked pair cannot lack: with each set in order of frequency,
two sets of n and m shingles that need k in common share one of the first n - k + 1 and m - k + 1. Sets whose sizes rule a link
out are not paired. Leads are minima summed up before the shuffle, and no bucket is gathered in one group. Full sets are
fetched once, for the nodes that share a bucket with any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import saved, shuffle_partitions, slices, small, take_rows
from skyloom.llm.components import connected_components

ROUNDS, ORDERS = 4, 16
NODES, WORDS = 1_000, 200_000  # nodes that are indexed at a time, and words whose hashes a task keeps between batches
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[str | None], k: int, hashes: dict) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct ``k``-word shingles of every text. Words are runs of other than ASCII spaces,
    A-Z in lower case; fewer than ``k`` words are one shingle, no words none."""
    words = [(t or "").encode().lower().split() for t in texts]
    sizes = [len(w) for w in words]
    flat = np.fromiter((h for w in words for h in map(hashes.__getitem__, w)), np.uint64, sum(sizes))
    rows, at = [], 0
    for n in sizes:
        own, at = flat[at:at + n], at + n
        width = min(k, n)
        out = np.full(max(n - width + 1, 0) if n else 0, width, np.uint64)
        for i in range(width):
            out = _mix(out * _A + own[i:n - width + 1 + i])
        rows.append(np.unique(out))
    return rows


def signatures(sets: list[np.ndarray], symbols: int, seed: int = 7) -> np.ndarray:
    """MinHash symbols [set, symbol] of 16 bits; the sets are not empty."""
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(0, 1 << 63, symbols, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), symbols), np.uint16)
    for j in range(symbols):
        least = np.minimum.reduceat(flat * a[j] + b[j], starts)
        out[:, j] = (least >> np.uint64(20)).astype(np.uint16)
    return out


def _index_keys(signature: np.ndarray, chunks: int, width: int) -> np.ndarray:
    """Bucket keys [set, chunks * width]: each chunk with each of its symbols left out."""
    parts = signature.reshape(len(signature), chunks, width).astype(np.uint64)
    out = np.empty((len(signature), chunks, width), np.uint64)
    for gone in range(width):
        key = np.zeros((len(signature), chunks), np.uint64)
        for i in range(width):
            if i != gone:
                key = _mix(key * _A + parts[:, :, i] + np.uint64(1))
        out[:, :, gone] = _mix(key + np.arange(chunks, dtype=np.uint64) * np.uint64(width) + np.uint64(gone))
    return out.reshape(len(signature), chunks * width)


class NearDuplicates:
    """The tables of one run over ``docs``."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int, chunks: int, width: int) -> None:
        self.docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("mark"))
        self.kind = self.docs.schema["doc_id"].dataType.simpleString()
        self.shingle, self.percent, self.chunks, self.width = shingle, percent, chunks, width

    def sets(self) -> DataFrame:
        """Per row: doc_id, n_shingles, digest of the set (null if empty), signature, row."""
        k, symbols = self.shingle, self.chunks * self.width

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for batch in slices(batches, "text"):
                if len(hashes) > WORDS:
                    hashes.clear()
                sets = shingle_sets(batch.column("text").to_pylist(), k, hashes)
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, sign = [None] * len(sets), [None] * len(sets)
                if full:
                    for i, row in zip(full, signatures([sets[i] for i in full], symbols)):
                        digest[i], sign[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(digest, pa.binary()), pa.array(sign, pa.binary())],
                    ["doc_id", "mark", "n_shingles", "digest", "signature"])

        out = self.docs.mapInArrow(build, f"doc_id {self.kind}, mark bigint, n_shingles bigint, digest binary, signature binary")
        return saved(out.withColumn("row", F.monotonically_increasing_id()), "near-sets")

    def keys(self, nodes: DataFrame) -> DataFrame:
        """(key, node, size): every node under all its bucket keys. A short signature becomes very many keys, so nodes are dealt
        by their number, not by the bytes of their files, and indexed in small batches."""
        chunks, width = self.chunks, self.width

        def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(a, NODES) for a in range(0, batch.num_rows, NODES)):
                    sign = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(part.num_rows, -1)
                    key = _index_keys(sign, chunks, width)
                    node, size = (np.repeat(part.column(c).to_numpy(), key.shape[1]) for c in ("node", "n_shingles"))
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(node), pa.array(size)], ["key", "node", "size"])

        dealt = nodes.select("node", "n_shingles", "signature").repartition(shuffle_partitions(nodes.sparkSession))
        return dealt.mapInArrow(index, "key bigint, node bigint, size bigint")

    def buckets(self, nodes: DataFrame) -> DataFrame:
        """(key, node, size, score) of the buckets with more than one node; ``score`` is how often the node meets others."""
        keys = self.keys(nodes)
        shared = saved(keys.groupBy("key").agg((F.count(F.lit(1)) - 1).alias("others")).where("others > 0"), "near-keys")
        rows = saved(keys.join(shared, "key"), "near-buckets")
        return saved(rows.drop("others").join(rows.groupBy("node").agg(F.sum("others").cast("double").alias("score")), "node"), "near-scored")

    def alike(self, n: str, m: str) -> Column:
        """Whether the sizes of two sets allow a link."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """(node, shingles) of the wanted (node, doc_id, digest), from the texts again."""
        k, rows = self.shingle, wanted.count()

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = _Hashes()
            for batch in slices(batches, "text"):
                if len(hashes) > WORDS:
                    hashes.clear()
                sets = shingle_sets(batch.column("text").to_pylist(), k, hashes)
                same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in
                        zip(sets, batch.column("digest").to_pylist())]
                sets = [s for s, ok in zip(sets, same) if ok]
                ends = np.cumsum([0] + [len(s) for s in sets])
                flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").filter(pa.array(same)),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["node", "shingles"])

        wanted = wanted.withColumnRenamed("doc_id", "wanted_id")
        texts = self.docs.join(small(wanted, rows), F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("node", "digest", "text")
        out = texts.mapInArrow(build, "node bigint, shingles array<bigint>")
        return saved(out.dropDuplicates(["node"]) if self.repeats else out, "near-full")

    def links(self, pairs: DataFrame, full: DataFrame) -> DataFrame:
        """The pairs confirmed on their full sets."""
        side = lambda x: full.select(F.col("node").alias(x), F.col("shingles").alias(f"s_{x}"))
        shared = F.size(F.array_intersect("s_a", "s_b"))
        union = F.size("s_a") + F.size("s_b") - shared
        return saved(pairs.join(side("a"), "a").join(side("b"), "b").where(100 * shared >= self.percent * union).select(
            F.col("a").alias("u"), F.col("b").alias("v")), "near-links")

    def wanted(self, nodes: DataFrame, some: DataFrame) -> DataFrame:
        return self.full_sets(saved(nodes.join(some.distinct(), "node").select("node", "doc_id", "digest"), "near-wanted"))

    def heads(self, full: DataFrame) -> DataFrame:
        """(key, node, size, place) of the rare shingles of every set: one of them at least is shared by any linked pair."""
        terms = full.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("key"))
        often = terms.groupBy("key").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
        # a shingle of one node only is rarest: it leads the order but meets nothing
        place = F.row_number().over(Window.partitionBy("node").orderBy("often", "key"))
        alone = F.col("size") - F.count(F.lit(1)).over(Window.partitionBy("node"))
        ranked = terms.join(often, "key").withColumn("place", (place + alone).cast("int"))
        least = F.ceil(F.col("size") * self.percent / 100)
        return saved(ranked.where(F.col("place") <= F.col("size") - least + 1).select("key", "node", "size", "place"), "near-heads")

    def open_rows(self, rows: DataFrame, labels: DataFrame | None, more_than: int = 1) -> DataFrame:
        """The rows of keys that reach over more than one component and number ``more_than``, with the component of their node."""
        if labels is None:
            return rows.withColumn("component", F.col("node"))
        labelled = rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        open_keys = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
        open_keys = open_keys.where((F.col("low") < F.col("high")) & (F.col("n") > more_than)).select("key")
        return saved(labelled.join(open_keys, "key"), "near-open")

    def lead_round(self, rows: DataFrame, full: DataFrame) -> DataFrame:
        """Links between nodes and the leads of their buckets that are in another component."""
        u = (F.pmod(F.xxhash64(F.pmod("key", F.lit(ORDERS)), "node"), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
        draw = -F.ln(u) / F.pow("score", F.lit(3.0))
        first = F.min(F.struct(draw.alias("draw"), "node", "size", "component")).alias("lead")
        met = rows.join(rows.groupBy("key").agg(first), "key").where((F.col("component") != F.col("lead.component")) & self.alike("size", "lead.size"))
        pairs = met.select(F.least("lead.node", "node").alias("a"), F.greatest("lead.node", "node").alias("b"))
        return self.links(saved(pairs.distinct(), "near-pairs"), full)

    def last_round(self, buckets: DataFrame, heads: DataFrame, full: DataFrame) -> DataFrame:
        """All links the lead rounds left open: between nodes of open buckets that share a rare shingle across components."""
        heads = saved(heads.join(buckets.select("node").distinct(), "node"), "near-last")
        a, b = heads.alias("a"), heads.alias("b")
        need = F.ceil((F.col("a.size") + F.col("b.size")) * self.percent / (100 + self.percent))
        meet = ((F.col("a.key") == F.col("b.key")) & (F.col("a.node") < F.col("b.node"))
                & (F.col("a.component") != F.col("b.component")) & self.alike("a.size", "b.size")
                & (F.col("a.place") <= F.col("a.size") - need + 1) & (F.col("b.place") <= F.col("b.size") - need + 1))
        pairs = a.join(b, meet).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
        return self.links(saved(pairs, "near-pairs"), full)

    def joined(self, links: DataFrame, labels: DataFrame | None) -> DataFrame:
        """The components with the links added."""
        if labels is not None:
            links = links.unionByName(labels.select(F.col("node").alias("u"), F.col("component").alias("v")))
        return saved(connected_components(links), "near-labels")

    def run(self) -> DataFrame:
        sets = self.sets()
        named = sets.where(F.col("digest").isNotNull())
        count = sets.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
        self.repeats = count["n"] != count["ids"]
        first = saved(named.groupBy("digest").agg(F.min("row").alias("node")), "near-classes")
        nodes = saved(sets.join(first.select(F.col("node").alias("row")), "row").withColumnRenamed("row", "node"), "near-nodes")
        buckets = self.buckets(nodes)
        full = self.wanted(nodes, buckets.select("node"))
        labels = None
        for turn in range(ROUNDS):
            part = buckets.where(F.pmod("key", F.lit(ROUNDS)) == turn)
            labels = self.joined(self.lead_round(self.open_rows(part, labels), full), labels)
        # in a bucket of two nodes both have met
        left = self.open_rows(buckets, labels, more_than=2)
        labels = self.joined(self.last_round(left, self.open_rows(self.heads(full), labels), full), labels)

        classes = first.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
        rows = sets.join(classes, "digest", "left").withColumn("component", F.coalesce("component", -1 - F.col("row")))
        best = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))
        keep = rows.groupBy("component").agg(best.alias("best"))
        return rows.join(keep, "component").select(
            "doc_id", "mark", "n_shingles", F.col("best.doc_id").alias("component_id"), (F.col("row") == F.col("best.row")).alias("kept"))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                    chunks: int = 16, width: int = 5) -> DataFrame:
    """Groups of documents linked by shingle sets with 100 * intersection >= ``percent`` * union.

    Returns one row per input row: doc_id, n_shingles (size of the set), component_id (smallest id reachable over links),
    kept (true for one row of each component: that of the smallest id). Every link between different sets whose signatures are within the
    distance is found; at the default size a pair at the threshold exceeds it about 3 times in 100,000, and most of those
    share a bucket all the same.

    Null, empty and wordless texts have no shingles, link with nothing and are kept. Equal sets are linked. Null ids
    come after all others; of rows that repeat an id and a text one is kept. Empty tables give no rows. Other columns
    are not read.
    """
    return NearDuplicates(docs, doc_id, text, shingle, percent, chunks, width).run().drop("mark")


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80,
                         chunks: int = 16, width: int = 5) -> DataFrame:
    """The rows that stay by :func:`near_duplicates`, with all their columns."""
    decided = NearDuplicates(docs, doc_id, text, shingle, percent, chunks, width).run().select(
        F.struct(F.col("doc_id").alias("id"), "mark").alias("key"), F.col("kept").cast("int").alias("copies"))
    return take_rows(docs, F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("mark")), decided)
