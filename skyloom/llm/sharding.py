"""Sharding by a weighted hash tree over regions, racks and shards.

A document descends from the root. At each level every child of the node it has reached draws -ln(u) / weight, u being a
hash of id and child and the weight that of the child's whole subtree, and the least draw wins: exponential draws, so
a child takes its share by weight. Only the winner's children draw at the next level, so a document costs one hash per region, per rack
of one region and per shard of one rack.

A draw depends on nothing but its own child's weight. When the weight of a shard changes, the draws of its rack, its region and
itself change and no other: rows move between regions only into (or, for a smaller weight, out of) the changed region, within it between racks
only into the changed rack, and within that between shards only into the changed shard. Rows that enter a region are
dealt there over all its racks. Added shards are regions of their own, so growth moves rows into them and nowhere else.

DataFrame operations only; nothing but ids, sizes and checksums is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import saved

BUCKET_ROWS = 100_000  # rows numbered in one task


Tree = list[list[list[tuple[int, float]]]]


def weighted_tree(weights: Sequence[float], racks: int = 4, rack_shards: int = 4, added: int = 0) -> Tree:
    """Regions of ``racks`` racks of ``rack_shards`` shards, filled in shard order; each of the last ``added`` shards is
    a region. Shards of weight 0 get no rows while any other shard has a weight."""
    shards = [(i, float(w)) for i, w in enumerate(weights)]
    old = len(shards) - added
    rows = [shards[i:min(i + rack_shards, old)] for i in range(0, old, rack_shards)]
    return [rows[i:i + racks] for i in range(0, len(rows), racks)] + [[[shard]] for shard in shards[old:]]


def _node(number: int, weight: float, below: Column) -> Column:
    return F.struct(F.lit(number).alias("node"), F.lit(weight).alias("weight"), below.alias("below"))


def shard_of(doc_id: Column, tree: Tree, seed: int = 29) -> Column:
    """The shard a document descends to. Null ids share one place."""
    weight = lambda rack: sum(w for _, w in rack)
    regions = F.array(*[
        _node(i, sum(map(weight, region)), F.array(*[
            _node(j, weight(rack), F.array(*[_node(k, w, F.lit(0)) for k, w in rack])) for j, rack in enumerate(region)]))
        for i, region in enumerate(tree)])

    def winner(children: Column, *path: Column) -> Column:
        def draw(x: Column) -> Column:
            u = (F.pmod(F.xxhash64(doc_id, *path, x["node"], F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
            lot = F.when(x["weight"] > 0, -F.ln(u) / x["weight"]).otherwise(F.lit(float("inf")))
            return F.struct(lot.alias("draw"), x["node"].alias("node"), x["below"].alias("below"))
        return F.array_min(F.transform(children, draw))

    def inside(top: Column) -> Column:
        rack = F.array(winner(top["below"], F.lit("rack"), top["node"]))
        return F.element_at(F.transform(rack, lambda r: winner(r["below"], F.lit("shard"))["node"]), 1)

    return F.element_at(F.transform(F.array(winner(regions, F.lit("region"))), inside), 1)


def assign_shards(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 40,
                  grown: Sequence[float] = (1.0,) * 41) -> DataFrame:
    """Shard, place in the shard and the shard after growth for every row.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law (``key``), shard,
    slot (0, 1, ... without gaps in every shard), grown_shard (the shard under ``grown``, whose shards beyond those of
    ``weights`` are added ones).

    Null text counts as empty (size 16, checksum 0). Rows of one id, null included, share a shard whatever their text;
    each gets a slot of its own. Slots follow a number fixed when the table is written, dealt in pieces of about
    100,000 rows, so a hot shard is numbered by many tasks. Empty tables give no rows. Other columns are not read.
    """
    key = F.col(doc_id)
    table = saved(docs.select(
        key.alias("doc_id"), (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
        shard_of(key, weighted_tree(weights)).alias("shard"),
        shard_of(key, weighted_tree(grown, added=len(grown) - len(weights))).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row")), "shards")
    pieces = max(1, -(-table.count() // BUCKET_ROWS))
    table = table.withColumn("piece", F.pmod(F.xxhash64("row"), F.lit(pieces)))
    counts = table.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("row")) - 1
    return table.withColumn("place", place).join(offsets, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("place")).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
