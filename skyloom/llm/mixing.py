"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with the copy rate of its source: some whole copies and a fraction. The fractions are
settled by pivotal steps: two documents are paired, and words move from one fraction to the other, at random but
without changing the expected copies of either, until one fraction is 0 or 1. The words of the pair stay the same,
so the words a source gives stay on target. A block of about ``fan_in`` documents leaves at most one open fraction;
these residuals meet in blocks of the next level, and so on up a tree, until one is left per source, which is
rounded to the nearer side.

DataFrame operations only. Blocks are drawn by a hash of the document, so a hot source is many blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.common import WORD, saved, small, take_rows

EXACT = 1e-12  # fractions this near to 0 or 1 are settled


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its size, rows and target.

    Sources in code-point order, null last, take ``weights`` in turn. ``share`` of all sizes is dealt by weight;
    a target above ``most`` times the source's size stops there and the excess goes to the others by weight.
    The windows run over one row per source, not over documents.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    table = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
             .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (turn % len(weights) + 1).cast("int")))
             .withColumn("cap", F.col("source_size") * F.lit(float(most)))
             .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share))))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    table = (table.withColumn("level", (F.col("budget") - before) / after)
             .withColumn("open", F.col("level") * F.col("weight") < F.col("cap")))
    first = F.min_by(F.when(F.col("open"), F.col("level")),
                     F.when(F.col("open"), F.col("cap") / F.col("weight"))).over(every)
    return table.select("source", "source_size", "rows", F.least(
        F.col("cap"), F.coalesce(first * F.col("weight"), F.col("cap"))).alias("target"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _settled(p: Column) -> Column:
    return F.when(p < EXACT, F.lit(0.0)).when(p > 1 - EXACT, F.lit(1.0)).otherwise(p)


def _is_open(p: Column) -> Column:
    return (p > 0) & (p < 1)


def _pivot(a: Column, b: Column, seed: int) -> Column:
    """Struct of both documents after one pivotal step: one of them has fraction 0 or 1."""
    mass_a, mass_b = a["p"] * a["size"], b["p"] * b["size"]
    total = mass_a + mass_b
    up, down = F.least(a["size"] - mass_a, mass_b), F.least(mass_a, b["size"] - mass_b)
    draw = F.pmod(F.xxhash64(a["key"], b["key"], F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))

    def move(gains: Column, loses: Column) -> tuple[Column, Column]:
        more = _settled(F.least(F.lit(1.0), total / gains["size"]))
        less = _settled(F.greatest(F.lit(0.0), total - gains["size"]) / loses["size"])
        return gains.withField("p", more), loses.withField("p", less)

    first, second = move(a, b), move(b, a)[::-1]
    a_gains = draw * (up + down) < down
    return F.struct(F.when(a_gains, first[0]).otherwise(second[0]).alias("a"),
                    F.when(a_gains, first[1]).otherwise(second[1]).alias("b"))


def _fold(items: Column, kind: str, last: Column, seed: int) -> Column:
    """All documents of a block after pairing them in turn; at most one fraction stays open."""
    start = F.struct(F.lit(None).cast(kind).alias("carry"), F.array().cast(f"array<{kind}>").alias("done"))

    def step(state: Column, x: Column) -> Column:
        def settle(pair: Column) -> Column:
            a, b = pair["a"], pair["b"]
            return (F.when(_is_open(a["p"]), F.struct(a.alias("carry"), F.concat(state["done"], F.array(b)).alias("done")))
                    .when(_is_open(b["p"]), F.struct(b.alias("carry"), F.concat(state["done"], F.array(a)).alias("done")))
                    .otherwise(F.struct(F.lit(None).cast(kind).alias("carry"),
                                        F.concat(state["done"], F.array(a, b)).alias("done"))))
        return F.when(state["carry"].isNull(), F.struct(x.alias("carry"), state["done"].alias("done"))).otherwise(
            _let(_pivot(state["carry"], x, seed), settle))

    def finish(state: Column) -> Column:
        carry = state["carry"]
        rounded = carry.withField("p", F.when(last, F.round(carry["p"])).otherwise(carry["p"]))
        return F.when(carry.isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(rounded)))

    return F.aggregate(items, start, step, finish)


def mix_sources(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, fan_in: int = 64,
                seed: int = 17) -> DataFrame:
    """Copies of every document so that each source gives its target number of words.

    Returns one row per input row: doc_id, source, size, source_size, target, copies, taken (= size * copies).
    ``copies`` is one of the two whole numbers around target / source_size, so at most ``most``. The words of a
    source differ from its target by half of one document at most. Reruns agree.

    Null text has size 0 and no copies when its source is empty, else the whole copies of its source; a null source
    is a source of its own; null ids are ordinary values. Rows equal in id, source and size are interchangeable:
    they are counted first, and their fractions add up before the pairing. An empty table gives no rows. Other
    columns are not read.
    """
    sizes = saved(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                              word_count(F.col(text)).alias("size")), "mix-sizes")
    targets = saved(source_targets(sizes, weights, share, most), "mix-targets")
    plan = targets.agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows")).first()
    targets = small(targets, plan["n"])

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + EXACT)
    units = (sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")).alias("u")
             .join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")))
             .select("u.*", "rows", whole.alias("base"), (F.col("n") * F.greatest(rate - whole, F.lit(0.0))).alias("mass"))
             .withColumn("more", F.floor(F.col("mass") + EXACT))
             .withColumn("p", _settled(F.greatest(F.col("mass") - F.col("more"), F.lit(0.0))))
             .withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(F.lit(0.0)))
             .withColumn("key", F.xxhash64("doc_id", "size", F.lit(seed)))
             .withColumn("rank", -F.col("size"))  # long documents first: what stays open is then short
             .withColumn("blocks", F.ceil(F.col("rows") / fan_in))
             .withColumn("block", F.pmod(F.col("key"), F.col("blocks")))
             .drop("mass", "rows"))
    level = saved(units, "mix-units")
    names = ["rank", "key", "doc_id", "size", "n", "base", "more", "p"]
    kind = "struct<" + ",".join(f"{c}:{level.schema[c].dataType.simpleString()}" for c in names) + ">"
    done, blocks = [level.where(~_is_open(F.col("p")))], -(-(plan["rows"] or 0) // fan_in)
    while blocks:
        items = F.array_sort(F.collect_list(F.struct(*names)))
        settled = _fold(F.col("items"), kind, F.col("blocks") == 1, seed)
        level = saved(
            level.where(_is_open(F.col("p"))).groupBy("source", "blocks", "block").agg(items.alias("items"))
            .select("source", "blocks", "block", F.explode(settled).alias("x"))
            .select("source", F.ceil(F.col("blocks") / fan_in).alias("blocks"),
                    F.floor(F.col("block") / fan_in).alias("block"), "x.*"), "mix-level")
        done.append(level.where(~_is_open(F.col("p"))))
        blocks = 0 if blocks == 1 else -(-blocks // fan_in)

    extra = (F.col("more") + F.col("p")).cast("long")
    copies = F.concat(F.array_repeat(F.col("base") + 1, extra.cast("int")),
                      F.array_repeat(F.col("base"), (F.col("n") - extra).cast("int")))
    rows = reduce(DataFrame.unionByName, [d.select("source", "doc_id", "size", "n", "base", "more", "p") for d in done])
    return (rows.select("doc_id", "source", "size", F.explode(copies).alias("copies")).alias("d")
            .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", F.col("copies").cast("long").alias("copies"),
                    (F.col("d.size") * F.col("copies")).cast("long").alias("taken")))


def take_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows in as many copies as :func:`mix_sources` gives them, with all their columns."""
    key = lambda d, s, n: F.struct(d.alias("id"), s.alias("source"), n.alias("size")).alias("key")
    decided = mix_sources(docs, doc_id=doc_id, text=text, source=source, **options).select(
        key(F.col("doc_id"), F.col("source"), F.col("size")), "copies")
    return take_rows(docs, key(F.col(doc_id), F.col(source), word_count(F.col(text))), decided)
