"""Series in bounded pieces: what every window operator of the library is built on.

A single series may hold a large share of all rows, so nothing here opens a window over a whole
series. Rows are cut into pieces and windows run inside a piece:

* unbounded look-back / look-ahead (fill, interpolation, as-of, gaps): a piece is a stretch of
  time, or a range of rows where times may be dense (:func:`row_pieces`); one summary row per piece carries the nearest value into the neighbouring pieces
  (:func:`with_neighbours`);
* bounded frames (lags, rolling, smoothing): a piece is a block of row positions, and the rows
  next to a block border are copied into the neighbouring block (:func:`in_blocks`).

Key columns must not be NULL (see ``sources.upserts.split_valid``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyloom.session import cut_lineage

CHUNK, OWN, BLOCK = "__chunk", "__own", "__block"
MICROS = 1_000_000


@dataclass(frozen=True)
class Series:
    """Key columns, time column, grid step and the longest stretch one piece may cover.

    ``complete`` states that the series has exactly one row per grid step between its first and
    last row, so that row positions follow from the time alone.
    """

    keys: tuple[str, ...] = ("site",)
    time: str = "time"
    step: int = 900
    chunk: int = 30 * 86400
    complete: bool = False

    def at(self) -> Column:
        return F.unix_micros(F.col(self.time))

    def chunk_of(self, at: Column) -> Column:
        return F.floor(at / F.lit(self.chunk * MICROS))

    def on_complete_grid(self) -> "Series":
        return replace(self, complete=True)

    @property
    def step_us(self) -> int:
        return self.step * MICROS


#: Rows of a grid that one task sorts.
TASK_ROWS = 250_000


def dealt(df: DataFrame, rows: int, *by: str | Column) -> DataFrame:
    """``df`` dealt by columns to as many parts as ``rows`` need. Rows that are about to unfold, or to be sorted, take far
    more memory than their bytes in a shuffle show, so the number follows the rows and is not merged by adaptive execution."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // TASK_ROWS)), *by)


def row_pieces(df: DataFrame, series: Series, *order: str) -> DataFrame:
    """``df`` in pieces of about equal numbers of rows, whatever their times; stored.

    Spark samples the keys and times for the borders of the ranges, so a key with most rows, or most rows within one stretch of
    time, is dealt to as many pieces as it fills. Pieces ascend with key, time and ``order``; operators that carry
    values from piece to piece take one summary row of each. Only rows equal in all of these cannot be parted.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.drop(CHUNK).repartitionByRange(n, *series.keys, series.time, *order)
    return cut_lineage(ranged.withColumn(CHUNK, F.spark_partition_id().cast("bigint")))


def in_pieces(df: DataFrame, series: Series) -> DataFrame:
    """The pieces a frame has, or stretches of time."""
    return df if CHUNK in df.columns else df.withColumn(CHUNK, series.chunk_of(series.at()))


def with_neighbours(df: DataFrame, series: Series, columns: Sequence[str], *,
                    back: bool = True, ahead: bool = True, strict: bool = False,
                    strict_back: Sequence[str] = (), at: Column | None = None,
                    tie: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """Add the nearest non-NULL value of each column on either side of every row.

    Adds ``__pt_c`` / ``__pv_c`` (coordinate and value at or before the row) and ``__nt_c`` /
    ``__nv_c`` (at or after it; strictly after with ``strict``). Columns in ``strict_back`` look
    strictly before the row. ``at`` is the BIGINT coordinate, microseconds by default.
    Columns in ``tie`` order rows that share a coordinate. Pieces made by :func:`row_pieces` are used
    as they are. ``rows`` is the number of rows that tasks have to hold, now or once they unfold.
    """
    at = series.at() if at is None else at
    keys = list(series.keys)
    pieces = in_pieces(df.withColumn("__at", at), series)
    if rows is not None:
        pieces = dealt(pieces, rows, *keys, CHUNK)

    summary, carried, added, helpers = [], [], [], ["__at", *([] if CHUNK in df.columns else [CHUNK])]
    by = ", ".join(f"`{k}`" for k in keys)
    # A frame that ends at the last row is quadratic in Spark; the mirrored order is not.
    earlier, later = (f"OVER (PARTITION BY {by} ORDER BY {CHUNK} {way} ROWS BETWEEN UNBOUNDED PRECEDING "
                      "AND 1 PRECEDING)" for way in ("ASC", "DESC"))
    up = ", ".join(["__at", *[f"`{c}`" for c in tie]])
    down = ", ".join(["__at DESC", *[f"`{c}` DESC" for c in tie]])

    def frame(order: str, itself: bool) -> str:
        last = "CURRENT ROW" if itself else "1 PRECEDING"
        return (f"OVER (PARTITION BY {by}, {CHUNK} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING "
                f"AND {last})")

    for c in columns:
        seen = f"if(`{c}` IS NOT NULL, __at, NULL)"
        sides = []
        if back:
            summary += [f"max({seen}) AS `__lt_{c}`", f"max_by(`{c}`, {seen}) AS `__lv_{c}`"]
            sides.append(("p", "l", earlier, frame(up, c not in strict_back)))
        if ahead:
            summary += [f"min({seen}) AS `__ft_{c}`", f"min_by(`{c}`, {seen}) AS `__fv_{c}`"]
            sides.append(("n", "f", later, frame(down, not strict)))
        for side, end, outside, inside in sides:
            for x, value in (("t", seen), ("v", f"`{c}`")):
                name = f"__c{side}{x}_{c}"
                carried.append(f"last(`__{end}{x}_{c}`, true) {outside} AS `{name}`")
                added.append(f"coalesce(last({value}, true) {inside}, `{name}`) AS `__{side}{x}_{c}`")
                helpers.append(name)
    ends = pieces.groupBy(*keys, CHUNK).agg(*[F.expr(e) for e in summary])
    ends = ends.selectExpr(*[f"`{k}`" for k in keys], CHUNK, *carried)
    # A broadcast would leave the rows dealt by key alone, all pieces of a long series in one task.
    return pieces.join(ends.hint("merge"), [*keys, CHUNK]).selectExpr("*", *added).drop(*helpers)


def with_position(df: DataFrame, series: Series, name: str = "__pos",
                  tie: Sequence[Column] = ()) -> DataFrame:
    """Row position inside the series, 0-based for irregular series.

    On a complete grid the position is the grid index of the time. Otherwise rows are counted per
    piece, the counts are summed over the few pieces of a series, and rows are numbered inside
    their piece.
    """
    if series.complete:
        return df.withColumn(name, F.expr(f"unix_micros(`{series.time}`) div {series.step_us}L"))
    keys = list(series.keys)
    pieces = in_pieces(df, series)
    counts = pieces.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, CHUNK,
                            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(series.time, *tie)
    return (pieces.join(offsets, [*keys, CHUNK])
            .withColumn(name, F.col("__off") + F.row_number().over(inside) - 1)
            .drop("__off", *([] if CHUNK in df.columns else [CHUNK])))


@dataclass(frozen=True)
class Blocks:
    """Rows placed in blocks, the window inside a block, and the way back to single rows."""

    df: DataFrame
    window: WindowSpec

    def own(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(OWN) == F.col(BLOCK)).drop(OWN, BLOCK)


def place_in_blocks(df: DataFrame, series: Series, *, lookback: int = 0, lookahead: int = 0,
                    block: int | None = None, tie: Sequence[Column] = ()) -> Blocks:
    """Cut series into blocks of row positions; rows next to a border go to both blocks.

    A block holds ``size`` positions plus at most ``lookback + lookahead`` copied rows, whatever
    the length of the series.
    """
    size = max(block or 2048, 8 * (lookback + lookahead))
    placed = with_position(df, series, tie=tie)
    offset = F.pmod(F.col("__pos"), F.lit(size))
    own = F.floor(F.col("__pos") / F.lit(size))
    copies = [own]
    if lookback:
        copies.append(F.when(offset >= size - lookback, own + 1))
    if lookahead:
        copies.append(F.when(offset < lookahead, own - 1))
    target = F.explode(F.array_compact(F.array(*copies))) if len(copies) > 1 else own
    placed = placed.withColumn(OWN, own).withColumn(BLOCK, target)
    return Blocks(placed, Window.partitionBy(*series.keys, BLOCK).orderBy("__pos"))


def in_blocks(df: DataFrame, series: Series, build: Callable[[WindowSpec], Sequence[Column]], *,
              lookback: int = 0, lookahead: int = 0, block: int | None = None,
              tie: Sequence[Column] = (),
              prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Evaluate bounded row frames: ``build`` gets the window and returns named columns.

    ``prepare`` may add columns to the placed rows first, in passes over the same window.
    """
    placed = place_in_blocks(df, series, lookback=lookback, lookahead=lookahead, block=block,
                             tie=tie)
    rows = prepare(placed.df) if prepare else placed.df
    return placed.own(rows.select("*", *build(placed.window))).drop("__pos")


def dedupe(df: DataFrame, keys: Sequence[str], order: Column | str, keep: str = "last") -> DataFrame:
    """One row per key: the last or first by ``order``. Copies collapse before the shuffle."""
    order = F.col(order) if isinstance(order, str) else order
    pick = {"last": F.max_by, "first": F.min_by}[keep]
    rest = [c for c in df.columns if c not in keys]
    return (df.withColumn("__ord", order).groupBy(*keys)
            .agg(*[pick(c, "__ord").alias(c) for c in rest]).select(*df.columns))
