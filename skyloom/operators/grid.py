"""Time-grid operators: grids, fills, interpolation, gaps and recovery plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalar import floor_time, on_grid, shift_time
from skyloom.operators.series import (
    CHUNK,
    MICROS,
    Series,
    dealt,
    dedupe,
    in_blocks,
    row_pieces,
    with_neighbours,
    with_position,
)
from skyloom.session import cut_lineage

GRID_PIECE = 4096


def time_grid(spans: DataFrame, series: Series, start: str = "start", end: str = "end",
              keep: Sequence[str] = (), rows: int | None = None) -> DataFrame:
    """All grid points of ``[start, end]`` per key; none where ``end < start``.

    A long span is first cut into pieces that are spread over the cluster, so one huge series is
    not generated by one task. ``rows`` is the number of points, if known, by which the pieces are dealt.
    """
    points = F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(series.step_us))
    pieces = (spans.where(F.col(end) >= F.col(start))
              .select(*series.keys, *keep, F.col(start).alias("__from"), points.alias("__last"))
              .withColumn("__piece", F.explode(F.sequence(
                  F.lit(0), F.floor(F.col("__last") / GRID_PIECE).cast("int")))))
    pieces = pieces.repartition(*series.keys, "__piece") if rows is None else dealt(pieces, rows, *series.keys, "__piece")
    first = F.col("__piece").cast("bigint") * GRID_PIECE
    index = F.explode(F.sequence(first, F.least(F.col("__last"), first + (GRID_PIECE - 1))))
    moment = F.timestamp_micros(F.unix_micros("__from") + F.col("__i") * F.lit(series.step_us))
    return (pieces.withColumn("__i", index)
            .select(*series.keys, *keep, moment.alias(series.time)))


def spans_of(df: DataFrame, series: Series) -> DataFrame:
    """First and last time per key."""
    return df.groupBy(*series.keys).agg(F.min(series.time).alias("start"),
                                        F.max(series.time).alias("end"))


# ---- fills on the rows at hand -------------------------------------------

def _between(c: str, at: Column) -> Column:
    """Linear value at ``at`` between the neighbours added by ``with_neighbours``."""
    pv, nv, pt, nt = (F.col(f"__{x}_{c}") for x in ("pv", "nv", "pt", "nt"))
    share = (at - pt).cast("double") / (nt - pt).cast("double")
    return F.when(nv.isNotNull() & pv.isNotNull() & (nt > pt), pv + (nv - pv) * share)


def ffill(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    near = with_neighbours(df, series, columns, ahead=False)
    return near.select(*[F.col(f"__pv_{c}").alias(c) if c in columns else F.col(c)
                         for c in df.columns])


def bfill(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    near = with_neighbours(df, series, columns, back=False)
    return near.select(*[F.col(f"__nv_{c}").alias(c) if c in columns else F.col(c)
                         for c in df.columns])


def fill_both(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Forward fill, then backward fill of what is still missing."""
    near = with_neighbours(df, series, columns)
    return near.select(*[F.coalesce(f"__pv_{c}", f"__nv_{c}").alias(c) if c in columns
                         else F.col(c) for c in df.columns])


def interpolate_time(df: DataFrame, series: Series, columns: Sequence[str], *,
                     fill_edges: bool = False, rows: int | None = None) -> DataFrame:
    """Linear in elapsed time. Leading NULLs stay, trailing NULLs take the last value.

    ``fill_edges`` adds the backward fill of the leading run. ``rows`` is the number of rows, if known.
    """
    near = with_neighbours(df, series, columns, rows=rows)
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        value = [F.col(c), _between(c, series.at()), F.col(f"__pv_{c}")]
        if fill_edges:
            value.append(F.col(f"__nv_{c}"))
        out.append(F.coalesce(*value).alias(c))
    return near.select(*out)


def ffill_limit(df: DataFrame, series: Series, columns: Sequence[str], limit: int,
                tie: Sequence[Column] = ()) -> DataFrame:
    """Forward fill of at most ``limit`` consecutive NULLs."""
    held = [f"__f_{c}" for c in columns]
    out = in_blocks(df, series, lookback=limit, tie=tie, build=lambda w: [
        F.last(c, True).over(w.rowsBetween(-limit, 0)).alias(h) for c, h in zip(columns, held)])
    return out.select(*[F.col(f"__f_{c}").alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def interpolate_limit(df: DataFrame, series: Series, columns: Sequence[str], limit: int,
                      by: str = "time") -> DataFrame:
    """Interpolate the first ``limit`` NULLs of every run, trailing run included.

    ``by='time'`` needs a complete grid; ``by='row'`` is linear in row position.
    """
    if by == "time":
        source, at, unit = df, series.at(), series.step_us
    else:
        source, at, unit = with_position(df, series), F.col("__pos"), 1
    near = with_neighbours(source, series, columns, at=at, rows=None if CHUNK in df.columns else df.count())
    out = []
    for c in df.columns:
        if c not in columns:
            out.append(F.col(c))
            continue
        reached = (at - F.col(f"__pt_{c}")) <= limit * unit
        filled = F.when(reached, F.coalesce(_between(c, at), F.col(f"__pv_{c}")))
        out.append(F.coalesce(F.col(c), filled).alias(c))
    return near.select(*out)


# ---- completing a grid ---------------------------------------------------

def complete_grid(df: DataFrame, series: Series, columns: Sequence[str], *,
                  fill: str = "interpolate", causal: bool = False,
                  start: Column | None = None, end: Column | None = None,
                  aligned: bool = True) -> DataFrame:
    """One row per grid step between the first and last time (or ``start`` / ``end``).

    No grid is joined: each observed row already knows the next one, so it is expanded to the
    missing steps behind it and every value is computed from the two neighbours it carries. The
    shuffle volume is that of the observed rows, not of the grid. A mark at the start of every piece
    of time cuts long holes, so a task unfolds one piece at a time. ``fill='hold'`` fills forward,
    then backward; ``fill='none'`` leaves new rows NULL; ``causal`` only looks back. Rows off the grid do not contribute; with
    ``aligned=False`` they still stretch the grid to the step they fall into. ``start`` and
    ``end`` are literals; rows outside them are cropped first.
    """
    keys = list(series.keys)
    rows = df.select(*keys, series.time, *columns)
    if start is not None:
        rows = rows.where(F.col(series.time) >= start)
    if end is not None:
        rows = rows.where(F.col(series.time) <= end)
    exact = on_grid(series.time, series.step)
    if aligned:
        rows = rows.where(exact)
    else:
        bucket = floor_time(series.time, series.step)
        rows = rows.groupBy(*keys, bucket.alias("__bucket")).agg(
            *[F.max(F.when(exact, F.col(c))).alias(c) for c in columns]
        ).withColumnRenamed("__bucket", series.time)
    carried = [] if fill == "none" else list(columns)
    # Only the keys and times are read for the number of steps.
    steps = _spans(rows, series, start, end).agg(F.sum((F.col("__to") - F.col("__from")) / F.lit(series.step_us) + 1)).first()[0]
    marked = rows.withColumn("__row", F.lit(1)).unionByName(
        _piece_marks(rows, series, start, end), allowMissingColumns=True)
    # A mark comes before a row of the same time, so that it sees the row ahead of it and unfolds nothing.
    marked = marked.withColumn("__mark", F.when(F.col("__row").isNull(), 0).otherwise(1))
    near = with_neighbours(marked, series, ["__row", *carried], strict=True,
                           strict_back=["__row"], tie=["__mark"], rows=int(max(steps or 0, 0)))

    at, step = series.at(), F.lit(series.step_us)
    last = floor_time(end, series.step) if end is not None else None
    behind = F.when(F.col("__nt___row").isNotNull(), (F.col("__nt___row") - at) / step - 1)
    tail = F.lit(0) if last is None else (F.unix_micros(last) - at) / step
    # A stretch ends with its piece; the mark of the next piece goes on from there.
    rest = (_piece_start(series, series.chunk_of(at) + 1) - at) / step - 1
    high = F.least(F.coalesce(behind, tail), rest).cast("bigint")
    high = F.when(F.col("__mark") == 1, F.greatest(high, F.lit(0))).otherwise(high)
    # What a row holds for its stretch is settled before it unfolds; only interpolation also
    # needs both neighbours at every step. The value of the row itself is its own neighbour.
    held = {c: (F.col(c) if fill == "none" else F.col(f"__pv_{c}") if causal
                else F.coalesce(f"__pv_{c}", f"__nv_{c}")).alias(f"__h_{c}") for c in columns}
    linear = fill == "interpolate" and not causal
    ends = [f"__{x}_{c}" for c in columns for x in ("pv", "nv", "pt", "nt")] if linear else []
    grown = near.where(high >= 0).select(*keys, series.time, *held.values(), *ends,
                                         F.explode(F.sequence(F.lit(0).cast("bigint"), high)).alias("__i"))
    moment = at + F.col("__i") * step
    out = [F.col(k) for k in keys] + [F.timestamp_micros(moment).alias(series.time)]
    for c in columns:
        value = F.col(f"__h_{c}")
        if fill == "none":
            value = F.when(F.col("__i") == 0, value)
        elif linear:
            value = F.coalesce(_between(c, moment), value)
        out.append(value.alias(c))
    return grown.select(*out)


def _piece_start(series: Series, piece: Column) -> Column:
    """The first grid point of a piece of time, in microseconds."""
    begin = (piece * F.lit(series.chunk * MICROS)).cast("bigint")
    return begin + F.pmod(-begin, F.lit(series.step_us))


def _spans(rows: DataFrame, series: Series, start: Column | None, end: Column | None) -> DataFrame:
    """First and last step of the grid per key, in microseconds."""
    first = floor_time(start, series.step) if start is not None else F.min(series.time)
    last = floor_time(end, series.step) if end is not None else F.max(series.time)
    return rows.groupBy(*series.keys).agg(F.unix_micros(first).alias("__from"), F.unix_micros(last).alias("__to"))


def _piece_marks(rows: DataFrame, series: Series, start: Column | None, end: Column | None) -> DataFrame:
    """A row (keys, time) at the first grid point of every piece that a series covers.

    With them a hole is unfolded piece by piece, wherever the pieces are dealt to, and no row unfolds more than a piece.
    """
    spans = _spans(rows, series, start, end)
    from_, to = series.chunk_of(F.col("__from")).cast("bigint"), series.chunk_of(F.col("__to")).cast("bigint")
    pieces = spans.withColumn("__piece", F.explode(F.sequence(from_, F.greatest(from_, to))))
    at = F.greatest(F.col("__from"), _piece_start(series, F.col("__piece")))
    return pieces.where(at <= F.col("__to")).select(*series.keys, F.timestamp_micros(at).alias(series.time))


def upsample(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Coarser rows to the grid: off-grid values are dropped, the rest is interpolated."""
    return complete_grid(df, series, columns, aligned=False)


def clean_series(df: DataFrame, series: Series, columns: Sequence[str], arrival: str,
                 hold: int = 6, reach: int = 12) -> DataFrame:
    """Keep the first arrival per time, hold values for ``hold`` rows, then row-linear fill.

    Both fills read their input several times; it is stored, so the source is scanned once. Pieces
    are ranges of rows, so arrivals may be as dense as they like.
    """
    one = row_pieces(dedupe(df, [*series.keys, series.time], arrival, keep="first").drop(arrival), series)
    held = cut_lineage(ffill_limit(one, series, columns, hold))
    return interpolate_limit(held, series, columns, reach, by="row").drop(CHUNK)


# ---- gaps ----------------------------------------------------------------

def gap_ranges(df: DataFrame, series: Series, start: Column, end: Column,
               locations: DataFrame | None = None) -> DataFrame:
    """Missing grid stretches inside ``[start, end]`` as (keys, gap_start, gap_end).

    A gap is what lies between two neighbouring observed times, so the expected grid is never
    materialised. ``locations`` adds keys that have no row in the range at all.
    """
    keys, step = list(series.keys), series.step
    seen = (df.where(F.col(series.time).between(start, end) & on_grid(series.time, step))
            .select(*keys, series.time).withColumn("__row", F.lit(1)))
    near = with_neighbours(seen, series, ["__row"], back=False, strict=True)
    following = F.coalesce(F.timestamp_micros("__nt___row"), shift_time(end, step))
    inner = near.select(*keys, shift_time(series.time, step).alias("gap_start"),
                        shift_time(following, -step).alias("gap_end"))
    firsts = seen.groupBy(*keys).agg(F.min(series.time).alias("__first"))
    head = firsts.select(*keys, start.alias("gap_start"),
                         shift_time("__first", -step).alias("gap_end"))
    gaps = inner.unionByName(head)
    if locations is not None:
        empty = locations.select(*keys).distinct().join(firsts, keys, "left_anti")
        gaps = gaps.unionByName(empty.select(*keys, start.alias("gap_start"), end.alias("gap_end")))
    return gaps.where(F.col("gap_start") <= F.col("gap_end"))


def missing_points(df: DataFrame, grid: DataFrame, series: Series) -> DataFrame:
    """Grid points without an observed row."""
    on = [*series.keys, series.time]
    return grid.join(df.select(*on), on, "left_anti")


def recovery_plan(df: DataFrame, locations: DataFrame, series: Series, now: Column,
                  history_start: Column, lookback_days: int = 14,
                  full_backfill: bool = False) -> DataFrame:
    """Range to repair per location: (keys, latest, recovery_start, recovery_end, reason).

    Everything for a location without data; else from the first gap of the look-back range to
    now; else from the step behind the latest row to now; else nothing (NULL range).
    """
    keys = list(series.keys)
    floor_now = floor_time(now, series.step)
    latest = df.groupBy(*keys).agg(floor_time(F.max(series.time), series.step).alias("latest"))
    since = F.greatest(history_start, shift_time(floor_now, -lookback_days * 86400))
    gaps = gap_ranges(df, series, since, floor_now, locations=locations)
    firsts = gaps.groupBy(*keys).agg(F.min("gap_start").alias("first_gap"))
    known = (locations.select(*keys).distinct()
             .join(latest, keys, "left").join(firsts, keys, "left"))
    no_data = F.lit(full_backfill) | F.col("latest").isNull()
    gap, behind = F.col("first_gap").isNotNull(), F.col("latest") < floor_now
    begin = (F.when(no_data, history_start).when(gap, F.col("first_gap"))
             .when(behind, shift_time("latest", series.step)))
    reason = (F.when(no_data, "history").when(gap, "gap").when(behind, "behind")
              .otherwise("none"))
    return known.select(*keys, "latest", begin.alias("recovery_start"),
                        F.when(begin.isNotNull(), floor_now).alias("recovery_end"),
                        reason.alias("reason"))


def resume_point(df: DataFrame, series: Series, start: Column, step_seconds: int = 3600) -> DataFrame:
    """Where a loader continues, per key: one step behind the latest time."""
    latest = df.groupBy(*series.keys).agg(F.max(series.time).alias("__latest"))
    return latest.select(*series.keys, F.coalesce(shift_time("__latest", step_seconds), start)
                         .alias("resume_at"))


__all__ = [
    "MICROS", "bfill", "clean_series", "complete_grid", "ffill", "ffill_limit", "fill_both",
    "gap_ranges", "interpolate_limit", "interpolate_time", "missing_points", "recovery_plan",
    "resume_point", "spans_of", "time_grid", "upsample",
]
