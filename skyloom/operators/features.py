"""Lag, rolling, smoothing and horizon features. All frames are evaluated in bounded blocks."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions import calendar, weather
from skyloom.functions.scalar import shift_time
from skyloom.operators.frames import (
    block_pass,
    frame_columns,
    held_values,
    inclusive_moments,
    past_frames,
    running_averages,
    shifted,
)
from skyloom.operators.grid import complete_grid, fill_both
from skyloom.operators.joins import EXTERNAL_ROWS, exact_external
from skyloom.operators.series import (
    BLOCK,
    Series,
    in_blocks,
    place_in_blocks,
    with_neighbours,
    with_position,
)

# ---- column builders on one window ---------------------------------------


def lag_columns(columns: Sequence[str], lags: Sequence[int], w: WindowSpec,
                names: str = "{c}_lag_{k}") -> list[Column]:
    return [F.lag(c, k).over(w).alias(names.format(c=c, k=k)) for c in columns for k in lags]


# The moments of a stretch of rows are (n, mean, sum of squared deviations); a stretch without
# values is (0, 0, 0). Moments of two stretches merge into those of their union.
Moments = tuple[Column, Column, Column]


def _merge_sql(a: Sequence[str], b: Sequence[str]) -> list[str]:
    n, apart = f"greatest({a[0]} + {b[0]}, 1D)", f"({b[1]} - {a[1]})"
    return [f"{a[0]} + {b[0]}", f"{a[1]} + {apart} * ({b[0]} / {n})",
            f"{a[2]} + {b[2]} + {apart} * {apart} * ({a[0]} * {b[0]} / {n})"]


def rolled(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], windows: Sequence[int],
           finish: Callable[[str, int, Moments, tuple[Column, Column] | None], list[Column]], *,
           past: bool, extremes: bool = False) -> DataFrame:
    """Rolling statistics in O(log n) passes instead of n updates per row.

    Pass j knows the statistics of the last 2**j rows and doubles the stretch by looking 2**j
    rows back; a window is put together from the powers of two it consists of. All columns and
    windows share the passes, and all passes share one sort. ``past`` leaves the current row out.
    ``finish`` turns (column, window, moments, (min, max)) into named columns.
    """
    over = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in (*keys, BLOCK))} ORDER BY __pos)"
    kinds = ["n", "m", "q", *(["lo", "hi"] if extremes else [])]
    given, base = rows.columns, []
    for i, c in enumerate(columns):
        x = f"lag(`{c}`, 1) {over}" if past else f"`{c}`"
        base.append(f"cast({x} as double) AS __x{i}")
    rows = rows.selectExpr("*", *base)
    start = []
    for i, _ in enumerate(columns):
        start += [f"if(__x{i} IS NULL, 0D, 1D) AS __n{i}", f"coalesce(__x{i}, 0D) AS __m{i}", f"0D AS __q{i}"]
        start += [f"__x{i} AS __{kind}{i}" for kind in kinds[3:]]
    rows = rows.selectExpr(*[f"`{c}`" for c in given], *start)
    done: list[str] = []
    top = max(n.bit_length() for n in windows)
    for j in range(top):
        size, lags, step, fresh = 2 ** j, {}, {}, {}

        def back(name: str, k: int) -> str:
            """The value ``k`` rows back, read once per pass."""
            if k == 0:
                return name
            value = f"lag({name}, {k}) {over}"
            value = value if name.startswith(("__lo", "__hi")) else f"coalesce({value}, 0D)"
            lags[f"{name}_b{k}"] = value
            return f"{name}_b{k}"

        for i, _ in enumerate(columns):
            mine = [f"__{kind}{i}" for kind in kinds]
            for n in windows:
                parts = [f"__w{n}{name}" for name in mine]
                if n & size:
                    here = [back(name, (n >> (j + 1)) << (j + 1)) for name in mine[:3]]
                    if parts[0] in done:
                        here = _merge_sql(parts[:3], here)
                    fresh |= dict(zip(parts[:3], here))
                if extremes and n.bit_length() == j + 1:
                    fresh[parts[3]] = f"least({mine[3]}, {back(mine[3], n - size)})" if n > size else mine[3]
                    fresh[parts[4]] = f"greatest({mine[4]}, {back(mine[4], n - size)})" if n > size else mine[4]
            if j + 1 < top:
                step |= dict(zip(mine[:3], _merge_sql(mine, [back(name, size) for name in mine[:3]])))
                if extremes:
                    step[mine[3]] = f"least({mine[3]}, {back(mine[3], size)})"
                    step[mine[4]] = f"greatest({mine[4]}, {back(mine[4], size)})"
        rows = rows.selectExpr("*", *[f"{e} AS {name}" for name, e in lags.items()])
        kept = [f"`{c}`" for c in (*given, *[d for d in done if d not in fresh])]
        rows = rows.selectExpr(*kept, *[f"{e} AS {name}" for name, e in {**fresh, **step}.items()])
        done += [name for name in fresh if name not in done]
    out = []
    for i, c in enumerate(columns):
        for n in windows:
            parts = [F.col(f"__w{n}__{kind}{i}") for kind in kinds]
            out += finish(c, n, tuple(parts[:3]), tuple(parts[3:]) if extremes else None)
    return rows.select(*given, *out)


def _spread(m: Moments) -> Column:
    """Sample standard deviation; NULL below two values."""
    return F.when(m[0] > 1, F.sqrt(m[2] / F.greatest(m[0] - 1, F.lit(1.0))))


def past_statistics(keys: Sequence[str], columns: Sequence[str], windows: Sequence[int],
                    names: Mapping[str, str] | None = None, half_full: bool = True):
    """Prepare step: mean and sample std of the rows before the current one.

    NULL unless at least half of the window (one row at the least) has a value. Without
    ``half_full`` any value is enough and a missing std is 0.
    """
    def finish(c: str, n: int, m: Moments, _) -> list[Column]:
        label = names[c] if names else c
        enough = m[0] >= (max(1, n // 2) if half_full else 1)
        std = F.when(enough, _spread(m))
        return [F.when(enough, m[1]).alias(f"{label}_roll_mean_{n}"),
                (std if half_full else F.coalesce(std, F.lit(0.0))).alias(f"{label}_roll_std_{n}")]

    return lambda rows: rolled(rows, keys, columns, windows, finish, past=True)


def inclusive_statistics(keys: Sequence[str], columns: Sequence[str], windows: Mapping[str, int],
                         extremes: bool = False):
    """Prepare step: statistics of the rows up to and with the current one; no std counts as 0."""
    labels = {n: label for label, n in windows.items()}

    def finish(c: str, n: int, m: Moments, ends) -> list[Column]:
        out = [F.when(m[0] > 0, m[1]).alias(f"{c}_rmean_{labels[n]}"),
               F.coalesce(_spread(m), F.lit(0.0)).alias(f"{c}_rstd_{labels[n]}")]
        if extremes:
            out += [ends[0].alias(f"{c}_rmin_{labels[n]}"), ends[1].alias(f"{c}_rmax_{labels[n]}")]
        return out

    return lambda rows: rolled(rows, keys, columns, list(labels), finish, past=False, extremes=extremes)


def diff_columns(columns: Sequence[str], periods: Mapping[str, int], w: WindowSpec) -> list[Column]:
    return [(F.col(c) - F.lag(c, k).over(w)).alias(f"{c}_diff_{label}")
            for c in columns for label, k in periods.items()]


def wind_direction_columns(c: str, w: WindowSpec) -> list[Column]:
    return wind_waves(F.lag(c, 1).over(w))


def wind_waves(before: Column) -> list[Column]:
    angle = F.radians(F.coalesce(before, F.lit(0.0)))
    return [F.sin(angle).alias("wind_direction_sin_lag1"),
            F.cos(angle).alias("wind_direction_cos_lag1")]


# ---- single operators ----------------------------------------------------

def lag_features(df: DataFrame, series: Series, columns: Sequence[str],
                 lags: Sequence[int] = config.LAGS) -> DataFrame:
    return in_blocks(df, series, lambda w: lag_columns(columns, lags, w), lookback=max(lags))


def rolling_past(df: DataFrame, series: Series, columns: Sequence[str],
                 windows: Sequence[int] = config.WINDOWS) -> DataFrame:
    return in_blocks(df, series, lambda w: [], lookback=max(windows),
                     prepare=past_statistics(series.keys, columns, windows))


def rolling_inclusive(df: DataFrame, series: Series, columns: Sequence[str],
                      windows: Mapping[str, int] = config.STATION_WINDOWS,
                      extremes: bool = False) -> DataFrame:
    return in_blocks(df, series, lambda w: [], lookback=max(windows.values()) - 1,
                     prepare=inclusive_statistics(series.keys, columns, windows, extremes))


def diff_features(df: DataFrame, series: Series, columns: Sequence[str],
                  periods: Mapping[str, int]) -> DataFrame:
    return in_blocks(df, series, lambda w: diff_columns(columns, periods, w),
                     lookback=max(periods.values()))


def wind_direction_lag(df: DataFrame, series: Series, column: str = "wind_direction_10m") -> DataFrame:
    return in_blocks(df, series, lambda w: wind_direction_columns(column, w), lookback=1)


def ema(df: DataFrame, series: Series, columns: Sequence[str],
        spans: Sequence[int] = config.STATION_EMA_SPANS, *, gapless: bool = False) -> DataFrame:
    """Exponential moving averages ``{c}_ema_{span}``; a NULL repeats the previous average.

    Each row with a value is the affine step y -> a*y + b. Steps compose, so the running average
    is a prefix scan by doubling: after j passes a row holds the composition of its last 2**j
    steps. The scan stops where the weight of everything older is below 2**-60, which no double
    can resolve; that reach is also the overlap of the blocks, so the length of a series does not
    matter. ``gapless`` states that no column has a NULL and saves a join per column.
    """
    if gapless:
        return _ema_scan(df, series, columns, spans).drop("__pos")
    out = with_position(df, series, "__row_pos")
    at = [*series.keys, series.time]
    for c in columns:
        names = [f"{c}_ema_{s}" for s in spans]
        # Rows without a value take no part, so positions are counted anew.
        valued = out.where(F.col(c).isNotNull()).select(*at, "__row_pos", c)
        averages = _ema_scan(valued, replace(series, complete=False), [c], spans, "__row_pos")
        joined = out.join(averages.select(*at, *names), at, "left")
        held = with_neighbours(joined, series, names, ahead=False)
        out = held.select(*out.columns, *[F.col(f"__pv_{n}").alias(n) for n in names])
    return out.drop("__row_pos")


def _ema_scan(df: DataFrame, series: Series, columns: Sequence[str], spans: Sequence[int],
              row: str = "__pos") -> DataFrame:
    """The scan over rows that all have a value; ``row`` counts skipped rows too."""
    placed = place_in_blocks(df, series, lookback=ema_reach(spans))
    return placed.own(_ema_steps(placed.df, placed.window, columns, spans, row))


def _ema_passes(span: int) -> int:
    return math.ceil(math.log2(1 + 60 * math.log(2) / -math.log1p(-2.0 / (span + 1.0))))


def ema_reach(spans: Sequence[int]) -> int:
    """Rows back from which a value still counts in a double."""
    return 2 ** max(map(_ema_passes, spans))


def _ema_steps(rows: DataFrame, w: WindowSpec, columns: Sequence[str], spans: Sequence[int], row: str = "__pos") -> DataFrame:
    """Prepare step: the scan over rows placed in blocks."""
    alpha = {s: 2.0 / (s + 1.0) for s in spans}
    passes = {s: _ema_passes(s) for s in spans}
    rows = rows.withColumn("__gap", (F.col(row) - F.lag(row, 1).over(w)).cast("double"))
    start = F.col("__gap").isNull()
    steps = {}
    for s, a in alpha.items():
        old = F.pow(F.lit(1.0 - a), F.col("__gap"))
        steps[f"__a_{s}"] = F.when(start, F.lit(0.0)).otherwise(old / (old + F.lit(a)))
        for c in columns:
            steps[f"{c}_ema_{s}"] = F.when(start, F.col(c)).otherwise(
                F.lit(a) * F.col(c) / (old + F.lit(a)))
    rows = rows.withColumns(steps)
    for j in range(max(passes.values())):
        step = {}
        for s in spans:
            if j < passes[s]:
                a = F.col(f"__a_{s}")
                for c in columns:
                    y = F.col(f"{c}_ema_{s}")
                    older = F.coalesce(F.lag(y, 2 ** j).over(w), F.lit(0.0))
                    step[f"{c}_ema_{s}"] = y + a * older
                step[f"__a_{s}"] = a * F.coalesce(F.lag(a, 2 ** j).over(w), F.lit(1.0))
        rows = rows.withColumns(step)
    return rows.drop("__gap", *[f"__a_{s}" for s in spans])


# ---- feature matrices ----------------------------------------------------

def impute(df: DataFrame, series: Series, measures: Sequence[str] = config.MEASURES,
           siblings: Mapping[str, str] = config.SIBLINGS) -> DataFrame:
    """Satellite gaps from the sibling measure, then forward and backward fill."""
    return fill_both(_from_siblings(df, siblings), series, [c for c in measures if c in df.columns])


def imputed_grid(df: DataFrame, series: Series, measures: Sequence[str] = config.MEASURES,
                 siblings: Mapping[str, str] = config.SIBLINGS) -> DataFrame:
    """:func:`impute` of the completed grid, worked out on the observed rows before they unfold."""
    present = [c for c in measures if c in df.columns]
    return complete_grid(_from_siblings(df, siblings), series, present, fill="hold")


def _from_siblings(df: DataFrame, siblings: Mapping[str, str]) -> DataFrame:
    return df.select(*[
        F.coalesce(F.col(c), F.col(siblings[c])).alias(c)
        if c in siblings and siblings[c] in df.columns else F.col(c) for c in df.columns])


def matrix_columns(measures: Sequence[str] = config.MEASURES, lags: Sequence[int] = config.LAGS,
                   windows: Sequence[int] = config.WINDOWS) -> list[str]:
    """Feature names in model order."""
    names = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "doy_sin", "doy_cos", "is_weekend"]
    for c in measures:
        names += [f"{c}_lag_{k}" for k in lags]
        for n in windows:
            names += [f"{c}_roll_mean_{n}", f"{c}_roll_std_{n}"]
    if "wind_direction_10m" in measures:
        names += ["wind_direction_sin_lag1", "wind_direction_cos_lag1"]
    return names


def feature_matrix(df: DataFrame, series: Series, *, measures: Sequence[str] = config.MEASURES,
                   targets: Sequence[str] = config.TARGETS, lags: Sequence[int] = config.LAGS,
                   windows: Sequence[int] = config.WINDOWS, drop_missing: bool = True,
                   imputed: bool = False, packed: str | None = None) -> DataFrame:
    """Calendar, lag, rolling and wind features of every measure, with the targets of the row.

    All frames come from one Arrow pass over one partitioning and one sort; targets ride along in
    the same rows, so no join is needed. ``packed`` names one array that holds the lags and rolling
    statistics in the order of ``frame_columns(measures, lags, windows)``; the rest stays in columns.
    """
    source = df if imputed else impute(df, series, measures)
    windy = "wind_direction_10m" in measures
    more = [1] if windy and 1 not in lags else []
    built = past_frames(source, series, measures, [*lags, *more], windows, whole=drop_missing and not more,
                        carry=[*series.keys, series.time, *targets], packed=packed)
    names = matrix_columns(measures, lags, windows)
    if packed:
        placed = frame_columns(measures, [*lags, *more], windows)
        before = F.col(packed)[placed.index("wind_direction_10m_lag_1")] if windy else None
        asked = frame_columns(measures, lags, windows)
        held = F.col(packed) if not more else F.array(*[F.col(packed)[placed.index(c)] for c in asked]).alias(packed)
        rest = [c for c in names if c not in set(asked)]
        ready = built.select(*series.keys, series.time, held, *(wind_waves(before) if windy else []), *calendar.cyclic(series.time), *targets)
        ready = ready.select(*series.keys, series.time, packed, *rest, *targets)
        if drop_missing and more:
            ready = ready.where(~F.exists(packed, F.isnull))
        return ready.dropna(how="any", subset=[*rest, *targets]) if drop_missing else ready
    wind = wind_waves(F.col("wind_direction_10m_lag_1")) if windy else []
    made = set(built.columns) & set(names)
    ready = built.select(*series.keys, series.time, *targets, *[c for c in names if c in made], *wind, *calendar.cyclic(series.time))
    ready = ready.select(*series.keys, series.time, *names, *targets)
    rest = names if more else [c for c in names if c not in made]
    return ready.dropna(how="any", subset=[*rest, *targets]) if drop_missing else ready


def station_columns(targets: Sequence[str] = config.STATION_TARGETS) -> list[str]:
    names = [f"{c}_lag{k}" for c in targets for k in config.STATION_LAGS]
    names += [f"{c}_{stat}_{label}" for c in targets for label in config.STATION_WINDOWS
              for stat in ("rmean", "rstd")]
    names += ["hour_sin", "hour_cos", "doy_sin", "doy_cos", "month", "is_daytime", "weekday",
              "ghi_dhi_ratio", "temp_wind_interaction", "cloud_ghi_interaction"]
    for c in targets:
        names += [f"{c}_ema_{s}" for s in config.STATION_EMA_SPANS]
        names += [f"{c}_diff_1h", f"{c}_diff_24h"]
    return names + [f"om_{c}" for c in targets] + ["vedas_temperature", "vedas_solar_potential"]


def station_matrix(df: DataFrame, series: Series, provider: DataFrame | None = None,
                   outlook: DataFrame | None = None, *, drop_missing: bool = True,
                   gapless: bool = False,
                   lags: Sequence[int] = config.STATION_LAGS) -> DataFrame:
    """Station features: lags, inclusive rolling, calendar, interactions, EMA, differences and
    the two external sources."""
    targets, spans = config.STATION_TARGETS, config.STATION_EMA_SPANS
    sources = {f"om_{c}": provider for c in targets} | {c: outlook for c in ("vedas_temperature", "vedas_solar_potential")}
    # The sources meet the narrow rows; then all frames come from one Arrow pass over them, so no feature is ever shuffled.
    source = exact_external(df, provider, series, [c for c in sources if c.startswith("om_")])
    source = exact_external(source, outlook, series, [c for c in sources if c.startswith("vedas_")])
    windows, diffs = config.STATION_WINDOWS, {"1h": 4, "24h": 96}
    averages = [f"{c}_ema_{n}" for n in spans for c in targets]
    lookback = max(*lags, *diffs.values(), *windows.values(), EXTERNAL_ROWS)
    if gapless:
        lookback = max(lookback, ema_reach(spans))
    else:
        source = ema(source, series, targets, spans)
    made = [*[f"{c}_lag{k}" for k in lags for c in targets], *[f"{c}_{stat}_{label}" for label in windows for stat in ("rmean", "rstd") for c in targets],
            *[f"{c}_diff_{label}" for label in diffs for c in targets], *sources, *(averages if gapless else [])]
    width, known = len(targets), len(targets) + len(sources)

    def work(x: np.ndarray, null: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | bool]:
        own, gone_own = x[:, :width], null[:, :width]
        parts, gone = [shifted(own, place, k, 0.0) for k in lags], [shifted(gone_own, place, k, True) for k in lags]
        keep = ~np.concatenate(gone, 1).any(1) if drop_missing else True
        moments = inclusive_moments(own, gone_own, place, list(windows.values()))
        for n in windows.values():
            count, mean, apart = moments[n]
            parts += [mean, np.where(count > 1, np.sqrt(apart / np.maximum(count - 1, 1.0)), 0.0)]
            gone += [count == 0, np.zeros_like(gone_own)]
        for k in diffs.values():
            parts.append(own - shifted(own, place, k, 0.0))
            gone.append(gone_own | shifted(gone_own, place, k, True))
        parts.append(held_values(x[:, width:known], null[:, width:known], place, EXTERNAL_ROWS))
        gone.append(np.zeros_like(null[:, width:known]))
        if gapless:
            step = x[:, known] - shifted(x[:, known], place, 1, 0.0)
            for n in spans:
                parts.append(running_averages(own, step, place, n, _ema_passes(n)))
                gone.append(gone_own)
        values, missing = np.concatenate(parts, 1), np.concatenate(gone, 1)
        if drop_missing:  # of what a row with all lags still lacks
            values[missing | np.isnan(values)] = 0.0
        return values, missing, keep

    columns = [*targets, *sources, *(["__pos"] if gapless else [])]
    given = [c for c in source.columns if c not in sources]
    out = block_pass(source, series, columns, given, made, lookback, work, whole=drop_missing)
    out = out.select(*[c for c in out.columns if c not in sources], *calendar.station(series.time), *weather.station_interactions(), *sources)
    if drop_missing:
        rest = [c for c in out.columns if c not in (*series.keys, series.time, *targets, *made)]
        out = out.fillna(0, subset=rest)
    return out


def hourly_columns(horizon: bool = False) -> list[str]:
    aliases = config.HOURLY_TARGETS.values()
    names = [f"{a}_lag_{k}" for a in aliases for k in config.HOURLY_LAGS]
    names += [f"{a}_roll_{stat}_{n}" for a in aliases for n in config.HOURLY_WINDOWS
              for stat in ("mean", "std")]
    names += ["hour_sin", "hour_cos", "doy_sin", "doy_cos", "dow_sin", "dow_cos", "is_daytime"]
    if horizon:
        names += ["forecast_horizon", "forecast_horizon_sin", "forecast_horizon_cos"]
    return names


def hourly_matrix(df: DataFrame, series: Series, drop_missing: bool = True, *, groups: int | None = None,
                  lead: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Past-only lags and rolling statistics of the four hourly targets plus the calendar. ``groups`` and ``lead`` as in
    :func:`frames.block_pass`, with the columns ``group`` and ``model``, and those that ``carry`` names, last."""
    aliases = config.HOURLY_TARGETS
    out = past_frames(df, series, list(aliases), config.HOURLY_LAGS, config.HOURLY_WINDOWS, names=aliases, whole=drop_missing, groups=groups, lead=lead)
    more = [*carry, *(["group"] if groups is not None else []), *(["model"] if lead is not None else [])]
    out = out.select("*", *calendar.cyclic_hourly(series.time)).select(
        *series.keys, series.time, *hourly_columns(), *aliases, *more)
    if lead is not None and drop_missing:
        return out.where(F.col("model").isNotNull() | reduce(Column.__and__, [F.col(c).isNotNull() for c in aliases]))
    return out.dropna(how="any", subset=list(aliases)) if drop_missing else out


def horizon_cross(df: DataFrame, series: Series, columns: Sequence[str], horizon: int, *,
                  gap: int = 1, lookback: int = 0, build=None, prepare=None) -> DataFrame:
    """Every origin row times ``horizon`` 1..H with the values ``horizon - 1 + gap`` rows ahead.

    The rows ahead are gathered by one bounded frame and unfolded in place; there is no
    self-join. Origins near the end, with fewer rows ahead, give fewer rows. ``build`` adds
    columns at the origin.
    """
    def frames(w: WindowSpec) -> list[Column]:
        row = F.struct(F.col(series.time).alias("__target_time"),
                       *[F.col(c).alias(f"__ahead_{c}") for c in columns])
        ahead = F.collect_list(row).over(w.rowsBetween(gap, gap + horizon - 1))
        return [ahead.alias("__ahead"), *(build(w) if build else [])]

    out = in_blocks(df, series, frames, lookback=lookback, lookahead=horizon + gap, prepare=prepare)
    kept = [c for c in out.columns if c not in ("__ahead", *columns)]
    out = out.select(*kept, F.posexplode("__ahead").alias("__h", "__r"))
    return out.select(*kept, (F.col("__h") + 1).alias("horizon"),
                      F.col("__r.__target_time").alias("target_time"),
                      *[F.col(f"__r.__ahead_{c}").alias(c) for c in columns])


def direct_matrix(df: DataFrame, series: Series, *, horizon: int = 24,
                  max_days: int | None = None, gap: int = 1, serving: bool = False, since: Column | None = None) -> DataFrame:
    """Direct multi-horizon rows: features of the rows before the origin, targets ahead of it.

    Lags look ``k`` rows behind the origin and rolling windows end just before it. Training
    takes every origin with the longest lag behind it and ``horizon`` rows ahead, of the last
    ``max_days`` days of each key if that is given; ``serving``
    takes the first row of every day and the hours of that day, so nothing of the day itself is
    used; ``since`` then leaves out target times before it.
    """
    aliases = config.HOURLY_TARGETS
    if max_days is not None:
        df = training_lookback(df, series, max_days, per_key=True)
    far = max(config.HOURLY_LAGS)

    def build(w: WindowSpec) -> list[Column]:
        out = []
        for c, a in aliases.items():
            out += lag_columns([c], config.HOURLY_LAGS, w, a + "_lag_{k}")
        return out + [F.lag(F.lit(1), far).over(w).alias("__warm"),
                      F.lead(F.lit(1), horizon).over(w).alias("__ripe")]

    if serving:
        rows = _of_their_day(df, series, horizon, gap, since)
    else:
        rows = horizon_cross(df, series, list(aliases), horizon, gap=gap, lookback=far, build=build,
                             prepare=past_statistics(series.keys, list(aliases), config.HOURLY_WINDOWS, aliases, half_full=False))
        rows = rows.where(F.col("__warm").isNotNull() & F.col("__ripe").isNotNull())
    base = set(hourly_columns())
    return rows.select(
        *series.keys, series.time, "target_time", "horizon", *[c for c in rows.columns if c in base],
        *calendar.cyclic_hourly("target_time"), *calendar.horizon_waves("horizon", horizon), *aliases)


def _of_their_day(df: DataFrame, series: Series, horizon: int, gap: int, since: Column | None) -> DataFrame:
    """Rows as targets of the first row of their day, with the frames of that row.

    Only first rows come back from the frames, and a day has one, so the rows of a day find it by key and day. On a complete
    grid the rows that the frames of a day reach follow from its time, so no earlier ones are shuffled.
    """
    aliases, time = config.HOURLY_TARGETS, series.time
    lags, windows, far = config.HOURLY_LAGS, config.HOURLY_WINDOWS, max(*config.HOURLY_LAGS, *config.HOURLY_WINDOWS)
    begin = None if since is None else F.date_trunc("day", since)
    if begin is not None and series.complete:
        df = df.where(F.col(time) >= shift_time(begin, -far * series.step))
    dated = df.select(*series.keys, time, *aliases, F.unix_date(F.to_date(time)).cast("double").alias("__day"))
    day, before, warm = len(aliases), lags.index(1), lags.index(max(lags))

    def first(x: np.ndarray, values: np.ndarray, gone: np.ndarray) -> np.ndarray:
        return ~gone[:, before, day] & ~gone[:, warm, day] & (values[:, before, day] < x[:, day])

    origins = past_frames(dated, series, [*aliases, "__day"], lags, windows, names={**aliases, "__day": "__day"}, half_full=False,
                          carry=[*series.keys, time, "__day"], only=first)
    kinds = [c for c in hourly_columns() if c in origins.columns]
    within = Window.partitionBy(*series.keys, "__day").orderBy(time)
    place = (F.row_number().over(within) - F.lit(gap)).alias("horizon")
    if begin is not None:
        dated, origins = (rows.where(F.col(time) >= begin) for rows in (dated, origins))
    targets = dated.select(*series.keys, "__day", F.col(time).alias("target_time"), place, *aliases)
    targets = targets.where(F.col("horizon").between(1, horizon) & (F.lit(True) if since is None else F.col("target_time") >= since))
    return targets.join(origins.select(*series.keys, "__day", time, *kinds), [*series.keys, "__day"])


def training_lookback(df: DataFrame, series: Series, days: int, per_key: bool = False) -> DataFrame:
    """Rows of the last ``days`` days, counted from the newest row (of the key)."""
    keys = list(series.keys) if per_key else []
    newest = df.groupBy(*keys).agg(F.max(series.time).alias("__newest"))
    joined = df.join(newest, keys) if keys else df.crossJoin(F.broadcast(newest))
    return joined.where(F.col(series.time) >= shift_time("__newest", -days * 86400)).drop("__newest")


def incremental_rows(observations: DataFrame, store: DataFrame, series: Series,
                     warmup_steps: int) -> DataFrame:
    """Observations a feature run has to read: everything newer than the stored features plus
    the warm-up stretch before them. Adds ``__known``, the newest stored time."""
    known = store.groupBy(*series.keys).agg(F.max(series.time).alias("__known"))
    joined = observations.join(known, list(series.keys), "left")
    since = shift_time("__known", -warmup_steps * series.step)
    return joined.where(F.col("__known").isNull() | (F.col(series.time) >= since))
