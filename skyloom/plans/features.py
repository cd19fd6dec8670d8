"""Feature store and the small flagship query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions.scalar import shift_time
from skyloom.operators.aggregates import error_metrics
from skyloom.operators.features import (
    feature_matrix,
    incremental_rows,
    lag_columns,
    past_statistics,
)
from skyloom.operators.grid import complete_grid
from skyloom.operators.series import Series, in_blocks


def incremental_features(observations: DataFrame, store: DataFrame, series: Series, *,
                         measures: Sequence[str] = config.MEASURES,
                         targets: Sequence[str] = config.TARGETS,
                         lags: Sequence[int] = config.LAGS, windows: Sequence[int] = config.WINDOWS,
                         now: Column | None = None, cold_days: int | None = None) -> DataFrame:
    """Feature rows newer than the stored ones. A new key starts with its whole history, or, where both are given,
    ``cold_days`` back from ``now``.

    Only the warm-up stretch in front of the new rows is read again.
    """
    warmup = max([*lags, *windows]) + 16
    rows = incremental_rows(observations, store, series, warmup)
    if now is not None and cold_days is not None:
        known = F.col("__known").isNotNull()
        rows = rows.where(known | (F.col(series.time) >= shift_time(now, -cold_days * 86400)))
    matrix = feature_matrix(rows.drop("__known"), series, measures=measures, targets=targets, lags=lags,
                            windows=windows)
    newest = store.groupBy(*series.keys).agg(F.max(series.time).alias("__known"))
    fresh = matrix.join(newest, list(series.keys), "left")
    return fresh.where(F.col("__known").isNull() | (F.col(series.time) > F.col("__known"))).drop("__known")


def persistence_scores(observations: DataFrame, series: Series, columns: Sequence[str],
                       lags: Sequence[int] = (1, 2, 4), windows: Sequence[int] = (4,)) -> DataFrame:
    """Error of two naive forecasts per key and measure: the last value and the recent mean.

    observations -> complete interpolated grid -> lag and rolling features -> scores.
    """
    gridded = complete_grid(observations, series, columns)

    def build(w: WindowSpec) -> list[Column]:
        return lag_columns(columns, lags, w)

    rows = in_blocks(gridded, series.on_complete_grid(), build, lookback=max([*lags, *windows]),
                     prepare=past_statistics(series.keys, columns, windows))
    cells = F.explode(F.array(*[F.struct(
        F.lit(c).alias("metric"), F.col(c).alias("actual"), F.col(f"{c}_lag_{lags[0]}").alias("last_value"),
        F.col(f"{c}_roll_mean_{windows[0]}").alias("recent_mean")) for c in columns]))
    long = rows.select(*series.keys, cells.alias("__c")).select(*series.keys, "__c.*")
    ids = [*series.keys, "metric"]
    last = error_metrics(long, "actual", "last_value", ids)
    mean = error_metrics(long, "actual", "recent_mean", ids).select(
        *ids, F.col("mae").alias("mean_mae"), F.col("rmse").alias("mean_rmse"))
    return last.join(mean, ids, "left")
