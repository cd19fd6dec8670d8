"""Reads, projections and views over observation and forecast tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions.scalar import in_bounding_box, shift_time
from skyloom.operators.joins import latest_issue
from skyloom.operators.series import Series, with_position

# Names of the stored table.
STORED_PREDICTION = {
    "forecast_time": "timestamp",
    "lat": "latitude",
    "lon": "longitude",
    "temperature_2m": "predicted_temperature",
    "cloud_cover": "predicted_cloud_cover",
    "wind_speed_10m": "predicted_wind_speed",
    "shortwave_radiation": "predicted_ghi",
    "diffuse_radiation": "predicted_dhi",
    "issue_time": "issue_time",
    "model_version": "model_version",
}
# End of fixed values.


# ---- projections ---------------------------------------------------------

def conform(df: DataFrame, columns: Mapping[str, str] | Sequence[str],
            rename: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, pad missing columns with typed NULLs and order. A sequence means doubles."""
    types = columns if isinstance(columns, Mapping) else {c: "double" for c in columns}
    renamed = df.withColumnsRenamed(dict(rename or {}))
    return renamed.select(*[
        F.col(c).cast(t).alias(c) if c in renamed.columns else F.lit(None).cast(t).alias(c)
        for c, t in types.items()])


def prepare_observations(df: DataFrame, lat: float | Column, lon: float | Column,
                         time: str = "time") -> DataFrame:
    lat, lon = (F.lit(x) if isinstance(x, float) else x for x in (lat, lon))
    rest = [c for c in df.columns if c not in (time, "lat", "lon")]
    return df.select(F.col(time).alias("time"), lat.alias("lat"), lon.alias("lon"), *rest)


def prepare_forecast(df: DataFrame, issue_time: Column, forecast_type: str, source: str,
                     model_version: str = "", time: str = "time") -> DataFrame:
    head = ("issue_time", "lat", "lon", "forecast_type", "source", "model_version", time)
    rest = [c for c in df.columns if c not in head]
    return df.select(issue_time.alias("issue_time"), F.col(time).alias("forecast_time"), "lat", "lon",
                     F.lit(forecast_type).alias("forecast_type"), F.lit(source).alias("source"),
                     F.lit(model_version).alias("model_version"), *rest)


def split_actual_forecast(df: DataFrame, issue: Column, time: str = "time") -> tuple[DataFrame, DataFrame]:
    """(actual, forecast): at or before the issue, and after it."""
    return df.where(F.col(time) <= issue), df.where(F.col(time) > issue)


def split_by_bounding_box(df: DataFrame, lat: str = "lat", lon: str = "lon") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); a NULL coordinate is rejected."""
    ok = in_bounding_box(lat, lon)
    return df.where(ok), df.where(~ok)


def simplify_prediction(df: DataFrame, names: Mapping[str, str] = STORED_PREDICTION) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


# ---- reads ---------------------------------------------------------------

def read_observations(df: DataFrame, measures: Sequence[str], *, lat: float | None = None,
                      lon: float | None = None, start: Column | None = None,
                      newest: int | None = None) -> DataFrame:
    """Pruned read of one location (or all), optionally its newest rows, in ascending order.

    When the table is partitioned by ``obs_date`` the start also prunes partitions.
    """
    out = df
    if lat is not None:
        out = out.where((F.col("lat") == lat) & (F.col("lon") == lon))
    if start is not None:
        out = out.where(F.col("time") >= start)
        if "obs_date" in df.columns:
            out = out.where(F.col("obs_date") >= F.to_date(start))
    out = out.select("time", "lat", "lon", *measures)
    if newest is not None:
        out = out.orderBy(F.desc("time")).limit(newest)
    return out.orderBy("time")


def newest_rows_per_key(df: DataFrame, series: Series, n: int) -> DataFrame:
    """The newest ``n`` rows of every key.

    Each time piece ranks its own rows and knows from the piece counts how many newer rows follow
    it, so no task ranks a whole series.
    """
    placed = with_position(df, Series(series.keys, series.time, series.step, series.chunk))
    sizes = placed.groupBy(*series.keys).agg(F.max("__pos").alias("__last"))
    return (placed.join(sizes, list(series.keys)).where(F.col("__pos") > F.col("__last") - n)
            .drop("__pos", "__last"))


# ---- long views ----------------------------------------------------------

def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str] = config.TARGETS) -> DataFrame:
    """Wide to (ids, metric, value); NULL values stay."""
    return df.select(*ids, *metrics).unpivot(list(ids), list(metrics), "metric", "value")


def latest_forecast_long(forecast: DataFrame, forecast_type: str) -> DataFrame:
    """Newest snapshot per location in long form, with its source or model version.

    One scan and one unfold take the place of one self-joined branch per metric.
    """
    extra = "source" if forecast_type == "provider" else "model_version"
    rows = latest_issue(forecast.where(F.col("forecast_type") == forecast_type))
    rows = rows.withColumnRenamed("forecast_time", "time")
    return unpivot_metrics(rows, ["time", "lat", "lon", "issue_time", extra]).select(
        "time", "lat", "lon", "metric", "value", "issue_time", extra)


def metric_range(long: DataFrame, metric: str, as_of: Column, days: int = 7, time: str = "time") -> DataFrame:
    since = shift_time(as_of, -days * 86400)
    return long.where((F.col("metric") == metric) & F.col(time).between(since, as_of)).orderBy(time)


def recent_points(points: DataFrame, as_of: Column, days: int = 3,
                  fields: Sequence[str] = ("predicted_value",), **tags: str) -> DataFrame:
    """Recent points with the given tags, fields side by side, by time."""
    rows = points.where(F.col("time") >= shift_time(as_of, -days * 86400))
    for tag, value in tags.items():
        rows = rows.where(F.col(tag) == value)
    ids = [c for c in points.columns if c not in ("field", "value")]
    return rows.groupBy(*ids).pivot("field", list(fields)).agg(F.max("value")).orderBy("time")


# ---- top-k ---------------------------------------------------------------

def stored_predictions(forecast: DataFrame, limit: int = 288, *, lat: float | None = None,
                       lon: float | None = None, scope: str = "global") -> DataFrame:
    """Latest ML snapshot, ordered by forecast time, at most ``limit`` rows.

    Without a location the newest issue is the global one (``scope='per_location'`` takes the
    newest of every location).
    """
    if not 1 <= limit <= 2880:
        raise ValueError("limit must be between 1 and 2880")
    rows = forecast.where(F.col("forecast_type") == "ml")
    if lat is not None:
        rows = rows.where((F.col("lat") == lat) & (F.col("lon") == lon))
    if scope == "global":
        newest = rows.agg(F.max("issue_time").alias("__issue"))
        rows = rows.join(F.broadcast(newest), F.col("issue_time") == F.col("__issue")).drop("__issue")
    else:
        rows = latest_issue(rows)
    order = ("timestamp", "latitude", "longitude", "model_version")
    return simplify_prediction(rows).orderBy(*order).limit(limit)


def latest_batch(df: DataFrame, created: str, model_version: str, time: str) -> DataFrame:
    """Rows of the newest write of one model version."""
    mine = df.where(F.col("model_version") == model_version)
    newest = mine.agg(F.max(created).alias("__created"))
    return (mine.join(F.broadcast(newest), F.col(created) == F.col("__created"))
            .drop("__created").orderBy(time))


def top_features(importances: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` most important features per target. A target has as many rows as features."""
    order = Window.partitionBy("target").orderBy(F.desc("importance"), "feature")
    return (importances.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= n))


def order_output(df: DataFrame, time: str, source: str = "source") -> DataFrame:
    return df.orderBy(time, source)


