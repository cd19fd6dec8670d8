"""Raw payload landing and the work list of what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import config

RAW_COLUMNS = ("source", "dataset_type", "lat", "lon", "requested_at", "interval_start",
               "interval_end", "payload")


def raw_snapshot(df: DataFrame, source: str, dataset_type: str, requested_at: Column | None = None) -> DataFrame:
    """Audit rows of raw payloads; ``df`` has lat, lon, interval_start, interval_end, payload."""
    moment = F.current_timestamp() if requested_at is None else requested_at
    return df.select(F.lit(source).alias("source"), F.lit(dataset_type).alias("dataset_type"), "lat",
                     "lon", moment.alias("requested_at"), "interval_start", "interval_end", "payload")


def land_raw_payload(df: DataFrame, path: str) -> None:
    """Append to the raw table, partitioned so that a replay reads one source only."""
    df.select(*RAW_COLUMNS).write.mode("append").partitionBy("source", "dataset_type").parquet(path)


def plan_year_chunks(ranges: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Calendar-year pieces of each range, clipped at both ends."""
    years = F.explode(F.sequence(F.year(start), F.year(end)))
    rest = [c for c in ranges.columns if c not in (start, end)]
    return (ranges.where(F.col(start) <= F.col(end)).select("*", years.alias("__y")).select(
        *rest, F.greatest(F.col(start), F.make_date("__y", F.lit(1), F.lit(1))).alias("chunk_start"),
        F.least(F.col(end), F.make_date("__y", F.lit(12), F.lit(31))).alias("chunk_end")))


def plan_day_chunks(ranges: DataFrame, days: int = 90, start: str = "start_date",
                    end: str = "end_date") -> DataFrame:
    """Pieces of ``days`` days; the last one ends with the range."""
    rest = [c for c in ranges.columns if c not in (start, end)]
    pieces = F.explode(F.sequence(F.lit(0), F.floor(F.date_diff(end, start) / days).cast("int")))
    first = F.date_add(start, F.col("__i") * days)
    return (ranges.where(F.col(start) <= F.col(end)).select("*", pieces.alias("__i")).select(
        *rest, first.alias("chunk_start"),
        F.least(F.col(end), F.date_add(first, days - 1)).alias("chunk_end")))


def missing_chunks(chunks: DataFrame, landed: DataFrame) -> DataFrame:
    """Chunks whose interval has no landed payload yet."""
    have = landed.select("lat", "lon", F.to_date("interval_start").alias("chunk_start"),
                         F.to_date("interval_end").alias("chunk_end")).distinct()
    return chunks.join(have, ["lat", "lon", "chunk_start", "chunk_end"], "left_anti")


def migrate_provider_forecast(old: DataFrame, lat: float, lon: float) -> DataFrame:
    """Rows of the location-less provider table in the shape of the forecast table."""
    return old.select(
        "issue_time", "forecast_time", F.lit(lat).alias("lat"), F.lit(lon).alias("lon"),
        F.lit("provider").alias("forecast_type"), "source", F.lit("").alias("model_version"),
        *[F.col(c).cast("double").alias(c) if c in old.columns else F.lit(None).cast("double").alias(c)
          for c in config.PROVIDER_MEASURES])


