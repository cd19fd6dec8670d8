"""Streaming queries. Inputs are written as files in time order and read back as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import HOURLY, QUARTER, Tables, base, query, sql, sql_obs, sql_obs2
from registry.grids import TWO, ts
from registry.sources import hourly_payloads
from skyloom.operators.series import Series
from skyloom.sources import payloads
from skyloom.streaming import jobs

MEASURE = ["temperature_2m"]
CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def folder_in_order(t: Tables, df, time: str = "time") -> str:
    """The table as files of three successive stretches of time."""
    path, moment = t.work("stream-input"), F.col(time)
    stretches = (moment < ts(CUTS[0]), (moment >= ts(CUTS[0])) & (moment < ts(CUTS[1])), moment >= ts(CUTS[1]))
    for stretch in stretches:
        df.where(stretch).write.mode("append").parquet(path)
    return path


def stream(t: Tables, df, time: str = "time"):
    """The same rows as a stream in at least three batches."""
    path = folder_in_order(t, df, time)
    files = t.spark.read.parquet(path).inputFiles()
    return jobs.read_folder(t.spark, path, df.schema, max(1, len(files) // 3))


def finished(started) -> None:
    started.awaitTermination()
    if started.exception() is not None:
        raise started.exception()


@query(sql("SELECT site, time, temperature_2m, cloud_cover FROM obs", *base(sql_obs(TWO)), doubles=TWO))
def stream_land_parse(t: Tables):
    raw, parsed = t.work("raw"), t.work("parsed")
    source = stream(t, hourly_payloads(t.obs(TWO)).withColumn("day", F.col("day").cast("timestamp")), "day")
    finished(jobs.land_and_parse(source, lambda b: payloads.parse_hourly_arrays(b, TWO), raw, parsed, t.work("ckpt")))
    return t.spark.read.parquet(parsed).select("site", "time", *TWO)


@query(sql("""SELECT coalesce(b.site, o.site) AS site, coalesce(b.time, o.time) AS time,
  CASE WHEN b.site IS NOT NULL THEN b.temperature_2m ELSE o.temperature_2m END AS temperature_2m
  FROM obs o FULL JOIN obs2 b ON o.site = b.site AND o.time = b.time""", *base(sql_obs(MEASURE), sql_obs2(MEASURE)),
           doubles=MEASURE))
def stream_upsert(t: Tables):
    """First one provider, then the other over the same keys."""
    path = t.work("upserted")
    for rows in (t.obs(MEASURE), t.obs2(MEASURE)):
        finished(jobs.upsert_stream(stream(t, rows), path, ["site", "time"], t.work("ckpt")))
    return t.spark.read.parquet(path).select("site", "time", *MEASURE)


@query(sql("""SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS time, avg(value) AS value FROM events
  GROUP BY 1, 2""", doubles=["value"]))
def stream_tumbling_mean(t: Tables):
    path, rows = t.work("means"), t.quarter()
    means = jobs.tumbling_mean(stream(t, rows), QUARTER, ["value"], "1 hour")
    finished(jobs.write_updates(means, path, ["source", "time"], t.work("ckpt")))
    return jobs.read_current(t.spark, path, means.schema)


@query(sql("""SELECT source, time, avg(value) AS value_mean, stddev_samp(value) AS value_std FROM (
  SELECT event_type AS source, value, time_bucket(INTERVAL 15 MINUTE, ts) + to_minutes(CAST(15 * k AS INTEGER)) AS time
  FROM events, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY source, time""", doubles=["value_mean", "value_std"]))
def stream_sliding_stats(t: Tables):
    path, rows = t.work("sliding"), t.quarter()
    stats = jobs.sliding_stats(stream(t, rows), QUARTER, ["value"], "1 hour", "15 minutes", "2 hours")
    finished(jobs.write_updates(stats, path, ["source", "time"], t.work("ckpt")))
    return jobs.read_current(t.spark, path, stats.schema)


@query(sql("SELECT DISTINCT event_type AS source, date_trunc('hour', ts) AS time FROM events"))
def stream_dedupe(t: Tables):
    path = t.work("unique")
    rows = t.quarter().select("source", F.date_trunc("hour", "time").alias("time"))
    unique = jobs.unique_rows(stream(t, rows), Series(keys=("source",), step=3600), "2 days")
    finished(jobs.write_appends(unique, path, t.work("ckpt")))
    return jobs.read_batches(t.spark, path, unique.schema).drop("batch_id")


@query(sql("""SELECT o.site, o.time, o.temperature_2m, o.time < TIMESTAMP '2024-01-21 00:00:00' AND coalesce(EXISTS (SELECT 1 FROM obs l
  WHERE l.site = o.site AND l.time < TIMESTAMP '2024-01-21 00:00:00' AND CAST(l.time AS DATE) = CAST(o.time AS DATE)
  AND l.time < n.newest - INTERVAL 14 DAY), FALSE) AS repaired FROM obs o LEFT JOIN (SELECT site, max(time) AS newest FROM obs
  WHERE time >= TIMESTAMP '2024-01-21 00:00:00' GROUP BY site) n ON n.site = o.site""", *base(sql_obs(MEASURE)), doubles=MEASURE))
def late_data(t: Tables):
    """The newest stretch arrives first. Older rows still reach the table; those that the stream's state no longer covers
    name the days to be made again."""
    path, source, checkpoint, rows = t.work("late"), t.work("late-input"), t.work("ckpt"), t.obs(MEASURE)
    newest = F.col("time") >= ts(CUTS[1])
    for stretch in (newest, ~newest):
        rows.where(stretch).write.mode("append").parquet(source)
        arriving = jobs.read_folder(t.spark, source, rows.schema)
        finished(jobs.upsert_with_late(arriving, path, HOURLY, checkpoint))
    days = t.spark.read.parquet(f"{path}_repairs").select("site", F.col("day").alias("obs_date")).distinct().withColumn("repaired", F.lit(True))
    stored = t.spark.read.parquet(path).join(days, ["site", "obs_date"], "left")
    return stored.select("site", "time", *MEASURE, F.coalesce("repaired", F.lit(False)).alias("repaired"))


@query(sql("""SELECT site, time + INTERVAL 1 HOUR AS gap_start, following - INTERVAL 1 HOUR AS gap_end FROM (
  SELECT site, time, lead(time) OVER (PARTITION BY site ORDER BY time) AS following FROM obs)
  WHERE following > time + INTERVAL 1 HOUR""", *base(sql_obs(MEASURE))))
def stream_gap_alert(t: Tables):
    path = t.work("alerts")
    found = jobs.gap_alerts(stream(t, t.obs(MEASURE)), HOURLY, keep_days=40)
    finished(jobs.write_appends(found, path, t.work("ckpt")))
    return jobs.open_gaps(jobs.read_batches(t.spark, path, found.schema), ["site"])


@query(sql("""SELECT lat, lon, time + INTERVAL 1 HOUR AS gap_start, following - INTERVAL 1 HOUR AS gap_end FROM (
  SELECT lat, lon, time, lead(time) OVER (PARTITION BY lat, lon ORDER BY time) AS following FROM lobs)
  WHERE following > time + INTERVAL 1 HOUR""", *base(sql_obs(MEASURE, ("lat", "lon"), "lobs")), doubles=["lat", "lon"]))
def stream_gap_alert_by_place(t: Tables):
    """Keys of two columns that are not whole numbers."""
    path, series = t.work("alerts"), Series(keys=("lat", "lon"), step=3600)
    found = jobs.gap_alerts(stream(t, t.obs(MEASURE, keys=("lat", "lon"))), series, keep_days=40)
    finished(jobs.write_appends(found, path, t.work("ckpt")))
    return jobs.open_gaps(jobs.read_batches(t.spark, path, found.schema), ["lat", "lon"])
