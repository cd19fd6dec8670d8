"""Join and aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import (
    EV,
    FULL,
    HOURLY,
    QUARTER,
    STATION,
    TARGETS,
    Tables,
    base,
    query,
    sql,
    sql_forecast,
    sql_forecast_base,
    sql_grid,
    sql_obs,
    sql_obs2,
    sql_rounded,
    sql_station,
)
from registry.grids import TWO, ts
from skyloom import config
from skyloom.operators import aggregates, joins
from skyloom.operators.features import lag_features
from skyloom.sources import writers

_J = """j AS (SELECT coalesce(a.site, b.site) AS site, coalesce(a.time, b.time) AS time, {cols}
  FROM {a} a FULL JOIN {b} b ON a.site = b.site AND a.time = b.time)"""


@query(sql("SELECT * FROM j", *base(sql_obs(TWO), sql_obs2(["nasa_ghi", "nasa_dhi"]), _J.format(
    cols="temperature_2m, cloud_cover, nasa_ghi, nasa_dhi", a="obs", b="obs2")), doubles=[*TWO, "nasa_ghi", "nasa_dhi"]))
def merge_sources_outer(t: Tables):
    return joins.merge_outer(t.obs(TWO), t.obs2(["nasa_ghi", "nasa_dhi"]), ["site", "time"])


_ST = list(STATION)


def _lim(c: str, lo: float, hi: float) -> str:
    value = f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL OR epoch_us(time) - epoch_us(pt_{c}) > 8 * 3600000000
      THEN NULL WHEN nv_{c} IS NULL THEN pv_{c} ELSE pv_{c} + (nv_{c} - pv_{c}) *
      (CAST(epoch_us(time) - epoch_us(pt_{c}) AS DOUBLE) / CAST(epoch_us(nt_{c}) - epoch_us(pt_{c}) AS DOUBLE)) END"""
    return f"CASE WHEN ({value}) IS NOT NULL THEN greatest({lo}e0, least({hi}e0, {value})) END AS {c}"


@query(sql(f"""SELECT site, time, {', '.join(f'coalesce({c}, (median({c}) OVER (PARTITION BY site))) AS {c}' for c in _ST)}
  FROM (SELECT site, time, {', '.join(_lim(c, *config.STATION_BOUNDS[c]) for c in _ST)} FROM hg_n)""",
           *base(sql_obs(TARGETS), sql_station("obs", "st"), sql_obs2(TARGETS), sql_station("obs2", "st2"),
                 """cut AS (SELECT * FROM st WHERE time < TIMESTAMP '2024-01-20 00:00:00'),
                 cut2 AS (SELECT * FROM st2 WHERE time < TIMESTAMP '2024-01-20 00:00:00')""",
                 _J.format(cols=", ".join(f"coalesce(a.{c}, b.{c}) AS {c}" for c in _ST), a="cut", b="cut2"),
                 f"""hist AS (SELECT * FROM j UNION ALL SELECT s.site, s.time, {', '.join(f's.{c}' for c in _ST)} FROM st s
                   LEFT JOIN (SELECT site, max(time) AS m FROM j GROUP BY site) x ON x.site = s.site
                   WHERE x.m IS NULL OR s.time > x.m)""",
                 sql_grid(_ST, "hist", "hg").split("hg AS (")[0].rstrip().rstrip(",")), doubles=_ST))
def merge_sources_coalesce(t: Tables):
    before = F.col("time") < ts("2024-01-20 00:00:00")
    return joins.merge_history(t.station().where(before), t.station(True).where(before), t.station(), HOURLY)


@query(sql(f"""SELECT g.site, g.time, {', '.join(f'''coalesce(last_value(e.{c} IGNORE NULLS) OVER (PARTITION BY g.site
  ORDER BY g.time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0) AS om_{c}''' for c in ('ghi', 'temperature'))}
  FROM grid g LEFT JOIN ext e ON e.site = g.site AND e.time = g.time""",
           *base(sql_obs(TWO), sql_grid(TWO), sql_obs2(TARGETS), sql_station("obs2", "ext")),
           doubles=["om_ghi", "om_temperature"]))
def left_join_external(t: Tables):
    external = t.station(True).select("site", "time", F.col("ghi").alias("om_ghi"),
                                      F.col("temperature").alias("om_temperature"))
    return joins.left_join_external(t.grid(TWO).select("site", "time"), external, FULL, ["om_ghi", "om_temperature"])


@query(sql("""SELECT event_id, coalesce(CASE WHEN nt IS NULL OR epoch_us(ts) - epoch_us(pt) <= epoch_us(nt) - epoch_us(ts)
  THEN pv ELSE nv END, 0) AS temperature_2m FROM (SELECT e.event_id, e.ts, p.time AS pt, p.temperature_2m AS pv,
    n.time AS nt, n.temperature_2m AS nv FROM ev e ASOF LEFT JOIN obs p ON p.site = e.site AND e.ts >= p.time
    ASOF LEFT JOIN obs n ON n.site = e.site AND e.ts <= n.time)""",
           *base(sql_obs(["temperature_2m"])), doubles=["temperature_2m"]))
def nearest_asof_join(t: Tables):
    moments = t.events().select("site", F.col("ts").alias("time"), "event_id")
    return joins.nearest_asof(moments, t.obs(["temperature_2m"]), HOURLY, ["temperature_2m"]).select(
        "event_id", "temperature_2m")


_LATEST = """SELECT f.issue_time, f.forecast_time, f.lat, f.lon, f.temperature_2m FROM {src} f JOIN (SELECT lat, lon,
  max(issue_time) AS m FROM {src} GROUP BY lat, lon) x ON x.lat = f.lat AND x.lon = f.lon AND x.m = f.issue_time"""


@query(sql(_LATEST.format(src="fc"), sql_forecast_base(TWO), sql_forecast("provider", TWO),
           doubles=["lat", "lon", "temperature_2m"]))
def latest_issue_join(t: Tables):
    rows = joins.latest_issue(t.forecast("provider", TWO))
    return rows.select("issue_time", "forecast_time", "lat", "lon", "temperature_2m")


@query(sql("""SELECT issue_time, forecast_time, lat, lon, temperature_2m FROM fc
  WHERE issue_time = (SELECT max(issue_time) FROM fc)""", sql_forecast_base(TWO), sql_forecast("provider", TWO),
           doubles=["lat", "lon", "temperature_2m"]))
def scalar_subquery_latest(t: Tables):
    rows = joins.latest_overall(t.forecast("provider", TWO), "issue_time")
    return rows.select("issue_time", "forecast_time", "lat", "lon", "temperature_2m")


@query(sql("""SELECT site, time, temperature_2m, s.value AS now_value, s.event_type AS now_type FROM obs,
  (SELECT value, event_type FROM events ORDER BY ts DESC LIMIT 1) s""", *base(sql_obs(["temperature_2m"])),
           doubles=["temperature_2m", "now_value"]))
def attach_scalar_row(t: Tables):
    snapshot = t.events().select("ts", F.col("value").alias("now_value"), F.col("event_type").alias("now_type"))
    return joins.attach_snapshot(t.obs(["temperature_2m"]), snapshot, "ts")


@query(sql("""SELECT f.site, f.time, f.temperature_2m_lag_1, f.cloud_cover_lag_1, o.temperature_2m, o.cloud_cover FROM (
  SELECT site, time, lag(temperature_2m) OVER (PARTITION BY site ORDER BY time) AS temperature_2m_lag_1,
    lag(cloud_cover) OVER (PARTITION BY site ORDER BY time) AS cloud_cover_lag_1 FROM grid) f
  LEFT JOIN obs o ON o.site = f.site AND o.time = f.time""", *base(sql_obs(TWO), sql_grid(TWO)),
           doubles=[*TWO, "temperature_2m_lag_1", "cloud_cover_lag_1"]))
def targets_join(t: Tables):
    """Features of every grid step with the targets that were observed; steps without an observation keep NULL targets."""
    features = lag_features(t.grid(TWO), FULL, TWO, (1,)).drop(*TWO)
    return joins.join_targets(features, t.obs(TWO), FULL, TWO)


_SUP = """sta AS (SELECT s_suppkey AS station_id, CAST(6 + (s_suppkey * 37 % 1240) / 40e0 AS DOUBLE) AS lat,
  CAST(68 + (s_suppkey * 53 % 1200) / 40e0 AS DOUBLE) AS lon FROM supplier),
sites AS (SELECT DISTINCT site AS site_id, lat, lon FROM ev)"""
_KM = """2 * 6371e0 * asin(sqrt(least(1, pow(sin(radians(b.lat - a.lat) / 2), 2)
  + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))))"""


@query(sql(f"""SELECT site_id, station_id, km FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY km, station_id)
  AS rn FROM (SELECT a.site_id, b.station_id, {_KM} AS km FROM sites a CROSS JOIN sta b)) WHERE rn = 1""",
           EV, _SUP, doubles=["km"]))
def nearest_station(t: Tables):
    key = F.col("s_suppkey")
    stations = t.raw("supplier").select(key.alias("station_id"), (F.lit(6.0) + (key * 37 % 1240) / F.lit(40.0)).alias("lat"),
                                        (F.lit(68.0) + (key * 53 % 1200) / F.lit(40.0)).alias("lon"))
    sites = t.events().select(F.col("site").alias("site_id"), "lat", "lon").distinct()
    return joins.nearest_station(sites, stations).select("site_id", "station_id", "km")


_FVA = ["temperature_2m", "cloud_cover"]


@query(sql("""SELECT time, temperature_2m, cloud_cover, 'ml_model' AS source FROM ml UNION ALL
  SELECT time, temperature_2m, cloud_cover, 'openmeteo_reference' FROM obs2 WHERE time BETWEEN
  (SELECT min(time) FROM ml) AND (SELECT max(time) FROM ml)""", *base(
    sql_obs(_FVA), sql_obs2(_FVA), "ml AS (SELECT * FROM obs WHERE time >= TIMESTAMP '2024-01-27 00:00:00')"), doubles=_FVA))
def forecast_vs_actual(t: Tables):
    ml = t.obs(_FVA).where(F.col("time") >= ts("2024-01-27 00:00:00"))
    return joins.forecast_vs_actual(ml, t.obs2(_FVA), "time", _FVA).orderBy("time", "source")


@query(sql("""SELECT site, time, temperature_2m FROM obs WHERE time < TIMESTAMP '2024-01-15 00:00:00' UNION ALL
  SELECT site, time, temperature_2m FROM obs2 WHERE time > (SELECT max(time) FROM obs
    WHERE time < TIMESTAMP '2024-01-15 00:00:00')""", *base(sql_obs(["temperature_2m"]), sql_obs2(["temperature_2m"])),
           doubles=["temperature_2m"]))
def append_newer(t: Tables):
    first = t.obs(["temperature_2m"]).where(F.col("time") < ts("2024-01-15 00:00:00"))
    return joins.append_newer(first, t.obs2(["temperature_2m"]), "time")


@query(sql("SELECT * FROM obs UNION ALL SELECT * FROM obs2", *base(sql_obs(TWO), sql_obs2(TWO)), doubles=TWO))
def union_chunks(t: Tables):
    return t.obs(TWO).unionByName(t.obs2(TWO))


# ---- aggregates ----------------------------------------------------------

_BUCKETS = """b AS (SELECT event_type AS source, time_bucket(INTERVAL 15 MINUTE, ts) AS time, avg(value) AS value
  FROM events GROUP BY 1, 2)"""


@query(sql("""SELECT g.source, g.time, b.value FROM (SELECT source, unnest(generate_series(min(time), max(time),
  INTERVAL 15 MINUTE)) AS time FROM b GROUP BY source) g LEFT JOIN b ON b.source = g.source AND b.time = g.time""",
           _BUCKETS, doubles=["value"]))
def resample_mean(t: Tables):
    return aggregates.resample_mean(t.quarter(), QUARTER, ["value"])


@query(sql("SELECT source, time + INTERVAL 15 MINUTE AS time, value FROM b", _BUCKETS, doubles=["value"]))
def bucket_mean_by_tag(t: Tables):
    return aggregates.bucket_mean(t.quarter(), QUARTER, ["value"], label="end")


@query(sql("""SELECT lat, lon, time_bucket(INTERVAL 15 MINUTE, max(ts)) AS latest_value FROM ev GROUP BY lat, lon""", EV,
           doubles=["lat", "lon"]))
def latest_value(t: Tables):
    return aggregates.latest_value(t.events(), "ts", ["lat", "lon"], step=900)


@query(sql("SELECT lat, lon, count(*) AS row_count, max(ts) AS last_updated FROM ev GROUP BY lat, lon", EV,
           doubles=["lat", "lon"]))
def location_summary(t: Tables):
    return aggregates.location_summary(t.events(), "lat", "lon", "ts")


@query(sql("SELECT DISTINCT lat, lon FROM ev", EV, doubles=["lat", "lon"]))
def active_locations(t: Tables):
    return aggregates.active_locations(t.events(), "lat", "lon")


_LONG = """lp AS (SELECT date_trunc('day', ts) AS issue_time, date_trunc('hour', ts) AS forecast_time,
  'v' || user_id % 3 AS model_version, CASE event_type WHEN 'click' THEN 'temperature_2m' WHEN 'view' THEN 'cloud_cover'
  WHEN 'purchase' THEN 'wind_speed_10m' WHEN 'error' THEN 'shortwave_radiation' ELSE 'diffuse_radiation' END AS target,
  value AS predicted_value FROM events)"""


def long_predictions(t: Tables):
    target = F.create_map(*[F.lit(x) for pair in zip(("click", "view", "purchase", "error", "signup"), TARGETS)
                            for x in pair])[F.col("event_type")]
    return t.raw("events").select(
        F.date_trunc("day", "ts").alias("issue_time"), F.date_trunc("hour", "ts").alias("forecast_time"),
        F.concat(F.lit("v"), F.col("user_id") % 3).alias("model_version"), target.alias("target"),
        F.col("value").alias("predicted_value"))


@query(sql(f"""SELECT issue_time, forecast_time, model_version, 28.6139e0 AS lat, 77.209e0 AS lon, 'ml' AS forecast_type, 'boosted' AS source,
  {', '.join(f"max(CASE WHEN target = '{c}' THEN predicted_value END) + CASE WHEN model_version = 'v0' THEN 1000 ELSE 0 END AS {c}" for c in TARGETS)}
  FROM lp GROUP BY 1, 2, 3""", _LONG, doubles=[*TARGETS, "lat", "lon"]))
def pivot_long_to_wide(t: Tables):
    """Long predictions inserted into a forecast table that holds one version already, with other values; done twice."""
    path, long = t.work("pivoted"), long_predictions(t)
    constants = {"lat": F.lit(28.6139), "lon": F.lit(77.209), "forecast_type": F.lit("ml"), "source": F.lit("boosted")}
    first = long.where("model_version = 'v0'").withColumn("predicted_value", F.col("predicted_value") + 1000)
    for part in (first, long, long):
        writers.insert_predictions(part, path, TARGETS, constants)
    return t.spark.read.parquet(path).drop("issue_date")


@query(sql("SELECT event_type AS \"column\", median(value) AS median FROM events GROUP BY 1", doubles=["median"]))
def exact_median(t: Tables):
    rows = t.raw("events")
    return aggregates.exact_median(rows, ["value"], ["event_type"]).select(F.col("event_type").alias("column"), "median")


@query(sql(f"SELECT site, time, {', '.join(f'coalesce({c}, (SELECT median({c}) FROM obs)) AS {c}' for c in TWO)} FROM obs",
           *base(sql_obs(TWO)), doubles=TWO))
def median_fill(t: Tables):
    return aggregates.median_fill(t.obs(TWO), TWO)


_PAIR = """pr AS (SELECT a.site, a.time, a.temperature_2m AS actual, b.temperature_2m AS predicted FROM obs a
  JOIN obs2 b ON a.site = b.site AND a.time = b.time WHERE a.temperature_2m IS NOT NULL AND b.temperature_2m IS NOT NULL)"""


def pairs(t: Tables):
    second = t.obs2(["temperature_2m"]).withColumnRenamed("temperature_2m", "predicted")
    return t.obs(["temperature_2m"]).withColumnRenamed("temperature_2m", "actual").join(second, ["site", "time"])


@query(sql("""SELECT site, count(*) AS n, avg(abs(actual - predicted)) AS mae, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
  CASE WHEN var_pop(actual) > 0 THEN 1 - sum(pow(actual - predicted, 2)) / (var_pop(actual) * count(*)) END AS r2
  FROM pr GROUP BY site""", *base(sql_obs(["temperature_2m"]), sql_obs2(["temperature_2m"]), _PAIR),
           doubles=["mae", "rmse", "r2"]))
def error_metrics(t: Tables):
    return aggregates.error_metrics(pairs(t), "actual", "predicted", ["site"])


@query(sql("""SELECT site, 100 * avg(CASE WHEN actual <> 0 THEN abs(actual - predicted) / abs(actual) END) AS mape
  FROM pr GROUP BY site""", *base(sql_obs(["temperature_2m"]), sql_obs2(["temperature_2m"]), _PAIR), doubles=["mape"]))
def mape(t: Tables):
    both = pairs(t).where("actual IS NOT NULL AND predicted IS NOT NULL")
    return aggregates.mape(both, "actual", "predicted", ["site"])


_Q = " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
  100e0 * (count(*) - count({c})) / count(*) AS null_percentage, 100e0 * (count(*) - count({c})) / count(*) > 5 AS high_null,
  count(*) AS total_rows, CAST(2 AS BIGINT) AS total_columns, min(time) AS min_time, max(time) AS max_time,
  CAST((SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM obs GROUP BY {', '.join(TWO)})) AS BIGINT) AS duplicated_rows,
  'nasa_ghi' AS missing_columns FROM obs""" for c in TWO)


@query(sql(_Q, *base(sql_obs(TWO)), doubles=["null_percentage"]))
def quality_report(t: Tables):
    return aggregates.quality_report(t.obs(TWO).drop("site"), "time", [*TWO, "nasa_ghi"])


_CORR = " UNION ALL ".join(f"""SELECT '{y}' AS target, '{x}' AS feature, corr({x}, {y}) AS r,
  coalesce(abs(corr({x}, {y})) > 0.99e0, FALSE) AS suspicious FROM obs""" for y in ("temperature_2m", "cloud_cover")
    for x in ("temperature_2m", "pressure_msl", "cloud_cover_low", "relative_humidity_2m"))


@query(sql(_CORR, *base(sql_obs()), doubles=["r"]))
def correlation_screen(t: Tables):
    return aggregates.correlations(t.obs(), ["temperature_2m", "pressure_msl", "cloud_cover_low", "relative_humidity_2m"],
                                   ["temperature_2m", "cloud_cover"])


_DESC = " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS count, {sql_rounded(f'avg({c})', 2)} AS mean,
  {sql_rounded(f'stddev_samp({c})', 2)} AS std, {sql_rounded(f'min({c})', 2)} AS min,
  {sql_rounded(f'quantile_cont({c}, 0.25)', 2)} AS p25, {sql_rounded(f'quantile_cont({c}, 0.5)', 2)} AS p50,
  {sql_rounded(f'quantile_cont({c}, 0.75)', 2)} AS p75, {sql_rounded(f'max({c})', 2)} AS max FROM obs""" for c in TWO)


@query(sql(_DESC, *base(sql_obs(TWO))))
def describe(t: Tables):
    return aggregates.describe(t.obs(TWO), TWO)


@query(sql("""SELECT c.c_custkey, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS has_rows
  FROM customer c"""))
def has_rows(t: Tables):
    orders = t.raw("orders").withColumnRenamed("o_custkey", "c_custkey")
    return aggregates.has_rows(orders, t.raw("customer"), ["c_custkey"])

