"""Upsert, sink, projection, view and top-k queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import (
    EV,
    HOURLY,
    TARGETS,
    Tables,
    base,
    query,
    sql,
    sql_forecast,
    sql_forecast_base,
    sql_forecasts,
    sql_near,
    sql_obs,
    sql_obs2,
)
from registry.grids import TWO, ts
from registry.joins import long_predictions
from skyloom.functions import scalar
from skyloom.operators import features as feats
from skyloom.operators import tables as views
from skyloom.sources import upserts, writers

# ---- upserts -------------------------------------------------------------

_BATCH = """bat AS (SELECT site, time, temperature_2m, seq FROM (SELECT *, row_number() OVER (PARTITION BY site, time
  ORDER BY seq DESC) AS rn FROM (SELECT site, time, temperature_2m, 1 AS seq FROM obs2 UNION ALL
  SELECT site, time, temperature_2m + 1, 2 FROM obs2)) WHERE rn = 1)"""
_UP = base(sql_obs(TWO), sql_obs2(TWO), _BATCH)
_FULL = """SELECT coalesce(o.site, b.site) AS site, coalesce(o.time, b.time) AS time, {t} AS temperature_2m,
  {c} AS cloud_cover FROM obs o FULL JOIN bat b ON o.site = b.site AND o.time = b.time"""


def batch(t: Tables):
    """Two arrivals per key, without cloud cover."""
    one = t.obs2(["temperature_2m"])
    again = one.withColumn("temperature_2m", F.col("temperature_2m") + 1)
    return one.withColumn("seq", F.lit(1)).unionByName(again.withColumn("seq", F.lit(2)))


@query(sql(_FULL.format(t="CASE WHEN b.site IS NOT NULL THEN b.temperature_2m ELSE o.temperature_2m END",
                        c="CASE WHEN b.site IS NULL THEN o.cloud_cover END"), *_UP, doubles=TWO))
def upsert_replace(t: Tables):
    return upserts.upsert_replace(t.obs(TWO), batch(t), ["site", "time"], order="seq")


@query(sql(_FULL.format(t="CASE WHEN b.site IS NOT NULL THEN b.temperature_2m ELSE o.temperature_2m END",
                        c="o.cloud_cover"), *_UP, doubles=TWO))
def upsert_columns(t: Tables):
    return upserts.upsert_columns(t.obs(TWO), batch(t), ["site", "time"], order="seq")


@query(sql("""SELECT site, time, temperature_2m, cloud_cover FROM obs UNION ALL SELECT b.site, b.time,
  b.temperature_2m - 1, NULL FROM bat b ANTI JOIN obs o ON o.site = b.site AND o.time = b.time""", *_UP, doubles=TWO))
def insert_if_absent(t: Tables):
    return upserts.insert_if_absent(t.obs(TWO), batch(t), ["site", "time"], order="seq")


@query(sql(_FULL.format(t="CASE WHEN b.site IS NOT NULL THEN b.temperature_2m ELSE o.temperature_2m END",
                        c="o.cloud_cover"), *_UP, doubles=TWO))
def merge_into_table(t: Tables):
    """The stored form of upsert_columns; the batch is merged twice to the same effect."""
    path, keys = t.work("merged"), ["site", "time"]
    writers.merge_into(t.obs(TWO), path, keys, partition_of=F.to_date("time"))
    for _ in range(2):
        writers.merge_into(batch(t), path, keys, partition_of=F.to_date("time"), order="seq")
    return t.spark.read.parquet(path).select("site", "time", *TWO)


@query(sql("SELECT * FROM obs2", *base(sql_obs2(TWO)), doubles=TWO))
def replace_all(t: Tables):
    path = t.work("replaced")
    writers.replace_all(t.obs(TWO), path)
    writers.replace_all(t.obs2(TWO), path)
    return t.spark.read.parquet(path)


_POINTS = " UNION ALL ".join(f"""SELECT time, CASE WHEN lat < 6 THEN 28.6139e0 ELSE lat END AS lat, '{c}' AS field, {c} AS value
  FROM lobs WHERE {c} IS NOT NULL""" for c in TWO)


@query(sql(_POINTS, sql_forecast_base(TWO), doubles=["lat", "value"]))
def append_long_points(t: Tables):
    path = t.work("points")
    obs = t.obs(TWO, keys=("lat", "lon")).withColumn("lat", F.when(F.col("lat") >= 6, F.col("lat")))
    writers.append_points(writers.to_points(obs, "time", TWO, ["lat"], {"lat": 28.6139}), path)
    return t.spark.read.parquet(path).drop("obs_date")


@query(sql("SELECT site, time, temperature_2m FROM obs", *base(sql_obs(TWO)), doubles=["temperature_2m"]))
def export_csv(t: Tables):
    path = t.work("export")
    writers.export_csv(t.obs(["temperature_2m"]), path, ["site", "time"])
    return t.spark.read.csv(path, header=True, schema="site bigint, time timestamp, temperature_2m double")


@query(sql("""SELECT coalesce(b.site, o.site) AS site, coalesce(b.time, o.time) AS time,
  CASE WHEN b.site IS NOT NULL THEN b.temperature_2m ELSE o.temperature_2m END AS temperature_2m
  FROM obs o FULL JOIN obs2 b ON o.site = b.site AND o.time = b.time""", *base(sql_obs(TWO), sql_obs2(TWO)),
           doubles=["temperature_2m"]))
def import_csv_upsert(t: Tables):
    source, path, keys = t.work("import-csv"), t.work("imported"), ["site", "time"]
    text = t.obs2(["temperature_2m"]).withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    writers.export_csv(text, source, keys)
    writers.merge_into(t.obs(["temperature_2m"]), path, keys, partition_of=F.to_date("time"))
    writers.import_csv_upsert(t.spark, source, path, "site bigint, time string, temperature_2m double", keys)
    return t.spark.read.parquet(path).drop("obs_date")


@query(sql("""SELECT site, time, 'v1' AS feature_set_version, lag(temperature_2m) OVER (PARTITION BY site ORDER BY time) AS lag_1,
  temperature_2m AS target FROM obs""", *base(sql_obs(["temperature_2m"])), doubles=["lag_1", "target"]))
def feature_store_write(t: Tables):
    path = t.work("features")
    matrix = feats.lag_features(t.obs(["temperature_2m"]), HOURLY, ["temperature_2m"], (1,))
    rows = writers.feature_store_rows(matrix, ["temperature_2m_lag_1"], ["temperature_2m"], "v1", ("site", "time"))
    writers.merge_into(rows, path, ["time", "site", "feature_set_version"], mode="replace",
                       partition_of=F.to_date("time"))
    return t.spark.read.parquet(path).select(
        "site", "time", "feature_set_version", F.col("features")["temperature_2m_lag_1"].alias("lag_1"),
        F.col("targets")["temperature_2m"].alias("target"))


_RUNS = """runs AS (SELECT strftime(o_orderdate, '%Y%m%d') AS model_version, o_orderpriority AS target,
  CAST(6 + c_nationkey AS DOUBLE) AS lat, CAST(70 + c_nationkey AS DOUBLE) AS lon,
  o_orderdate + to_seconds(o_orderkey) AS trained_at, o_totalprice AS mae FROM orders JOIN customer ON c_custkey = o_custkey)"""


def training_runs(t: Tables):
    rows = t.raw("orders").join(t.raw("customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("model_version"), F.col("o_orderpriority").alias("target"),
        (F.lit(6.0) + F.col("c_nationkey")).alias("lat"), (F.lit(70.0) + F.col("c_nationkey")).alias("lon"),
        scalar.shift_time("o_orderdate", F.col("o_orderkey")).alias("trained_at"),
        F.struct(F.col("o_totalprice").alias("mae")).alias("metrics"))


def stored_runs(t: Tables) -> tuple[str, str]:
    """Runs up to 1998, then all of them, then the later ones again."""
    registry, history, runs = t.work("registry"), t.work("run-history"), training_runs(t)
    for part in (F.col("trained_at") < ts("1998-01-01 00:00:00"), F.lit(True), F.col("trained_at") >= ts("1998-01-01 00:00:00")):
        writers.write_runs(runs.where(part), registry, history, "boosted", "v1", scalar.location_token("lat", "lon"))
    return registry, history


@query(sql("""SELECT model_name, model_version, lat, lon, trained_at, mae FROM (SELECT *, 'boosted_' || target ||
  replace(printf('_lat_%.4f_lon_%.4f', lat, lon), '.', '_') AS model_name, row_number() OVER (
    PARTITION BY target, lat, lon ORDER BY trained_at DESC) AS rn FROM runs) WHERE rn = 1""", _RUNS,
           doubles=["lat", "lon", "mae"]))
def registry_write(t: Tables):
    """The registry read back after three merges."""
    rows = t.spark.read.parquet(stored_runs(t)[0])
    return rows.select("model_name", "model_version", "lat", "lon", "trained_at", F.col("metrics.mae").alias("mae"))


@query(sql("""SELECT model_version, target, lat, lon, trained_at, mae FROM (SELECT *, row_number() OVER (
    PARTITION BY model_version, target, lat, lon ORDER BY trained_at DESC) AS rn FROM runs) WHERE rn = 1""", _RUNS,
           doubles=["lat", "lon", "mae"]))
def run_history(t: Tables):
    """The history of runs read back after three merges."""
    rows = t.spark.read.parquet(stored_runs(t)[1])
    return rows.select("model_version", "target", "lat", "lon", "trained_at", F.col("metrics.mae").alias("mae"))


@query(sql("""SELECT time, coalesce(CASE WHEN lat >= 6 THEN lat END, 28.6139e0) AS lat,
  coalesce(CASE WHEN lat >= 6 THEN lon END, 77.209e0) AS lon, temperature_2m FROM lobs""", sql_forecast_base(TWO),
           doubles=["lat", "lon", "temperature_2m"]))
def backfill_null_location(t: Tables):
    known = F.col("lat") >= 6
    obs = t.obs(["temperature_2m"], keys=("lat", "lon"))
    obs = obs.withColumns({"lat": F.when(known, F.col("lat")), "lon": F.when(known, F.col("lon"))})
    return upserts.backfill_location(obs, 28.6139, 77.2090)


_KIND = "CASE event_type WHEN 'click' THEN 'provider' WHEN 'view' THEN 'ml' ELSE event_type END"


@query(sql(f"""SELECT violation, count(*) AS n FROM (SELECT CASE WHEN value IS NULL THEN 'value is null'
  WHEN lat < 6 THEN 'lat is null' WHEN {_KIND} NOT IN ('provider', 'ml') THEN 'forecast_type not allowed' END AS violation
  FROM ev) WHERE violation IS NOT NULL GROUP BY violation""", EV))
def enforce_constraints(t: Tables):
    kind = F.when(F.col("event_type") == "click", "provider").when(F.col("event_type") == "view", "ml").otherwise(
        F.col("event_type"))
    rows = t.events().select("value", F.when(F.col("lat") >= 6, F.col("lat")).alias("lat"), kind.alias("forecast_type"))
    _, bad = upserts.split_valid(rows, ["value", "lat"], {"forecast_type": ["provider", "ml"]})
    return bad.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query(sql("""SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS copies FROM events GROUP BY 1, 2
  HAVING count(*) > 1"""))
def duplicate_keys(t: Tables):
    rows = t.raw("events").select("user_id", F.date_trunc("hour", "ts").alias("hour"))
    return upserts.duplicate_keys(rows, ["user_id", "hour"])


@query(sql("""SELECT TIMESTAMP '2024-02-01 00:00:00' AS run_at, event_type AS target, 'h' || hour(ts) AS horizon,
  avg(value) AS mae, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type, hour(ts)""", doubles=["mae"]))
def training_report_append(t: Tables):
    report = t.raw("events").groupBy(F.col("event_type").alias("target"), F.concat(F.lit("h"), F.hour("ts")).alias("horizon")).agg(
        F.avg("value").alias("mae"), F.count(F.lit(1)).alias("n"), F.lit(float("nan")).alias("r2"))
    path = t.work("report")
    writers.training_report_rows(report, ts("2024-02-01 00:00:00")).write.mode("append").parquet(path)
    fields = F.from_json("metrics", "mae double, n bigint, r2 double")
    return t.spark.read.parquet(path).select("run_at", "target", "horizon", fields["mae"].alias("mae"), fields["n"].alias("n"))


# ---- projections ---------------------------------------------------------

@query(sql("""SELECT site, time, temperature_2m AS temperature, CAST(NULL AS DOUBLE) AS ghi, cloud_cover FROM obs""",
           *base(sql_obs(TWO)), doubles=["temperature", "ghi", "cloud_cover"]))
def conform_columns(t: Tables):
    types = {"site": "bigint", "time": "timestamp", "temperature": "double", "ghi": "double", "cloud_cover": "double"}
    return views.conform(t.obs(TWO), types, {"temperature_2m": "temperature"})


@query(sql("SELECT time, 28.6139e0 AS lat, 77.209e0 AS lon, site, temperature_2m FROM obs", *base(sql_obs(TWO)),
           doubles=["lat", "lon", "temperature_2m"]))
def prepare_observations(t: Tables):
    return views.prepare_observations(t.obs(["temperature_2m"]), 28.6139, 77.2090)


@query(sql("""SELECT TIMESTAMP '2024-01-30 00:00:00' AS issue_time, time AS forecast_time, lat, lon, 'provider' AS forecast_type,
  'open_meteo' AS source, '' AS model_version, temperature_2m FROM lobs""", sql_forecast_base(["temperature_2m"]),
           doubles=["lat", "lon", "temperature_2m"]))
def prepare_forecast(t: Tables):
    return views.prepare_forecast(t.obs(["temperature_2m"], keys=("lat", "lon")), ts("2024-01-30 00:00:00"), "provider",
                                  "open_meteo")


@query(sql("""SELECT site, time, temperature_2m, CASE WHEN time <= TIMESTAMP '2024-01-20 12:00:00' THEN 'actual' ELSE 'forecast' END
  AS part FROM obs""", *base(sql_obs(TWO)), doubles=["temperature_2m"]))
def split_actual_forecast(t: Tables):
    actual, future = views.split_actual_forecast(t.obs(["temperature_2m"]), ts("2024-01-20 12:00:00"))
    return actual.withColumn("part", F.lit("actual")).unionByName(future.withColumn("part", F.lit("forecast")))


@query(sql("SELECT event_id, lat BETWEEN 6 AND 37 AND lon BETWEEN 68 AND 98 AS accepted FROM ev", EV))
def bbox_filter(t: Tables):
    yes, no = views.split_by_bounding_box(t.events().select("event_id", "lat", "lon"))
    return yes.select("event_id", F.lit(True).alias("accepted")).unionByName(no.select("event_id", F.lit(False).alias("accepted")))


@query(sql("""SELECT event_id, lat, lon, site, replace(replace(printf('lat_%.4f_lon_%.4f', lat - 20, lon), '-', 'm'), '.', '_')
  AS token FROM ev""", EV, doubles=["lat", "lon"]))
def round_location(t: Tables):
    ev = t.events()
    noisy_lat, noisy_lon = F.col("lat") + F.lit(0.00002), F.col("lon") - F.lit(0.00002)
    key = scalar.site_key(noisy_lat, noisy_lon)
    return ev.select("event_id", scalar.site_lat(key).alias("lat"), scalar.site_lon(key).alias("lon"), key.alias("site"),
                     scalar.location_token(scalar.round_coordinate(noisy_lat) - 20, "lon").alias("token"))


@query(sql("""SELECT event_id, CASE WHEN value < 2 THEN NULL ELSE greatest(10, least(60, value)) END AS clipped,
  CASE WHEN value >= 2 THEN value END AS kept FROM events""", doubles=["clipped", "kept"]))
def clip_bounds(t: Tables):
    return _marked(t).select("event_id", scalar.clip(scalar.sentinel_to_null("x"), 10, 60).alias("clipped"),
                             scalar.sentinel_to_null("x").alias("kept"))


def _marked(t: Tables):
    """Event values where everything below 2 is the missing-value mark."""
    return t.raw("events").select("event_id", F.when(F.col("value") < 2, F.lit(-999.0)).otherwise(F.col("value")).alias("x"))


@query(sql("SELECT event_id, CASE WHEN value >= 2 THEN value END AS x FROM events", doubles=["x"]))
def sentinel_to_null(t: Tables):
    return _marked(t).select("event_id", scalar.sentinel_to_null("x").alias("x"))


_IMP = ["temperature_2m", "nasa_temperature"]


@query(sql("SELECT site, time, coalesce(pv_temperature_2m, nv_temperature_2m) AS temperature_2m, "
           "coalesce(pv_nasa_temperature, nv_nasa_temperature) AS nasa_temperature FROM n", *base(
    sql_obs(["temperature_2m"]), sql_obs2(["nasa_temperature"]),
    """m AS (SELECT coalesce(a.site, b.site) AS site, coalesce(a.time, b.time) AS time, temperature_2m,
      coalesce(nasa_temperature, temperature_2m) AS nasa_temperature FROM obs a FULL JOIN obs2 b
      ON a.site = b.site AND a.time = b.time)""", sql_near(_IMP, "m", "n")), doubles=_IMP))
def impute_from_sibling(t: Tables):
    both = t.obs(["temperature_2m"]).join(t.obs2(["nasa_temperature"]), ["site", "time"], "full")
    return feats.impute(both, HOURLY, _IMP)


@query(sql("SELECT * FROM obs WHERE temperature_2m IS NOT NULL AND cloud_cover IS NOT NULL", *base(sql_obs(TWO)), doubles=TWO))
def dropna_any(t: Tables):
    return t.obs(TWO).dropna(how="any", subset=TWO)


@query(sql("SELECT site, time, coalesce(temperature_2m, 0) AS temperature_2m, coalesce(cloud_cover, 0) AS cloud_cover FROM obs",
           *base(sql_obs(TWO)), doubles=TWO))
def fill_defaults(t: Tables):
    # An infinity and a NaN count as missing, too.
    odd = F.coalesce(F.col("temperature_2m"), F.lit(float("inf"))), F.coalesce(F.col("cloud_cover"), F.lit(float("nan")))
    return t.obs(TWO).select("site", "time", scalar.finite_or_zero(odd[0]).alias("temperature_2m"),
                             scalar.finite_or_zero(odd[1]).alias("cloud_cover"))


@query(sql("""SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS floored, CASE WHEN time_bucket(INTERVAL 15 MINUTE, ts) = ts
  THEN ts ELSE time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE END AS ceiled,
  time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS next_run FROM events"""))
def floor_to_interval(t: Tables):
    return t.raw("events").select("event_id", scalar.floor_time("ts", 900).alias("floored"),
                                  scalar.ceil_time("ts", 900).alias("ceiled"), scalar.next_run("ts", 900).alias("next_run"))


@query(sql("SELECT * FROM obs WHERE time >= (SELECT max(time) FROM obs) - INTERVAL 10 DAY", *base(sql_obs(TWO)), doubles=TWO))
def training_lookback(t: Tables):
    return feats.training_lookback(t.obs(TWO), HOURLY, 10)


_SIMPLE = """forecast_time AS timestamp, lat AS latitude, lon AS longitude, temperature_2m AS predicted_temperature,
  cloud_cover AS predicted_cloud_cover, wind_speed_10m AS predicted_wind_speed, shortwave_radiation AS predicted_ghi,
  diffuse_radiation AS predicted_dhi, issue_time, model_version"""
_SIMPLE_D = ["latitude", "longitude", "predicted_temperature", "predicted_cloud_cover", "predicted_wind_speed", "predicted_ghi",
             "predicted_dhi"]
_ML = (sql_forecast_base(), sql_forecast("ml", name="mfc"))


@query(sql(f"SELECT {_SIMPLE} FROM mfc", *_ML, doubles=_SIMPLE_D))
def simplify_prediction(t: Tables):
    return views.simplify_prediction(t.forecast("ml"))


@query(sql("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS text FROM events"))
def iso_format(t: Tables):
    return t.raw("events").select("event_id", scalar.iso_utc("ts").alias("text"))


# ---- views and top-k -----------------------------------------------------

_TOP = f"""SELECT {_SIMPLE} FROM mfc WHERE issue_time = (SELECT max(issue_time) FROM mfc)
  ORDER BY timestamp, latitude, longitude, model_version LIMIT 288"""


@query(sql(_TOP, *_ML, doubles=_SIMPLE_D))
def latest_forecast_topk(t: Tables):
    return views.stored_predictions(t.forecasts(), 288)


@query(sql("""SELECT issue_time, forecast_time, lat, lon, model_version, temperature_2m FROM fcs WHERE model_version = 'v20240130'
  AND issue_time = (SELECT max(issue_time) FROM fcs WHERE model_version = 'v20240130')""", sql_forecasts(TWO),
           doubles=["lat", "lon", "temperature_2m"]))
def latest_batch(t: Tables):
    rows = views.latest_batch(t.forecasts(TWO), "issue_time", "v20240130", "forecast_time")
    return rows.select("issue_time", "forecast_time", "lat", "lon", "model_version", "temperature_2m")


@query(sql("""SELECT target, feature, importance, rank FROM (SELECT event_type AS target, 'f' || user_id AS feature,
  sum(value) AS importance, row_number() OVER (PARTITION BY event_type ORDER BY sum(value) DESC, 'f' || user_id) AS rank
  FROM events GROUP BY event_type, user_id) WHERE rank <= 15""", doubles=["importance"]))
def top_features(t: Tables):
    named = F.concat(F.lit("f"), F.col("user_id").cast("string"))
    rows = t.raw("events").groupBy(F.col("event_type").alias("target"), named.alias("feature")).agg(
        F.sum("value").alias("importance"))
    return views.top_features(rows, 15)


@query(sql("SELECT forecast_time, source, temperature_2m FROM fcs", sql_forecasts(TWO), doubles=["temperature_2m"]))
def order_output(t: Tables):
    return views.order_output(t.forecasts(TWO).select("forecast_time", "source", "temperature_2m"), "forecast_time")


_UNPIVOT = " UNION ALL ".join(f"SELECT time, lat, lon, '{c}' AS metric, {c} AS value FROM lobs" for c in TARGETS)


@query(sql(_UNPIVOT, sql_forecast_base(), doubles=["lat", "lon", "value"]))
def unpivot_metrics(t: Tables):
    return views.unpivot_metrics(t.obs(TARGETS, keys=("lat", "lon")), ["time", "lat", "lon"])


def _latest_long(name: str, extra: str) -> str:
    parts = " UNION ALL ".join(f"""SELECT f.forecast_time AS time, f.lat, f.lon, '{c}' AS metric, f.{c} AS value, f.issue_time,
      f.{extra} FROM {name} f JOIN newest n ON n.lat = f.lat AND n.lon = f.lon AND n.issue_time = f.issue_time""" for c in TARGETS)
    return parts


@query(sql(_latest_long("pfc", "source"), sql_forecast_base(), sql_forecast("provider", name="pfc"),
           "newest AS (SELECT lat, lon, max(issue_time) AS issue_time FROM pfc GROUP BY 1, 2)", doubles=["lat", "lon", "value"]))
def latest_provider_long(t: Tables):
    return views.latest_forecast_long(t.forecasts(), "provider")


@query(sql(_latest_long("mfc", "model_version"), *_ML,
           "newest AS (SELECT lat, lon, max(issue_time) AS issue_time FROM mfc GROUP BY 1, 2)", doubles=["lat", "lon", "value"]))
def latest_ml_long(t: Tables):
    return views.latest_forecast_long(t.forecasts(), "ml")


@query(sql("""SELECT time, lat, lon, 'cloud_cover' AS metric, cloud_cover AS value FROM lobs
  WHERE time BETWEEN TIMESTAMP '2024-01-18 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00'""", sql_forecast_base(TWO),
           doubles=["lat", "lon", "value"]))
def metric_range_query(t: Tables):
    long = views.unpivot_metrics(t.obs(TARGETS, keys=("lat", "lon")), ["time", "lat", "lon"])
    return views.metric_range(long, "cloud_cover", ts("2024-01-25 00:00:00"))


@query(sql("""SELECT forecast_time AS time, target, max(predicted_value) AS predicted_value FROM lp
  WHERE forecast_time >= TIMESTAMP '2024-01-27 00:00:00' AND target = 'cloud_cover' GROUP BY 1, 2""",
           """lp AS (SELECT date_trunc('hour', ts) AS forecast_time, CASE event_type WHEN 'view' THEN 'cloud_cover' ELSE 'other' END
             AS target, value AS predicted_value FROM events)""", doubles=["predicted_value"]))
def recent_points_query(t: Tables):
    points = long_predictions(t).select(F.col("forecast_time").alias("time"), "target", F.lit("predicted_value").alias("field"),
                                        F.col("predicted_value").alias("value"))
    return views.recent_points(points, ts("2024-01-30 00:00:00"), target="cloud_cover")

