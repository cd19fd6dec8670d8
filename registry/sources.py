"""Parser, file and landing queries. Payloads are built from the observations, then parsed back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.core import (
    EV,
    HOURLY,
    STATION,
    TARGETS,
    Tables,
    base,
    query,
    sql,
    sql_forecast,
    sql_forecast_base,
    sql_obs,
    sql_obs2,
)
from skyloom import config
from skyloom.operators import tables as views
from skyloom.sources import files, landing, payloads
from skyloom.sources.upserts import FORECAST_KEYS, insert_if_absent

THREE = ["temperature_2m", "cloud_cover", "shortwave_radiation"]


def _per_day(obs: DataFrame) -> DataFrame:
    """One row per station and day with its hours in order (at most 24)."""
    values = [c for c in obs.columns if c not in ("site", "time")]
    return obs.groupBy("site", F.to_date("time").alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("time", *values))).alias("h"))


def _array(c: str):
    return F.transform("h", lambda r: r[c])


def hourly_payloads(obs: DataFrame, block: str = "hourly", names: Mapping[str, str] | None = None) -> DataFrame:
    values = [c for c in obs.columns if c not in ("site", "time")]
    times = F.transform("h", lambda r: F.date_format(r["time"], "yyyy-MM-dd'T'HH:mm"))
    arrays = [_array(c).alias((names or {}).get(c, c)) for c in values]
    body = F.struct(F.struct(times.alias("time"), *arrays).alias(block))
    return _per_day(obs).select("site", "day", F.to_json(body).alias("payload"))


def parameter_payloads(obs: DataFrame, parameters: Mapping[str, str]) -> DataFrame:
    def per_hour(c: str):
        return F.map_from_entries(F.transform("h", lambda r: F.struct(
            F.date_format(r["time"], "yyyyMMddHH"), F.coalesce(r[c], F.lit(-999.0)))))

    inner = F.struct(*[per_hour(c).alias(p) for p, c in parameters.items()])
    body = F.struct(F.struct(inner.alias("parameter")).alias("properties"))
    return _per_day(obs).select("site", "day", F.to_json(body).alias("payload"))


@query(sql("SELECT site, time, temperature_2m, cloud_cover, shortwave_radiation, CAST(NULL AS DOUBLE) AS dew_point_2m "
           "FROM obs", *base(sql_obs(THREE)), doubles=[*THREE, "dew_point_2m"]))
def parse_hourly_arrays(t: Tables):
    rows = payloads.parse_hourly_arrays(hourly_payloads(t.obs(THREE)), [*THREE, "dew_point_2m"])
    return rows.select("site", "time", *THREE, "dew_point_2m")


_MINUTELY = {"shortwave_radiation": "shortwave_radiation", "diffuse_radiation": "diffuse_radiation",
             "temperature_2m": "temperature_2m", "wind_speed_10m": "windspeed_10m", "cloud_cover": "cloudcover"}
_OM = {"shortwave_radiation": "om_ghi", "diffuse_radiation": "om_dhi", "temperature_2m": "om_temperature",
       "wind_speed_10m": "om_windspeed", "cloud_cover": "om_cloud_cover"}


@query(sql(f"SELECT site, time, {', '.join(f'{c} AS {n}' for c, n in _OM.items())} FROM obs",
           *base(sql_obs(TARGETS)), doubles=list(_OM.values())))
def parse_minutely15_arrays(t: Tables):
    rows = payloads.parse_minutely15_arrays(hourly_payloads(t.obs(TARGETS), "minutely_15", _MINUTELY))
    return rows.select("site", "time", *_OM.values())


_SAT = list(config.SATELLITE_PARAMETERS.values())


@query(sql(f"SELECT site, time, {', '.join(_SAT)} FROM obs2", *base(sql_obs2()), doubles=_SAT))
def parse_param_map(t: Tables):
    rows = payloads.parse_param_map(parameter_payloads(t.obs2(), config.SATELLITE_PARAMETERS))
    return rows.select("site", "time", *_SAT)


def struct_payloads(t: Tables) -> DataFrame:
    """Days with a single row carry an error instead of data."""
    hours = F.transform("h", lambda r: F.struct(
        (F.hour(r["time"]) * 100).cast("string").alias("time"), r["temperature_2m"].cast("string").alias("tempC"),
        r["cloud_cover"].cast("string").alias("cloudcover"), r["shortwave_radiation"].cast("string").alias("precipMM")))
    good = F.to_json(F.struct(F.struct(F.array(F.struct(hours.alias("hourly"))).alias("weather")).alias("data")))
    error = F.lit('{"data": {"error": [{"msg": "no data"}]}}')
    return _per_day(t.obs(THREE)).select(
        "site", "day", F.when(F.size("h") > 1, good).otherwise(error).alias("payload"))


@query(sql("""SELECT site, time, coalesce(temperature_2m, 0) AS temp, coalesce(cloud_cover, 0) AS cloud_cover,
  coalesce(shortwave_radiation, 0) AS rain FROM (SELECT *, count(*) OVER (PARTITION BY site, CAST(time AS DATE)) AS n
  FROM obs) WHERE n > 1""", *base(sql_obs(THREE)), doubles=["temp", "cloud_cover", "rain"]))
def parse_hourly_structs(t: Tables):
    return payloads.parse_hourly_structs(struct_payloads(t)).drop("day")


@query(sql("""SELECT site, CAST(CAST(time AS DATE) AS TIMESTAMP) AS day FROM obs GROUP BY site, CAST(time AS DATE)
  HAVING count(*) = 1""", *base(sql_obs(THREE))))
def rejected_payloads(t: Tables):
    return payloads.split_hourly_structs(struct_payloads(t))[1].select("site", "day")


@query(sql("""SELECT site, time, temperature_2m AS vedas_temperature,
  CASE WHEN n = m THEN shortwave_radiation END AS vedas_solar_potential FROM (SELECT *,
    count(*) OVER (PARTITION BY site, CAST(time AS DATE)) AS n,
    count(shortwave_radiation) OVER (PARTITION BY site, CAST(time AS DATE)) AS m FROM obs) WHERE hour(time) <> 0""",
           *base(sql_obs(THREE)), doubles=["vedas_temperature", "vedas_solar_potential"]))
def parse_list_forecast(t: Tables):
    # Midnight carries an unreadable time; the second value list loses its missing values.
    text = F.transform("h", lambda r: F.when(F.hour(r["time"]) == 0, F.lit("30Feb:00.00")).otherwise(
        F.date_format(r["time"], "dMMM:HH.mm")))
    body = F.struct(text.alias("timeList"), _array("temperature_2m").alias("temprList"),
                    F.array_compact(_array("shortwave_radiation")).alias("potentialList"))
    rows = _per_day(t.obs(THREE)).select("site", F.to_json(F.array(body)).alias("payload"))
    return payloads.parse_list_forecast(rows, F.lit(2024))


@query(sql("""SELECT event_id, ts AS timestamp, value AS temp, CAST(NULL AS DOUBLE) AS uv_index, k AS humidity,
  event_type AS description FROM ev""", EV, doubles=["temp", "humidity", "uv_index"]))
def parse_current_snapshot(t: Tables):
    body = F.to_json(F.struct(F.struct(
        F.col("value").alias("temperature"), F.col("k").alias("humidity"),
        F.array("event_type").alias("weather_descriptions")).alias("current")))
    rows = t.events().select("event_id", F.col("ts").alias("requested_at"), body.alias("payload"))
    return payloads.parse_current_snapshot(rows).select(
        "event_id", "timestamp", "temp", "uv_index", "humidity", "description")


@query(sql("""SELECT event_id, ts AS timestamp, value AS temp, k AS cloud_cover,
  CASE WHEN event_type = 'view' THEN value ELSE 0 END AS rain FROM ev""", EV, doubles=["temp", "cloud_cover", "rain"]))
def parse_observed_now(t: Tables):
    rain = F.when(F.col("event_type") == "view", F.struct(F.col("value").alias("1h")))
    body = F.to_json(F.struct(F.struct(F.col("value").alias("temp")).alias("main"),
                              F.struct(F.col("k").alias("all")).alias("clouds"), rain.alias("rain")))
    rows = t.events().select("event_id", F.col("ts").alias("requested_at"), body.alias("payload"))
    return payloads.parse_observed_now(rows)


@query(sql("""SELECT time AS timestamp, temperature_2m AS temperature, wind_speed_10m AS windspeed,
  cloud_cover AS cloudcover, shortwave_radiation AS ghi, diffuse_radiation AS dhi FROM obs""",
           *base(sql_obs(TARGETS)), doubles=["temperature", "windspeed", "cloudcover", "ghi", "dhi"]))
def read_metadata_csv(t: Tables):
    obs, path = t.obs(TARGETS), t.work("satellite-csv")
    measures = ["temperature_2m", "wind_speed_10m", "shortwave_radiation", "diffuse_radiation", "cloud_cover"]
    cells = [F.year("time"), F.month("time"), F.dayofmonth("time"), F.hour("time"),
             *[F.coalesce(F.col(c), F.lit(-999.0)) for c in measures]]
    data = obs.select(F.concat_ws(",", *[c.cast("string") for c in cells]).alias("value"))
    preamble = [("-BEGIN HEADER-",), *[(f"note {i}",) for i in range(11)], ("-END HEADER-",),
                (",".join(files.SATELLITE_CSV),)]
    t.spark.createDataFrame(preamble, "value string").unionByName(data).write.text(path)
    return files.read_metadata_csv(t.spark, path)


_CSV = ["site", "timestamp", "ghi", "dhi", "temperature", "windspeed", "cloudcover"]


@query(sql(f"""SELECT CAST(site AS VARCHAR) AS site, time AS timestamp, {', '.join(f'{c} AS {n}' for n, c in STATION.items())}
  FROM (SELECT *, row_number() OVER (PARTITION BY site, time ORDER BY seq DESC) AS rn FROM (
    SELECT *, 1 AS seq FROM obs UNION ALL SELECT *, 2 AS seq FROM obs2) WHERE hour(time) <> 0) WHERE rn = 1""",
           *base(sql_obs(TARGETS), sql_obs2(TARGETS)), doubles=list(STATION)))
def read_series_csv(t: Tables):
    path = t.work("series-csv")
    both = t.station().withColumn("seq", F.lit(1)).unionByName(t.station(True).withColumn("seq", F.lit(2)))
    text = F.when(F.hour("time") == 0, F.lit("n/a")).otherwise(F.date_format("time", "yyyy-MM-dd HH:mm:ss"))
    (both.orderBy("site", "time", "seq").select(
        "site", text.alias("timestamp"), "ghi", "dhi", "temperature", "windspeed",
        F.col("cloud_cover").alias("cloudcover")).write.csv(path, header=True))
    return files.read_series_csv(t.spark, path, _CSV, keys=["site"])


@query(sql("""SELECT 'open_meteo' AS source, 'archive' AS dataset_type, lat, lon, count(DISTINCT CAST(ts AS DATE)) AS payloads,
  min(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS first_interval FROM ev GROUP BY lat, lon""", EV, doubles=["lat", "lon"]))
def land_raw_payload(t: Tables):
    obs, path = t.obs(THREE, keys=("site", "lat", "lon")), t.work("raw")
    where = obs.select("site", "lat", "lon").distinct()
    rows = hourly_payloads(obs.drop("lat", "lon")).join(where, "site").withColumns({
        "interval_start": F.col("day").cast("timestamp"),
        "interval_end": F.col("day").cast("timestamp") + F.expr("INTERVAL 1 DAY")})
    landing.land_raw_payload(landing.raw_snapshot(rows, "open_meteo", "archive"), path)
    return t.spark.read.parquet(path).groupBy("source", "dataset_type", "lat", "lon").agg(
        F.count("payload").alias("payloads"), F.min("interval_start").alias("first_interval"))


@query(sql("""SELECT time, lat, lon, temperature_2m, cloud_cover FROM obs WHERE time >= TIMESTAMP '2024-01-10 00:00:00'""",
           *base(sql_obs(THREE, ("lat", "lon"))), doubles=["lat", "lon", "temperature_2m", "cloud_cover"]))
def read_observations(t: Tables):
    return views.read_observations(t.obs(keys=("lat", "lon")), ["temperature_2m", "cloud_cover"],
                                   start=F.lit("2024-01-10").cast("timestamp"))


@query(sql("""SELECT site, time, temperature_2m FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time DESC)
  AS rn FROM obs) WHERE rn <= 24""", *base(sql_obs(THREE)), doubles=["temperature_2m"]))
def newest_n_ascending(t: Tables):
    return views.newest_rows_per_key(t.obs(["temperature_2m"]), HOURLY, 24).orderBy("site", "time")


_DEFAULT = "28.6139e0 AS lat, 77.209e0 AS lon"


@query(sql(f"""SELECT issue_time, forecast_time, lat, lon, forecast_type, source, model_version, temperature_2m, cloud_cover
  FROM fc UNION ALL SELECT issue_time, forecast_time, {_DEFAULT}, 'provider', source, '', avg(temperature_2m), avg(cloud_cover)
  FROM fc GROUP BY issue_time, forecast_time, source""", sql_forecast_base(["temperature_2m", "cloud_cover"]),
           sql_forecast("provider", ["temperature_2m", "cloud_cover"]),
           doubles=["lat", "lon", "temperature_2m", "cloud_cover"]))
def migrate_provider_forecast(t: Tables):
    columns = ["temperature_2m", "cloud_cover"]
    table = t.forecast("provider", columns).drop("site")
    old = table.groupBy("issue_time", "forecast_time", "source").agg(*[F.avg(c).alias(c) for c in columns])
    moved = landing.migrate_provider_forecast(old, 28.6139, 77.2090)
    merged = insert_if_absent(table, moved, FORECAST_KEYS)
    # A second run keeps what is there.
    return insert_if_absent(merged, moved, FORECAST_KEYS)


@query(sql("SELECT time, site, temperature_2m FROM obs", *base(sql_obs(THREE)), doubles=["temperature_2m"]))
def read_time_series(t: Tables):
    path = t.work("series")
    t.obs(THREE).write.parquet(path)
    return files.read_table(t.spark, path, ["site", "temperature_2m"])


@query(sql("""SELECT lat, lon, CAST(d AS TIMESTAMP) AS chunk_start, CAST(d AS TIMESTAMP) AS chunk_end FROM (SELECT lat, lon,
  unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM ev GROUP BY lat, lon) c
  WHERE NOT EXISTS (SELECT 1 FROM ev e WHERE e.lat = c.lat AND e.lon = c.lon AND CAST(e.ts AS DATE) = CAST(c.d AS DATE))""",
           EV, doubles=["lat", "lon"]))
def missing_chunks(t: Tables):
    ev = t.events()
    ranges = ev.groupBy("lat", "lon").agg(F.to_date(F.min("ts")).alias("start_date"),
                                          F.to_date(F.max("ts")).alias("end_date"))
    day = F.date_trunc("day", "ts")
    landed = ev.select("lat", "lon", day.alias("interval_start"), day.alias("interval_end")).distinct()
    return landing.missing_chunks(landing.plan_day_chunks(ranges, days=1), landed)
