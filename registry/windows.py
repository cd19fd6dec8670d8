"""Lag, rolling, calendar, interaction and horizon queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import (
    EV,
    FULL,
    HOURLY,
    STATION,
    TARGETS,
    Tables,
    base,
    query,
    sql,
    sql_grid,
    sql_obs,
    sql_obs2,
    sql_station,
)
from registry.grids import TWO
from skyloom import config
from skyloom.functions import calendar, solar, weather
from skyloom.operators import features as feats
from skyloom.operators.aggregates import key_means
from skyloom.operators.frames import frame_columns
from skyloom.operators.joins import merge_outer
from skyloom.plans.features import incremental_features

GRID2 = base(sql_obs(TWO), sql_grid(TWO))
GRID5 = base(sql_obs(TARGETS), sql_grid(TARGETS))
BY = "PARTITION BY site ORDER BY time"
PI = "3.141592653589793e0"


def past(n: int) -> str:
    return f"OVER ({BY} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def upto(n: int) -> str:
    return f"OVER ({BY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_LAGGED = [f"{c}_lag_{k}" for c in TWO for k in (1, 4, 96)]


@query(sql(f"SELECT site, time, {', '.join(f'lag({c}, {k}) OVER ({BY}) AS {c}_lag_{k}' for c in TWO for k in (1, 4, 96))} "
           "FROM grid", *GRID2, doubles=_LAGGED))
def lag_features(t: Tables):
    return feats.lag_features(t.grid(TWO), FULL, TWO, (1, 4, 96)).select("site", "time", *_LAGGED)


@query(sql(f"SELECT site, time, {', '.join(f'lag({c}, {k}) OVER ({BY}) AS {c}_lag_{k}' for c in TWO for k in (1, 4, 96))} "
           "FROM obs", *base(sql_obs(TWO)), doubles=_LAGGED))
def lag_features_irregular(t: Tables):
    return feats.lag_features(t.obs(TWO), HOURLY, TWO, (1, 4, 96)).select("site", "time", *_LAGGED)


def _roll_past(c: str, n: int, label: str | None = None) -> str:
    label = label or c
    enough = f"count({c}) {past(n)} >= {max(1, n // 2)}"
    return (f"CASE WHEN {enough} THEN avg({c}) {past(n)} END AS {label}_roll_mean_{n}, "
            f"CASE WHEN {enough} THEN stddev_samp({c}) {past(n)} END AS {label}_roll_std_{n}")


_ROLLED = [f"{c}_roll_{s}_{n}" for c in TWO for n in (4, 16) for s in ("mean", "std")]


@query(sql(f"SELECT site, time, {', '.join(_roll_past(c, n) for c in TWO for n in (4, 16))} FROM obs",
           *base(sql_obs(TWO)), doubles=_ROLLED))
def rolling_mean_past(t: Tables):
    return feats.rolling_past(t.obs(TWO), HOURLY, TWO, (4, 16)).select("site", "time", *_ROLLED)


@query(sql(f"SELECT site, time, {', '.join(_roll_past(c, n) for c in TWO for n in (4, 16))} FROM grid",
           *GRID2, doubles=_ROLLED))
def rolling_std_past(t: Tables):
    return feats.rolling_past(t.grid(TWO), FULL, TWO, (4, 16)).select("site", "time", *_ROLLED)


def _roll_incl(c: str, label: str, n: int, extremes: bool = False) -> str:
    out = (f"avg({c}) {upto(n)} AS {c}_rmean_{label}, "
           f"coalesce(stddev_samp({c}) {upto(n)}, 0) AS {c}_rstd_{label}")
    if extremes:
        out += f", min({c}) {upto(n)} AS {c}_rmin_{label}, max({c}) {upto(n)} AS {c}_rmax_{label}"
    return out


_WIN = {"1h": 4, "3h": 12}
_INCL = [f"{c}_{s}_{w}" for c in TWO for w in _WIN for s in ("rmean", "rstd")]


@query(sql(f"SELECT site, time, {', '.join(_roll_incl(c, w, n) for c in TWO for w, n in _WIN.items())} FROM obs",
           *base(sql_obs(TWO)), doubles=_INCL))
def rolling_inclusive(t: Tables):
    return feats.rolling_inclusive(t.obs(TWO), HOURLY, TWO, _WIN).select("site", "time", *_INCL)


_LEG = {k: config.LEGACY_WINDOWS[k] for k in ("1h", "6h", "1d")}
_EXT = [f"{c}_{s}_{w}" for c in TWO for w in _LEG for s in ("rmean", "rstd", "rmin", "rmax")]


@query(sql(f"SELECT site, time, {', '.join(_roll_incl(c, w, n, True) for c in TWO for w, n in _LEG.items())} FROM grid",
           *GRID2, doubles=_EXT))
def rolling_min_max(t: Tables):
    return feats.rolling_inclusive(t.grid(TWO), FULL, TWO, _LEG, extremes=True).select("site", "time", *_EXT)


def sql_ema(c: str, span: int, source: str = "grid", name: str = "ema") -> str:
    """Step by step along each gap-free series."""
    a = 2.0 / (span + 1.0)
    return (f"{name}_p AS (SELECT site, time, {c} AS x, row_number() OVER ({BY}) AS i FROM {source}),\n"
            f"{name} AS (SELECT site, time, i, x AS y FROM {name}_p WHERE i = 1 UNION ALL "
            f"SELECT n.site, n.time, n.i, {a!r}e0 * n.x + (1e0 - {a!r}e0) * e.y FROM {name} e JOIN {name}_p n "
            "ON n.site = e.site AND n.i = e.i + 1)")


@query("WITH RECURSIVE " + sql(
    "SELECT a.site, a.time, a.y AS temperature_2m_ema_4, b.y AS temperature_2m_ema_48 FROM e4 a JOIN e48 b "
    "ON a.site = b.site AND a.time = b.time", *base(sql_obs(["temperature_2m"]), sql_grid(["temperature_2m"])),
    sql_ema("temperature_2m", 4, name="e4"), sql_ema("temperature_2m", 48, name="e48"),
    doubles=["temperature_2m_ema_4", "temperature_2m_ema_48"])[5:])
def ema(t: Tables):
    out = feats.ema(t.grid(["temperature_2m"]), FULL, ["temperature_2m"], (4, 48), gapless=True)
    return out.drop("temperature_2m")


_SPARSE_EMA = """pos AS (SELECT site, time, temperature_2m AS x, row_number() OVER (PARTITION BY site ORDER BY time) AS i FROM obs),
val AS (SELECT site, time, x, i, i - lag(i) OVER (PARTITION BY site ORDER BY i) AS gap,
  row_number() OVER (PARTITION BY site ORDER BY i) AS j FROM pos WHERE x IS NOT NULL),
e AS (SELECT site, time, i, j, x AS y FROM val WHERE j = 1 UNION ALL
  SELECT v.site, v.time, v.i, v.j, (pow(0.6e0, v.gap) * e.y + 0.4e0 * v.x) / (pow(0.6e0, v.gap) + 0.4e0)
  FROM e JOIN val v ON v.site = e.site AND v.j = e.j + 1)"""


@query("WITH RECURSIVE " + sql(
    "SELECT p.site, p.time, last_value(e.y IGNORE NULLS) OVER (PARTITION BY p.site ORDER BY p.i ROWS BETWEEN UNBOUNDED "
    "PRECEDING AND CURRENT ROW) AS temperature_2m_ema_4 FROM pos p LEFT JOIN e ON e.site = p.site AND e.i = p.i",
    *base(sql_obs(["temperature_2m"])), _SPARSE_EMA, doubles=["temperature_2m_ema_4"])[5:])
def ema_with_gaps(t: Tables):
    return feats.ema(t.obs(["temperature_2m"]), HOURLY, ["temperature_2m"], (4,)).drop("temperature_2m")


_DIFF = {"1": 1, "4": 4, "96": 96}
_DIFFS = [f"{c}_diff_{k}" for c in TWO for k in _DIFF]


@query(sql(f"SELECT site, time, {', '.join(f'{c} - lag({c}, {k}) OVER ({BY}) AS {c}_diff_{k}' for c in TWO for k in _DIFF)} "
           "FROM grid", *GRID2, doubles=_DIFFS))
def diff_features(t: Tables):
    return feats.diff_features(t.grid(TWO), FULL, TWO, _DIFF).select("site", "time", *_DIFFS)


HOUR = "(hour(time) + minute(time) / 60e0)"
WEEKDAY = "(isodow(time) - 1)"
_CYCLE = f"""sin(2 * {PI} * {HOUR} / 24) AS hour_sin, cos(2 * {PI} * {HOUR} / 24) AS hour_cos,
  sin(2 * {PI} * dayofyear(time) / 365.25e0) AS doy_sin, cos(2 * {PI} * dayofyear(time) / 365.25e0) AS doy_cos"""
_WEEK = f"sin(2 * {PI} * {WEEKDAY} / 7e0) AS dow_sin, cos(2 * {PI} * {WEEKDAY} / 7e0) AS dow_cos"
_WAVES = ["hour_sin", "hour_cos", "doy_sin", "doy_cos", "dow_sin", "dow_cos"]
_EVT = "evt AS (SELECT event_id, ts AS time, lat, lon FROM ev)"


def _events(t: Tables, *columns):
    return t.events().withColumnRenamed("ts", "time").select("event_id", *columns)


@query(sql(f"SELECT event_id, {_CYCLE}, {_WEEK}, CAST({WEEKDAY} >= 5 AS BIGINT) AS is_weekend FROM evt", EV, _EVT,
           doubles=_WAVES))
def calendar_cyclic(t: Tables):
    return _events(t, *calendar.cyclic())


@query(sql(f"""SELECT event_id, month(time) AS month, {WEEKDAY} AS weekday,
  CAST(hour(time) >= 6 AND hour(time) < 18 AS BIGINT) AS is_daytime,
  CAST({HOUR} >= 6 AND {HOUR} <= 18 AS BIGINT) AS is_daytime_closed FROM evt""", EV, _EVT))
def calendar_plain(t: Tables):
    closed = calendar.cyclic_hourly()[-1].alias("is_daytime_closed")
    return _events(t, *calendar.plain(), closed)


@query(sql(f"""SELECT event_id, sin(2 * {PI} * month(time) / 12e0) AS month_sin, cos(2 * {PI} * month(time) / 12e0) AS month_cos,
  sin(2 * {PI} * weekofyear(time) / 52e0) AS week_sin, cos(2 * {PI} * weekofyear(time) / 52e0) AS week_cos,
  minute(time) AS minute_of_hour, hour(time) * 4 + minute(time) // 15 AS step_of_day FROM evt""", EV, _EVT,
           doubles=["month_sin", "month_cos", "week_sin", "week_cos"]))
def calendar_legacy(t: Tables):
    return _events(t, *calendar.legacy())


_WIND = ["wind_direction_sin_lag1", "wind_direction_cos_lag1"]


@query(sql(f"""SELECT site, time, sin(radians(coalesce(lag(wind_direction_10m) OVER ({BY}), 0))) AS wind_direction_sin_lag1,
  cos(radians(coalesce(lag(wind_direction_10m) OVER ({BY}), 0))) AS wind_direction_cos_lag1 FROM obs""",
           *base(sql_obs(["wind_direction_10m"])), doubles=_WIND))
def wind_direction_lag(t: Tables):
    return feats.wind_direction_lag(t.obs(["wind_direction_10m"]), HOURLY).select("site", "time", *_WIND)


@query(sql("""SELECT site, time, CASE WHEN dhi > 1 THEN ghi / dhi ELSE 0 END AS ghi_dhi_ratio,
  temperature * windspeed / 100 AS temp_wind_interaction, cloud_cover * ghi / 1000 AS cloud_ghi_interaction FROM st""",
           *base(sql_obs(TARGETS), sql_station("obs", "st")),
           doubles=["ghi_dhi_ratio", "temp_wind_interaction", "cloud_ghi_interaction"]))
def interaction_features(t: Tables):
    return t.station().select("site", "time", *weather.station_interactions())


_INTER = ["temp_x_humidity", "wind_x_cloud", "ghi_x_clearsky", "temp_dewpoint_spread", "diffuse_fraction"]


@query(sql("""SELECT site, time, temperature_2m * relative_humidity_2m / 100 AS temp_x_humidity,
  wind_speed_10m * cloud_cover / 100 AS wind_x_cloud, shortwave_radiation * (1 - cloud_cover / 100) AS ghi_x_clearsky,
  temperature_2m - dew_point_2m AS temp_dewpoint_spread,
  CASE WHEN shortwave_radiation <> 0 THEN diffuse_radiation / shortwave_radiation END AS diffuse_fraction FROM obs""",
           *base(sql_obs()), doubles=_INTER))
def interaction_legacy(t: Tables):
    return t.obs().select("site", "time", *weather.legacy_interactions())


_U, _V = ("(-wind_speed_10m * sin(radians(wind_direction_10m)))", "(-wind_speed_10m * cos(radians(wind_direction_10m)))")
_VEC = ["wind_u", "wind_v", "wind_dir_sin", "wind_dir_cos", "wind_u_x_cloud", "wind_v_x_cloud", "cloud_advection_rate",
        "gust_factor", "cloud_layer_ratio", "pressure_x_wind"]
_WINDY = ["wind_speed_10m", "wind_direction_10m", "cloud_cover", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high",
          "wind_gusts_10m", "pressure_msl"]


@query(sql(f"""SELECT site, time, {_U} AS wind_u, {_V} AS wind_v, sin(radians(wind_direction_10m)) AS wind_dir_sin,
  cos(radians(wind_direction_10m)) AS wind_dir_cos, {_U} * cloud_cover AS wind_u_x_cloud, {_V} * cloud_cover AS wind_v_x_cloud,
  sqrt({_U} * cloud_cover * {_U} * cloud_cover + {_V} * cloud_cover * {_V} * cloud_cover) AS cloud_advection_rate,
  CASE WHEN wind_speed_10m <> 0 THEN wind_gusts_10m / wind_speed_10m END AS gust_factor,
  cloud_cover_low / (cloud_cover_low + cloud_cover_mid + cloud_cover_high + 1) AS cloud_layer_ratio,
  (pressure_msl - 1013.25e0) * wind_speed_10m AS pressure_x_wind FROM grid""",
           *base(sql_obs(_WINDY), sql_grid(_WINDY)), doubles=_VEC))
def wind_vectors(t: Tables):
    return t.grid(_WINDY).select("site", "time", *weather.wind_vectors())


_B = "(radians(360e0 / 365e0 * (dayofyear(time) - 81)))"
_DECL = f"(radians(23.45e0) * sin({_B}))"
_EOT = f"(9.87e0 * sin(2 * {_B}) - 7.53e0 * cos({_B}) - 1.5e0 * sin({_B}))"
_HA = f"(radians(15 * ({HOUR} + (4 * (lon - 82.5e0) + {_EOT}) / 60 - 12)))"
_COSZ = f"greatest(-1, least(1, sin(radians(lat)) * sin({_DECL}) + cos(radians(lat)) * cos({_DECL}) * cos({_HA})))"


@query(sql(f"""SELECT event_id, solar_zenith, 90 - solar_zenith AS solar_elevation, day_length,
  CAST(90 - solar_zenith > 0 AS BIGINT) AS is_daylight FROM (SELECT event_id, degrees(acos({_COSZ})) AS solar_zenith,
    2 * degrees(acos(greatest(-1, least(1, -tan(radians(lat)) * tan({_DECL}))))) / 15 AS day_length FROM evt)""",
           EV, _EVT, doubles=["solar_zenith", "solar_elevation", "day_length"]))
def solar_position(t: Tables):
    return _events(t, *solar.solar_position())


# ---- matrices ------------------------------------------------------------

_WIDE_NAMES = [*feats.matrix_columns(), *TARGETS]
_W_COLS = list(config.PROVIDER_MEASURES)
_W_MORE = list(config.SATELLITE_MEASURES)


def wide_observations(t: Tables):
    """All 23 measures of both providers on the complete grid of every station."""
    return feats.imputed_grid(merge_outer(t.obs(), t.obs2(), ["site", "time"]), HOURLY)


def _fill(c: str, source: str) -> str:
    return f"coalesce(pv_{c}, nv_{c}) AS {c}"


_WIDE = ",\n".join([
    sql_obs(), sql_obs2(),
    f"""duo AS (SELECT coalesce(a.site, b.site) AS site, coalesce(a.time, b.time) AS time, {', '.join(_W_COLS)},
      {', '.join(f'coalesce({c}, {config.SIBLINGS[c]}) AS {c}' for c in _W_MORE)}
      FROM obs a FULL JOIN obs2 b ON a.site = b.site AND a.time = b.time)""",
    sql_grid([*_W_COLS, *_W_MORE], "duo", "wg").split("wg AS (")[0].rstrip().rstrip(","),
    f"wide AS (SELECT site, time, {', '.join(_fill(c, 'wg_n') for c in [*_W_COLS, *_W_MORE])} FROM wg_n)"])
_WIDE_FRAMES = ", ".join([*[f"lag({c}, {k}) OVER ({BY}) AS {c}_lag_{k}" for c in config.MEASURES for k in config.LAGS],
                          *[_roll_past(c, n) for c in config.MEASURES for n in config.WINDOWS],
                          *[f"{wave}(radians(coalesce(lag(wind_direction_10m) OVER ({BY}), 0))) AS wind_direction_{wave}_lag1" for wave in ("sin", "cos")]])


@query(sql(f"""SELECT site, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in _WIDE_NAMES)} FROM (SELECT site, time,
  {_WIDE_FRAMES}, {_CYCLE}, {_WEEK}, CAST({WEEKDAY} >= 5 AS BIGINT) AS is_weekend, {', '.join(TARGETS)} FROM wide)
  WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _WIDE_NAMES)} GROUP BY site""", *base(_WIDE), doubles=_WIDE_NAMES))
def feature_matrix(t: Tables):
    """The 308 features and the targets of every row; of each column the mean per station."""
    matrix = feats.feature_matrix(wide_observations(t), FULL, imputed=True, packed="frames")
    frames = frame_columns(config.MEASURES, config.LAGS, config.WINDOWS)
    means = key_means(matrix, ["site"], [c for c in _WIDE_NAMES if c not in set(frames)], {"frames": frames})
    return means.select("site", "n", *_WIDE_NAMES)


_ST = list(STATION)
_STATION_BASE = base(sql_obs(TARGETS), sql_grid(TARGETS), sql_station("grid", "sg"), sql_obs2(TARGETS),
                     sql_station("obs2", "ext"))
_ST_NAMES = [*_ST, *feats.station_columns()]
_ST_DOUBLES = [c for c in _ST_NAMES if c not in ("month", "is_daytime", "weekday")]
_ST_LAGS = [(c, k) for c in _ST for k in config.STATION_LAGS]


def _held(c: str, name: str, source: str) -> str:
    """An external value held for four rows, then 0."""
    return (f"coalesce(last_value({source}.{c} IGNORE NULLS) OVER (PARTITION BY sg.site ORDER BY sg.time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0) "
            f"AS {name}")


def sql_emas(columns: list[str], spans: tuple[int, ...], source: str, name: str) -> str:
    """As :func:`sql_ema`, all averages step by step together."""
    alpha = {n: 2.0 / (n + 1.0) for n in spans}
    first = ", ".join(f"{c} AS {c}_ema_{n}" for c in columns for n in spans)
    step = ", ".join(f"{a!r}e0 * n.{c} + (1e0 - {a!r}e0) * e.{c}_ema_{n} AS {c}_ema_{n}" for c in columns for n, a in alpha.items())
    return (f"{name}_p AS (SELECT site, time, {', '.join(columns)}, row_number() OVER ({BY}) AS i FROM {source}),\n"
            f"{name} AS (SELECT site, time, i, {first} FROM {name}_p WHERE i = 1 UNION ALL "
            f"SELECT n.site, n.time, n.i, {step} FROM {name} e JOIN {name}_p n ON n.site = e.site AND n.i = e.i + 1)")


_ST_FRAMES = ",\n".join([
    *[f"lag(sg.{c}, {k}) OVER s AS {c}_lag{k}" for c, k in _ST_LAGS],
    *[f"avg(sg.{c}) OVER w{n} AS {c}_rmean_{label}, coalesce(stddev_samp(sg.{c}) OVER w{n}, 0) AS {c}_rstd_{label}"
      for label, n in config.STATION_WINDOWS.items() for c in _ST],
    *[f"coalesce(sg.{c} - lag(sg.{c}, {k}) OVER s, 0) AS {c}_diff_{label}" for label, k in (("1h", 4), ("24h", 96)) for c in _ST],
    *[_held(c, f"om_{c}", "e") for c in _ST], _held("temperature", "vedas_temperature", "v"), _held("ghi", "vedas_solar_potential", "v")])
_ST_OVER = ", ".join(["s AS (PARTITION BY sg.site ORDER BY sg.time)", *[
    f"w{n} AS (PARTITION BY sg.site ORDER BY sg.time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in config.STATION_WINDOWS.values()]])


@query("WITH RECURSIVE " + sql(
    f"""SELECT site, time, {', '.join(_ST_NAMES)} FROM (SELECT sg.*, {_ST_FRAMES},
  sin(2 * {PI} * (hour(sg.time) + minute(sg.time) / 60e0) / 24) AS hour_sin, cos(2 * {PI} * (hour(sg.time) + minute(sg.time) / 60e0) / 24) AS hour_cos,
  sin(2 * {PI} * dayofyear(sg.time) / 365.25e0) AS doy_sin, cos(2 * {PI} * dayofyear(sg.time) / 365.25e0) AS doy_cos, month(sg.time) AS month,
  CAST(hour(sg.time) >= 6 AND hour(sg.time) < 18 AS BIGINT) AS is_daytime, isodow(sg.time) - 1 AS weekday,
  coalesce(CASE WHEN sg.dhi > 1 THEN sg.ghi / sg.dhi ELSE 0 END, 0) AS ghi_dhi_ratio,
  coalesce(sg.temperature * sg.windspeed / 100, 0) AS temp_wind_interaction, coalesce(sg.cloud_cover * sg.ghi / 1000, 0) AS cloud_ghi_interaction
  FROM sg LEFT JOIN ext e ON e.site = sg.site AND e.time = sg.time
  LEFT JOIN ext v ON v.site = sg.site AND v.time = sg.time - INTERVAL 1 HOUR WINDOW {_ST_OVER}) m
  JOIN (SELECT * EXCLUDE (i) FROM em) em USING (site, time) WHERE {' AND '.join(f'{c}_lag{k} IS NOT NULL' for c, k in _ST_LAGS)}""",
    *_STATION_BASE, sql_emas(_ST, config.STATION_EMA_SPANS, "sg", "em"), doubles=_ST_DOUBLES)[5:])
def feature_matrix_v1(t: Tables):
    """Every row of the station matrix with the targets and all 127 features."""
    external = t.station(second=True).withColumnsRenamed({c: f"om_{c}" for c in _ST})
    # The second source: the outlook of the hour before.
    outlook = t.station(second=True).select("site", (F.col("time") + F.expr("INTERVAL 1 HOUR")).alias("time"),
                                            F.col("temperature").alias("vedas_temperature"), F.col("ghi").alias("vedas_solar_potential"))
    matrix = feats.station_matrix(t.station_grid(), FULL, external, outlook, gapless=True)
    return matrix.select("site", "time", *_ST_NAMES)


_HT = list(config.HOURLY_TARGETS)
_H_SAMPLE = ["temp_lag_1", "ghi_lag_48", "cloud_roll_mean_24", "wind_roll_std_6", "is_daytime", "dow_cos"]
GRID4 = base(sql_obs(_HT), sql_grid(_HT))


@query(sql(f"""SELECT site, time, {', '.join(_H_SAMPLE)} FROM (SELECT *, lag(temperature_2m) OVER ({BY}) AS temp_lag_1,
  lag(shortwave_radiation, 48) OVER ({BY}) AS ghi_lag_48, row_number() OVER ({BY}) AS i,
  {_roll_past('cloud_cover', 24, 'cloud')}, {_roll_past('wind_speed_10m', 6, 'wind')}, {_CYCLE}, {_WEEK},
  CAST({HOUR} >= 6 AND {HOUR} <= 18 AS BIGINT) AS is_daytime FROM grid) WHERE i > 48 AND temperature_2m IS NOT NULL
  AND cloud_cover IS NOT NULL AND wind_speed_10m IS NOT NULL AND shortwave_radiation IS NOT NULL""",
           *GRID4, doubles=["temp_lag_1", "ghi_lag_48", "cloud_roll_mean_24", "wind_roll_std_6", "dow_cos"]))
def feature_matrix_hourly(t: Tables):
    return feats.hourly_matrix(t.grid(_HT), FULL).select("site", "time", *_H_SAMPLE)


_NAMES = feats.hourly_columns()


@query(sql(f"""SELECT position, feature, n FROM (SELECT unnest([{', '.join(f"{{'position': CAST({i} AS BIGINT), 'feature': '{n}'}}"
           for i, n in enumerate(_NAMES))}], recursive := true)), (SELECT count(*) AS n FROM (SELECT *,
  row_number() OVER ({BY}) AS i FROM grid) WHERE i > 48 AND temperature_2m IS NOT NULL AND cloud_cover IS NOT NULL
  AND wind_speed_10m IS NOT NULL AND shortwave_radiation IS NOT NULL)""", *GRID4))
def feature_manifest(t: Tables):
    """Ordered feature names with the rows that have a value."""
    matrix = feats.hourly_matrix(t.grid(_HT), FULL)
    counts = matrix.agg(*[F.count(n).alias(n) for n in _NAMES]).unpivot([], _NAMES, "feature", "n")
    order = F.array_position(F.array(*[F.lit(n) for n in _NAMES]), F.col("feature")) - 1
    return counts.select(order.alias("position"), "feature", "n")


_AHEAD = """pos AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time) AS i,
  count(*) OVER (PARTITION BY site) AS n FROM grid),
cross_ AS (SELECT o.site, o.time, o.i, o.n, CAST(a.i - o.i AS BIGINT) AS horizon, a.time AS target_time,
  {cols} FROM pos o JOIN pos a ON a.site = o.site AND a.i BETWEEN o.i + 1 AND o.i + {h})"""


@query(sql("""SELECT horizon, count(*) AS n, avg(temperature_2m) AS temperature_2m, max(target_time) AS last_target
  FROM cross_ GROUP BY horizon""", *GRID2, _AHEAD.format(cols="a.temperature_2m", h=24), doubles=["temperature_2m"]))
def horizon_cross(t: Tables):
    rows = feats.horizon_cross(t.grid(TWO), FULL, ["temperature_2m"], 24)
    return rows.groupBy("horizon").agg(F.count(F.lit(1)).alias("n"), F.avg("temperature_2m").alias("temperature_2m"),
                                       F.max("target_time").alias("last_target"))


_D_SAMPLE = ["temp_lag_1", "ghi_lag_48", "cloud_roll_mean_24", "wind_roll_std_6", "forecast_horizon_sin", "temperature_2m",
             "hour_sin"]


@query(sql(f"""SELECT c.site, c.horizon, count(*) AS n, {', '.join(f'avg({x}) AS {x}' for x in _D_SAMPLE)} FROM (
  SELECT x.site, x.horizon, f.temp_lag_1, f.ghi_lag_48, f.cloud_roll_mean_24, f.wind_roll_std_6, x.temperature_2m,
    sin(2 * {PI} * x.horizon / 24) AS forecast_horizon_sin,
    sin(2 * {PI} * (hour(x.target_time) + minute(x.target_time) / 60e0) / 24) AS hour_sin
  FROM cross_ x JOIN (SELECT site, i, lag(temperature_2m) OVER ({BY}) AS temp_lag_1,
    lag(shortwave_radiation, 48) OVER ({BY}) AS ghi_lag_48, avg(cloud_cover) {past(24)} AS cloud_roll_mean_24,
    coalesce(stddev_samp(wind_speed_10m) {past(6)}, 0) AS wind_roll_std_6 FROM pos) f ON f.site = x.site AND f.i = x.i
  WHERE x.i > 48 AND x.i <= x.n - 24) c GROUP BY c.site, c.horizon""",
           *GRID4, _AHEAD.format(cols="a.temperature_2m", h=24), doubles=_D_SAMPLE))
def direct_horizon_matrix(t: Tables):
    rows = feats.direct_matrix(t.grid(_HT), FULL, horizon=24)
    return rows.groupBy("site", "horizon").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in _D_SAMPLE])


_STORE = """known AS (SELECT site, max(time) AS k FROM grid WHERE time < TIMESTAMP '2024-01-20 00:00:00' GROUP BY site)"""


@query(sql(f"""SELECT site, time, temperature_2m_lag_4, cloud_cover_roll_mean_4 FROM (SELECT g.site, g.time, k.k,
  lag(temperature_2m, 4) OVER (PARTITION BY g.site ORDER BY g.time) AS temperature_2m_lag_4,
  row_number() OVER (PARTITION BY g.site ORDER BY g.time) AS i, temperature_2m, cloud_cover,
  avg(cloud_cover) OVER (PARTITION BY g.site ORDER BY g.time ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS cloud_cover_roll_mean_4
  FROM grid g LEFT JOIN known k ON k.site = g.site) WHERE (k IS NULL OR time > k) AND i > 4 AND temperature_2m IS NOT NULL
  AND cloud_cover IS NOT NULL""", *GRID2, _STORE, doubles=["temperature_2m_lag_4", "cloud_cover_roll_mean_4"]),
       name="incremental_features")
def incremental(t: Tables):
    """A store filled up to 20 January, then everything newer."""
    observations = t.grid(TWO)
    store = observations.where("time < TIMESTAMP '2024-01-20 00:00:00'").select("site", "time")
    rows = incremental_features(observations, store, FULL, measures=TWO, targets=TWO, lags=(1, 4), windows=(4,))
    return rows.select("site", "time", "temperature_2m_lag_4", "cloud_cover_roll_mean_4")


