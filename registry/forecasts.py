"""Splits, scaling, post-processing and model queries."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from registry.core import (
    EV,
    FULL,
    HOURLY,
    TARGETS,
    Tables,
    base,
    query,
    rounded,
    sql,
    sql_between,
    sql_filled,
    sql_forecast,
    sql_forecast_base,
    sql_grid,
    sql_near,
    sql_obs,
    sql_obs2,
    sql_rounded,
)
from registry.grids import TWO, ts
from registry.storage import _RUNS, training_runs
from skyloom import config
from skyloom.functions.scalar import horizon_bucket as bucket
from skyloom.functions.scalar import site_key, site_lat, site_lon
from skyloom.operators import features as feats
from skyloom.operators import grid as grids
from skyloom.operators import boosting, models, postprocess
from skyloom.operators.aggregates import error_metrics
from skyloom.operators.boosting import Linear, Made
from skyloom.operators.series import Series
from skyloom.operators.tables import top_features
from skyloom.plans import forecast as plans
from skyloom.plans.recursion import feature_order
from skyloom.sources import writers
from skyloom.session import cut_lineage, stored

SNAPSHOT = Series(keys=("site", "issue_time"), time="forecast_time", step=3600, chunk=10 * 86400)
_FC = (sql_forecast_base(), sql_forecast("ml", name="mfc"))


@query(sql("""SELECT site, time, CASE WHEN a < b - INTERVAL 14 DAY THEN time >= b - INTERVAL 14 DAY ELSE i > floor(n * 0.8e0) END
  AS is_validation FROM (SELECT site, time, min(time) OVER (PARTITION BY site) AS a, max(time) OVER (PARTITION BY site) AS b,
    count(*) OVER (PARTITION BY site) AS n, row_number() OVER (PARTITION BY site ORDER BY time) AS i FROM obs)""",
           *base(sql_obs(TWO))))
def temporal_split(t: Tables):
    return models.temporal_split(t.obs(TWO), HOURLY, 14).select("site", "time", "is_validation")


@query(sql("""SELECT site, time, (temperature_2m - m) / CASE WHEN d = 0 THEN 1 ELSE d END AS temperature_2m FROM obs,
  (SELECT avg(temperature_2m) AS m, stddev_pop(temperature_2m) AS d FROM obs WHERE time <= TIMESTAMP '2024-01-20 00:00:00')""",
           *base(sql_obs(["temperature_2m"])), doubles=["temperature_2m"]))
def standard_scale(t: Tables):
    fit = F.col("time") <= ts("2024-01-20 00:00:00")
    return models.standard_scale(t.obs(["temperature_2m"]), ["temperature_2m"], fit)


@query(sql("""SELECT o.site, o.time, 0.55e0 * o.temperature_2m + 0.45e0 * b.temperature_2m AS weighted,
  0.5e0 * o.temperature_2m + 0.5e0 * b.temperature_2m AS voted FROM obs o JOIN obs2 b ON o.site = b.site AND o.time = b.time""",
           *base(sql_obs(["temperature_2m"]), sql_obs2(["temperature_2m"])), doubles=["weighted", "voted"]))
def ensemble_blend(t: Tables):
    second = t.obs2(["temperature_2m"]).withColumnRenamed("temperature_2m", "second")
    rows = t.obs(["temperature_2m"]).join(second, ["site", "time"])
    first, second = F.col("temperature_2m"), F.col("second")
    return rows.select("site", "time", postprocess.ensemble_blend(first, second).alias("weighted"),
                       postprocess.ensemble_blend(first, second, (0.5, 0.5)).alias("voted"))


@query(sql("""SELECT l.lat, l.lon, max(r.trained_at) AS trained_at,
  coalesce(max(r.trained_at) < TIMESTAMP '2001-07-31 12:00:00' - INTERVAL 24 HOUR, TRUE) AS stale
  FROM (SELECT DISTINCT CAST(6 + n_nationkey AS DOUBLE) AS lat, CAST(70 + n_nationkey AS DOUBLE) AS lon FROM nation) l
  LEFT JOIN runs r ON r.lat = l.lat AND r.lon = l.lon GROUP BY l.lat, l.lon""", _RUNS, doubles=["lat", "lon"]))
def model_staleness(t: Tables):
    places = t.raw("nation").select((F.lit(6.0) + F.col("n_nationkey")).alias("lat"), (F.lit(70.0) + F.col("n_nationkey")).alias("lon"))
    return models.model_staleness(places, training_runs(t), ts("2001-07-31 12:00:00"))


_AL = ["temperature_2m"]


@query(sql(f"""SELECT site, time, issue_time, step, CASE WHEN temperature_2m IS NOT NULL THEN temperature_2m
  WHEN pv_temperature_2m IS NULL THEN nv_temperature_2m WHEN nv_temperature_2m IS NULL THEN pv_temperature_2m
  ELSE {sql_between('temperature_2m')} END AS temperature_2m FROM n""", sql_forecast_base(_AL), sql_forecast("provider", _AL),
           """lastobs AS (SELECT site, max(time) AS l FROM lobs WHERE time < TIMESTAMP '2024-01-25 00:00:00' GROUP BY site),
           iss AS (SELECT site, max(issue_time) AS issue_time FROM fc GROUP BY site),
           g AS (SELECT l.site, i.issue_time, CAST(s AS BIGINT) AS step, l.l + to_hours(CAST(s + 1 AS INTEGER)) AS time FROM lastobs l
             JOIN iss i ON i.site = l.site CROSS JOIN (SELECT unnest(generate_series(0, 287)) AS s)),
           gj AS (SELECT g.*, f.temperature_2m FROM g LEFT JOIN fc f ON f.site = g.site AND f.issue_time = g.issue_time
             AND f.forecast_time = g.time)""", sql_near(_AL, "gj", "n"), doubles=_AL))
def provider_align(t: Tables):
    before = t.obs(_AL).where(F.col("time") < ts("2024-01-25 00:00:00"))
    rows = postprocess.provider_align(t.forecast("provider", _AL), before, HOURLY, _AL, 288)
    return rows.select("site", "time", "issue_time", "step", *_AL)


def _bound(target: str, value: str, night: str) -> str:
    if target in ("shortwave_radiation", "diffuse_radiation"):
        return f"CASE WHEN {value} IS NULL THEN NULL WHEN {night} THEN 0e0 ELSE greatest(0e0, {value}) END"
    if target == "cloud_cover":
        return f"CASE WHEN {value} IS NOT NULL THEN greatest(0e0, least(100e0, {value})) END"
    if target == "wind_speed_10m":
        return f"CASE WHEN {value} IS NOT NULL THEN greatest(0e0, {value}) END"
    return value


_NIGHT = "(hour(forecast_time) < 5 OR hour(forecast_time) > 19)"
_LOW = ", ".join(f"{c} - 40e0 AS {c}" for c in TARGETS)


def lowered(t: Tables):
    """ML snapshots shifted down so that every limit is crossed somewhere."""
    return t.forecast("ml").withColumns({c: F.col(c) - F.lit(40.0) for c in TARGETS})


@query(sql(f"SELECT site, issue_time, forecast_time, {', '.join(f'{_bound(c, c, _NIGHT)} AS {c}' for c in TARGETS)} FROM low",
           *_FC, f"low AS (SELECT site, issue_time, forecast_time, {_LOW} FROM mfc)", doubles=TARGETS))
def physical_constraints(t: Tables):
    return postprocess.physical_constraints(lowered(t)).select("site", "issue_time", "forecast_time", *TARGETS)


@query(sql("""SELECT site, issue_time, forecast_time, CASE WHEN p IS NULL THEN m ELSE p + 0.7e0 * exp(-3 * (step / 71e0)) * (m - p)
  END AS temperature_2m FROM (SELECT m.site, m.issue_time, m.forecast_time, p.temperature_2m AS p, m.temperature_2m AS m,
    (epoch_us(m.forecast_time) - epoch_us(m.issue_time)) / 3600000000e0 AS step FROM mfc m LEFT JOIN pfc p ON p.site = m.site
    AND p.issue_time = m.issue_time AND p.forecast_time = m.forecast_time)""", *_FC, sql_forecast("provider", name="pfc"),
           doubles=["temperature_2m"]))
def provider_blend(t: Tables):
    key = ["site", "issue_time", "forecast_time"]
    provider = t.forecast("provider", _AL).select(*key, F.col("temperature_2m").alias("provider_temperature_2m"))
    rows = t.forecast("ml", _AL).join(provider, key, "left")
    rows = rows.withColumn("step", (F.unix_micros("forecast_time") - F.unix_micros("issue_time")) / F.lit(3600e6))
    return postprocess.provider_blend(rows, "step", 72, _AL).select(*key, "temperature_2m")


_STEPS = f"""stp AS (SELECT site, issue_time, forecast_time, {_LOW}, row_number() OVER (PARTITION BY site, issue_time
  ORDER BY forecast_time) AS i FROM mfc)"""


def _walk(c: str) -> str:
    limit = config.STEP_LIMITS[c]
    moved = f"greatest(w.{c} - {limit}e0, least(w.{c} + {limit}e0, s.{c}))"
    night = _NIGHT.replace("forecast_time", "s.forecast_time")
    fresh = _bound(c, f"s.{c}", night)
    return f"""CASE WHEN s.{c} IS NULL OR w.{c} IS NULL THEN coalesce({fresh}, w.{c}) ELSE {_bound(c, moved, night)} END"""


@query("WITH RECURSIVE " + sql(
    f"""SELECT k.site, k.issue_time, k.forecast_time, {', '.join(f'CASE WHEN s.{c} IS NOT NULL THEN k.{c} END AS {c}' for c in TARGETS)}
  FROM walk k JOIN stp s ON s.site = k.site AND s.issue_time = k.issue_time AND s.i = k.i""", *_FC, _STEPS,
    f"""walk AS (SELECT site, issue_time, forecast_time, i, {', '.join(f'{_bound(c, c, _NIGHT)} AS {c}' for c in TARGETS)} FROM stp
      WHERE i = 1 UNION ALL SELECT s.site, s.issue_time, s.forecast_time, s.i, {', '.join(f'{_walk(c)} AS {c}' for c in TARGETS)}
      FROM walk w JOIN stp s ON s.site = w.site AND s.issue_time = w.issue_time AND s.i = w.i + 1)""", doubles=TARGETS)[5:])
def rate_limit(t: Tables):
    rows = lowered(t).select("site", "issue_time", "forecast_time", *TARGETS)
    return postprocess.rate_limit(rows, ["site", "issue_time"])


@query(sql("""SELECT o.site, o.time, CASE WHEN b.temperature_2m IS NULL THEN o.temperature_2m ELSE 0.7e0 * o.temperature_2m
  + 0.3e0 * b.temperature_2m END AS temperature_2m FROM obs o LEFT JOIN obs2 b ON o.site = b.site AND o.time = b.time""",
           *base(sql_obs(_AL), sql_obs2(_AL)), doubles=_AL))
def inertia_feedback(t: Tables):
    seed = t.obs2(_AL).withColumnRenamed("temperature_2m", "seed")
    rows = t.obs(_AL).join(seed, ["site", "time"], "left")
    return rows.select("site", "time", postprocess.feedback(F.col("temperature_2m"), F.col("seed")).alias("temperature_2m"))


def _smooth(c: str, window: int, sigma: float, part: str) -> str:
    half, over = window // 2, f"OVER (PARTITION BY {part} ORDER BY forecast_time)"
    x = {k: (f"lag({c}, {-k}) {over}" if k < 0 else f"lead({c}, {k}) {over}" if k else c) for k in range(-half, half + 1)}
    wt = {k: f"{math.exp(-0.5 * (k / sigma) ** 2)!r}e0" if 'e' not in repr(math.exp(-0.5 * (k / sigma) ** 2))
          else repr(math.exp(-0.5 * (k / sigma) ** 2)) for k in x}
    top = " + ".join(f"coalesce({x[k]} * {wt[k]}, 0)" for k in x)
    bottom = " + ".join(f"CASE WHEN {x[k]} IS NOT NULL THEN {wt[k]} ELSE 0 END" for k in x)
    return f"CASE WHEN ({bottom}) > 0 THEN ({top}) / ({bottom}) END AS {c}"


@query(sql(f"SELECT site, issue_time, forecast_time, {', '.join(_smooth(c, 11, 3.0, 'site, issue_time') for c in TWO)} FROM mfc",
           sql_forecast_base(TWO), sql_forecast("ml", TWO, "mfc"), doubles=TWO))
def gaussian_smooth(t: Tables):
    rows = t.forecast("ml", TWO).select("site", "issue_time", "forecast_time", *TWO)
    return postprocess.gaussian_smooth(rows, SNAPSHOT, TWO)


@query(sql(" UNION ALL ".join(f"SELECT issue_time, forecast_time, site, '{c}' AS target, {c} AS predicted_value, model_version FROM mfc"
                              for c in TARGETS), *_FC, doubles=["predicted_value"]))
def forecast_to_long(t: Tables):
    return postprocess.forecast_to_long(t.forecast("ml").drop("lat", "lon"))


_EV4 = {"temperature_2m": "temp", "cloud_cover": "cloud", "wind_speed_10m": "wind", "shortwave_radiation": "ghi"}


@query(sql(" UNION ALL ".join(f"""SELECT o.site, o.time, '{c}' AS variable, o.{c} AS actual, b.{c} AS predicted,
  o.{c} - b.{c} AS residual FROM obs o JOIN obs2 b ON o.site = b.site AND o.time = b.time""" for c in _EV4),
           *base(sql_obs(list(_EV4)), sql_obs2(list(_EV4))), doubles=["actual", "predicted", "residual"]))
def evaluation_long(t: Tables):
    actual = t.obs(list(_EV4)).select("site", "time", *[F.col(c).alias(f"actual_{a}") for c, a in _EV4.items()])
    predicted = t.obs2(list(_EV4)).select("site", "time", *[F.col(c).alias(f"predicted_{a}") for c, a in _EV4.items()])
    return postprocess.evaluation_long(actual.join(predicted, ["site", "time"]), keys=["site"])


@query(sql("""SELECT site, issue_time, forecast_time, CASE WHEN h <= 0 THEN NULL WHEN h <= 24 THEN '24h' WHEN h <= 48 THEN '48h'
  WHEN h <= 72 THEN '72h' END AS horizon FROM (SELECT *, (epoch_us(forecast_time) - epoch_us(issue_time)) / 3600000000e0 AS h FROM mfc)""",
           *_FC))
def horizon_bucket(t: Tables):
    return t.forecast("ml", _AL).select("site", "issue_time", "forecast_time", bucket("issue_time", "forecast_time").alias("horizon"))


@query(sql(f"""SELECT site, issue_time, a AS gap_start, b AS gap_end FROM (SELECT site, issue_time, min(t) AS a, max(t) AS b FROM (
  SELECT e.site, e.issue_time, e.t, e.t - to_hours(CAST(row_number() OVER (PARTITION BY e.site, e.issue_time ORDER BY e.t) AS INTEGER)) AS g
  FROM (SELECT site, issue_time, unnest(generate_series(TIMESTAMP '2024-01-05 01:00:00', TIMESTAMP '2024-01-08 00:00:00', INTERVAL 1 HOUR))
    AS t FROM (SELECT DISTINCT site, issue_time FROM fc WHERE issue_time = TIMESTAMP '2024-01-05 00:00:00')) e
  LEFT JOIN fc f ON f.site = e.site AND f.issue_time = e.issue_time AND f.forecast_time = e.t WHERE f.site IS NULL)
  GROUP BY site, issue_time, g)""", sql_forecast_base(_AL), sql_forecast("provider", _AL)))
def forecast_gap_ranges(t: Tables):
    issue = ts("2024-01-05 00:00:00")
    rows = t.forecast("provider", _AL).where(F.col("issue_time") == issue)
    return grids.gap_ranges(rows, SNAPSHOT, ts("2024-01-05 01:00:00"), ts("2024-01-08 00:00:00"), locations=rows)


_BY_HORIZON = " UNION ALL ".join(f"""SELECT '{c}' AS target, f.model_version, (epoch_us(f.forecast_time) - epoch_us(f.issue_time)) / 3600000000e0 AS h,
  o.{c} AS actual, f.{c} AS predicted FROM mfc f JOIN ob o ON o.site = f.site AND o.time = f.forecast_time
  WHERE o.{c} IS NOT NULL AND f.{c} IS NOT NULL""" for c in TARGETS)


@query(sql("""SELECT target, model_version, horizon, count(*) AS n, avg(abs(actual - predicted)) AS mae, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
  CASE WHEN var_pop(actual) > 0 THEN 1 - sum(pow(actual - predicted, 2)) / (var_pop(actual) * count(*)) END AS r2 FROM (SELECT *, CASE WHEN h <= 0 THEN NULL
  WHEN h <= 24 THEN '24h' WHEN h <= 48 THEN '48h' WHEN h <= 72 THEN '72h' END AS horizon FROM pairs) GROUP BY target, model_version, horizon""",
           *_FC, sql_obs(TARGETS, name="ob"), f"pairs AS ({_BY_HORIZON})", doubles=["mae", "rmse", "r2"]))
def metrics_by_horizon(t: Tables):
    """Errors of every target, model version and forecast horizon against what was observed."""
    rows = t.forecast("ml").withColumnsRenamed({c: f"p_{c}" for c in TARGETS}).withColumn("horizon", bucket("issue_time", "forecast_time"))
    both = rows.join(t.obs(TARGETS).withColumnRenamed("time", "forecast_time"), ["site", "forecast_time"])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("actual"), F.col(f"p_{c}").alias("predicted")) for c in TARGETS]))
    return error_metrics(both.select("model_version", "horizon", cells.alias("x")).select("model_version", "horizon", "x.*"), "actual", "predicted",
                         ["target", "model_version", "horizon"])


# ---- model jobs ----------------------------------------------------------

_HT = list(config.HOURLY_TARGETS)
_DIRECT = feats.hourly_columns(horizon=True)
_BASE = feats.hourly_columns()
_CUT = "2024-01-20 00:00:00"


def _observed(t: Tables):
    """All measures of both providers."""
    return t.obs().join(t.obs2(), ["site", "time"], "full")


def _linear(names: list[str], weights: dict[str, float]) -> Linear:
    """A model of given coefficients. Forecasts take fitted models as input; fitting has queries of its own."""
    values = np.zeros(len(names))
    for name, weight in weights.items():
        values[names.index(name)] = weight
    return Linear(values, 0.2)


def _weighed(weights: dict[str, float], values: dict[str, str]) -> str:
    return " + ".join(["0.2e0", *[f"{w}e0 * coalesce({values[n]}, 0)" for n, w in weights.items()]])


# ---- the recursion, with a recursive twin

_SIX = [*TARGETS, "wind_direction_10m"]


def _step_weights(c: str) -> dict[str, float]:
    return {f"{c}_lag_1": 0.6, f"{c}_lag_192": 0.15, f"{c}_roll_mean_96": 0.1, f"{c}_roll_std_16": 0.05, "hour_sin": 0.5,
            "is_weekend": 0.25, "wind_direction_cos_lag1": 0.3}


def _step_models() -> dict[str, Linear]:
    return {c: _linear(feature_order(), _step_weights(c)) for c in TARGETS}


def _step_sql(c: str) -> tuple[str, str]:
    """The value that a step publishes and the one it feeds back."""
    h = f"r.h_{c}"
    mean, std = f"list_slice({h}, 97, 192)", f"list_slice({h}, 177, 192)"
    values = {f"{c}_lag_1": f"{h}[192]", f"{c}_lag_192": f"{h}[1]",
              f"{c}_roll_mean_96": f"CASE WHEN list_aggregate({mean}, 'count') >= 48 THEN list_avg({mean}) END",
              f"{c}_roll_std_16": f"CASE WHEN list_aggregate({std}, 'count') >= 8 THEN list_aggregate({std}, 'stddev_samp') END",
              "hour_sin": "s.hour_sin", "is_weekend": "s.is_weekend",
              "wind_direction_cos_lag1": "cos(radians(coalesce(r.h_wind_direction_10m[192], 0)))"}
    ml = _bound(c, f"({_weighed(_step_weights(c), values)})", "s.night")
    mixed = f"(CASE WHEN s.{c} IS NULL THEN {ml} ELSE s.{c} + s.w * ({ml} - s.{c}) END)"
    most = config.STEP_LIMITS[c]
    held = f"(CASE WHEN r.{c} IS NULL THEN {mixed} ELSE greatest(r.{c} - {most}e0, least(r.{c} + {most}e0, {mixed})) END)"
    return _bound(c, held, "s.night"), f"CASE WHEN s_{c} IS NULL THEN v_{c} ELSE 0.7e0 * v_{c} + 0.3e0 * s_{c} END"


def _recursion_sql() -> tuple[str, ...]:
    """CTEs up to ``steps``: the published values of every location and step."""
    six = ", ".join(_SIX)
    fed = ", ".join(f"list_append(list_slice(h_{c}, 2, 192), coalesce({_step_sql(c)[1] if c in TARGETS else f's_{c}'}, h_{c}[192])) AS h_{c}" for c in _SIX)
    return (sql_obs(_SIX), sql_obs2(), sql_forecast_base(_SIX)[len(EV) + 2:], sql_forecast("provider", _SIX),
            """ends AS (SELECT site, min(time) AS a, max(time) AS b FROM (SELECT site, time FROM obs UNION ALL SELECT site, time FROM obs2) GROUP BY site)""",
            """places AS (SELECT site, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time, b FROM ends)""",
            f"placed AS (SELECT p.site, p.time, p.b, {', '.join(f'o.{c}' for c in _SIX)} FROM places p LEFT JOIN obs o ON o.site = p.site AND o.time = p.time)",
            sql_near(_SIX, "placed", "nearest"),
            f"""past AS (SELECT site, time, b, {', '.join(f'coalesce(pv_{c}, nv_{c}) AS {c}' for c in _SIX)} FROM nearest)""",
            f"""began AS (SELECT e.site, {', '.join(f"list(p.{c} ORDER BY k) AS h_{c}" for c in _SIX)} FROM
              (SELECT site, b, unnest(generate_series(0, 191)) AS k FROM ends) e
              LEFT JOIN past p ON p.site = e.site AND p.time = e.b - to_hours(CAST(191 - e.k AS INTEGER)) GROUP BY e.site)""",
            "iss AS (SELECT site, max(issue_time) AS issue_time FROM fc GROUP BY site)",
            """ahead AS (SELECT l.site, i.issue_time, CAST(s AS BIGINT) AS step, l.b + to_hours(CAST(s + 1 AS INTEGER)) AS time FROM ends l
              JOIN iss i ON i.site = l.site CROSS JOIN (SELECT unnest(generate_series(0, 287)) AS s))""",
            f"""aj AS (SELECT g.*, {', '.join(f'f.{c}' for c in _SIX)} FROM ahead g LEFT JOIN fc f ON f.site = g.site AND f.issue_time = g.issue_time
              AND f.forecast_time = g.time)""", sql_near(_SIX, "aj", "an"),
            f"""seeds AS (SELECT site, issue_time, step, time, {', '.join(f'{sql_filled(c)} AS {c}' for c in _SIX)},
              sin(2 * {math.pi!r}e0 * hour(time) / 24) AS hour_sin, CASE WHEN isodow(time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
              (hour(time) < 5 OR hour(time) > 19) AS night, 0.7e0 * exp(-3e0 * step / 287) AS w FROM an)""",
            f"""steps AS (SELECT site, CAST(-1 AS BIGINT) AS step, NULL::TIMESTAMP AS issue_time, NULL::TIMESTAMP AS forecast_time,
              {', '.join(f'NULL::DOUBLE AS {c}' for c in TARGETS)}, {', '.join(f'h_{c}' for c in _SIX)} FROM began
            UNION ALL SELECT site, step, issue_time, time, {', '.join(f'v_{c}' for c in TARGETS)}, {fed} FROM
              (SELECT s.site, s.step, s.issue_time, s.time, {', '.join(f'{_step_sql(c)[0]} AS v_{c}' for c in TARGETS)},
                {', '.join(f's.{c} AS s_{c}' for c in _SIX)}, {', '.join(f'r.h_{c}' for c in _SIX)}
              FROM steps r JOIN seeds s ON s.site = r.site AND s.step = r.step + 1))""")


def _three(names: list[str]) -> str:
    """Three digits: a recursion of 288 steps adds up the last bits of two engines."""
    return ", ".join(f"{sql_rounded(c, 3)} AS {c}" for c in names)


def _recursive(body: str, *more: str) -> str:
    return "WITH RECURSIVE " + sql(body, EV, *_recursion_sql(), *more)[5:]


@query(_recursive(f"SELECT site, issue_time, forecast_time, step, {_three(TARGETS)} FROM steps WHERE step >= 0"))
def recursive_forecast(t: Tables):
    """288 steps, all measures, lags and windows, of models with given coefficients."""
    history, _ = stored(feats.imputed_grid(_observed(t), HOURLY), "history")
    aligned, _ = stored(postprocess.provider_align(t.forecast("provider", config.PROVIDER_MEASURES), history, HOURLY, config.MEASURES), "aligned")
    rows = plans.recursive_forecast(history, aligned, HOURLY, _step_models(), measures=config.MEASURES)
    return rows.select("site", "issue_time", "forecast_time", "step", *[rounded(c, 3).alias(c) for c in TARGETS])


def _limited_sql(names: list[str]) -> str:
    return ", ".join(f"{_bound(c, c, _NIGHT)} AS {c}" for c in names)


@query(_recursive(f"SELECT site, issue_time, forecast_time, 'v1' AS model_version, {_three(TARGETS)} FROM (SELECT site, issue_time, forecast_time, {_limited_sql(TARGETS)} FROM smooth)",
                  f"""smooth AS (SELECT site, issue_time, forecast_time, step, {', '.join(_smooth(c, 11, 3.0, 'site, issue_time') for c in TARGETS)}
                    FROM steps WHERE step >= 0)"""))
def on_demand_cycle(t: Tables):
    """The whole cycle of all locations with current models (``train_regressors`` and the tests fit them), stored and read back."""
    runs = _observed(t).select("site", F.lit("2024-02-04 12:00:00").cast("timestamp").alias("trained_at")).distinct()
    made = plans.cycle(_observed(t), t.forecast("provider", config.PROVIDER_MEASURES), runs, HOURLY, ts("2024-02-05 00:00:00"),
                       measures=config.MEASURES, models=_step_models())
    folder = t.work("cycle")
    for _ in range(2):  # a cycle that is run again replaces its own rows
        writers.store_forecast(made.forecast, None, folder, "v1", "boosted", site_lat("site"), site_lon("site"), TARGETS)
    stored = t.spark.read.parquet(f"{folder}/forecasts")
    return stored.select(site_key("lat", "lon").alias("site"), "issue_time", "forecast_time", "model_version", *[rounded(c, 3).alias(c) for c in TARGETS])


# ---- the direct forecast

def _direct_weights(a: str) -> dict[str, float]:
    return {f"{a}_lag_1": 0.6, f"{a}_lag_48": 0.05, f"{a}_roll_mean_24": 0.2, f"{a}_roll_std_6": 0.1, "forecast_horizon": 0.3,
            "forecast_horizon_sin": 0.5, "hour_sin": 0.25}


def _direct_sql() -> tuple[str, ...]:
    by, pi = "PARTITION BY site ORDER BY time", f"{math.pi!r}e0"
    past = "OVER (" + by + " ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    own, found, four = [], [], config.HOURLY_TARGETS
    for c, a in four.items():
        own += [f"lag({c}) OVER ({by}) AS {a}_lag_1", f"lag({c}, 48) OVER ({by}) AS {a}_lag_48", f"avg({c}) {past.format(n=24)} AS {a}_roll_mean_24",
                f"coalesce(stddev_samp({c}) {past.format(n=6)}, 0) AS {a}_roll_std_6"]
        names = {n: f"o.{n}" for n in _direct_weights(a) if n.startswith(a)}
        names |= {"forecast_horizon": "(x.i - o.i + 1) / 24e0", "forecast_horizon_sin": f"sin(2 * {pi} * (x.i - o.i + 1) / 24)",
                  "hour_sin": f"sin(2 * {pi} * hour(x.time) / 24)"}
        found.append(f"{_weighed(_direct_weights(a), names)} AS p_{a}")
    bound = {a: _bound(c, f"p_{a}", _NIGHT) for c, a in four.items()}
    smooth = {a: _smooth(f"p_{a}", 5, 1.5, "site") for a in four.values()}
    return (f"known AS (SELECT * FROM grid WHERE {' AND '.join(f'{c} IS NOT NULL' for c in four)})",
            f"""pos AS (SELECT *, row_number() OVER ({by}) AS i, lag(time) OVER ({by}) AS before, {', '.join(own)} FROM known)""",
            f"""raw AS (SELECT o.site, x.time AS forecast_time, {', '.join(f'x.{c} AS actual_{a}' for c, a in four.items())}, {', '.join(found)}
              FROM pos o JOIN pos x ON x.site = o.site AND x.i BETWEEN o.i AND o.i + 23 AND CAST(x.time AS DATE) = CAST(o.time AS DATE)
              WHERE o.i > 48 AND CAST(o.before AS DATE) < CAST(o.time AS DATE) AND x.time >= TIMESTAMP '{_CUT}')""",
            f"low AS (SELECT * REPLACE ({', '.join(f'{b} AS p_{a}' for a, b in bound.items())}) FROM raw)",
            f"smooth AS (SELECT * REPLACE ({', '.join(smooth.values())}) FROM low)",
            f"direct AS (SELECT site, forecast_time AS time, {', '.join(f'actual_{a}, {bound[a]} AS predicted_{a}' for a in four.values())} FROM smooth)")


_DIRECT_COLUMNS = [f"{kind}_{a}" for kind in ("actual", "predicted") for a in config.HOURLY_TARGETS.values()]


@query(sql("SELECT * FROM direct", *base(sql_obs(_HT), sql_grid(_HT)), *_direct_sql(), doubles=_DIRECT_COLUMNS))
def direct_forecast(t: Tables):
    """Every hour from the rows before its day, for all days from 20 January on."""
    observations = cut_lineage(t.grid(_HT).dropna(how="any", subset=_HT))
    fixed = {c: _linear(_DIRECT, _direct_weights(a)) for c, a in config.HOURLY_TARGETS.items()}
    return plans.direct_forecast(observations, FULL, fixed, since=ts(_CUT))


# ---- fits: row counts and what any sound fit satisfies have a twin; the scores themselves do not

def _parts(t: Tables):
    """Training and held-out rows of the hourly matrix, made where they are fitted and scored."""
    rows = Made(t.grid(_HT), FULL, feats.hourly_matrix, max(*config.HOURLY_LAGS, *config.HOURLY_WINDOWS))
    return models.fixed_split(rows, "time", ts(_CUT))


_FIT_ROWS = (*base(sql_obs(_HT), sql_grid(_HT)),
             f"""fit_rows AS (SELECT site, time <= TIMESTAMP '{_CUT}' AS training FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time) AS i FROM grid)
               WHERE i > 48 AND {' AND '.join(f'{c} IS NOT NULL' for c in _HT)})""",
             f"targets AS (SELECT unnest([{', '.join(repr(c) for c in _HT)}]) AS target)",
             "sizes AS (SELECT count(*) FILTER (WHERE training) AS train_rows, count(*) FILTER (WHERE NOT training) AS held_rows FROM fit_rows)")


@query(sql("SELECT target, train_rows, held_rows, TRUE AS bounded, TRUE AS better_than_mean FROM targets, sizes", *_FIT_ROWS))
def train_regressors(t: Tables):
    """350 rounds per group of locations and target: rows used, R2 at most 1, and an error below that of the training mean."""
    train, test = _parts(t)
    fitted = models.train_regressors(train, HOURLY, _BASE, _HT)
    used = fitted.table.groupBy("target").agg(F.sum("train_rows").alias("train_rows"),
                                              (F.sum(F.col("base") * F.col("train_rows")) / F.sum("train_rows")).alias("mean"))  # a base is the mean of its group
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(c).alias("actual")) for c in _HT])).alias("p")
    flat = test.rows().select(pairs).select("p.*").join(F.broadcast(used.select("target", "mean")), "target")
    flat = error_metrics(flat, "actual", "mean", ["target"]).select("target", F.col("rmse").alias("flat"))
    used = used.drop("mean")
    found = models.scores(test, fitted, _BASE, _HT).join(used, "target").join(flat, "target")
    return found.select("target", "train_rows", F.col("n").alias("held_rows"), (F.col("r2") <= 1).alias("bounded"),
                        (F.col("rmse") < F.col("flat")).alias("better_than_mean"))


_GRID = [boosting.Settings(depth=depth, rate=rate) for depth in (3, 5) for rate in (0.03, 0.1)]


@query(sql(f"SELECT target, parameters, held_rows, TRUE AS sound FROM targets, sizes, (SELECT unnest([{', '.join(repr(models.described(g)) for g in _GRID)}]) AS parameters)",
           *_FIT_ROWS))
def hyperparameter_search(t: Tables):
    """Four settings of 350 rounds; the best setting of a target is no worse than the others and errors are finite."""
    train, test = _parts(t)
    found = models.hyperparameter_search(train, test, HOURLY, _BASE, _HT, _GRID)
    return found.select("target", "parameters", F.col("n").alias("held_rows"), (F.col("mae") <= F.col("rmse")).alias("sound"))


@query(sql(f"SELECT target, CAST({len(_BASE)} AS BIGINT) AS features, 1e0 AS total, TRUE AS sound FROM targets", *_FIT_ROWS, doubles=["total"]))
def feature_importance(t: Tables):
    """Gain shares of all features and the 15 best: they sum to 1 and the best hold more than an even share."""
    train, _ = _parts(t)
    shares = cut_lineage(boosting.importances(models.train_regressors(train, HOURLY, _BASE, _HT)))
    best = top_features(shares).groupBy("target").agg(F.sum("importance").alias("best"), F.min("importance").alias("least"))
    return (shares.groupBy("target").agg(F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total")).join(best, "target")
            .select("target", "features", "total", ((F.col("best") > 15 / len(_BASE)) & (F.col("least") >= 0)).alias("sound")))


@query(sql("SELECT target, TRUE AS passed, TRUE AS destroyed FROM targets", *_FIT_ROWS))
def leak_test_shuffle(t: Tables):
    """A target permuted over all rows is not learned, and losing it costs R2."""
    train, test = _parts(t)
    found = models.leak_test_shuffle(train, test, HOURLY, _BASE, _HT)
    return found.select("target", "passed", (F.col("r2_shuffled") < 0.05).alias("destroyed"))


@query(sql("SELECT target, TRUE AS bounded FROM targets", *_FIT_ROWS))
def leak_test_realism(t: Tables):
    """Held-out R2 against the limit above which it is too good to be true."""
    train, test = _parts(t)
    found = models.leak_test_realism(train, test, HOURLY, _BASE, _HT)
    return found.select("target", ((F.col("r2") < 0.99) == F.col("passed")).alias("bounded"))
