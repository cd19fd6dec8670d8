"""Time-grid queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.core import (
    DAY,
    EV,
    FULL,
    HOURLY,
    QUARTER,
    SQL_QUARTER_MEAN,
    TARGETS,
    Tables,
    base,
    query,
    sql,
    sql_filled,
    sql_grid,
    sql_near,
    sql_obs,
    sql_obs2,
    sql_points,
)
from skyloom.functions.scalar import window_end
from skyloom.operators import grid
from skyloom.operators.series import Series, dedupe
from skyloom.plans.observations import backfill
from skyloom.sources.landing import plan_year_chunks

TWO = ["temperature_2m", "cloud_cover"]
START, END = "2024-01-02 00:00:00", "2024-01-29 21:00:00"


def ts(text: str):
    return F.lit(text).cast("timestamp")


@query(sql("SELECT site, time FROM g", EV, sql_obs(TWO), sql_points("obs", "g")))
def time_grid(t: Tables):
    return grid.time_grid(grid.spans_of(t.obs(TWO), HOURLY), HOURLY)


@query(sql("SELECT site, time, temperature_2m, cloud_cover FROM grid", *base(
    sql_obs(TWO), sql_grid(TWO, step="15 MINUTE")), doubles=TWO))
def upsample_asfreq(t: Tables):
    return grid.upsample(t.obs(TWO), Series(step=900, chunk=10 * DAY), TWO)


@query(sql("SELECT * FROM grid", *base(sql_obs(TARGETS), sql_grid(TARGETS)), doubles=TARGETS))
def ensure_full_grid(t: Tables):
    return grid.complete_grid(t.obs(TARGETS), HOURLY, TARGETS)


_RANGE = f"""rng AS (SELECT * FROM obs WHERE time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'),
rgg AS (SELECT site, unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS time
  FROM (SELECT DISTINCT site FROM rng)),
rj AS (SELECT g.site, g.time, o.temperature_2m, o.cloud_cover FROM rgg g LEFT JOIN rng o
  ON o.site = g.site AND o.time = g.time)"""


@query(sql(f"SELECT site, time, {', '.join(f'{sql_filled(c)} AS {c}' for c in TWO)} FROM rn", *base(
    sql_obs(TWO), _RANGE, sql_near(TWO, "rj", "rn")), doubles=TWO))
def ensure_full_grid_in_range(t: Tables):
    return grid.complete_grid(t.obs(TWO), HOURLY, TWO, start=ts(START), end=ts(END))


_DUPES = "dup AS (SELECT *, 1 AS seq FROM obs UNION ALL SELECT *, 2 AS seq FROM obs2)"


def dupes(t: Tables, columns=TWO):
    return t.obs(columns).withColumn("seq", F.lit(1)).unionByName(
        t.obs2(columns).withColumn("seq", F.lit(2)))


def _kept(order: str) -> str:
    return sql(f"""SELECT site, time, temperature_2m, cloud_cover FROM (SELECT *, row_number() OVER (
      PARTITION BY site, time ORDER BY seq {order}) AS rn FROM dup) WHERE rn = 1""",
               *base(sql_obs(TWO), sql_obs2(TWO), _DUPES), doubles=TWO)


@query(_kept("DESC"))
def dedupe_time(t: Tables):
    return dedupe(dupes(t), ["site", "time"], "seq").drop("seq")


@query(_kept("ASC"))
def dedupe_time_first(t: Tables):
    return dedupe(dupes(t), ["site", "time"], "seq", keep="first").drop("seq")


def _near(expression) -> str:
    items = ", ".join(f"{expression(c)} AS {c}" for c in TWO)
    return sql(f"SELECT site, time, {items} FROM n", *base(sql_obs(TWO), sql_near(TWO, "obs", "n")), doubles=TWO)


@query(_near(lambda c: f"CASE WHEN pv_{c} IS NULL THEN NULL ELSE {sql_filled(c)} END"))
def interpolate_time(t: Tables):
    return grid.interpolate_time(t.obs(TWO), HOURLY, TWO)


@query(_near(lambda c: f"pv_{c}"))
def ffill(t: Tables):
    return grid.ffill(t.obs(TWO), HOURLY, TWO)


@query(_near(lambda c: f"nv_{c}"))
def bfill(t: Tables):
    return grid.bfill(t.obs(TWO), HOURLY, TWO)


@query(sql("""SELECT site, time, last_value(temperature_2m IGNORE NULLS) OVER r AS temperature_2m,
  last_value(cloud_cover IGNORE NULLS) OVER r AS cloud_cover FROM obs
  WINDOW r AS (PARTITION BY site ORDER BY time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
           *base(sql_obs(TWO)), doubles=TWO))
def ffill_limit(t: Tables):
    return grid.ffill_limit(t.obs(TWO), HOURLY, TWO, 4)


_LIMITED = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN NULL
  WHEN epoch_us(time) - epoch_us(pt_{c}) > 8 * 3600000000 THEN NULL ELSE {sql_filled(c)} END AS {c}""" for c in TWO)


@query(sql(f"SELECT site, time, {_LIMITED} FROM jn", *base(sql_obs(TWO), sql_grid(TWO).replace(
    "grid_n AS", "jn AS").split("grid AS")[0].rstrip().rstrip(",")), doubles=TWO))
def interpolate_limit(t: Tables):
    holes = grid.complete_grid(t.obs(TWO), HOURLY, TWO, fill="none")
    return grid.interpolate_limit(holes, FULL, TWO, 8)


_ROWS = """pos AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time) AS i FROM obs),
rown AS (SELECT *, last_value(CASE WHEN temperature_2m IS NOT NULL THEN i END IGNORE NULLS) OVER p AS pi,
  last_value(temperature_2m IGNORE NULLS) OVER p AS pv, first_value(CASE WHEN temperature_2m IS NOT NULL THEN i END
  IGNORE NULLS) OVER f AS ni, first_value(temperature_2m IGNORE NULLS) OVER f AS nv FROM {src}
  WINDOW p AS (PARTITION BY site ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  f AS (PARTITION BY site ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_ROW_VALUE = """CASE WHEN temperature_2m IS NOT NULL THEN temperature_2m WHEN pv IS NULL OR i - pi > {n} THEN NULL
  WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (CAST(i - pi AS DOUBLE) / CAST(ni - pi AS DOUBLE)) END"""


@query(sql(f"SELECT site, time, {_ROW_VALUE.format(n=12)} AS temperature_2m FROM rown",
           *base(sql_obs(TWO), _ROWS.format(src="pos")), doubles=["temperature_2m"]))
def interpolate_limit_rows(t: Tables):
    return grid.interpolate_limit(t.obs(TWO).drop("cloud_cover"), HOURLY, ["temperature_2m"], 12, by="row")


_GAPS = f"""ex AS (SELECT source, unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 15 MINUTE))
  AS bucket FROM (SELECT DISTINCT source FROM quarter)),
miss AS (SELECT e.source, e.bucket FROM ex e LEFT JOIN quarter q ON q.source = e.source AND q.time = e.bucket
  WHERE q.time IS NULL),
grp AS (SELECT source, bucket, bucket - to_minutes(CAST(15 * row_number() OVER (PARTITION BY source ORDER BY bucket)
  AS INTEGER)) AS island FROM miss)"""


@query(sql("SELECT source, min(bucket) AS gap_start, max(bucket) AS gap_end FROM grp GROUP BY source, island",
           SQL_QUARTER_MEAN, _GAPS))
def gap_ranges(t: Tables):
    return grid.gap_ranges(t.quarter_mean(), QUARTER, ts(START), ts(END))


@query(sql("SELECT source, bucket AS time FROM miss", SQL_QUARTER_MEAN, _GAPS))
def left_anti_missing(t: Tables):
    spans = t.quarter_mean().select("source").distinct().select(
        "source", ts(START).alias("start"), ts(END).alias("end"))
    return grid.missing_points(t.quarter_mean(), grid.time_grid(spans, QUARTER), QUARTER)


NOW, HISTORY = "2024-01-29 12:20:00", "2023-06-01 00:00:00"


@query(sql(f"""SELECT l.site, m.latest,
  CASE WHEN m.latest IS NULL THEN TIMESTAMP '{HISTORY}' WHEN g.first_gap IS NOT NULL THEN g.first_gap
       WHEN m.latest < TIMESTAMP '2024-01-29 12:00:00' THEN m.latest + INTERVAL 1 HOUR END AS recovery_start,
  CASE WHEN m.latest IS NULL OR g.first_gap IS NOT NULL OR m.latest < TIMESTAMP '2024-01-29 12:00:00'
       THEN TIMESTAMP '2024-01-29 12:00:00' END AS recovery_end,
  CASE WHEN m.latest IS NULL THEN 'history' WHEN g.first_gap IS NOT NULL THEN 'gap'
       WHEN m.latest < TIMESTAMP '2024-01-29 12:00:00' THEN 'behind' ELSE 'none' END AS reason
  FROM places l LEFT JOIN (SELECT site, max(time) AS latest FROM obs WHERE temperature_2m IS NOT NULL GROUP BY site) m
    ON m.site = l.site
  LEFT JOIN (SELECT e.site, min(e.time) AS first_gap FROM (SELECT site, unnest(generate_series(
      TIMESTAMP '2024-01-15 12:00:00', TIMESTAMP '2024-01-29 12:00:00', INTERVAL 1 HOUR)) AS time FROM places) e
    LEFT JOIN obs o ON o.site = e.site AND o.time = e.time AND o.temperature_2m IS NOT NULL
    WHERE o.time IS NULL GROUP BY e.site) g ON g.site = l.site""",
           *base(sql_obs(TWO), "places AS (SELECT DISTINCT site FROM ev)")))
def recovery_plan(t: Tables):
    seen = t.obs(["temperature_2m"]).where("temperature_2m IS NOT NULL")
    return grid.recovery_plan(seen, t.events().select("site"), HOURLY, ts(NOW), ts(HISTORY))


@query(sql("SELECT site, max(time) + INTERVAL 1 HOUR AS resume_at FROM obs GROUP BY site", *base(sql_obs(TWO))))
def resume_point(t: Tables):
    return grid.resume_point(t.obs(TWO), HOURLY, ts("2015-01-01 00:00:00"))


_CLEAN = """fst AS (SELECT site, time, temperature_2m FROM (SELECT *, row_number() OVER (
  PARTITION BY site, time ORDER BY seq) AS rn FROM dup) WHERE rn = 1),
held AS (SELECT site, time, last_value(temperature_2m IGNORE NULLS) OVER (PARTITION BY site ORDER BY time
  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS temperature_2m FROM fst)"""


@query(sql(f"SELECT site, time, {_ROW_VALUE.format(n=12)} AS temperature_2m FROM rown", *base(
    sql_obs(TWO), sql_obs2(TWO), _DUPES, _CLEAN, _ROWS.format(src="pos").replace("FROM obs)", "FROM held)")),
           doubles=["temperature_2m"]))
def clean_series(t: Tables):
    return grid.clean_series(dupes(t).drop("cloud_cover"), HOURLY, ["temperature_2m"], "seq")


_BF = ["temperature_2m", "nasa_ghi"]


@query(sql("SELECT site, time, temperature_2m, nasa_ghi FROM w", *base(
    sql_obs(["temperature_2m"], name="a"), sql_obs2(["nasa_ghi"], name="b"),
    sql_grid(["temperature_2m"], "a", "ga"), sql_grid(["nasa_ghi"], "b", "gb"),
    "j AS (SELECT coalesce(x.site, y.site) AS site, coalesce(x.time, y.time) AS time, temperature_2m, nasa_ghi "
    "FROM ga x FULL JOIN gb y ON x.site = y.site AND x.time = y.time)",
    f"c AS (SELECT * FROM j WHERE time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}')",
    f"""g AS (SELECT site, unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 HOUR)) AS time
      FROM (SELECT DISTINCT site FROM c))""",
    "cj AS (SELECT g.site, g.time, temperature_2m, nasa_ghi FROM g LEFT JOIN c ON c.site = g.site AND c.time = g.time)",
    sql_near(_BF, "cj", "n"),
    f"w AS (SELECT site, time, {', '.join(f'{sql_filled(c)} AS {c}' for c in _BF)} FROM n)"), doubles=_BF))
def backfill_merge(t: Tables):
    from registry.sources import hourly_payloads, parameter_payloads

    archive = hourly_payloads(t.obs(["temperature_2m"])).withColumn("arrival", F.lit(1))
    satellite = parameter_payloads(t.obs2(["nasa_ghi"]), {"ALLSKY_SFC_SW_DWN": "nasa_ghi"}).withColumn(
        "arrival", F.lit(1))
    rows = backfill(archive.drop("day"), satellite.drop("day"), HOURLY, ts(START), ts(END))
    return rows.select("site", "time", *_BF)


@query(sql("""SELECT o_custkey, CAST(greatest(a, make_date(y, 1, 1)) AS TIMESTAMP) AS chunk_start,
  CAST(least(b, make_date(y, 12, 31)) AS TIMESTAMP) AS chunk_end
  FROM (SELECT o_custkey, a, b, unnest(generate_series(year(a), year(b))) AS y FROM (SELECT o_custkey,
    CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1))"""))
def plan_chunks(t: Tables):
    return plan_year_chunks(order_ranges(t))


def order_ranges(t: Tables):
    return t.raw("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("start_date"),
                                                    F.to_date(F.max("o_orderdate")).alias("end_date"))


@query(sql("""SELECT o_custkey, CAST(a + CAST(90 * i AS INTEGER) AS TIMESTAMP) AS chunk_start,
  CAST(least(b, CAST(a + CAST(90 * i + 89 AS INTEGER) AS DATE)) AS TIMESTAMP) AS chunk_end
  FROM (SELECT o_custkey, a, b, unnest(generate_series(0, (b - a) // 90)) AS i FROM (SELECT o_custkey,
    CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1))"""))
def plan_day_chunks(t: Tables):
    from skyloom.sources.landing import plan_day_chunks as chunks

    return chunks(order_ranges(t))


@query(sql("""SELECT user_id, CASE WHEN event_type = 'click' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY
  - INTERVAL 15 MINUTE ELSE time_bucket(INTERVAL 15 MINUTE, date_trunc('second', ts)) END AS window_end FROM events"""),
       name="window_end")
def window_end_query(t: Tables):
    text = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.raw("events").select("user_id", window_end(text, 900).alias("window_end"))


