"""Edge rules of joins, upserts, parsers, aggregates and post-processing."""

import math
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_series, random_series, series_frame
from skyloom.functions import scalar
from skyloom.operators import aggregates, joins, models, postprocess
from skyloom.operators import tables as views
from skyloom.operators.series import Series
from skyloom.session import shared_folder
from skyloom.sources import landing, payloads, upserts, writers

HOURLY = Series(step=3600, chunk=2 * 86400)


def one(spark, expression, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expression.alias("v")).first().v


def test_nearest_asof(spark):
    left = spark.sql("""SELECT bigint(1) AS site, timestamp(t) AS time, i FROM VALUES ('2024-01-01 00:30:00', 1),
      ('2024-01-01 02:00:00', 2), ('2023-12-01 00:00:00', 3), ('2024-02-01 00:00:00', 4), ('2024-01-01 00:31:00', 5) AS v(t, i)
      UNION ALL SELECT 2, timestamp'2024-01-01', 6""")
    right = spark.sql("""SELECT bigint(1) AS site, timestamp(t) AS time, double(x) AS x FROM VALUES ('2024-01-01 00:00:00', 10),
      ('2024-01-01 01:00:00', 20), ('2024-01-01 02:00:00', 30) AS v(t, x)""")
    got = {r.i: r.x for r in joins.nearest_asof(left, right, HOURLY, ["x"]).collect()}
    assert got == {1: 10.0, 2: 30.0, 3: 10.0, 4: 30.0, 5: 20.0, 6: 0.0}


def test_nearest_station_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    sites = pd.DataFrame({"site_id": range(60), "lat": rng.uniform(-60, 75, 60), "lon": rng.uniform(-180, 180, 60)})
    sites.loc[0, ["lat", "lon"]] = [10.0, 179.9]
    stations = pd.DataFrame({"station_id": range(40), "lat": rng.uniform(-60, 75, 40), "lon": rng.uniform(-180, 180, 40)})
    stations.loc[0, ["lat", "lon"]] = [10.0, -179.9]

    def km(a, b):
        p, q = np.radians(a.lat), np.radians(b.lat.to_numpy())
        h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(b.lon.to_numpy() - a.lon) / 2) ** 2
        return 2 * 6371 * np.arcsin(np.sqrt(h))

    want = {int(s.site_id): int(np.argmin(km(s, stations))) for s in sites.itertuples()}
    got = joins.nearest_station(spark.createDataFrame(sites), spark.createDataFrame(stations))
    assert {r.site_id: r.station_id for r in got.collect()} == want


def test_nearest_station_compares_few_stations_of_far_sites(spark, monkeypatch):
    rng = np.random.default_rng(2)
    sites = pd.DataFrame({"site_id": range(300), "lat": rng.uniform(-60, 60, 300), "lon": rng.uniform(-150, -60, 300)})
    stations = pd.DataFrame({"station_id": range(500), "lat": rng.uniform(20, 21, 500), "lon": rng.uniform(80, 81, 500)})
    stations.loc[499, ["lat", "lon"]] = stations.loc[3, ["lat", "lon"]]
    pairs, plain = spark.sparkContext.accumulator(0), joins.haversine_km
    counted = F.udf(lambda x: pairs.add(1) or 0.0, "double")
    monkeypatch.setattr(joins, "haversine_km", lambda a, b, c, d: plain(a, b, c, d) + counted(c))
    got = {r.site_id: r.station_id for r in joins.nearest_station(spark.createDataFrame(sites), spark.createDataFrame(stations)).collect()}
    p, q = np.radians(sites.lat.to_numpy())[:, None], np.radians(stations.lat.to_numpy())[None]
    h = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(stations.lon.to_numpy()[None] - sites.lon.to_numpy()[:, None]) / 2) ** 2
    assert got == dict(enumerate(h.argmin(1).tolist()))
    assert pairs.value < len(sites) * 64


def test_upserts(spark):
    table = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 6.0)], "k int, a double, b double")
    batch = spark.createDataFrame([(2, 20.0, 1), (3, 30.0, 1), (2, 21.0, 2)], "k int, a double, seq int")
    rows = lambda df: sorted((r.k, r.a, r.b) for r in df.collect())
    assert rows(upserts.upsert_replace(table, batch, ["k"], "seq")) == [(1, 1.0, 5.0), (2, 21.0, None), (3, 30.0, None)]
    merged = upserts.upsert_columns(table, batch, ["k"], order="seq")
    assert rows(merged) == [(1, 1.0, 5.0), (2, 21.0, 6.0), (3, 30.0, None)]
    assert rows(upserts.upsert_columns(merged, batch, ["k"], order="seq")) == rows(merged)
    assert rows(upserts.insert_if_absent(table, batch, ["k"], "seq")) == [(1, 1.0, 5.0), (2, 2.0, 6.0), (3, 30.0, None)]


@pytest.mark.parametrize("mode,expected", [("replace", [(1, 1.0, 5.0), (2, 9.0, None), (3, 8.0, None)]),
                                           ("update_given", [(1, 1.0, 5.0), (2, 9.0, 6.0), (3, 8.0, None)]),
                                           ("keep_existing", [(1, 1.0, 5.0), (2, 2.0, 6.0), (3, 8.0, None)])])
def test_merge_into_rewrites_only_touched_partitions(spark, tmp_path, mode, expected):
    path = str(tmp_path / "t")
    day = F.to_date("time")
    first = spark.sql("""SELECT k, timestamp(t) AS time, double(a) AS a, double(b) AS b FROM VALUES (1, '2024-01-01', 1, 5),
      (2, '2024-01-02', 2, 6) AS v(k, t, a, b)""")
    second = spark.sql("SELECT k, timestamp'2024-01-02' AS time, double(a) AS a FROM VALUES (2, 9), (3, 8) AS v(k, a)")
    assert writers.merge_into(first, path, ["k", "time"], partition_of=day) == 2
    untouched = sorted(p.name for p in (tmp_path / "t" / "obs_date=2024-01-01").glob("*.parquet"))
    for _ in range(2):
        assert writers.merge_into(second, path, ["k", "time"], mode=mode, partition_of=day) == 2
    assert sorted((r.k, r.a, r.b) for r in spark.read.parquet(path).collect()) == expected
    assert sorted(p.name for p in (tmp_path / "t" / "obs_date=2024-01-01").glob("*.parquet")) == untouched


def test_merge_leaves_no_copies_behind(spark, tmp_path):
    """Neither the batch nor the merged rows stay in the shared folder; without an order the last arrival wins, file order or not."""
    shared = Path(shared_folder(spark))
    files = lambda: {p for p in shared.rglob("*") if p.is_file()}
    path, before = str(tmp_path / "t"), files()
    batch = spark.range(0, 4000, 1, 7).select((F.col("id") % 1000).alias("k"), F.col("id").alias("a"), F.lit("2024-01-01").cast("timestamp").alias("time"))
    for _ in range(2):
        assert writers.merge_into(batch, path, ["k", "time"], mode="replace", partition_of=F.to_date("time")) == 4000
    assert files() <= before
    assert sorted((r.k, r.a) for r in spark.read.parquet(path).collect()) == [(k, 3000 + k) for k in range(1000)]


def test_constraints(spark):
    df = spark.createDataFrame([(1.0, "ml"), (None, "ml"), (2.0, "x")], "lat double, kind string")
    good, bad = upserts.split_valid(df, ["lat"], {"kind": ["ml", "provider"]})
    assert good.count() == 1
    assert sorted(r.violation for r in bad.collect()) == ["kind not allowed", "lat is null"]


@pytest.mark.parametrize("text,expected", [("10Mar:05.30", "2024-03-10 05:30:00"), ("1Foo:00.15", "2024-01-01 00:15:00"),
                                           ("31Feb:00.00", None), ("nonsense", None), ("9Dec:23.45", "2024-12-09 23:45:00")])
def test_list_time(spark, text, expected):
    got = one(spark, payloads.list_time(F.lit(text), F.lit(2024)).cast("string"))
    assert got == expected


def test_payloads_without_block(spark):
    df = spark.createDataFrame([(1, '{"reason": "none"}'), (2, '{"hourly": {"temperature_2m": [1.0]}}'),
                                (3, '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, null]}}')],
                               "id int, payload string")
    got = payloads.parse_hourly_arrays(df, ["temperature_2m", "cloud_cover"]).orderBy("time").collect()
    assert [(r.id, r.temperature_2m, r.cloud_cover) for r in got] == [(3, 1.5, None), (3, None, None)]


def test_param_map_with_uneven_hours(spark):
    text = '{"properties": {"parameter": {"T2M": {"2024010100": 5.0, "2024010101": -999}, "PS": {"2024010102": 90.0}}}}'
    df = spark.createDataFrame([(text,)], "payload string")
    got = payloads.parse_param_map(df, {"T2M": "t", "PS": "p"}).orderBy("time").collect()
    assert [(r.time.hour, r.t, r.p) for r in got] == [(0, 5.0, None), (1, None, None), (2, None, 90.0)]


def test_scalars(spark):
    ts = lambda s: F.lit(s).cast("timestamp")
    text = lambda c: c.cast("string")
    assert one(spark, text(scalar.floor_time(ts("2024-01-01 00:14:59"), 900))) == "2024-01-01 00:00:00"
    assert one(spark, text(scalar.ceil_time(ts("2024-01-01 00:15:00"), 900))) == "2024-01-01 00:15:00"
    assert one(spark, text(scalar.next_run(ts("2024-01-01 00:15:00"), 900))) == "2024-01-01 00:30:00"
    assert one(spark, text(scalar.window_end(F.lit("2024-01-01"), 900))) == "2024-01-01 23:45:00"
    assert one(spark, text(scalar.window_end(F.lit("2024-01-01 10:07:00"), 900))) == "2024-01-01 10:00:00"
    assert one(spark, scalar.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert one(spark, scalar.location_token(F.lit(-10.32), F.lit(78.66))) == "lat_m10_3200_lon_78_6600"
    key = scalar.site_key(F.lit(-28.61391), F.lit(-77.2090))
    assert one(spark, scalar.site_lat(key)) == -28.6139 and one(spark, scalar.site_lon(key)) == -77.209
    bucket = lambda h: one(spark, scalar.horizon_bucket(ts("2024-01-01"), scalar.shift_time(ts("2024-01-01"), h * 3600)))
    assert [bucket(h) for h in (0, 1, 24, 25, 72, 73)] == [None, "24h", "24h", "48h", "72h", None]


def test_exact_quantiles_under_skew(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.zeros(5000), rng.exponential(10, 3001), [1e6]])
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "x": values}))
    got = aggregates.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75, 0.999], ["k"]).first()
    want = np.quantile(values, [0.25, 0.5, 0.75, 0.999])
    assert [got[f"q_{i}"] for i in range(4)] == pytest.approx(list(want))


def test_error_metrics_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (4.0, None)], "y double, p double")
    row = aggregates.error_metrics(df, "y", "p").first()
    assert (row.n, row.mae, row.r2) == (3, 2.0, pytest.approx(1 - 14 / 2))
    assert row.rmse == pytest.approx(math.sqrt(14 / 3))


def test_gaussian_smooth_across_blocks(spark):
    frame = random_series(4, n=5000, holes=0.2)
    got = postprocess.gaussian_smooth(series_frame(spark, {1: frame}), HOURLY.on_complete_grid(), ["x"], 11, 3.0)
    weights = np.exp(-0.5 * (np.arange(-5, 6) / 3.0) ** 2)
    x = np.pad(frame.x.to_numpy(), 5, constant_values=np.nan)
    views_ = np.lib.stride_tricks.sliding_window_view(x, 11)
    seen = ~np.isnan(views_)
    with np.errstate(invalid="ignore"):
        want = (np.where(seen, views_, 0) * weights).sum(1) / (seen * weights).sum(1)
    assert_series(got, {1: pd.DataFrame({"x": want}, index=frame.index)})


def test_rate_limit_resets_at_night(spark):
    hours = pd.date_range("2024-01-01 17:00", periods=6, freq="1h")
    rows = [(1, h.to_pydatetime(), v) for h, v in zip(hours, [500.0, 100.0, 700.0, 300.0, 300.0, 300.0])]
    df = spark.createDataFrame(rows, "site bigint, forecast_time timestamp, shortwave_radiation double")
    got = postprocess.rate_limit(df, ["site"], targets=["shortwave_radiation"]).orderBy("forecast_time").collect()
    assert [r.shortwave_radiation for r in got] == [500.0, 420.0, 500.0, 0.0, 0.0, 0.0]


def test_blend_and_feedback(spark):
    weight = postprocess.ml_weight(F.lit(0), 288)
    assert one(spark, postprocess.blended(F.lit(10.0), F.lit(20.0), weight)) == pytest.approx(17.0)
    assert one(spark, postprocess.blended(F.lit(None).cast("double"), F.lit(20.0), weight)) == 20.0
    assert one(spark, postprocess.feedback(F.lit(10.0), F.lit(0.0))) == 7.0
    assert one(spark, postprocess.ml_weight(F.lit(0), 1)) == pytest.approx(0.7)


def test_temporal_split_falls_back_to_position(spark):
    short = pd.DataFrame({"x": 1.0}, index=pd.date_range("2024-01-01", periods=10, freq="1h"))
    long = pd.DataFrame({"x": 1.0}, index=pd.date_range("2024-01-01", periods=24 * 30, freq="1h"))
    df = models.temporal_split(series_frame(spark, {1: short, 2: long}), HOURLY, 14)
    counts = {(r.site, r.is_validation): r["count"] for r in df.groupBy("site", "is_validation").count().collect()}
    assert counts == {(1, False): 8, (1, True): 2, (2, False): 720 - 337, (2, True): 337}


def test_shuffled_target_is_a_permutation(spark):
    frame = random_series(6, n=300, holes=0)
    out = models.shuffled_target(series_frame(spark, {1: frame}), HOURLY, "x").toPandas().set_index("time").sort_index()
    assert sorted(out.x) == pytest.approx(sorted(frame.x))
    assert (out.x != frame.x).mean() > 0.9


def test_chunks(spark):
    ranges = spark.sql("SELECT 1 AS k, date'2023-11-05' AS start_date, date'2025-02-03' AS end_date")
    years = [(str(r.chunk_start), str(r.chunk_end)) for r in landing.plan_year_chunks(ranges).orderBy("chunk_start").collect()]
    assert years == [("2023-11-05", "2023-12-31"), ("2024-01-01", "2024-12-31"), ("2025-01-01", "2025-02-03")]
    days = landing.plan_day_chunks(ranges, 200).orderBy("chunk_start").collect()
    assert [str(r.chunk_end) for r in days] == ["2024-05-22", "2024-12-08", "2025-02-03"]


def test_stored_predictions_scope(spark):
    rows = [(1.0, "2024-01-01"), (2.0, "2024-01-02")]
    df = spark.createDataFrame(rows, "lat double, t string").select(
        "lat", F.col("lat").alias("lon"), F.lit("ml").alias("forecast_type"), F.col("t").cast("timestamp").alias("issue_time"),
        F.col("t").cast("timestamp").alias("forecast_time"), F.lit("v").alias("model_version"),
        *[F.lit(1.0).alias(c) for c in ("temperature_2m", "cloud_cover", "wind_speed_10m", "shortwave_radiation", "diffuse_radiation")])
    assert views.stored_predictions(df).count() == 1
    assert views.stored_predictions(df, scope="per_location").count() == 2
    assert views.stored_predictions(df, lat=1.0, lon=1.0).count() == 1
    with pytest.raises(ValueError):
        views.stored_predictions(df, 0)


def test_live_update_splits_at_the_issue(spark):
    from skyloom.plans.observations import live_update

    text = '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"], "temperature_2m": [1.0, 2.0, 4.0]}}'
    df = spark.createDataFrame([(10.0, 70.0, 1, text)], "lat double, lon double, arrival int, payload string")
    actual, future = live_update(df, Series(keys=("lat", "lon")), F.lit("2024-01-01 01:00:00").cast("timestamp"),
                                 measures=["temperature_2m"])
    assert sorted(r.temperature_2m for r in actual.collect()) == [1.0, 1.25, 1.5, 1.75, 2.0]
    rows = sorted((r.forecast_type, r.temperature_2m) for r in future.collect())
    assert rows == [("provider", 2.5), ("provider", 3.0), ("provider", 3.5), ("provider", 4.0)]
