import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_series, collect, random_series, series_frame
from skyloom import config
from skyloom.operators import features as feats
from skyloom.operators import frames
from skyloom.operators.aggregates import key_means
from skyloom.operators.series import Series, in_blocks
from skyloom.plans.features import incremental_features

HOURLY = Series(step=3600, chunk=2 * 86400)
FULL = HOURLY.on_complete_grid()


@pytest.fixture(scope="module")
def long():
    """Longer than one block of row positions."""
    return {1: random_series(1, n=5000, holes=0.3), 2: random_series(2, n=3, holes=0), 3: random_series(3, n=900, holes=0.8)}


def test_lags_cross_block_borders(spark, long):
    for series in (FULL, HOURLY):
        got = feats.lag_features(series_frame(spark, long), series, ["x"], (1, 7, 192))
        names = ("x_lag_1", "x_lag_7", "x_lag_192")
        want = {k: pd.DataFrame({f"x_lag_{n}": v.x.shift(n) for n in (1, 7, 192)}) for k, v in long.items()}
        assert_series(got, want, names)


def test_past_rolling_matches_pandas(spark, long):
    got = feats.rolling_past(series_frame(spark, long), FULL, ["x"], (4, 6, 16, 96))
    want = {}
    for k, v in long.items():
        cols = {}
        for n in (4, 6, 16, 96):
            r = v.x.shift(1).rolling(n, min_periods=max(1, n // 2))
            cols |= {f"x_roll_mean_{n}": r.mean(), f"x_roll_std_{n}": r.std()}
        want[k] = pd.DataFrame(cols)
    assert_series(got, want, tuple(want[1].columns))


def test_inclusive_rolling_matches_pandas(spark, long):
    windows = {"a": 4, "b": 12, "c": 288}
    got = feats.rolling_inclusive(series_frame(spark, long), FULL, ["x"], windows, extremes=True)
    want = {}
    for k, v in long.items():
        cols = {}
        for label, n in windows.items():
            r = v.x.rolling(n, min_periods=1)
            cols |= {f"x_rmean_{label}": r.mean(), f"x_rstd_{label}": r.std().fillna(0),
                     f"x_rmin_{label}": r.min(), f"x_rmax_{label}": r.max()}
        want[k] = pd.DataFrame(cols)
    assert_series(got, want, tuple(want[1].columns))


def test_constant_window_has_zero_spread(spark):
    frame = pd.DataFrame({"x": [0.1] * 200}, index=pd.date_range("2024-01-01", periods=200, freq="1h"))
    got = collect(feats.rolling_past(series_frame(spark, {1: frame}), FULL, ["x"], (96,)), ("x_roll_std_96",))[1]
    assert (got.x_roll_std_96.iloc[60:] == 0).all()


def test_ema_matches_pandas(spark, long):
    spans = (4, 48)
    want = {k: pd.DataFrame({f"x_ema_{s}": v.x.ewm(span=s, adjust=False).mean() for s in spans}) for k, v in long.items()}
    assert_series(feats.ema(series_frame(spark, long), HOURLY, ["x"], spans), want, ("x_ema_4", "x_ema_48"))
    dense = {k: v.ffill().bfill() for k, v in long.items()}
    want = {k: pd.DataFrame({f"x_ema_{s}": v.x.ewm(span=s, adjust=False).mean() for s in spans}) for k, v in dense.items()}
    assert_series(feats.ema(series_frame(spark, dense), FULL, ["x"], spans, gapless=True), want, ("x_ema_4", "x_ema_48"))


def test_horizon_cross(spark):
    frame = random_series(5, n=30, holes=0)
    got = feats.horizon_cross(series_frame(spark, {1: frame}), FULL, ["x"], 3).toPandas()
    x = frame.x.to_numpy()
    want = {(frame.index[i], h): x[i + h] for i in range(30) for h in (1, 2, 3) if i + h < 30}
    assert {(r.time, r.horizon): r.x for r in got.itertuples()} == pytest.approx(want)


HOUR_TARGETS = ["temperature_2m", "cloud_cover", "wind_speed_10m", "shortwave_radiation"]


def hourly_frame(spark, n=200, seed=0, bump=None):
    rng = np.random.default_rng(seed)
    index = pd.date_range("2024-01-01", periods=n, freq="1h")
    frame = pd.DataFrame({c: rng.normal(20, 5, n) for c in HOUR_TARGETS}, index=index)
    if bump is not None:
        frame.iloc[bump:] += 1000
    return frame, series_frame(spark, {1: frame}, HOUR_TARGETS)


def test_no_feature_sees_its_own_row_or_later(spark):
    _, base = hourly_frame(spark)
    _, changed = hourly_frame(spark, bump=120)
    names = [n for n in feats.hourly_columns() if "_lag_" in n or "_roll_" in n]
    before, after = (feats.hourly_matrix(d, FULL).toPandas().set_index("time").sort_index() for d in (base, changed))
    upto = before.index <= before.index[0] + pd.Timedelta(hours=120 - 48)
    pd.testing.assert_frame_equal(before[upto][names], after[upto][names])
    assert (before[~upto][names].to_numpy() != after[~upto][names].to_numpy()).any()


def test_direct_matrix_training_and_serving(spark):
    frame, df = hourly_frame(spark)
    x = frame.temperature_2m.to_numpy()
    train = feats.direct_matrix(df, FULL, horizon=24).toPandas()
    assert len(train) == (200 - 24 - 48) * 24
    row = train[(train.time == frame.index[60]) & (train.horizon == 5)].iloc[0]
    assert row.temp_lag_12 == x[48] and row.temperature_2m == x[65]
    assert row.temp_roll_mean_6 == pytest.approx(x[54:60].mean())
    assert row.temp_roll_std_6 == pytest.approx(x[54:60].std(ddof=1))
    serve = feats.direct_matrix(df, FULL, horizon=24, gap=0, serving=True, max_days=None).toPandas()
    day = serve[serve.time == frame.index[72]].sort_values("horizon")
    assert list(day.target_time) == list(frame.index[72:96])
    assert (day.temp_lag_1 == x[71]).all() and list(day.temperature_2m) == list(x[72:96])


def test_serving_frames_come_back_for_first_rows_of_days(spark, monkeypatch):
    frame, df = hourly_frame(spark)
    made, frames = [], feats.past_frames
    monkeypatch.setattr(feats, "past_frames", lambda *a, **kw: made.append(frames(*a, **kw)) or made[-1])
    whole = feats.direct_matrix(df, FULL, horizon=24, gap=0, serving=True).toPandas()
    warm = frame.index[48:]
    assert made[0].count() == (warm.hour == 0).sum()
    assert len(whole) == (warm >= warm[warm.hour == 0][0]).sum()
    cut = frame.index[101]
    late = feats.direct_matrix(df, FULL, horizon=24, gap=0, serving=True, since=F.lit(str(cut)).cast("timestamp")).toPandas()
    want = whole[whole.target_time >= cut].sort_values("target_time").reset_index(drop=True)
    pd.testing.assert_frame_equal(late.sort_values("target_time").reset_index(drop=True), want, rtol=1e-12)


def test_feature_matrix_has_308_columns():
    assert len(feats.matrix_columns()) == 308


def test_incremental_equals_full(spark):
    frame = random_series(7, n=400, holes=0)
    df = series_frame(spark, {1: frame})
    kw = dict(measures=["x"], targets=["x"], lags=(1, 4), windows=(4,))
    full = feats.feature_matrix(df, FULL, **kw)
    store = full.where(F.col("time") <= F.lit(str(frame.index[300])).cast("timestamp"))
    fresh = incremental_features(df, store, FULL, **kw)
    names = ("x_lag_4", "x_roll_std_4")
    want = collect(full, names)[1].loc[frame.index[301]:]
    assert_series(fresh, {1: want}, names)


def test_station_matrix_defaults_for_missing_sources(spark):
    rng = np.random.default_rng(0)
    index = pd.date_range("2024-01-01", periods=400, freq="15min")
    targets = ["ghi", "dhi", "temperature", "windspeed", "cloud_cover"]
    frame = pd.DataFrame({c: rng.uniform(0, 50, 400) for c in targets}, index=index)
    out = feats.station_matrix(series_frame(spark, {1: frame}, targets), Series(step=900).on_complete_grid(), gapless=True)
    got = out.toPandas()
    assert len(got) == 400 - 288
    assert set(feats.station_columns()) <= set(got.columns)
    assert (got.om_ghi == 0).all() and (got.vedas_temperature == 0).all()


def test_imputed_grid_equals_impute_of_grid(spark):
    from skyloom.operators.grid import complete_grid

    data = {1: random_series(8, n=500, holes=0.5, drop_rows=0.6), 2: random_series(9, n=40, holes=1.0)}
    df = series_frame(spark, data)
    want = feats.impute(complete_grid(df, HOURLY, ["x"], fill="none"), HOURLY, ["x"])
    assert_series(feats.imputed_grid(df, HOURLY, ["x"]), collect(want))


def test_station_matrix_shuffles_narrow_rows_only(spark):
    hours = pd.date_range("2024-01-01", periods=400, freq="1h")
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({c: rng.normal(20, 5, 400) for c in config.STATION_TARGETS}, index=hours)
    series = Series(step=3600, chunk=10 * 86400, complete=True)
    base = series_frame(spark, {1: frame, 2: frame + 1}, config.STATION_TARGETS)
    provider = base.where("hour(time) % 7 = 0").withColumnsRenamed({c: f"om_{c}" for c in config.STATION_TARGETS})
    outlook = base.where("hour(time) % 5 = 0").select("site", "time", F.col("temperature").alias("vedas_temperature"), F.col("ghi").alias("vedas_solar_potential"))
    matrix = feats.station_matrix(base, series, provider, outlook, gapless=True)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(matrix._jdf.queryExecution(), "simple")
    # The two sides of the first join, the second source, and the blocks: no shuffle carries a feature.
    assert plan.count("Exchange hashpartitioning(site") == 4
    got = matrix.toPandas().set_index(["site", "time"]).sort_index()
    one = frame.copy()
    one["om"] = frame["ghi"].where(hours.hour % 7 == 0).ffill(limit=4).fillna(0.0)
    one["lag"], one["ema"] = frame["ghi"].shift(288), frame["ghi"].ewm(span=48, adjust=False).mean()
    one = one.iloc[288:]
    for c, name in (("om", "om_ghi"), ("lag", "ghi_lag288"), ("ema", "ghi_ema_48")):
        np.testing.assert_allclose(got.loc[1][name].to_numpy(), one[c].to_numpy(), rtol=1e-9, atol=1e-9)


def test_past_frames_equal_the_windows(spark, monkeypatch):
    """Several blocks a series and several series a batch, missing values in a row: the pass gives what the windows give, bit by bit."""
    rng = np.random.default_rng(5)
    index = pd.date_range("2024-01-01", periods=5000, freq="1h")
    frames_ = {}
    for site in (1, 2, 3):
        values = rng.normal(20, 5, (len(index) - 1200 * site, 2))
        values[rng.random(values.shape) < 0.3] = np.nan
        values[100:140] = np.nan
        values[200:260] = 7.0
        frames_[site] = pd.DataFrame(values, columns=["a", "b"], index=index[:len(values)])
    df = series_frame(spark, frames_, ("a", "b")).cache()
    lags, windows = (1, 3, 96), (2, 4, 13, 96)
    local = lambda d: d.toPandas().sort_values(["site", "time"]).reset_index(drop=True)
    for half_full in (True, False):
        want = local(in_blocks(df, FULL, lambda w: feats.lag_columns(["a", "b"], lags, w), lookback=96,
                               prepare=feats.past_statistics(FULL.keys, ["a", "b"], windows, half_full=half_full)))
        for rows in (64, 2048):
            monkeypatch.setattr(frames, "ROWS", rows)
            got = local(frames.past_frames(df, FULL, ["a", "b"], lags, windows, half_full=half_full))
            assert sorted(got.columns) == sorted(want.columns)
            pd.testing.assert_frame_equal(got[want.columns], want, check_exact=True)
        whole = local(frames.past_frames(df, FULL, ["a", "b"], lags, windows, half_full=half_full, whole=True))
        made = [c for c in want.columns if "_" in c]
        pd.testing.assert_frame_equal(whole[want.columns], want.dropna(subset=made).reset_index(drop=True), check_exact=True)


def test_matrices_have_one_pass(spark):
    """The matrices take their frames from one Arrow pass, not from windows over wide rows."""
    df = series_frame(spark, {1: pd.DataFrame({c: [1.0] * 60 for c in config.HOURLY_TARGETS}, index=pd.date_range("2024-01-01", periods=60, freq="1h"))},
                      tuple(config.HOURLY_TARGETS))
    plan = feats.hourly_matrix(df, FULL)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Window" not in plan


def test_key_means_equal_plain_averages(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame(rng.normal(size=(500, 3)), columns=["a", "b", "c"]).mask(rng.random((500, 3)) < 0.2)
    data.insert(0, "site", np.sort(rng.integers(0, 5, 500)))
    data.loc[data["site"] == 2, "b"] = np.nan
    df = spark.createDataFrame(data).select("site", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "abc"])
    packed = df.select("site", "a", F.array("b", "c").alias("bc"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # keys go on over batches
    try:
        got = [key_means(df, ["site"], ["a", "b", "c"]).toPandas(), key_means(packed, ["site"], ["a"], {"bc": ["b", "c"]}).toPandas()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = data.groupby("site").mean()
    for found in got:
        found = found.set_index("site").sort_index()
        assert found["n"].tolist() == data.groupby("site").size().tolist()
        np.testing.assert_allclose(found[["a", "b", "c"]].to_numpy(), want.to_numpy(), rtol=1e-12)


def test_packed_matrix_holds_the_same_frames(spark):
    source = series_frame(spark, {1: random_series(1, 60, holes=0.0)}).withColumn("y", F.col("x") * 2)
    given = dict(measures=["x", "y"], targets=["y"], lags=(1, 3), windows=(4,), imputed=True)
    wide = feats.feature_matrix(source, FULL, **given).orderBy("time").toPandas()
    packed = feats.feature_matrix(source, FULL, packed="frames", **given).orderBy("time").toPandas()
    names = frames.frame_columns(["x", "y"], (1, 3), (4,))
    assert (np.stack(packed["frames"]) == wide[names].to_numpy()).all()
    rest = [c for c in wide.columns if c not in names]
    assert packed[rest].equals(wide[rest])


def test_station_matrix_frames_in_arrow(spark):
    """All statistics against pandas."""
    index = pd.date_range("2024-01-01", periods=3000, freq="1h")  # more than one block
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({c: rng.uniform(2, 50, 3000) for c in config.STATION_TARGETS}, index=index)
    frame.loc[index[600:700], "dhi"] = 7.0
    base = series_frame(spark, {1: frame}, config.STATION_TARGETS)
    matrix = feats.station_matrix(base, FULL, gapless=True)
    assert "Window" not in matrix._jdf.queryExecution().toString()
    got = matrix.toPandas().set_index("time").sort_index()
    for c in config.STATION_TARGETS:
        want = {f"{c}_lag{k}": frame[c].shift(k) for k in config.STATION_LAGS}
        for label, n in config.STATION_WINDOWS.items():
            want |= {f"{c}_rmean_{label}": frame[c].rolling(n, 1).mean(), f"{c}_rstd_{label}": frame[c].rolling(n, 1).std().fillna(0)}
        want |= {f"{c}_diff_{label}": frame[c].diff(k) for label, k in (("1h", 4), ("24h", 96))}
        want |= {f"{c}_ema_{n}": frame[c].ewm(span=n, adjust=False).mean() for n in config.STATION_EMA_SPANS}
        for name, values in want.items():
            np.testing.assert_allclose(got[name].to_numpy(), values.iloc[288:].to_numpy(), rtol=1e-9, atol=1e-6 if "rstd" in name else 1e-9, err_msg=name)
    assert (got.loc[index[660:700], "dhi_rstd_12h"] == 0).all()
