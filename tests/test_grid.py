from pyspark.sql import functions as F
import pandas as pd
import pytest

from skyloom.operators import grid
from skyloom.operators.series import Series, dedupe
from helpers import assert_series, random_series, series_frame

# Pieces of two days: every rule has to hold across piece borders.
HOURLY = Series(step=3600, chunk=2 * 86400)


@pytest.fixture(scope="module")
def data():
    return {1: random_series(1), 2: random_series(2, holes=0.9), 3: random_series(3, n=1, holes=0)}


@pytest.fixture(scope="module")
def gappy():
    return {1: random_series(4, drop_rows=0.5), 2: random_series(5, holes=0.95, drop_rows=0.7)}


def test_fills_match_pandas(spark, data):
    df = series_frame(spark, data)
    assert_series(grid.ffill(df, HOURLY, ["x"]), {k: v.ffill() for k, v in data.items()})
    assert_series(grid.bfill(df, HOURLY, ["x"]), {k: v.bfill() for k, v in data.items()})
    assert_series(grid.fill_both(df, HOURLY, ["x"]), {k: v.ffill().bfill() for k, v in data.items()})


def test_interpolation_matches_pandas(spark, gappy):
    df = series_frame(spark, gappy)
    assert_series(grid.interpolate_time(df, HOURLY, ["x"]),
                  {k: v.interpolate(method="time") for k, v in gappy.items()})


@pytest.mark.parametrize("limit", [1, 4, 8])
def test_limits_match_pandas(spark, data, gappy, limit):
    full = series_frame(spark, data)
    complete = HOURLY.on_complete_grid()
    assert_series(grid.ffill_limit(full, complete, ["x"], limit),
                  {k: v.ffill(limit=limit) for k, v in data.items()})
    assert_series(grid.interpolate_limit(full, complete, ["x"], limit),
                  {k: v.interpolate(method="time", limit=limit) for k, v in data.items()})
    part = series_frame(spark, gappy)
    assert_series(grid.ffill_limit(part, HOURLY, ["x"], limit),
                  {k: v.ffill(limit=limit) for k, v in gappy.items()})
    assert_series(grid.interpolate_limit(part, HOURLY, ["x"], limit, by="row"),
                  {k: v.interpolate(method="linear", limit=limit) for k, v in gappy.items()})


def test_complete_grid_matches_reindex(spark, gappy):
    df = series_frame(spark, gappy)
    want = {}
    for k, v in gappy.items():
        full = pd.date_range(v.index.min(), v.index.max(), freq="1h")
        want[k] = v.reindex(full).interpolate(method="time").ffill().bfill()
    assert_series(grid.complete_grid(df, HOURLY, ["x"]), want)
    start, end = pd.Timestamp("2023-12-30 05:00"), pd.Timestamp("2024-01-20 07:00")
    want = {}
    for k, v in gappy.items():
        want[k] = v.reindex(pd.date_range(start, end, freq="1h")).interpolate(
            method="time").ffill().bfill()
    got = grid.complete_grid(df, HOURLY, ["x"], start=F.lit(start).cast("timestamp"),
                             end=F.lit(end).cast("timestamp"))
    assert_series(got, want)


def test_upsample_drops_off_grid_values(spark):
    index = pd.to_datetime(["2024-01-01 00:07", "2024-01-01 01:00", "2024-01-01 01:20",
                            "2024-01-01 02:00", "2024-01-01 03:08"])
    frame = pd.DataFrame({"x": [1.0, 10.0, 99.0, 20.0, 7.0]}, index=index)
    want = frame.resample("15min").interpolate(method="time").ffill().bfill()
    got = grid.upsample(series_frame(spark, {1: frame}), Series(step=900, chunk=3600), ["x"])
    assert_series(got, {1: want})


def test_empty_buckets_stay_null(spark, gappy):
    got = grid.complete_grid(series_frame(spark, gappy), HOURLY, ["x"], fill="none")
    assert_series(got, {k: v.asfreq("1h") for k, v in gappy.items()})


def test_time_grid(spark):
    spans = spark.createDataFrame(
        [(1, "2024-01-01 00:00", "2024-01-01 01:00"), (2, "2024-01-02 00:00", "2024-01-01 00:00"),
         (3, "2024-01-01 00:10", "2024-06-01 00:00")], "site bigint, start string, end string")
    spans = spans.select("site", F.col("start").cast("timestamp"), F.col("end").cast("timestamp"))
    got = grid.time_grid(spans, Series(step=900)).toPandas()
    assert list(got[got.site == 1].time.sort_values()) == list(
        pd.date_range("2024-01-01", "2024-01-01 01:00", freq="15min"))
    assert (got.site == 2).sum() == 0
    assert sorted(got[got.site == 3].time) == list(
        pd.date_range("2024-01-01 00:10", "2024-06-01", freq="15min"))


def test_gap_ranges(spark):
    start, end = pd.Timestamp("2024-01-01"), pd.Timestamp("2024-01-05")
    full = pd.date_range(start, end, freq="1h")
    seen = full.delete([0, 1, 30, 31, 32, 60, 95, 96])
    frame = pd.DataFrame({"x": 1.0}, index=seen)
    nothing = pd.DataFrame({"x": [1.0]}, index=[pd.Timestamp("2023-01-01")])
    df = series_frame(spark, {1: frame, 2: nothing})
    got = grid.gap_ranges(df, HOURLY, F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"),
                          locations=df).toPandas()
    one = got[got.site == 1].sort_values("gap_start")
    assert list(zip(one.gap_start, one.gap_end)) == [
        (full[0], full[1]), (full[30], full[32]), (full[60], full[60]), (full[95], full[96])]
    two = got[got.site == 2]
    assert list(zip(two.gap_start, two.gap_end)) == [(start, end)]


def test_recovery_plan(spark):
    now = pd.Timestamp("2024-03-01 00:20")
    at = lambda *t: pd.DataFrame({"x": 1.0}, index=pd.DatetimeIndex(t))
    whole = pd.date_range("2024-02-10", "2024-03-01", freq="1h")
    df = series_frame(spark, {1: at(*whole), 2: at(*whole[:-3]), 3: at(*whole.delete(-50)),
                              4: at(pd.Timestamp("2023-05-01"))})
    places = spark.createDataFrame([(i,) for i in range(1, 6)], "site bigint")
    got = grid.recovery_plan(df, places, HOURLY, F.lit(now).cast("timestamp"),
                             F.lit(pd.Timestamp("2015-01-01")).cast("timestamp")).toPandas()
    got = got.set_index("site").recovery_start.to_dict()
    assert pd.isna(got[1])
    assert got[2] == whole[-3]
    assert got[3] == whole[-50]
    assert got[4] == pd.Timestamp("2024-02-16")
    assert got[5] == pd.Timestamp("2015-01-01")


def test_clean_series(spark):
    frame = random_series(9, n=300, holes=0.93)
    df = series_frame(spark, {1: frame}).withColumn("seq", F.lit(1))
    again = series_frame(spark, {1: frame + 5}).withColumn("seq", F.lit(2))
    got = grid.clean_series(df.unionByName(again), HOURLY, ["x"], "seq")
    want = frame.ffill(limit=6).interpolate(method="linear", limit=12)
    assert_series(got, {1: want})


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 1, 7.0)], "k int, seq int, v double")
    last = {r.k: r.v for r in dedupe(df, ["k"], "seq").collect()}
    first = {r.k: r.v for r in dedupe(df, ["k"], "seq", keep="first").collect()}
    assert last == {1: None, 2: 7.0} and first == {1: 5.0, 2: 7.0}


def test_grids_are_dealt_by_their_rows(spark, monkeypatch):
    from skyloom.operators import series as pieces

    monkeypatch.setattr(pieces, "TASK_ROWS", 50, raising=False)
    series = Series(step=3600, chunk=86400)
    frame = random_series(8, n=1200, holes=0.5, drop_rows=0.3)
    rows = series_frame(spark, {1: frame, 2: frame})
    holes = grid.complete_grid(rows, series, ["x"], fill="none")
    for df in (holes, grid.interpolate_limit(holes, series.on_complete_grid(), ["x"], 8)):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) >= 2300 and max(sizes) <= 400
