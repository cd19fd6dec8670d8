"""Shapes that hurt at scale: long holes, dense pieces, hot keys."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import series_frame
from skyloom.operators import aggregates, grid, joins, series
from skyloom.operators.series import Series

SITE = Series(step=3600, chunk=30 * 86400)


@pytest.fixture
def no_merging(spark):
    """Shuffle partitions as they come, so that the spread of rows can be seen."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def spread(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return sum(sizes), max(sizes)


@pytest.mark.parametrize("fill", ["interpolate", "hold", "none"])
def test_a_hole_of_24_years_unfolds_in_many_tasks(spark, no_merging, fill):
    rows = pd.DataFrame({"x": [0.0, 210_384.0]}, index=pd.to_datetime(["2000-01-01", "2024-01-01"]))
    df = series_frame(spark, {1: rows})
    total, most = spread(grid.complete_grid(df, SITE, ["x"], fill=fill))
    assert total == 210_385 and most < total / 3
    full = grid.complete_grid(df, SITE, ["x"], fill=fill).where("time in (timestamp'2000-01-01 01:00:00', timestamp'2013-05-01 07:00:00')")
    at = {r["time"]: r["x"] for r in full.collect()}
    hours = (dt.datetime(2013, 5, 1, 7) - dt.datetime(2000, 1, 1)).total_seconds() / 3600
    want = {"interpolate": [1.0, hours], "hold": [0.0, 0.0], "none": [None, None]}[fill]
    assert [at[k] for k in sorted(at)] == (pytest.approx(want) if want[0] is not None else want)


def test_ranges_far_from_the_rows_unfold_in_many_tasks(spark, no_merging):
    df = series_frame(spark, {1: pd.DataFrame({"x": [5.0]}, index=pd.to_datetime(["2012-06-01"]))})
    start, end = (F.lit(x).cast("timestamp") for x in ("2000-01-01 00:30:00", "2024-01-01 00:00:00"))
    total, most = spread(grid.complete_grid(df, SITE, ["x"], start=start, end=end))
    assert total == 210_385 and most < total / 3
    causal = grid.complete_grid(df, SITE, ["x"], start=start, end=end, causal=True)
    assert causal.where("x is null and time >= timestamp'2012-06-01'").count() == 0 and causal.where("x is not null and time < timestamp'2012-06-01'").count() == 0


@pytest.mark.parametrize("step, chunk", [(3600, 86400), (7 * 60, 86400), (3600, 5000)])
def test_pieces_do_not_show(spark, step, chunk):
    """Steps that do not divide a piece, pieces shorter than two steps, rows on the border of a piece."""
    rng = np.random.default_rng(step + chunk)
    slots = np.sort(rng.choice(900, 60, replace=False))
    base = pd.Timestamp(int(np.ceil(1_704_067_200 / step)) * step, unit="s")
    frame = pd.DataFrame({"x": rng.normal(size=60)}, index=base + pd.to_timedelta(slots * step, unit="s"))
    frame.loc[frame.index[::5], "x"] = np.nan
    series = Series(step=step, chunk=chunk)
    got = grid.complete_grid(series_frame(spark, {1: frame}), series, ["x"]).toPandas().set_index("time").sort_index()["x"]
    want = frame["x"].reindex(pd.date_range(frame.index[0], frame.index[-1], freq=f"{step}s")).interpolate(method="time").bfill()
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=1e-9)


def test_merged_history_does_not_reread_its_sources(spark):
    """Sources are scanned once; what follows reads stored stages."""
    frame = pd.DataFrame({"ghi": [1.0, 2.0, 3.0]}, index=pd.date_range("2024-01-01", periods=3, freq="1h"))
    reads = spark.sparkContext.accumulator(0)

    def source():
        def counted(batches):
            for b in batches:
                reads.add(b.num_rows)
                yield b
        df = series_frame(spark, {1: frame}, ("ghi",))
        return df.mapInArrow(counted, df.schema)

    out = joins.merge_history(source(), source(), source(), SITE, ["ghi"])
    assert out.count() == 3 and reads.value <= 4 * 3


def dense(n=30_000, seed=1):
    """Nearly all rows of one key within a minute, and a second key."""
    rng = np.random.default_rng(seed)
    micros = np.sort(rng.integers(0, 60_000_000, n))
    times = pd.Timestamp("2024-01-01") + pd.to_timedelta(micros, unit="us")
    return pd.DataFrame({"site": np.where(np.arange(n) % 50 == 0, 2, 1), "time": times, "v": rng.normal(size=n).round(3)})


def test_dense_rows_of_one_key_are_many_tasks(spark, no_merging):
    other = dense(seed=2)
    left, right = (spark.createDataFrame(d) for d in (dense()[["site", "time"]], other))
    got = joins.nearest_asof(left, right, SITE, ["v"])
    total, most = spread(got)
    assert total == 30_000 and most < total / 3
    for site in (1, 2):
        mine = dense().query("site == @site").sort_values("time")[["time"]]
        want = pd.merge_asof(mine, other.query("site == @site").groupby("time", as_index=False).first()[["time", "v"]], on="time", direction="nearest")
        have = got.where(F.col("site") == site).toPandas().sort_values("time")
        assert list(have["time"]) == list(want["time"])
        assert (have["v"].to_numpy() == want["v"].to_numpy()).mean() > 0.999  # equal distances: the earlier


def test_dense_arrivals_are_cleaned_as_one_series(spark):
    rng = np.random.default_rng(3)
    frame = dense(6000)[["site", "time", "v"]].drop_duplicates(["site", "time"])
    frame.loc[rng.random(len(frame)) < 0.7, "v"] = np.nan
    rows = spark.createDataFrame(frame).selectExpr("site", "time", "if(isnan(v), null, v) AS v", "1 AS seq")
    got = grid.clean_series(rows.repartition(7), SITE, ["v"], "seq", hold=3, reach=4).toPandas()
    for site, part in frame.groupby("site"):
        want = part.sort_values("time")["v"].ffill(limit=3).interpolate(limit=4)
        have = got[got["site"] == site].sort_values("time")["v"]
        np.testing.assert_allclose(have.to_numpy(), want.to_numpy(), rtol=1e-9)


def test_medians_of_keys_are_dealt_by_rows(spark, monkeypatch):
    """Small keys are never ordered as one table of values; a key beyond the bound goes by ranks. Both are the exact medians."""
    rng = np.random.default_rng(8)
    data = pd.DataFrame({"k": np.where(np.arange(6000) % 3 == 0, -1, np.arange(6000) % 40), "x": np.round(rng.normal(size=6000), 2), "y": rng.normal(size=6000)})
    data.loc[rng.random(6000) < 0.4, "x"] = np.nan
    data.loc[(data["k"] == 7) | (rng.random(6000) < 0.2), "y"] = np.nan
    df = spark.createDataFrame(data).selectExpr("k", "monotonically_increasing_id() AS i", "if(isnan(x), null, x) AS x", "if(isnan(y), null, y) AS y").cache()
    monkeypatch.setattr(series, "TASK_ROWS", 100)
    ranked = []
    seen = aggregates.ordered_values
    monkeypatch.setattr(aggregates, "ordered_values", lambda rows: ranked.append(rows) or seen(rows))
    own = aggregates.median_fill(df, ["x", "y"], ["k"])
    assert not ranked and own.rdd.getNumPartitions() >= 60
    mixed = aggregates.median_fill(df, ["x", "y"], ["k"], key_rows=500)
    assert [r["k"] for r in ranked[0].select("k").distinct().collect()] == [-1]
    frame = df.toPandas()
    for c in ("x", "y"):
        frame[c] = frame[c].fillna(frame.groupby("k")[c].transform("median"))
    want = frame.set_index("i").sort_index()
    for got in (own, mixed):
        have = got.toPandas().set_index("i").sort_index()
        assert list(got.columns) == df.columns and list(have["k"]) == list(want["k"])
        np.testing.assert_allclose(have[["x", "y"]].to_numpy(float), want[["x", "y"]].to_numpy(float), rtol=1e-12)


def test_an_outlier_leaves_no_large_bucket(spark, monkeypatch):
    """One value of 1e12 among values near 0, nulls, equal values, and keys of their own size."""
    rng = np.random.default_rng(4)
    data = pd.DataFrame({"k": np.where(np.arange(40_000) % 100 == 0, 2, 1), "x": rng.normal(size=40_000), "y": np.round(rng.normal(size=40_000), 1)})
    data.loc[7, "x"], data.loc[8, "y"] = 1e12, -1e15
    data.loc[::9, "x"] = np.nan
    df = spark.createDataFrame(data).selectExpr("k", "if(isnan(x), null, x) AS x", "y").repartition(6)
    sizes = []
    seen = aggregates.ordered_values
    monkeypatch.setattr(aggregates, "ordered_values", lambda rows: sizes.append(rows) or seen(rows))
    q = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {(r["k"], r["column"]): [r[f"q_{i}"] for i in range(5)] for r in aggregates.exact_quantiles(df, ["x", "y"], q, ["k"], bucket_rows=300).collect()}
    for k in (1, 2):
        for c in ("x", "y"):
            assert got[k, c] == pytest.approx(data[data["k"] == k][c].quantile(q).tolist(), rel=1e-12)
    largest = sizes[0].groupBy("k", "__column", "__round", "__bucket").count().agg(F.max("count")).first()[0]
    assert largest <= 300
    assert aggregates.exact_quantiles(df.where("false"), ["x"], [0.5]).count() == 0
    nothing = df.withColumn("x", F.lit(None).cast("double"))
    assert aggregates.exact_quantiles(nothing, ["x"], [0.5]).count() == 0
    constant = aggregates.exact_quantiles(df.withColumn("x", F.lit(3.0)), ["x"], [0.25, 0.5], bucket_rows=2).first()
    assert (constant["q_0"], constant["q_1"]) == (3.0, 3.0)


def test_correlations_of_many_pairs_in_one_scan(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 40)) + 1e6
    data = pd.DataFrame(base, columns=[f"f{i}" for i in range(40)])
    data["t0"], data["t1"] = data["f0"] * -2 + 7, data["f1"] + rng.normal(size=3000)
    data["flat"], data["gone"] = 5.0, np.nan
    data.loc[::3, "f2"], data.loc[::7, "t1"] = np.nan, np.nan
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame(data).repartition(5)
    df = df.mapInArrow(counted, df.schema)
    features, targets = [*data.columns[:40], "flat", "gone"], ["t0", "t1"]
    got = {(r["target"], r["feature"]): r for r in aggregates.correlations(df, features, targets).collect()}
    assert len(got) == 84 and reads.value == 3000
    for (t, f), row in got.items():
        want = data[[t, f]].dropna().corr().iloc[0, 1] if data[f].nunique() > 1 else np.nan
        assert row["r"] == pytest.approx(want, abs=1e-9) if want == want else row["r"] is None
        assert row["suspicious"] == (abs(want) > 0.99)
    assert got["t0", "f0"]["suspicious"]
    none = aggregates.correlations(df.where("false"), features[:2], targets)
    assert all(r["r"] is None for r in none.collect())
