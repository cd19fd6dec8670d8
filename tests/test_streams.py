"""Late rows, withdrawn gaps and stored aggregates of the streaming jobs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators.series import Series
from skyloom.streaming import jobs

SITE = Series(step=3600)
HOUR = 3_600_000_000



def rows(spark, *pairs):
    return spark.createDataFrame([(s, h) for s, h in pairs], "site long, h long").selectExpr(
        "site", f"timestamp_micros(h * {HOUR}) AS time", "cast(h as double) AS x")


def run_batches(spark, folder, build, batches):
    """One run of the job per batch, on one checkpoint."""
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        job = build(jobs.read_folder(spark, f"{folder}/in", batch.schema))
        job.awaitTermination()
        assert job.exception() is None


def test_gaps_in_any_order_of_rows():
    rng = random.Random(1)
    for _ in range(200):
        hours = rng.sample(range(60), rng.randint(1, 40))
        first = last = hours[0]
        gaps, i = [], 0
        while i < len(hours):
            n = rng.randint(1, 10)
            first, last, gaps = jobs._with_rows(first, last, gaps, np.unique(hours[i:i + n]), 1)
            i += n
        seen = sorted(hours)
        assert (first, last) == (seen[0], seen[-1])
        assert gaps == [(a + 1, b - 1) for a, b in zip(seen, seen[1:]) if b - a > 1]


def test_a_filled_gap_is_withdrawn(spark, tmp_path):
    folder, batches = str(tmp_path), [
        rows(spark, (1, 10), (1, 20), (2, 10)), rows(spark, (1, 15), (2, 12)), rows(spark, (2, 11), (1, 5)),
        rows(spark, *[(1, h) for h in range(16, 20)]), rows(spark, (1, 1000)), rows(spark, (1, 12))]
    build = lambda df: jobs.write_appends(jobs.gap_alerts(df, SITE, keep_days=14), f"{folder}/out", f"{folder}/ckpt")
    run_batches(spark, folder, build, batches)
    changes = spark.read.parquet(f"{folder}/out").withColumns({c: (F.unix_micros(c) / HOUR).cast("int") for c in ("gap_start", "gap_end")})
    events = sorted(map(tuple, changes.select("site", "gap_start", "gap_end", "change").collect()))
    assert (1, 11, 19, 1) in events and (1, 11, 19, -1) in events and (2, 11, 11, -1) in events
    left = sorted(map(tuple, jobs.open_gaps(changes, ["site"]).collect()))
    # The row at hour 12 came after the state had let go of its gap: that gap stays as it was reported.
    assert left == [(1, 6, 9), (1, 11, 14), (1, 21, 999)]


def test_late_rows_take_the_merge_path_and_name_their_days(spark, tmp_path):
    folder, day = str(tmp_path), 24
    batches = [rows(spark, (1, 40 * day), (2, day)), rows(spark, (1, 39 * day), (1, 3 * day), (1, 3 * day + 1), (2, 30 * day), (3, 0)),
               rows(spark, (2, 5 * day), (1, 41 * day)).withColumn("x", F.lit(-1.0))]
    run_batches(spark, folder, lambda df: jobs.upsert_with_late(df, f"{folder}/t", SITE, f"{folder}/ckpt"), batches)
    stored = {(r["site"], r["h"]): r["x"] for r in spark.read.parquet(f"{folder}/t").withColumn("h", (F.unix_micros("time") / HOUR).cast("int")).collect()}
    assert len(stored) == 9 and stored[1, 3 * day] == 72.0 and stored[2, 5 * day] == -1.0
    repairs = spark.read.parquet(f"{folder}/t_repairs")
    assert sorted((r["site"], (r["day"] - np.datetime64("1970-01-01").astype(object)).days) for r in repairs.collect()) == [(1, 3), (2, 5)]


@pytest.mark.parametrize("again", [False, True])
def test_stored_aggregates_hold_one_row_per_group(spark, tmp_path, again):
    folder = str(tmp_path)
    batches = [rows(spark, (1, 0), (1, 1)), rows(spark, (1, 1), (1, 2)), rows(spark, (1, 2), (2, 2))]
    build = lambda df: jobs.write_updates(jobs.tumbling_mean(df, SITE, ["x"], "10 days"), f"{folder}/t", ["site", "time"], f"{folder}/ckpt")
    run_batches(spark, folder, build, batches + batches[:1] * again)
    schema = rows(spark, (1, 0)).schema
    got = jobs.read_current(spark, f"{folder}/t", schema)
    assert got.count() == 4 and "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert jobs.read_current(spark, f"{folder}/nothing", schema).count() == 0
