"""Registered queries against their SQL twins. SKYLOOM_ALL=1 runs every one."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from skyloom import config
from skyloom.operators import features as feats

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUICK = [
    "time_grid", "ensure_full_grid_in_range", "gap_ranges", "recovery_plan", "clean_series", "backfill_merge",
    "rolling_mean_past", "ema_with_gaps", "incremental_features", "merge_sources_coalesce", "quality_report",
    "merge_into_table", "latest_ml_long", "provider_align", "rate_limit", "parse_list_forecast", "read_series_csv",
    "stream_upsert", "stream_gap_alert", "recursive_forecast", "on_demand_cycle", "direct_forecast",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("SKYLOOM_ALL") else QUICK


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    out = []
    for row in df.itertuples(index=False):
        out.append(tuple("NULL" if x is None or x is pd.NaT or x != x else
                         str(pd.Timestamp(x)) if isinstance(x, pd.Timestamp) else repr(float(x)) if isinstance(x, float)
                         else str(x) for x in row))
    return sorted(out)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, db, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_feature_matrix_returns_all_columns(spark):
    names = [*feats.matrix_columns(), *config.TARGETS]
    assert len(names) == 313 and entry.queries()["feature_matrix"](spark, FOLDER).columns == ["site", "n", *names]
    assert all(f"avg({c}) AS {c}" in entry.oracle_sql()["feature_matrix"] for c in names)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_station_matrix_returns_all_columns(spark):
    names = [*config.STATION_TARGETS, *feats.station_columns()]
    assert len(names) == 132 and entry.queries()["feature_matrix_v1"](spark, FOLDER).columns == ["site", "time", *names]
    twin = entry.oracle_sql()["feature_matrix_v1"]
    assert twin.index("SELECT site, time, " + ", ".join(names)) > 0
