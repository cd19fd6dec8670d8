"""Small hand-made series and comparison with plain pandas."""

import numpy as np
import pandas as pd
from pyspark.sql import types as T


def series_frame(spark, data, columns=("x",)):
    """``data``: {site: DataFrame indexed by time}."""
    rows = []
    for site, frame in data.items():
        for moment, row in frame.iterrows():
            values = [None if pd.isna(row[c]) else float(row[c]) for c in columns]
            rows.append((site, moment.to_pydatetime(), *values))
    schema = T.StructType([T.StructField("site", T.LongType()), T.StructField("time", T.TimestampType())]
                          + [T.StructField(c, T.DoubleType()) for c in columns])
    return spark.createDataFrame(rows, schema)


def collect(df, columns=("x",)):
    out = {}
    for site, part in df.toPandas().groupby("site"):
        out[site] = part.set_index("time").sort_index()[list(columns)].astype(float)
    return out


def assert_series(df, expected, columns=("x",), **kw):
    got = collect(df, columns)
    assert set(got) == set(expected)
    for site, want in expected.items():
        have = got[site]
        assert list(have.index) == list(want.index), site
        for c in columns:
            np.testing.assert_allclose(have[c].to_numpy(), want[c].astype(float).to_numpy(),
                                       rtol=1e-9, atol=1e-9, err_msg=f"{site} {c}", **kw)


def random_series(seed, n=400, freq="1h", holes=0.6, start="2024-01-01", drop_rows=0.0):
    rng = np.random.default_rng(seed)
    index = pd.date_range(start, periods=n, freq=freq)
    values = rng.normal(20, 5, n)
    values[rng.random(n) < holes] = np.nan
    frame = pd.DataFrame({"x": values}, index=index)
    return frame[rng.random(n) >= drop_rows] if drop_rows else frame
