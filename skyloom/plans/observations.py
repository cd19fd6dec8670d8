"""From landed payloads to observation and forecast tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from skyloom import config
from skyloom.operators.grid import complete_grid, upsample
from skyloom.operators.joins import merge_outer
from skyloom.operators.series import Series, dedupe
from skyloom.operators.tables import prepare_forecast, split_actual_forecast
from skyloom.sources.payloads import parse_hourly_arrays, parse_param_map


def latest_rows(rows: DataFrame, series: Series, arrival: str) -> DataFrame:
    return dedupe(rows, [*series.keys, series.time], arrival).drop(arrival)


def merged_history(archive: DataFrame, satellite: DataFrame, series: Series, start: Column, end: Column, *,
                   provider: Sequence[str] = config.PROVIDER_MEASURES,
                   measures: Sequence[str] = config.SATELLITE_MEASURES) -> DataFrame:
    """Both archives on the grid, merged, cropped to the range and completed."""
    left = upsample(archive, series, provider)
    right = upsample(satellite, series, measures)
    merged = merge_outer(left, right, [*series.keys, series.time])
    return complete_grid(merged, series, [*provider, *measures], start=start, end=end)


def backfill(archive_payloads: DataFrame, satellite_payloads: DataFrame, series: Series, start: Column,
             end: Column, arrival: str = "arrival") -> DataFrame:
    """Observation rows of a repair range from landed archive and satellite payloads."""
    archive = latest_rows(parse_hourly_arrays(archive_payloads), series, arrival)
    satellite = latest_rows(parse_param_map(satellite_payloads), series, arrival)
    return merged_history(archive, satellite, series, start, end)


def live_update(payloads: DataFrame, series: Series, issue: Column, arrival: str = "arrival",
                measures: Sequence[str] = config.PROVIDER_MEASURES) -> tuple[DataFrame, DataFrame]:
    """(observation rows up to the issue, provider forecast rows after it).

    ``series`` is keyed by (lat, lon), which the forecast table needs.
    """
    rows = latest_rows(parse_hourly_arrays(payloads, measures), series, arrival)
    actual, future = split_actual_forecast(upsample(rows, series, measures), issue, series.time)
    return actual, prepare_forecast(future, issue, "provider", "open_meteo", time=series.time)
