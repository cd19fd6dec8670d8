"""Column expressions for cleaning, keys, bounds and time alignment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import config


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- locations -----------------------------------------------------------

def round_coordinate(c: Column | str) -> Column:
    return F.round(_col(c), 4)


def site_key(lat: Column | str, lon: Column | str) -> Column:
    """One BIGINT per location at four decimals: exact to join and group on."""
    lat_e4 = F.round(_col(lat) * 10000).cast("bigint")
    lon_e4 = F.round(_col(lon) * 10000).cast("bigint")
    return (lat_e4 + 900000) * 3600001 + lon_e4 + 1800000


def site_lat(site: Column | str) -> Column:
    return (F.floor(_col(site) / F.lit(3600001)) - 900000) / F.lit(10000.0)


def site_lon(site: Column | str) -> Column:
    return (F.pmod(_col(site), F.lit(3600001)) - 1800000) / F.lit(10000.0)


def location_token(lat: Column | str, lon: Column | str) -> Column:
    def part(c: Column | str) -> Column:
        return F.translate(F.format_string("%.4f", _col(c)), "-.", "m_")

    return F.concat(F.lit("lat_"), part(lat), F.lit("_lon_"), part(lon))


def in_bounding_box(lat: Column | str, lon: Column | str) -> Column:
    (lat_lo, lat_hi), (lon_lo, lon_hi) = config.BOUNDING_BOX["lat"], config.BOUNDING_BOX["lon"]
    inside = _col(lat).between(lat_lo, lat_hi) & _col(lon).between(lon_lo, lon_hi)
    return F.coalesce(inside, F.lit(False))


# ---- values --------------------------------------------------------------

def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to [low, high]; NULL stays NULL."""
    x = _col(c)
    out = x
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    return F.when(x.isNotNull(), out)


def sentinel_to_null(c: Column | str, sentinel: float = config.SENTINEL) -> Column:
    x = _col(c)
    return F.when(x != sentinel, x)


def finite_or_zero(c: Column | str) -> Column:
    """NULL, NaN and both infinities become 0."""
    x = _col(c)
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(bad, F.lit(0.0)).otherwise(x)


# ---- time ----------------------------------------------------------------

def floor_time(c: Column | str, step_seconds: int) -> Column:
    us = F.unix_micros(_col(c))
    return F.timestamp_micros(us - F.pmod(us, F.lit(step_seconds * 1_000_000)))


def ceil_time(c: Column | str, step_seconds: int) -> Column:
    us = F.unix_micros(_col(c))
    return F.timestamp_micros(us + F.pmod(-us, F.lit(step_seconds * 1_000_000)))


def next_run(c: Column | str, step_seconds: int) -> Column:
    """The next grid point strictly after the given moment."""
    return shift_time(floor_time(c, step_seconds), step_seconds)


def on_grid(c: Column | str, step_seconds: int) -> Column:
    return F.pmod(F.unix_micros(_col(c)), F.lit(step_seconds * 1_000_000)) == 0


def shift_time(c: Column | str, seconds: int | Column) -> Column:
    micros = (F.lit(seconds * 1_000_000) if isinstance(seconds, int)
              else seconds.cast("bigint") * F.lit(1_000_000))
    return F.timestamp_micros(F.unix_micros(_col(c)) + micros)


def window_end(text: Column | str, step_seconds: int) -> Column:
    """A bare date names the last grid point of that day; anything else is floored."""
    s = _col(text)
    moment = F.try_to_timestamp(s)
    last_of_day = shift_time(moment, 86400 - step_seconds)
    return floor_time(F.when(F.length(s) == 10, last_of_day).otherwise(moment), step_seconds)


def iso_utc(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def horizon_bucket(base: Column | str, moment: Column | str) -> Column:
    """24h / 48h / 72h by distance from ``base``; each bucket excludes its lower end."""
    ahead = (F.unix_micros(_col(moment)) - F.unix_micros(_col(base))) / F.lit(900e6)
    out = F.when(ahead <= 0, F.lit(None).cast("string"))
    for label, steps in config.HORIZONS.items():
        out = out.when(ahead <= steps, F.lit(label))
    return out
