"""Where the sun stands, as one set of column expressions over UTC-independent clock time.

With b = 2 pi (day - 81) / 365, declination and the equation of time are short sine sums of b; the cosine of the zenith
is a sin-sin plus a cos-cos term of latitude and declination, the second times the cosine of the hour angle. The same two
terms give the half day: the sun stands on the horizon where their sum is zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.functions.calendar import fractional_hour

# Obliquity in degrees, and minutes of the equation of time by term (sin 2b, cos b, sin b).
OBLIQUITY = 23.45
TIME_TERMS = (9.87, -7.53, -1.5)
# End of fixed values.


def solar_position(time: str = "time", lat: str = "lat", lon: str = "lon", utc_offset: float = 5.5) -> list[Column]:
    """solar_zenith and solar_elevation in degrees, day_length in hours, is_daylight; ``time`` is clock time at
    ``utc_offset``. Nulls give nulls; polar day and night are 24 and 0 hours."""
    day, hour = F.dayofyear(time), fractional_hour(F.col(time))
    b = F.radians((day - 81) * F.lit(360.0 / 365.0))
    tilt, phi = F.radians(F.lit(OBLIQUITY)) * F.sin(b), F.radians(lat)
    minutes = sum(F.lit(k) * wave for k, wave in zip(TIME_TERMS, (F.sin(b * 2.0), F.cos(b), F.sin(b))))
    noon = F.lit(12.0) - (minutes + (F.col(lon) - F.lit(15.0 * utc_offset)) * 4.0) / 60.0
    turned = F.radians((hour - noon) * 15.0)
    arc = lambda cosine: F.degrees(F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))))
    zenith = arc(F.sin(phi) * F.sin(tilt) + F.cos(phi) * F.cos(tilt) * F.cos(turned))
    half_day = arc(-(F.tan(phi) * F.tan(tilt))) / 15.0
    return [zenith.alias("solar_zenith"), (F.lit(90.0) - zenith).alias("solar_elevation"),
            (half_day * 2.0).alias("day_length"), (zenith < 90.0).cast("int").alias("is_daylight")]
