"""Parsers of landed provider payloads: one JSON text column in, typed rows out.

Every parser takes a DataFrame with a ``payload`` column; the other columns (location, request
window) stay on each row. Only the fields named in the schemas are read from the text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import config
from skyloom.functions.scalar import sentinel_to_null

# Field names of the provider payloads.
MINUTELY_FIELDS = {
    "shortwave_radiation": "om_ghi",
    "diffuse_radiation": "om_dhi",
    "temperature_2m": "om_temperature",
    "windspeed_10m": "om_windspeed",
    "cloudcover": "om_cloud_cover",
    "relative_humidity_2m": "om_relative_humidity",
    "surface_pressure": "om_surface_pressure",
}
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
CURRENT_FIELDS = {
    "temperature": "temp",
    "feelslike": "feelslike",
    "humidity": "humidity",
    "pressure": "pressure",
    "wind_speed": "wind_speed",
    "cloudcover": "cloudcover",
    "precip": "precipitation",
    "uv_index": "uv_index",
    "visibility": "visibility",
}
# End of fixed values.


def _doubles(names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]


def _kept(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "payload"]


def split_bad_times(rows: DataFrame, time: str = "time") -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): parsers give NULL for a time text they cannot read; such rows go to quarantine."""
    return rows.where(F.col(time).isNotNull()), rows.where(F.col(time).isNull())


def _parallel_arrays(df: DataFrame, block: str, measures: Sequence[str]) -> DataFrame:
    """Struct of parallel arrays to rows; no block or no ``time`` gives no rows."""
    fields = T.StructType([T.StructField("time", T.ArrayType(T.StringType())), *_doubles(measures)])
    schema = T.StructType([T.StructField(block, fields)])
    kept = _kept(df)
    body = df.select(*kept, F.from_json("payload", schema)[block].alias("__b"))
    # An absent variable is padded with NULL to the length of the time array.
    none = F.array().cast("array<double>")
    zipped = F.arrays_zip(F.col("__b.time").alias("time"), *[
        F.coalesce(F.col(f"__b.{c}"), none).alias(c) for c in measures])
    rows = body.where(F.col("__b.time").isNotNull()).select(*kept, F.explode(zipped).alias("__r"))
    return rows.select(*kept, F.try_to_timestamp("__r.time").alias("time"),
                       *[F.col(f"__r.{c}").alias(c) for c in measures])


def parse_hourly_arrays(df: DataFrame, measures: Sequence[str] = config.PROVIDER_MEASURES) -> DataFrame:
    return _parallel_arrays(df, "hourly", measures)


def parse_minutely15_arrays(df: DataFrame, fields: Mapping[str, str] = MINUTELY_FIELDS) -> DataFrame:
    return _parallel_arrays(df, "minutely_15", list(fields)).withColumnsRenamed(dict(fields))


def parse_param_map(df: DataFrame, parameters: Mapping[str, str] = config.SATELLITE_PARAMETERS) -> DataFrame:
    """``properties.parameter.{NAME}.{yyyyMMddHH}`` to one row per hour; -999 is missing.

    The maps of one payload are unfolded over the union of their hours, so no shuffle is needed
    to put the parameters side by side.
    """
    per_hour = T.MapType(T.StringType(), T.DoubleType())
    inner = T.StructType([T.StructField(p, per_hour) for p in parameters])
    schema = T.StructType([T.StructField("properties", T.StructType([T.StructField("parameter", inner)]))])
    kept = _kept(df)
    body = df.select(*kept, F.from_json("payload", schema)["properties"]["parameter"].alias("__p"))
    none = F.array().cast("array<string>")
    hours = F.array_distinct(F.flatten(F.array(*[
        F.coalesce(F.map_keys(f"__p.{p}"), none) for p in parameters])))
    rows = body.select("*", F.explode(hours).alias("__h"))
    return rows.select(*kept, F.try_to_timestamp("__h", F.lit("yyyyMMddHH")).alias("time"), *[
        sentinel_to_null(F.element_at(F.col(f"__p.{p}"), F.col("__h"))).alias(name)
        for p, name in parameters.items()])


def _hourly_struct_schema() -> T.StructType:
    text = T.StringType()
    hourly = T.StructType([T.StructField(n, text) for n in ("time", "tempC", "cloudcover", "precipMM")])
    day = T.StructType([T.StructField("hourly", T.ArrayType(hourly))])
    data = T.StructType([T.StructField("weather", T.ArrayType(day)), T.StructField("error", text)])
    return T.StructType([T.StructField("data", data)])


def split_hourly_structs(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): a payload without ``data`` or with an ``error`` is rejected."""
    parsed = df.withColumn("__data", F.from_json("payload", _hourly_struct_schema())["data"])
    ok = F.col("__data").isNotNull() & F.col("__data.error").isNull()
    return parsed.where(ok), parsed.where(~ok).drop("__data")


def parse_hourly_structs(df: DataFrame, day: str = "day") -> DataFrame:
    """``data.weather[0].hourly[]`` with ``time`` as HHmm (zero padded); missing numbers are 0."""
    usable, _ = split_hourly_structs(df)
    kept = _kept(df)
    hourly = F.explode(F.get(F.col("__data.weather"), F.lit(0))["hourly"])
    rows = usable.select(*kept, hourly.alias("__h"))
    hhmm = F.lpad("__h.time", 4, "0")
    moment = F.try_to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "),
                                         F.substring(hhmm, 1, 2), F.lit(":"), F.substring(hhmm, 3, 2)))

    def number(c: str) -> Column:
        return F.coalesce(F.col(f"__h.{c}").try_cast("double"), F.lit(0.0))

    return rows.select(*kept, moment.alias("time"), number("tempC").alias("temp"),
                       number("cloudcover").alias("cloud_cover"), number("precipMM").alias("rain"))


def list_time(text: Column, year: Column) -> Column:
    """``10Mar:05.30`` of the given year; NULL when the text or the date is not valid.

    An unknown month name counts as January.
    """
    pattern = r"^(\d{1,2})(\w{3}):(\d{2})\.(\d{2})"
    part = [F.regexp_extract(text, pattern, i) for i in range(1, 5)]
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), part[1])
    return F.when(F.regexp_like(text, F.lit(pattern)), F.try_make_timestamp(
        year, F.when(month == 0, F.lit(1)).otherwise(month).cast("int"),
        part[0].try_cast("int"), part[2].try_cast("int"), part[3].try_cast("int"), F.lit(0).cast("decimal(16,6)")))


def parse_list_forecast(df: DataFrame, year: Column) -> DataFrame:
    """Parallel ``timeList`` / ``temprList`` / ``potentialList``.

    The payload may be the record or a list whose first entry is the record. A value list counts
    only when it is as long as the time list.
    """
    numbers = T.ArrayType(T.DoubleType())
    record = T.StructType([T.StructField("timeList", T.ArrayType(T.StringType())),
                           T.StructField("temprList", numbers), T.StructField("potentialList", numbers)])
    kept = _kept(df)
    is_list = F.substring(F.trim("payload"), 1, 1) == "["
    first = F.when(is_list, F.get(F.from_json("payload", T.ArrayType(record)), F.lit(0))).otherwise(
        F.from_json("payload", record))
    body = df.select(*kept, first.alias("__r")).where(F.size("__r.timeList") > 0)

    def usable(c: str) -> Column:
        same = F.size(f"__r.{c}") == F.size("__r.timeList")
        return F.when(same, F.col(f"__r.{c}")).alias(c)

    body = body.select(*kept, F.col("__r.timeList").alias("timeList"), usable("temprList"),
                       usable("potentialList"))
    rows = body.select(*kept, "temprList", "potentialList", F.posexplode("timeList").alias("__i", "__t"))
    return rows.select(*kept, list_time(F.col("__t"), year).alias("time"),
                       F.get("temprList", F.col("__i")).alias("vedas_temperature"),
                       F.get("potentialList", F.col("__i")).alias("vedas_solar_potential"),
                       ).where(F.col("time").isNotNull())


def parse_current_snapshot(df: DataFrame, requested_at: str = "requested_at") -> DataFrame:
    """``current`` conditions to one row per payload; payloads without the block give none."""
    fields = [T.StructField(c, T.DoubleType()) for c in CURRENT_FIELDS]
    current = T.StructType([*fields, T.StructField("wind_dir", T.StringType()),
                            T.StructField("weather_descriptions", T.ArrayType(T.StringType()))])
    schema = T.StructType([T.StructField("current", current)])
    kept = [c for c in _kept(df) if c != requested_at]
    rows = df.select(*kept, F.col(requested_at).alias("timestamp"),
                     F.from_json("payload", schema)["current"].alias("__c"))
    return rows.where(F.col("__c").isNotNull()).select(
        *kept, "timestamp", *[F.col(f"__c.{c}").alias(n) for c, n in CURRENT_FIELDS.items()],
        F.col("__c.wind_dir").alias("wind_dir"),
        F.get("__c.weather_descriptions", F.lit(0)).alias("description"))


def parse_observed_now(df: DataFrame, requested_at: str = "requested_at") -> DataFrame:
    """``main`` / ``clouds`` / ``rain`` conditions; no ``rain.1h`` means 0."""
    number = T.DoubleType()
    schema = T.StructType([
        T.StructField("main", T.StructType([T.StructField("temp", number)])),
        T.StructField("clouds", T.StructType([T.StructField("all", number)])),
        T.StructField("rain", T.StructType([T.StructField("1h", number)]))])
    kept = [c for c in _kept(df) if c != requested_at]
    rows = df.select(*kept, F.col(requested_at).alias("timestamp"),
                     F.from_json("payload", schema).alias("__c"))
    return rows.where(F.col("__c.main").isNotNull()).select(
        *kept, "timestamp", F.col("__c.main.temp").alias("temp"),
        F.col("__c.clouds.all").alias("cloud_cover"),
        F.coalesce(F.col("__c.rain")["1h"], F.lit(0.0)).alias("rain"))
