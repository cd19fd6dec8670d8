"""CSV sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions.scalar import sentinel_to_null
from skyloom.operators.series import dedupe
from skyloom.operators.tables import conform

# Column names of the satellite CSV and known aliases of series CSVs.
SATELLITE_CSV = {
    "YEAR": "int", "MO": "int", "DY": "int", "HR": "int",
    "T2M": "double", "WS10M": "double", "ALLSKY_SFC_SW_DWN": "double",
    "ALLSKY_SFC_SW_DIFF": "double", "CLOUD_AMT": "double",
}
SATELLITE_CSV_NAMES = {
    "T2M": "temperature", "WS10M": "windspeed", "CLOUD_AMT": "cloudcover",
    "ALLSKY_SFC_SW_DWN": "ghi", "ALLSKY_SFC_SW_DIFF": "dhi",
}
SERIES_ALIASES = {"cloudcover": "cloud_cover", "CLOUD_AMT": "cloud_cover"}
# End of fixed values.


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Satellite CSV whose preamble lines stand before the header.

    A data line starts with a four-digit year and a comma; preamble and header never do, so lines
    are told apart without counting them and files stay splittable. -999 is missing.
    """
    lines = spark.read.text(path).where(F.col("value").rlike(r"^\s*\d{4}\s*,"))
    schema = ", ".join(f"{c} {t}" for c, t in SATELLITE_CSV.items())
    row = lines.select(F.from_csv("value", schema).alias("r")).select("r.*")
    moment = F.try_make_timestamp("YEAR", "MO", "DY", "HR", F.lit(0), F.lit(0).cast("decimal(16,6)"))
    return row.select(moment.alias("timestamp"), *[
        sentinel_to_null(c).alias(n) for c, n in SATELLITE_CSV_NAMES.items()])


def read_series_csv(spark: SparkSession, path: str, columns: Sequence[str], *,
                    targets: Sequence[str] = config.STATION_TARGETS, keys: Sequence[str] = (),
                    aliases: Mapping[str, str] = SERIES_ALIASES) -> DataFrame:
    """Station CSV with a header; ``columns`` is the header, so nothing is inferred.

    Aliases are renamed, missing targets padded with NULL, rows without a readable timestamp
    dropped, and the last row per timestamp kept (by file and line order).
    """
    raw = spark.read.csv(path, header=True, enforceSchema=False,
                         schema=", ".join(f"`{c}` string" for c in columns))
    arrival = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                       F.monotonically_increasing_id())
    rows = raw.select("*", arrival.alias("__arrival")).withColumnsRenamed(dict(aliases))
    rows = conform(rows.withColumn("timestamp", F.try_to_timestamp("timestamp")),
                   {**{k: "string" for k in keys}, "timestamp": "timestamp",
                    **{t: "double" for t in targets},
                    "__arrival": "struct<a:string,b:bigint,c:bigint>"})
    rows = rows.where(F.col("timestamp").isNotNull())
    return dedupe(rows, [*keys, "timestamp"], "__arrival").drop("__arrival").orderBy(*keys, "timestamp")


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               time: str = "time") -> DataFrame:
    """A stored series table by time; a missing table is an error of the reader."""
    df = spark.read.parquet(path)
    return (df.select(time, *columns) if columns else df).orderBy(time)
