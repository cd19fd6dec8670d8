"""Merging a batch into a keyed table, as DataFrame transformations.

Each merge is one shuffle on the key. Copies of a key inside the batch collapse before the
shuffle, so a batch that is mostly copies of one row stays cheap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.series import dedupe

OBSERVATION_KEYS = ("time", "lat", "lon")
FORECAST_KEYS = ("issue_time", "forecast_time", "lat", "lon", "forecast_type", "source", "model_version")
PREDICTION_KEYS = ("issue_time", "forecast_time", "target", "model_version")
SIMPLE_PREDICTION_KEYS = ("latitude", "longitude", "timestamp", "issue_time")
FEATURE_KEYS = ("time", "lat", "lon", "feature_set_version")
RUN_KEYS = ("model_version", "target", "lat", "lon")


def _arrival(batch: DataFrame, order: str | None) -> tuple[DataFrame, Column]:
    if order is None:
        return batch, F.monotonically_increasing_id()
    return batch, F.col(order)


def upsert_replace(table: DataFrame, batch: DataFrame, keys: Sequence[str],
                   order: str | None = None) -> DataFrame:
    """A key match replaces the whole row: columns the batch lacks become NULL.

    The last arrival of a key wins; ``order`` is the arrival column of the batch.
    """
    columns = table.columns
    batch, arrival = _arrival(batch, order)
    incoming = batch.withColumn("__seq", arrival.cast("bigint"))
    incoming = incoming.select(*[c for c in columns if c in batch.columns], "__seq")
    # Stored rows rank below every arrival.
    stored = table.withColumn("__seq", F.lit(-(2 ** 62)).cast("bigint"))
    rows = stored.unionByName(incoming, allowMissingColumns=True)
    return dedupe(rows, list(keys), "__seq").select(*columns)


def upsert_columns(table: DataFrame, batch: DataFrame, keys: Sequence[str],
                   update: Sequence[str] | None = None, order: str | None = None) -> DataFrame:
    """A key match replaces only the ``update`` columns (all given ones by default)."""
    batch, arrival = _arrival(batch, order)
    given = [c for c in batch.columns if c in table.columns and c not in keys]
    update = list(update) if update is not None else given
    incoming = dedupe(batch.select(*keys, *given, arrival.cast("bigint").alias("__seq")), list(keys), "__seq")
    renamed = incoming.select(*keys, F.lit(True).alias("__in"), *[F.col(c).alias(f"__n_{c}") for c in given])
    joined = table.withColumn("__old", F.lit(True)).join(renamed, list(keys), "full")

    def value(c: str) -> Column:
        if c in keys or c not in given:
            return F.col(c)
        if c in update:
            return F.when(F.col("__in"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c)
        return F.when(F.col("__old"), F.col(c)).otherwise(F.col(f"__n_{c}")).alias(c)

    return joined.select(*[value(c) for c in table.columns])


def insert_if_absent(table: DataFrame, batch: DataFrame, keys: Sequence[str],
                     order: str | None = None) -> DataFrame:
    """Existing rows win; inside the batch the first arrival of a key wins."""
    batch, arrival = _arrival(batch, order)
    given = [c for c in batch.columns if c in table.columns]
    incoming = dedupe(batch.select(*given, arrival.cast("bigint").alias("__seq")), list(keys), "__seq",
                      keep="first").drop("__seq")
    fresh = incoming.join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(fresh, allowMissingColumns=True)


def backfill_location(df: DataFrame, lat: float, lon: float) -> DataFrame:
    return df.withColumns({"lat": F.coalesce("lat", F.lit(lat)), "lon": F.coalesce("lon", F.lit(lon))})


# ---- constraints ---------------------------------------------------------

def violation(required: Sequence[str], allowed: Mapping[str, Sequence[str]] | None = None) -> Column:
    """Name of the first broken rule of a row, or NULL."""
    out = F.lit(None).cast("string")
    for c, values in reversed(list((allowed or {}).items())):
        ok = F.coalesce(F.col(c).isin(*values), F.lit(True))
        out = F.when(~ok, F.lit(f"{c} not allowed")).otherwise(out)
    for c in reversed(list(required)):
        out = F.when(F.col(c).isNull(), F.lit(f"{c} is null")).otherwise(out)
    return out


def split_valid(df: DataFrame, required: Sequence[str],
                allowed: Mapping[str, Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the reason)."""
    marked = df.withColumn("violation", violation(required, allowed))
    return marked.where(F.col("violation").isNull()).drop("violation"), marked.where(
        F.col("violation").isNotNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
