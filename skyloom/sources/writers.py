"""Sinks. Tables are Parquet; keyed tables are partitioned and rewritten partition by partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.aggregates import pivot_targets
from skyloom.operators.postprocess import forecast_to_long
from skyloom.operators.tables import STORED_PREDICTION, simplify_prediction
from skyloom.session import cut_lineage, discard, stored
from skyloom.sources import upserts

MERGES = {
    "replace": upserts.upsert_replace,
    "update_given": upserts.upsert_columns,
    "keep_existing": upserts.insert_if_absent,
}


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


#: Partition values up to which a merge prunes by a literal list; a batch that touches more reads the table by a join.
MOST_TOUCHED = 10_000


def _touched(table: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The stored partitions that a batch touches."""
    distinct = batch.select(partition).distinct()
    values = [r[0] for r in distinct.limit(MOST_TOUCHED + 1).collect()]
    if len(values) > MOST_TOUCHED:
        same = F.col(f"t.{partition}").eqNullSafe(F.col(f"b.{partition}"))
        return table.alias("t").join(distinct.alias("b"), same, "left_semi").select(*table.columns)
    named = F.col(partition).isin([v for v in values if v is not None])
    return table.where(named | F.col(partition).isNull() if None in values else named)


def merge_into(batch: DataFrame, path: str, keys: Sequence[str], *, mode: str = "update_given",
               partition: str = "obs_date", partition_of: Column | None = None,
               order: str | None = None) -> int:
    """Merge a batch into a partitioned table; returns the rows offered.

    Only the partitions the batch touches are read (the scan is filtered by their values) and
    rewritten, each by as many tasks as its size asks for. The batch is stored once, compressed, and deleted at the end. New
    files are written beside the stored ones, which a dynamic overwrite replaces only when all are complete, so the merged rows
    need no copy of their own. One writer per table. The partition value must follow from the key, so that a key cannot move.
    """
    spark = batch.sparkSession
    if partition_of is not None:
        batch = batch.withColumn(partition, partition_of)
    if order is None:  # files are read back in any order
        order, batch = ARRIVAL, batch.withColumn(ARRIVAL, F.monotonically_increasing_id())
    batch, stage = stored(batch, "batch")
    try:
        offered = batch.count()
        if offered:
            _merge(batch, path, list(dict.fromkeys([*keys, partition])), mode, partition, order)
        return offered
    finally:
        discard(spark, stage)


ARRIVAL = "__arrival"


def _merge(batch: DataFrame, path: str, keys: list[str], mode: str, partition: str, order: str) -> None:
    given = batch.drop(order)
    table = read_if_exists(batch.sparkSession, path)
    if table is not None:
        table = _touched(table, batch, partition)
        columns = [*table.columns, *[c for c in given.columns if c not in table.columns]]
        for c in columns[len(table.columns):]:
            table = table.withColumn(c, F.lit(None).cast(given.schema[c].dataType))
    else:
        table = batch.sparkSession.createDataFrame([], given.schema)
    merged = MERGES[mode](table, batch, keys, order=order)
    (merged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def replace_all(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def to_points(df: DataFrame, time: str, fields: Sequence[str], tags: Sequence[str],
              defaults: Mapping[str, float] | None = None) -> DataFrame:
    """(time, tags, field, value) without NULL values; missing tag values take their default."""
    defaults = defaults or {}
    tag_columns = [F.coalesce(F.col(t), F.lit(defaults[t])).alias(t) if t in defaults else F.col(t)
                   for t in tags]
    rows = df.select(F.col(time).alias("time"), *tag_columns, *[F.col(f).cast("double").alias(f) for f in fields])
    return rows.unpivot(["time", *tags], list(fields), "field", "value").where(F.col("value").isNotNull())


def append_points(points: DataFrame, path: str) -> None:
    (points.withColumn("obs_date", F.to_date("time")).write.mode("append")
     .partitionBy("obs_date").parquet(path))


def export_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Range-sorted CSV parts with a header; reading the parts in name order gives the order."""
    df.orderBy(*order).write.mode("overwrite").csv(path, header=True)


def import_csv_upsert(spark: SparkSession, source: str, path: str, schema: str, keys: Sequence[str],
                      time: str = "time") -> int:
    """Merges the rows of CSV files; rows whose time cannot be read are appended to ``<path>_rejected`` as they were."""
    rows = spark.read.csv(source, header=True, schema=schema)
    read = rows.withColumn("__time", F.try_to_timestamp(time))
    bad = read.where(F.col("__time").isNull()).drop("__time")
    if not bad.isEmpty():
        bad.write.mode("append").parquet(f"{path}_rejected")
    batch = read.where(F.col("__time").isNotNull()).withColumn(time, F.col("__time")).drop("__time")
    return merge_into(batch, path, keys, mode="replace", partition_of=F.to_date(time))


# ---- shapes of stored rows -----------------------------------------------

def feature_store_rows(matrix: DataFrame, features: Sequence[str], targets: Sequence[str], version: str,
                       keys: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Feature and target maps of one row each."""
    def as_map(names: Sequence[str]) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(n) for n in names]),
                                 F.array(*[F.col(n).cast("double") for n in names]))

    return matrix.select(*keys, F.lit(version).alias("feature_set_version"),
                         as_map(features).alias("features"), as_map(targets).alias("targets"))


def registry_rows(runs: DataFrame, algorithm: str, feature_version: str, token: Column) -> DataFrame:
    """Registry entries of training runs: newest run per model name."""
    named = runs.withColumn("model_name", F.concat_ws("_", F.lit(algorithm), "target", token))
    one = upserts.dedupe(named, ["model_name"], "trained_at")
    return one.select("model_name", "model_version", F.lit(algorithm).alias("algorithm"),
                      F.lit(feature_version).alias("feature_set_version"), "lat", "lon", "trained_at",
                      "metrics")


def bucket_of(keys: Sequence[str], buckets: int = 16) -> Column:
    """Partition of tables whose keys hold no date."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_runs(runs: DataFrame, registry: str, history: str, algorithm: str, feature_version: str, token: Column) -> int:
    """Merge training runs into the registry (newest per model name) and into the run history (one row per ``RUN_KEYS``).

    Of equal keys in ``runs`` the one trained last counts. Repeating the call changes nothing. Returns the runs offered.
    """
    runs = cut_lineage(runs.withColumn("__trained", F.unix_micros("trained_at")))
    merge_into(registry_rows(runs, algorithm, feature_version, token), registry, ["model_name"], mode="replace",
               partition="bucket", partition_of=bucket_of(["model_name"]))
    return merge_into(runs, history, upserts.RUN_KEYS, mode="replace", partition="bucket", partition_of=bucket_of(upserts.RUN_KEYS), order="__trained")


def insert_predictions(long: DataFrame, path: str, targets: Sequence[str], constants: Mapping[str, Column]) -> int:
    """Long predictions as forecast rows: one wide row per (issue, forecast, version) with the columns that the long form
    lacks as ``constants``. Rows that the table has stay as they are. Returns the rows offered."""
    ids = ["issue_time", "forecast_time", "model_version"]
    wide = pivot_targets(long, ids, targets).withColumns(dict(constants))
    return merge_into(wide, path, upserts.FORECAST_KEYS, mode="keep_existing", partition="issue_date", partition_of=F.to_date("issue_time"))


def store_forecast(forecast: DataFrame, models: DataFrame | None, folder: str, version: str, source: str, lat: Column, lon: Column,
                   targets: Sequence[str]) -> None:
    """The stored end of a cycle: forecast rows, their long and simplified forms, and the models that made them.

    Tables under ``folder``: ``forecasts``, ``predictions``, ``predictions_simple`` and ``models``. Every write is a merge by
    the key of its table, so a cycle that is run again replaces its own rows.
    """
    rows, stage = stored(forecast.select(
        "issue_time", "forecast_time", lat.alias("lat"), lon.alias("lon"), F.lit("ml").alias("forecast_type"), F.lit(source).alias("source"),
        F.lit(version).alias("model_version"), *targets), "forecast")
    day = F.to_date("issue_time")
    merge_into(rows, f"{folder}/forecasts", upserts.FORECAST_KEYS, mode="replace", partition="issue_date", partition_of=day)
    merge_into(forecast_to_long(rows, targets), f"{folder}/predictions", [*upserts.PREDICTION_KEYS, "lat", "lon"], mode="replace",
               partition="issue_date", partition_of=day)
    names = {c: n for c, n in STORED_PREDICTION.items() if c in rows.columns}
    merge_into(simplify_prediction(rows, names), f"{folder}/predictions_simple", upserts.SIMPLE_PREDICTION_KEYS, mode="replace",
               partition="issue_date", partition_of=day)
    discard(forecast.sparkSession, stage)
    if models is not None:
        merge_into(models.withColumn("model_version", F.lit(version)), f"{folder}/models", ["model_version", "group", "target"], mode="replace",
                   partition="bucket", partition_of=bucket_of(["model_version", "group", "target"]))


def training_report_rows(report: DataFrame, run_at: Column) -> DataFrame:
    """One row per target and horizon; every other column goes into a JSON text, NaN as null."""
    rest = [c for c in report.columns if c not in ("target", "horizon")]
    doubles = {f.name for f in report.schema.fields if f.dataType.typeName() in ("double", "float")}
    clean = [F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in rest]
    metrics = F.to_json(F.struct(*clean), {"ignoreNullFields": "false"})
    return report.select(run_at.alias("run_at"), "target", "horizon", metrics.alias("metrics"))
