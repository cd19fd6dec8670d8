"""The 15-minute loop as Structured Streaming.

Every query can run once over what is there (``availableNow``) or on a schedule; a restart
continues from its checkpoint. Batches are written under their id and overwritten on replay, so a
repeated batch changes nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skyloom.operators.series import Series
from skyloom.session import cut_lineage
from skyloom.sources.writers import merge_into, read_if_exists


def read_folder(spark: SparkSession, path: str, schema, files_per_batch: int | None = None,
                kind: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, *,
          mode: str = "append", every: str | None = None) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _to_batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """All batch folders, with ``batch_id``; empty when nothing was written."""
    rows = read_if_exists(spark, path)
    if rows is None:
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0))
    return rows


def read_current(spark: SparkSession, path: str, schema) -> DataFrame:
    """The present state that :func:`write_updates` keeps: one row per key, a plain scan."""
    rows = read_if_exists(spark, path)
    return spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())


def land_and_parse(payloads: DataFrame, parse: Callable[[DataFrame], DataFrame], raw_path: str,
                   parsed_path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Raw audit rows and parsed rows of every new payload."""
    to_raw, to_parsed = _to_batch_folder(raw_path), _to_batch_folder(parsed_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        to_raw(batch, batch_id)
        to_parsed(parse(batch), batch_id)
        batch.unpersist()

    return start(payloads, handle, checkpoint, every=every)


def upsert_stream(rows: DataFrame, path: str, keys: Sequence[str], checkpoint: str, *,
                  mode: str = "update_given", time: str = "time", order: str | None = None,
                  audit: str | None = "epoch_id", every: str | None = None) -> StreamingQuery:
    """Merge every batch into a keyed table; running a window again gives the same table.

    Rows of any age are merged, so late data simply overwrites by key.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn(audit, F.lit(batch_id)) if audit else batch
        merge_into(marked, path, keys, mode=mode, partition_of=F.to_date(time), order=order)

    return start(rows, handle, checkpoint, every=every)


def tumbling_mean(rows: DataFrame, series: Series, columns: Sequence[str], delay: str) -> DataFrame:
    """Mean per key and bucket of the grid step."""
    bucket = F.window(series.time, f"{series.step} seconds")
    return (rows.withWatermark(series.time, delay).groupBy(*series.keys, bucket)
            .agg(*[F.avg(c).alias(c) for c in columns])
            .select(*series.keys, F.col("window.start").alias(series.time), *columns))


def sliding_stats(rows: DataFrame, series: Series, columns: Sequence[str], width: str, slide: str,
                  delay: str) -> DataFrame:
    """Mean and sample std over sliding time windows, labelled by window end.

    Equal to row-based rolling statistics only on a gap-free grid.
    """
    stats = [s for c in columns for s in (F.avg(c).alias(f"{c}_mean"), F.stddev_samp(c).alias(f"{c}_std"))]
    names = [n for c in columns for n in (f"{c}_mean", f"{c}_std")]
    return (rows.withWatermark(series.time, delay)
            .groupBy(*series.keys, F.window(series.time, width, slide)).agg(*stats)
            .select(*series.keys, F.col("window.end").alias(series.time), *names))


def write_updates(aggregate: DataFrame, path: str, keys: Sequence[str], checkpoint: str, *, time: str = "time",
                  every: str | None = None) -> StreamingQuery:
    """Keep the newest value of every group in a keyed table.

    A batch brings each changed group once and is merged into the days it touches, which the watermark bounds. So the
    table holds one row per group at all times; a repeated batch writes the same rows again.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_into(batch, path, keys, mode="replace", partition_of=F.to_date(time))

    return start(aggregate, handle, checkpoint, mode="update", every=every)


def unique_rows(rows: DataFrame, series: Series, delay: str) -> DataFrame:
    """The first row per key and time within the watermark."""
    return rows.withWatermark(series.time, delay).dropDuplicatesWithinWatermark([*series.keys, series.time])


def write_appends(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return start(rows, _to_batch_folder(path), checkpoint, every=every)


def split_late(batch: DataFrame, time: str, newest_seen: str, days: int = 14) -> tuple[DataFrame, DataFrame]:
    """(in time, late): late rows are older than the state keeps and take the merge path. Rows of a key that was never
    seen are in time."""
    late = F.coalesce(F.unix_micros(time) < F.unix_micros(newest_seen) - days * 86_400_000_000, F.lit(False))
    return batch.where(~late), batch.where(late)


def upsert_with_late(rows: DataFrame, path: str, series: Series, checkpoint: str, *, days: int = 14,
                     mode: str = "update_given", every: str | None = None) -> StreamingQuery:
    """Merge rows of any age into a keyed table and say which of them came late.

    The newest time seen of every key is kept per batch under ``<path>_newest``. Rows up to ``days`` older
    follow the stream. Older ones are merged in a step of their own, and their (keys, day) go to ``<path>_repairs``: what was
    derived from these days is to be made again. A repeated batch reads the state before it, so it parts the same rows.
    """
    keys, t = list(series.keys), series.time
    to_newest, to_repairs = _to_batch_folder(f"{path}_newest"), _to_batch_folder(f"{path}_repairs")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = cut_lineage(batch)
        known = read_if_exists(spark, f"{path}_newest")
        if known is not None:
            known = known.where(F.col("batch_id") < batch_id)
            known = cut_lineage(known.groupBy(*keys).agg(F.max("__newest").alias("__newest")))
            marked = batch.join(known, keys, "left")
        else:
            marked = batch.withColumn("__newest", F.lit(None).cast("timestamp"))
        current, late = (part.drop("__newest") for part in split_late(marked, t, "__newest", days))
        merge_into(current, path, [*keys, t], mode=mode, partition_of=F.to_date(t))
        if merge_into(late, path, [*keys, t], mode=mode, partition_of=F.to_date(t)):
            to_repairs(late.select(*keys, F.to_date(t).alias("day")).distinct(), batch_id)
        to_newest(batch.groupBy(*keys).agg(F.max(t).alias("__newest")), batch_id)

    return start(rows, handle, checkpoint, every=every)


def _with_rows(first: int, last: int, gaps: list[tuple[int, int]], times: np.ndarray, step: int) -> tuple[int, int, list[tuple[int, int]]]:
    """The span and the gaps of a key after rows at ``times`` (ascending); ``gaps`` ascend and do not touch."""
    begins = [g[0] for g in gaps]
    for t in times.tolist():
        if t > last:
            if t - last > step:
                gaps.append((last + step, t - step))
                begins.append(last + step)
            last = t
        elif t < first:
            if first - t > step:
                gaps.insert(0, (t + step, first - step))
                begins.insert(0, t + step)
            first = t
        else:
            i = bisect_right(begins, t) - 1
            if i >= 0 and t <= gaps[i][1]:
                low, high = gaps[i]
                rest = [g for g in ((low, t - step), (t + step, high)) if g[0] <= g[1]]
                gaps[i:i + 1], begins[i:i + 1] = rest, [g[0] for g in rest]
    return first, last, gaps


def gap_alerts(rows: DataFrame, series: Series, keep_days: int = 14) -> DataFrame:
    """Missing grid stretches between the rows of a key, as they open and as late rows close them.

    Rows may come in any order. ``change`` is 1 for a gap that opened and -1 for one that is withdrawn because a row
    fell into it; what is left of it opens anew. :func:`open_gaps` adds the changes up. The state of a
    key is its span and the gaps of its last ``keep_days`` days: older gaps are final, and rows older than that do not change them.
    """
    names, step, keep = list(series.keys), series.step_us, keep_days * 86_400_000_000
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in names)

    def find(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times = np.unique(np.concatenate([p["__at"].to_numpy() for p in parts]))
        if state.exists:
            first, last, lows, highs = state.get
            before = list(zip(lows, highs))
        else:
            first, last, before = int(times[0]), int(times[0]), []
        first, last, after = _with_rows(first, last, list(before), times[times >= last - keep], step)
        opened, withdrawn = sorted(set(after) - set(before)), sorted(set(before) - set(after))
        kept = [g for g in after if g[1] >= last - keep]
        state.update((max(first, last - keep), last, [g[0] for g in kept], [g[1] for g in kept]))
        changes = [(*g, 1) for g in opened] + [(*g, -1) for g in withdrawn]
        if changes:
            low, high, change = zip(*changes)
            yield pd.DataFrame({**dict(zip(names, keys)), "gap_start": list(low), "gap_end": list(high), "change": list(change)})

    on_grid = F.pmod(series.at(), F.lit(step)) == 0
    slim = rows.where(on_grid).select(*names, series.at().alias("__at"))
    found = slim.groupBy(*names).applyInPandasWithState(
        find, f"{kinds}, gap_start bigint, gap_end bigint, change int", "first bigint, last bigint, lows array<bigint>, highs array<bigint>",
        "append", GroupStateTimeout.NoTimeout)
    return found.select(*names, F.timestamp_micros("gap_start").alias("gap_start"),
                        F.timestamp_micros("gap_end").alias("gap_end"), "change")


def open_gaps(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gaps that opened and were not withdrawn."""
    return (changes.groupBy(*keys, "gap_start", "gap_end").agg(F.sum("change").alias("__open"))
            .where(F.col("__open") > 0).drop("__open"))
