"""Aggregations: buckets, latest values, medians, error metrics and quality reports."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from skyloom.functions.scalar import floor_time, shift_time
from skyloom.operators.grid import complete_grid
from skyloom.operators.series import TASK_ROWS, Series, dealt
from skyloom.session import cut_lineage


def bucket_mean(df: DataFrame, series: Series, columns: Sequence[str],
                label: str = "start") -> DataFrame:
    """Mean per key and tumbling bucket, without empty buckets; labelled by start or end."""
    bucket = floor_time(series.time, series.step)
    out = df.groupBy(*series.keys, bucket.alias("__bucket")).agg(
        *[F.avg(c).alias(c) for c in columns])
    named = F.col("__bucket") if label == "start" else shift_time("__bucket", series.step)
    return out.select(*series.keys, named.alias(series.time), *columns)


def resample_mean(df: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """As :func:`bucket_mean`, with a NULL row for every empty bucket in between."""
    return complete_grid(bucket_mean(df, series, columns), series, columns, fill="none")


def key_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str], packed: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(keys, n, mean of every column): what ``groupBy(keys)`` with ``avg`` gives, for hundreds of columns. ``packed`` gives the
    names of what array columns hold.

    A generated aggregate of that width is too large a method to be compiled. Here tasks add up runs of rows of one key as
    arrays, one row per run is shuffled, and runs of a key are added up in order. Keys must not be NULL.
    """
    keys, plain = list(keys), list(columns)
    packed = {c: list(names) for c, names in (packed or {}).items()}
    columns = [*plain, *(name for names in packed.values() for name in names)]
    width = len(columns)
    ids = [df.schema[k] for k in keys]
    partial = StructType([*ids, StructField("n", LongType()), StructField("__sums", ArrayType(DoubleType())), StructField("__counts", ArrayType(DoubleType()))])

    def heads(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for k in keys:
            cells = batch.column(k)
            new[1:] |= pc.not_equal(cells.slice(1), cells.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def arrays(x: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * width, pa.int32()), pa.array(x.reshape(-1)))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = heads(batch)
            sizes = np.diff(np.append(at, batch.num_rows))
            sums, counts = np.empty((len(at), width)), np.empty((len(at), width))
            for i, c in enumerate(plain):
                cells = batch.column(c)
                whole = cells.null_count == 0
                sums[:, i] = np.add.reduceat((cells if whole else pc.fill_null(cells, 0.0)).to_numpy(zero_copy_only=False), at)
                counts[:, i] = sizes if whole else np.add.reduceat(np.asarray(cells.is_valid()).astype(float), at)
            end = len(plain)
            for c, names in packed.items():
                begin, end = end, end + len(names)
                cells = batch.column(c).flatten()
                shaped = (cells if cells.null_count == 0 else pc.fill_null(cells, 0.0)).to_numpy(zero_copy_only=False).reshape(-1, len(names))
                sums[:, begin:end] = np.add.reduceat(shaped, at)
                valid = None if cells.null_count == 0 else np.asarray(cells.is_valid()).astype(float).reshape(-1, len(names))
                counts[:, begin:end] = sizes[:, None] if valid is None else np.add.reduceat(valid, at)
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(at)) for k in keys), pa.array(sizes), arrays(sums), arrays(counts)], partial.names)

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the key that may go on in the next batch

        def finished(key: pa.RecordBatch, n: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            found = [pa.array(sums[:, i] / np.maximum(counts[:, i], 1.0), mask=counts[:, i] == 0) for i in range(width)]
            return pa.RecordBatch.from_arrays([*key.columns, pa.array(n), *found], [*keys, "n", *columns])

        for batch in batches:
            if not batch.num_rows:
                continue
            at = heads(batch)
            key = pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(at)) for k in keys], keys)
            n = np.add.reduceat(batch.column("n").to_numpy(), at)
            sums, counts = (np.add.reduceat(batch.column(c).flatten().to_numpy().reshape(-1, width), at, axis=0) for c in ("__sums", "__counts"))
            if held is not None:
                if held[0].equals(key.slice(0, 1)):
                    n[0] += held[1][0]
                    sums[0] += held[2][0]
                    counts[0] += held[3][0]
                else:
                    yield finished(*held)
            if len(at) > 1:
                yield finished(key.slice(0, len(at) - 1), n[:-1], sums[:-1], counts[:-1])
            held = key.slice(len(at) - 1), n[-1:], sums[-1:], counts[-1:]
        if held is not None:
            yield finished(*held)

    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in plain], *packed).mapInArrow(runs, partial)
    schema = StructType([*ids, StructField("n", LongType()), *[StructField(c, DoubleType()) for c in columns]])
    return rows.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys).mapInArrow(means, schema)


def latest_value(df: DataFrame, time: str, keys: Sequence[str] = (), step: int | None = None) -> DataFrame:
    newest = F.max(time)
    return df.groupBy(*keys).agg((floor_time(newest, step) if step else newest).alias("latest_value"))


def location_summary(df: DataFrame, lat: str, lon: str, created: str) -> DataFrame:
    """Rows and newest write per location, most recently written first."""
    return (df.groupBy(lat, lon).agg(F.count(F.lit(1)).alias("row_count"),
                                     F.max(created).alias("last_updated"))
            .orderBy(F.desc("last_updated"), lat, lon))


def active_locations(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.select(lat, lon).distinct().orderBy(lat, lon)


def pivot_targets(df: DataFrame, ids: Sequence[str], targets: Sequence[str], name: str = "target",
                  value: str = "predicted_value") -> DataFrame:
    """Long predictions to one wide row per id; the target list is fixed, so no extra pass."""
    return df.groupBy(*ids).pivot(name, list(targets)).agg(F.max(value))


def has_rows(df: DataFrame, locations: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether a location has any row."""
    present = df.select(*keys).distinct().withColumn("__present", F.lit(True))
    return locations.select(*keys).distinct().join(present, list(keys), "left").select(
        *keys, F.coalesce("__present", F.lit(False)).alias("has_rows"))


# ---- exact quantiles -----------------------------------------------------

#: Distinct values that one task orders, and the rounds of splitting, far more than 1024 buckets each ever need.
BUCKET_ROWS = 1_000_000
ROUNDS = 8


def ordered_values(rows: DataFrame) -> DataFrame:
    """Adds ``__upto``, the number of values up to and with a row, in buckets that are small by now."""
    ranked = Window.partitionBy(*[c for c in rows.columns if c not in ("__value", "__n", "__before", "__in", "__total")]).orderBy("__value")
    inside = F.sum("__n").over(ranked.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__upto", F.col("__before") + inside)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    keys: Sequence[str] = (), buckets: int = 1024, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Exact linear-interpolated quantiles per key and column: (keys, column, q_0, q_1, ...).

    Rank selection: equal values collapse to counts before the shuffle. Splitters from a quantile sketch cut the values into
    buckets of about equal counts, whatever their distances; bucket totals locate the wanted ranks, and only buckets that
    hold one go on. A bucket that still has more than ``bucket_rows`` distinct values is cut again by splitters of its own.
    Only small buckets are ordered. NULLs are ignored. Keys of few rows need none of this (:func:`key_quantiles`).
    """
    ids = [*keys, "__column"]
    long = df.select(*keys, *columns).unpivot(list(keys), list(columns), "__column", "__value")
    counts = (long.where(F.col("__value").isNotNull()).groupBy(*ids, "__value")
              .agg(F.count(F.lit(1)).alias("__n")))
    open_ = cut_lineage(counts.withColumns({"__round": F.lit(0), "__bucket": F.lit(0).cast("bigint"), "__before": F.lit(0).cast("bigint")}))
    totals = open_.groupBy(*ids).agg(F.sum("__n").alias("__total"))
    spots = [(F.col("__total") - 1) * F.lit(float(p)) for p in probabilities]
    parts, group = [], [*ids, "__round", "__bucket", "__before"]
    fractions = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    for round_ in range(1, ROUNDS + 1):
        sizes = open_.groupBy(*group).agg(F.count(F.lit(1)).alias("__distinct"))
        large = cut_lineage(sizes.where(F.col("__distinct") > bucket_rows))
        if large.isEmpty():
            break
        parts.append(open_.join(large.select(*group), group, "left_anti"))
        cut = open_.join(large.select(*group), group)
        # A sketch of the distinct values: its size is bounded, and its error only moves the borders.
        borders = cut.groupBy(*group).agg(F.array_distinct(F.percentile_approx("__value", fractions, F.lit(4 * buckets))).alias("__borders"))
        cut = cut.join(borders, group)
        slot = F.size("__borders") - F.size(F.filter("__borders", lambda b: b >= F.col("__value")))
        cut = cut.withColumn("__slot", slot.cast("bigint")).drop("__borders")
        inside = cut.groupBy(*group, "__slot").agg(F.sum("__n").alias("__in"))
        earlier = Window.partitionBy(*group).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
        inside = inside.withColumn("__first", F.col("__before") + F.coalesce(F.sum("__in").over(earlier), F.lit(0))).join(totals, ids)
        wanted = F.lit(False)
        for spot in spots:
            wanted = wanted | ((F.floor(spot) < F.col("__first") + F.col("__in")) & (F.ceil(spot) >= F.col("__first")))
        hit = inside.where(wanted).select(*group, "__slot", "__first")
        kept = cut.join(hit, [*group, "__slot"])
        open_ = cut_lineage(kept.select(
            *ids, "__value", "__n", F.lit(round_).alias("__round"), (F.col("__bucket") * buckets + F.col("__slot")).alias("__bucket"),
            F.col("__first").alias("__before")))
    parts.append(open_)
    inside = ordered_values(reduce(DataFrame.unionByName, parts)).join(totals, ids)
    below = F.col("__upto") - F.col("__n")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= below) & (rank < F.col("__upto")), F.col("__value")))

    ends = []
    for i, spot in enumerate(spots):
        ends += [at(F.floor(spot)).alias(f"__a{i}"), at(F.ceil(spot)).alias(f"__b{i}")]
    out = inside.groupBy(*ids, "__total").agg(*ends)
    values = []
    for i, spot in enumerate(spots):
        a, b = F.col(f"__a{i}"), F.col(f"__b{i}")
        values.append((a + (b - a) * (spot - F.floor(spot))).alias(f"q_{i}"))
    return out.select(*keys, F.col("__column").alias("column"), *values)


def exact_median(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column, median)."""
    return exact_quantiles(df, columns, [0.5], keys).withColumnRenamed("q_0", "median")


def key_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """As :func:`exact_quantiles`, one row per key with an array per column, where a task can hold the values of a key."""
    return df.groupBy(*keys).agg(*[F.percentile(c, [float(p) for p in probabilities]).alias(c) for c in columns])


def median_fill(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), key_rows: int = TASK_ROWS) -> DataFrame:
    """Remaining NULLs take the exact median of their column (and key).

    ``df`` should be stored: its rows are counted first. Keys of up to ``key_rows`` rows are dealt to as many tasks as the
    rows need and find their medians where they are, so that neither the medians nor the way back sorts more than that.
    The few larger keys go by :func:`exact_median`.
    """
    if not keys:
        return _filled(df.crossJoin(F.broadcast(_medians(df, columns, keys))), df, columns)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    rows, most = sizes.agg(F.sum("__size"), F.max("__size")).first()
    small, parts = df, []
    if (most or 0) > key_rows:
        # Each has more rows than a task, so they are far fewer than tasks.
        long = F.broadcast(cut_lineage(sizes.where(F.col("__size") > key_rows).select(*keys)))
        small, large = df.join(long, list(keys), "left_anti"), df.join(long, list(keys), "left_semi")
        parts.append(_filled(large.join(F.broadcast(_medians(large, columns, keys)), list(keys), "left"), df, columns))
    small = dealt(small.select(*df.columns), rows or 0, *keys)
    medians = key_quantiles(small, columns, [0.5], keys).select(*keys, *[F.col(c)[0].alias(f"__m_{c}") for c in columns])
    # The hash table holds a row per key; a merge would sort all rows again, a broadcast would send every key to every task.
    parts.append(_filled(small.join(medians.hint("shuffle_hash"), list(keys), "left"), df, columns))
    return reduce(DataFrame.unionByName, parts)


def _medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    medians = exact_median(df, columns, keys).groupBy(*keys).pivot("column", list(columns)).agg(F.first("median"))
    return medians.select(*keys, *[F.col(c).alias(f"__m_{c}") for c in columns])


def _filled(joined: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return joined.select(*[F.coalesce(c, f"__m_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


# ---- scores and reports --------------------------------------------------

def error_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 = 1 - SSres/SStot over rows that have both values.

    The total sum of squares comes from the merged population variance, which is numerically
    stable in one pass.
    """
    both = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    e, y = F.col(actual) - F.col(predicted), F.col(actual)
    total = F.var_pop(y) * F.count(F.lit(1))
    return both.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.when(total > 0, 1 - F.sum(e * e) / total).alias("r2"))


def mape(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute percentage error; rows with actual 0 are undefined and left out."""
    ratio = F.try_divide(F.abs(F.col(actual) - F.col(predicted)), F.abs(F.col(actual)))
    return df.groupBy(*keys).agg((F.avg(ratio) * 100).alias("mape"))


def quality_report(df: DataFrame, time: str, expected: Sequence[str],
                   null_limit: float = 5.0) -> DataFrame:
    """One row per column: nulls, share of nulls, flag above ``null_limit`` percent, plus the
    table-wide row count, time range, duplicate rows (time left out) and missing columns."""
    columns = [c for c in df.columns if c != time]
    nulls = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    totals = df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(time).alias("min_time"),
                    F.max(time).alias("max_time"), *nulls)
    copies = (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
              .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicated_rows")))
    missing = ",".join(c for c in expected if c not in df.columns)
    long = totals.unpivot(["total_rows", "min_time", "max_time"], columns, "column", "null_count")
    share = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("total_rows"))
    return long.crossJoin(F.broadcast(copies)).select(
        "column", "null_count", share.alias("null_percentage"),
        F.coalesce(share > null_limit, F.lit(False)).alias("high_null"), "total_rows",
        F.lit(len(columns)).alias("total_columns"), "min_time", "max_time", "duplicated_rows",
        F.lit(missing).alias("missing_columns"))


def correlations(df: DataFrame, features: Sequence[str], targets: Sequence[str], limit: float = 0.99) -> DataFrame:
    """(target, feature, r, suspicious): Pearson r of every feature with every target over rows where both are present.

    One scan: a task keeps the co-moments of all pairs for its rows as matrices, and the matrices of all tasks are merged
    pair by pair (Chan's update), so neither the plan nor the scan grows with the number of pairs. r is NULL
    with fewer than two rows or a constant side. NaN counts as missing.
    """
    features, targets = list(features), list(targets)
    names = list(dict.fromkeys([*features, *targets]))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(targets), len(features))
        n, mx, my, sxx, syy, sxy = (np.zeros(shape) for _ in range(6))
        for batch in batches:
            column = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names}
            x, y = (np.stack([column[c] for c in cs], 1) if batch.num_rows else np.zeros((0, len(cs))) for cs in (features, targets))
            hx, hy = ~np.isnan(x), ~np.isnan(y)
            # About a middle value first, so that sums of squares stay small beside the spread.
            cx, cy = (np.array([c[h].mean() if h.any() else 0.0 for c, h in zip(v.T, w.T)]) for v, w in ((x, hx), (y, hy)))
            x0, y0 = np.where(hx, x - cx, 0.0), np.where(hy, y - cy, 0.0)
            fx, fy = hx.astype(float), hy.astype(float)
            k = fy.T @ fx
            some = np.maximum(k, 1.0)
            bx, by = fy.T @ x0 / some, y0.T @ fx / some
            vx, vy, vxy = fy.T @ (x0 * x0) - k * bx * bx, (y0 * y0).T @ fx - k * by * by, y0.T @ x0 - k * bx * by
            bx, by = bx + cx, by + cy[:, None]
            total = np.maximum(n + k, 1.0)
            dx, dy, share = bx - mx, by - my, n * k / total
            sxx, syy, sxy = sxx + vx + dx * dx * share, syy + vy + dy * dy * share, sxy + vxy + dx * dy * share
            mx, my, n = mx + np.where(k > 0, dx * k / total, 0.0), my + np.where(k > 0, dy * k / total, 0.0), n + k
        t, f = np.divmod(np.arange(n.size), len(features))
        yield pa.RecordBatch.from_pydict({"target": pa.array([targets[i] for i in t], pa.string()), "feature": pa.array([features[i] for i in f], pa.string()),
                                          **{c: pa.array(v.ravel()) for c, v in zip(("n", "mx", "my", "sxx", "syy", "sxy"), (n, mx, my, sxx, syy, sxy))}})

    # A row per pair and task is stored: three aggregations follow, the rows themselves are read once.
    parts = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(
        moments, "target string, feature string, n double, mx double, my double, sxx double, syy double, sxy double"))
    # Sums of squares about the common mean: those of the parts plus the spread of their means about a fixed point.
    held = parts.where("n > 0")
    middle = held.groupBy("target", "feature").agg(*[(F.sum(F.col("n") * F.col(m)) / F.sum("n")).alias(f"__{m}") for m in ("mx", "my")])
    apart = {m: F.col(m) - F.col(f"__{m}") for m in ("mx", "my")}
    whole = held.join(middle, ["target", "feature"]).groupBy("target", "feature").agg(
        F.sum(F.col("sxx") + F.col("n") * apart["mx"] * apart["mx"]).alias("xx"), F.sum(F.col("syy") + F.col("n") * apart["my"] * apart["my"]).alias("yy"),
        F.sum(F.col("sxy") + F.col("n") * apart["mx"] * apart["my"]).alias("xy"), F.sum("n").alias("n"))
    pairs = parts.select("target", "feature").distinct()
    r = F.when((F.col("n") > 1) & (F.col("xx") > 0) & (F.col("yy") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))))
    return pairs.join(whole, ["target", "feature"], "left").select(
        "target", "feature", r.alias("r"), F.coalesce(F.abs(r) > limit, F.lit(False)).alias("suspicious"))


def describe(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """count, mean, std, min, quartiles (exact) and max per column, rounded.

    Rounding takes ties down a hair so that it does not depend on the last bit of a mean.
    """
    long = df.select(*columns).unpivot([], list(columns), "column", "value").where("value IS NOT NULL")
    base = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).withColumnsRenamed(
        {"q_0": "p25", "q_1": "p50", "q_2": "p75"})
    scale = F.lit(10.0 ** digits)
    rounded = [(F.floor(F.col(c) * scale + F.lit(0.469)) / scale).alias(c) for c in
               ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return base.join(quartiles, "column").select("column", "count", *rounded)
