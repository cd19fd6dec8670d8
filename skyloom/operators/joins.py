"""Joins between sources, snapshots and sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import config
from skyloom.functions.scalar import clip
from skyloom.functions.weather import haversine_km
from skyloom.operators.aggregates import median_fill, resample_mean
from skyloom.operators.grid import ffill_limit, interpolate_limit
from skyloom.operators.series import Series, dealt, row_pieces, with_neighbours
from skyloom.session import cut_lineage


def merge_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "full")


def merge_coalesce(primary: DataFrame, secondary: DataFrame, on: Sequence[str],
                   columns: Sequence[str]) -> DataFrame:
    """Full outer merge; the secondary source fills what the primary lacks."""
    other = secondary.select(*on, *[F.col(c).alias(f"__s_{c}") for c in columns])
    joined = primary.select(*on, *columns).join(other, list(on), "full")
    return joined.select(*on, *[F.coalesce(c, f"__s_{c}").alias(c) for c in columns])


def append_newer(base: DataFrame, live: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of ``live`` newer than the newest row of ``base`` (of the key) are appended."""
    newest = base.groupBy(*keys).agg(F.max(time).alias("__newest"))
    joined = live.join(newest, list(keys), "left") if keys else live.crossJoin(F.broadcast(newest))
    fresh = joined.where(F.col("__newest").isNull() | (F.col(time) > F.col("__newest")))
    return base.unionByName(fresh.select(*base.columns))


def merge_history(primary: DataFrame, secondary: DataFrame, live: DataFrame, series: Series,
                  columns: Sequence[str] = config.STATION_TARGETS, limit: int = 8,
                  bounds=config.STATION_BOUNDS) -> DataFrame:
    """One clean grid series per key from two archives and a live feed.

    Every stage reads its input several times, so the stages are stored in between: each source is scanned once, and
    a lost executor repeats one stage only. The archives are counted, so that the merge is dealt by their rows.
    """
    on = [*series.keys, series.time]
    primary, secondary = (cut_lineage(df.select(*on, *columns)) for df in (primary, secondary))
    rows = primary.count() + secondary.count()
    merged = cut_lineage(merge_coalesce(dealt(primary, rows, *on), dealt(secondary, rows, *on), on, columns))
    merged = cut_lineage(append_newer(merged, live.select(*on, *columns), series.time, series.keys))
    gridded = cut_lineage(resample_mean(merged, series, columns))
    filled = interpolate_limit(gridded, series.on_complete_grid(), columns, limit)
    clipped = cut_lineage(filled.select(*on, *[
        clip(c, *bounds[c]).alias(c) if c in bounds else F.col(c) for c in columns]))
    return median_fill(clipped, columns, series.keys)


#: Rows for which the value of an external source is held.
EXTERNAL_ROWS = 4


def exact_external(df: DataFrame, external: DataFrame | None, series: Series, columns: Sequence[str]) -> DataFrame:
    """Left join of an external source at exactly equal times. No source gives zeros."""
    if external is None:
        return df.select("*", *[F.lit(0.0).alias(c) for c in columns])
    on = [*series.keys, series.time]
    return df.join(external.select(*on, *columns), on, "left")


def left_join_external(df: DataFrame, external: DataFrame | None, series: Series,
                       columns: Sequence[str], limit: int = EXTERNAL_ROWS) -> DataFrame:
    """:func:`exact_external`, held for at most ``limit`` rows, then 0."""
    joined = exact_external(df, external, series, columns)
    if external is None:
        return joined
    held = ffill_limit(joined, series, columns, limit)
    return held.fillna(0.0, subset=list(columns))


def join_targets(features: DataFrame, targets: DataFrame, series: Series, columns: Sequence[str]) -> DataFrame:
    """Stored features with the targets of their time; a row without targets keeps NULLs, a target without features goes.

    Use it where the two are stored apart. A matrix built from one frame carries its targets along without a join.
    """
    on = [*series.keys, series.time]
    return features.join(targets.select(*on, *columns), on, "left")


def nearest_asof(df: DataFrame, other: DataFrame, series: Series, columns: Sequence[str],
                 default: float = 0.0) -> DataFrame:
    """For each row the row of ``other`` at the smallest time distance; a tie takes the earlier.

    Both sides are stacked into one series and the nearest carried values are read from either
    side: one pass, no range join. Pieces hold equal numbers of rows, so a key or a moment with most
    rows is many tasks.
    """
    keys, time = list(series.keys), series.time
    values = F.struct(*columns)
    right = other.select(*keys, time, F.lit(0).alias("__side"), values.alias("__match"))
    rest = [c for c in df.columns if c not in (*keys, time)]
    left = df.select(*keys, time, F.lit(1).alias("__side"), F.struct(
        *(rest or [F.lit(1).alias("__none")])).alias("__row"))
    stacked = left.unionByName(right, allowMissingColumns=True)
    near = with_neighbours(row_pieces(stacked, series, "__side"), series, ["__match"], tie=["__side"])
    at = series.at()
    back, ahead = at - F.col("__pt___match"), F.col("__nt___match") - at
    take_back = F.col("__pv___match").isNotNull() & (ahead.isNull() | (back <= ahead))
    near = near.where(F.col("__side") == 1).withColumn(
        "__near", F.when(take_back, F.col("__pv___match")).otherwise(F.col("__nv___match")))
    return near.select(*keys, time, *[F.col(f"__row.{c}").alias(c) for c in rest],
                       *[F.coalesce(F.col(f"__near.{c}"), F.lit(default)).alias(c) for c in columns])


def latest_issue(df: DataFrame, keys: Sequence[str] = ("lat", "lon"),
                 issue: str = "issue_time") -> DataFrame:
    """Rows of the newest issue per key.

    The maxima are pre-aggregated before the shuffle and joined on (keys, issue), which spreads a
    key with many issues; a window over the key would not.
    """
    newest = df.groupBy(*keys).agg(F.max(issue).alias(issue))
    return df.join(newest, [*keys, issue])


def latest_overall(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the global maximum of ``column`` (a one-row broadcast)."""
    newest = df.agg(F.max(column).alias("__newest"))
    return (df.join(F.broadcast(newest), F.col(column) == F.col("__newest"))
            .drop("__newest"))


def attach_snapshot(df: DataFrame, snapshot: DataFrame, order: str) -> DataFrame:
    """Attach the newest snapshot row to every row; the snapshot is reduced to one row first."""
    columns = [c for c in snapshot.columns if c != order]
    one = snapshot.agg(F.max_by(F.struct(*columns), order).alias("__one"))
    return df.crossJoin(F.broadcast(one)).select(*df.columns, *[
        F.col(f"__one.{c}").alias(c) for c in columns])


# Cells halve both axes of the globe per level; every other level is visited, so a cell has at most 16 children.
STATION_LEVELS = range(2, 21, 2)
#: Stations of a cell that are compared one by one; cells up to this level are few and go to every task.
STATION_LEAF, SHARED_LEVEL = 32, 6


def nearest_station(sites: DataFrame, stations: DataFrame, site: str = "site_id",
                    station: str = "station_id") -> DataFrame:
    """Closest station by great-circle distance; equal distances take the smaller id.

    Branch and bound down a tree of cells, all sites at once. A cell knows the box around its stations in space, so a
    straight line from a site to the box has a least and a greatest length; a cell whose least exceeds the smallest
    greatest length of the site's cells is left out. Only the stations of the last few cells are compared, however far
    a site lies from all stations. Cells that hold no station do not exist. Stations of one location count as the one
    of the smallest id.
    """
    places = stations.where("lat IS NOT NULL AND lon IS NOT NULL").groupBy("lat", "lon").agg(F.min(station).alias(station))
    places = cut_lineage(places.select(
        F.col(station), F.col("lat").alias("__slat"), F.col("lon").alias("__slon"), *_in_space("__s"),
        _cell_of(F.col("lat") + 90, 180).alias("__cy"), _cell_of(F.pmod("lon", F.lit(360.0)), 360).alias("__cx")))
    # Sites are few bytes and much work: a given number of parts is not merged by adaptive execution.
    parts = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    open_ = sites.where("lat IS NOT NULL AND lon IS NOT NULL").repartition(parts, site).select(
        site, "lat", "lon", F.lit(float("inf")).alias("__best"), F.array(F.lit(0).cast("bigint")).alias("__cells"))
    depth = _station_depth(places)
    for level in STATION_LEVELS[:STATION_LEVELS.index(depth) + 1]:
        boxes = [f(f"__s{c}").alias(f"__{end}{c}") for c in "xyz" for end, f in (("lo", F.min), ("hi", F.max))]
        cells = places.groupBy(_cell_at(level - 2).alias("__parent"), _cell_at(level).alias("__cell")).agg(*boxes)
        probes = open_.select(site, "lat", "lon", "__best", *_in_space("__p"), F.explode("__cells").alias("__parent"))
        joined = probes.join(F.broadcast(cells) if level <= SHARED_LEVEL else cells, "__parent")
        least, greatest = F.lit(0.0), F.lit(0.0)
        for c in "xyz":
            below, above = F.col(f"__lo{c}") - F.col(f"__p{c}"), F.col(f"__p{c}") - F.col(f"__hi{c}")
            least = least + F.pow(F.greatest(below, above, F.lit(0.0)), F.lit(2.0))
            greatest = greatest + F.pow(F.greatest(F.abs(below), F.abs(above)), F.lit(2.0))
        near = joined.select(site, "lat", "lon", "__best", "__cell", least.alias("__least"), greatest.alias("__greatest"))
        # The margin is far above the rounding of either formula, so equal distances are never parted here.
        near = near.where(F.col("__least") <= F.col("__best") * (1 + 1e-9) + 1e-12)
        found = near.groupBy(site, "lat", "lon").agg(
            F.min("__greatest").alias("__best"), F.collect_list(F.struct("__cell", "__least")).alias("__near"))
        open_ = found.select(site, "lat", "lon", "__best", F.expr(
            "transform(filter(__near, n -> n.__least <= __best * (1 + 1e-9D) + 1e-12D), n -> n.__cell)").alias("__cells"))
    leaves = places.withColumn("__cell", _cell_at(depth)).drop("__sx", "__sy", "__sz", "__cx", "__cy")
    pairs = open_.select(site, "lat", "lon", F.explode("__cells").alias("__cell")).join(leaves, "__cell")
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("__slat"), F.col("__slon"))
    best = F.min(F.struct(km.alias("km"), F.col(station)))
    return pairs.groupBy(site, "lat", "lon").agg(best.alias("__best")).select(site, "lat", "lon", "__best.*")


def _in_space(prefix: str) -> list[Column]:
    """The point of (lat, lon) on the unit sphere."""
    lat, lon = F.radians("lat"), F.radians("lon")
    return [x.alias(f"{prefix}{c}") for c, x in (("x", F.cos(lat) * F.cos(lon)), ("y", F.cos(lat) * F.sin(lon)), ("z", F.sin(lat)))]


def _cell_of(part: Column, whole: float) -> Column:
    """Cell number along one axis at the last level."""
    size = 2 ** STATION_LEVELS[-1]
    return F.least(F.greatest(F.floor(part / F.lit(float(whole)) * size), F.lit(0)), F.lit(size - 1)).cast("bigint")


def _cell_at(level: int) -> Column:
    up = STATION_LEVELS[-1] - level
    return F.shiftright("__cy", up) * F.lit(2 ** level) + F.shiftright("__cx", up)


def _station_depth(places: DataFrame) -> int:
    """The first level without a cell of more than ``STATION_LEAF`` stations, or the last level."""
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), _cell_at(n).alias("cell")) for n in STATION_LEVELS])).alias("c")
    counts = places.select(cells).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    small = counts.groupBy("c.level").agg(F.max("n").alias("n")).where(F.col("n") <= STATION_LEAF)
    return small.agg(F.min("level")).first()[0] or STATION_LEVELS[-1]


def forecast_vs_actual(ml: DataFrame, provider: DataFrame, time: str,
                       columns: Sequence[str]) -> DataFrame:
    """ML rows and the provider rows of the same time span, labelled by source."""
    span = ml.agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    reference = (provider.crossJoin(F.broadcast(span))
                 .where(F.col(time).between(F.col("__lo"), F.col("__hi"))))
    mine = ml.select(time, *columns, F.lit("ml_model").alias("source"))
    return mine.unionByName(reference.select(time, *columns, F.lit("openmeteo_reference").alias("source")))
