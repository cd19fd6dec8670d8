"""Cross-measure features of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def station_interactions() -> list[Column]:
    ghi, dhi = F.col("ghi"), F.col("dhi")
    return [
        F.when(dhi > 1, ghi / dhi).otherwise(F.lit(0.0)).alias("ghi_dhi_ratio"),
        (F.col("temperature") * F.col("windspeed") / F.lit(100.0)).alias("temp_wind_interaction"),
        (F.col("cloud_cover") * ghi / F.lit(1000.0)).alias("cloud_ghi_interaction"),
    ]


def legacy_interactions() -> list[Column]:
    ghi, cloud = F.col("shortwave_radiation"), F.col("cloud_cover")
    temp = F.col("temperature_2m")
    return [
        (temp * F.col("relative_humidity_2m") / F.lit(100.0)).alias("temp_x_humidity"),
        (F.col("wind_speed_10m") * cloud / F.lit(100.0)).alias("wind_x_cloud"),
        (ghi * (F.lit(1.0) - cloud / F.lit(100.0))).alias("ghi_x_clearsky"),
        (temp - F.col("dew_point_2m")).alias("temp_dewpoint_spread"),
        F.try_divide(F.col("diffuse_radiation"), ghi).alias("diffuse_fraction"),
    ]


def wind_vectors() -> list[Column]:
    """Wind components and products with cloud, gust and pressure.

    ``cloud_layer_ratio``, ``pressure_x_wind`` and ``cloud_advection_rate`` are defined here:
    low cloud over the sum of the layers (guarded by +1), pressure anomaly from 1013.25 hPa
    times speed, and the length of the wind-times-cloud vector.
    """
    speed, cloud = F.col("wind_speed_10m"), F.col("cloud_cover")
    theta = F.radians(F.col("wind_direction_10m"))
    u, v = -speed * F.sin(theta), -speed * F.cos(theta)
    layers = F.col("cloud_cover_low") + F.col("cloud_cover_mid") + F.col("cloud_cover_high")
    return [
        u.alias("wind_u"),
        v.alias("wind_v"),
        F.sin(theta).alias("wind_dir_sin"),
        F.cos(theta).alias("wind_dir_cos"),
        (u * cloud).alias("wind_u_x_cloud"),
        (v * cloud).alias("wind_v_x_cloud"),
        F.sqrt(u * cloud * u * cloud + v * cloud * v * cloud).alias("cloud_advection_rate"),
        F.try_divide(F.col("wind_gusts_10m"), speed).alias("gust_factor"),
        (F.col("cloud_cover_low") / (layers + F.lit(1.0))).alias("cloud_layer_ratio"),
        ((F.col("pressure_msl") - F.lit(1013.25)) * speed).alias("pressure_x_wind"),
    ]


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2.0 * 6371.0) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
