"""Dimension joins. Spark broadcasts the dimension when its size allows, else shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZONE_TYPES = ("residential", "commercial", "industrial", "transit_hub")
WEATHER_DEFAULTS = {"temperature_2m": 15.0, "rain": 0.0}


def enrich_zone(df: DataFrame, zones: DataFrame, on: str = "zone_id",
                prefix: str = "zone_") -> DataFrame:
    """Left join of zone name and type; unknown zones keep null."""
    meta = zones.select(F.col("zone_id").alias(on), F.col("zone_name").alias(f"{prefix}name"),
                        F.col("zone_type").alias(f"{prefix}type"))
    return df.join(meta, on, "left")


def enrich_zone_features(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Population density and one flag per zone type."""
    flags = [F.when(F.col("zone_type") == kind, 1).otherwise(0).alias(f"is_{kind}")
             for kind in ZONE_TYPES]
    return df.join(zones.select("zone_id", "population_density", *flags), "zone_id", "left")


def enrich_weather(df: DataFrame, weather: DataFrame, slot: str = "time_slot_30min") -> DataFrame:
    """Left join of the slot's weather hour, then defaults for missing values."""
    hourly = weather.select("time_slot_1h", "temperature_2m", "rain")
    joined = df.withColumn("time_slot_1h", F.date_trunc("hour", slot)) \
        .join(hourly, "time_slot_1h", "left").drop("time_slot_1h")
    return joined.fillna(WEATHER_DEFAULTS)


def join_back(df: DataFrame, derived: DataFrame, key: str = "TRIP_ID") -> DataFrame:
    """Inner join of derived columns on the trip id; duplicate ids multiply on purpose."""
    return df.join(derived, key, "inner")
