"""Record cleaning and filters; all narrow except the de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.functions.plan import evaluated_once
from cabstream.operators.latest import first_per_key
from cabstream.sources.zones import CITY, CITY_ZONES, Zone

MAX_SPEED_KMH = 150.0


def gps_reject_reason(box: geo.Box = geo.CITY_BOX, max_speed: float = MAX_SPEED_KMH,
                      timestamp: str = "timestamp") -> Column:
    """Name of the first rule a GPS event breaks, null for a valid event."""
    taxi = F.col("taxi_id")
    rules = (
        ("taxi_id", taxi.isNull() | (taxi == "") | (F.lower(taxi) == "unknown")),
        ("timestamp", ~F.coalesce(F.col(timestamp) > 0, F.lit(False))),
        ("lat", ~F.coalesce(F.col("lat").between(box.lat_min, box.lat_max), F.lit(False))),
        ("lon", ~F.coalesce(F.col("lon").between(box.lon_min, box.lon_max), F.lit(False))),
        ("speed", ~F.coalesce(F.col("speed").between(0, max_speed), F.lit(False))),
    )
    reason = F
    for name, broken in rules:
        reason = reason.when(broken, F.lit(name))
    return reason


def validate_gps(df: DataFrame, box: geo.Box = geo.CITY_BOX, max_speed: float = MAX_SPEED_KMH,
                 timestamp: str = "timestamp") -> DataFrame:
    """Keep plausible GPS events; box and speed limits are inclusive."""
    return df.filter(
        F.col("taxi_id").isNotNull() & (F.col("taxi_id") != "")
        & (F.lower("taxi_id") != "unknown") & (F.col(timestamp) > 0)
        & F.col("lat").between(box.lat_min, box.lat_max)
        & F.col("lon").between(box.lon_min, box.lon_max)
        & F.col("speed").between(0, max_speed)
    )


def valid_requests(df: DataFrame, trip_id: str = "trip_id",
                   origin: str = "origin_zone") -> DataFrame:
    """Requests with an id and a zone."""
    return df.filter((F.col(trip_id) != "") & (F.col(origin) > 0))


def valid_vehicles(df: DataFrame, taxi_id: str = "taxi_id", zone: str = "zone_id") -> DataFrame:
    """Zone-mapped GPS events with an id and a zone."""
    return df.filter((F.col(taxi_id) != "") & (F.col(zone) > 0))


def drop_missing(df: DataFrame, flag: str = "MISSING_DATA") -> DataFrame:
    """Drop trips whose trajectory is flagged incomplete (unknown flags are dropped too)."""
    return df.filter(~F.col(flag))


def dedup_trips(df: DataFrame, key: str = "TRIP_ID",
                order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per trip id: the smallest by ``order_by``, then by the other columns."""
    return first_per_key(df, [key], list(order_by or []))


def non_empty_trajectory(df: DataFrame, text: str = "POLYLINE", points: str = "points",
                         usable: str = "usable_points") -> DataFrame:
    """Parse the trajectory and keep rows that have at least one usable point.

    Adds all listed points and, apart, those with both coordinates.
    """
    parsed = evaluated_once(df, points, geo.parse_points(text))
    return evaluated_once(parsed, usable, geo.usable_points(points)).filter(F.size(usable) > 0)


def anonymize_to_centroid(df: DataFrame, zones: Sequence[Zone] = CITY_ZONES,
                          city: str = CITY) -> DataFrame:
    """Replace each position by its zone's centroid; the measured position is not kept."""
    mapped = geo.with_nearest_zone(df, "lat", "lon", zones)
    return mapped.withColumns({
        "lat": geo.zone_attribute("zone_id", "centroid_lat", zones),
        "lon": geo.zone_attribute("zone_id", "centroid_lon", zones),
        "zone_name": geo.zone_attribute("zone_id", "zone_name", zones),
        "city": F.lit(city),
    })


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls per column."""
    return df.fillna(defaults)


def sampled_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """A seeded share of the rows, e.g. for plots; the caller chooses the fraction for the size it needs."""
    return df.sample(False, fraction, seed)
