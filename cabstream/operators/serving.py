"""Read queries behind the dashboards and the trip service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.operators.latest import latest_per_key


def vehicles_in_zone(positions: DataFrame, as_of: Column, zone_id: int | None = None,
                     max_age_s: int = 30, time: str = "timestamp",
                     tie: Sequence[str] = ()) -> DataFrame:
    """Vehicles seen in a zone (or any zone) during the last seconds before ``as_of``.

    The time filter comes first, so only the recent slice is reduced per taxi.
    """
    recent = positions.filter(F.col(time).between(as_of - max_age_s, as_of))
    if zone_id is not None:
        recent = recent.filter(F.col("zone_id") == zone_id)
    return latest_per_key(recent, ["taxi_id"], [time, *tie])


def trip_status(final: DataFrame, trip_id: str | None = None) -> DataFrame:
    """Status and ETA by trip id; ``final`` holds one row per trip."""
    rows = final if trip_id is None else final.filter(F.col("trip_id") == trip_id)
    return rows.select(
        "trip_id", F.when(F.col("matched"), "matched").otherwise("unmatched").alias("status"),
        F.when(F.col("matched"), F.col("eta_seconds")).otherwise(F.lit(0)).alias("eta_seconds"))


def latest_demand(windows: DataFrame, keys: Sequence[str] = ("city", "zone_id")) -> DataFrame:
    """The newest demand row of every zone."""
    return latest_per_key(windows, list(keys), ["window_start"])


def recent_demand(windows: DataFrame, as_of: Column, minutes: int = 2) -> DataFrame:
    """Demand rows that started within the last minutes before ``as_of``."""
    return windows.filter(F.col("window_start").between(
        as_of - F.make_dt_interval(mins=F.lit(minutes)), as_of))


def latest_position(positions: DataFrame, per: str = "zone", time: str = "timestamp",
                    tie: Sequence[str] = ()) -> DataFrame:
    """The newest position per zone, or per taxi (which shows every vehicle)."""
    if per not in ("zone", "taxi"):
        raise ValueError(f"per is 'zone' or 'taxi', not {per!r}")
    key = "zone_id" if per == "zone" else "taxi_id"
    return latest_per_key(positions, [key], [time, *tie])


def kpi_lookup(kpis: DataFrame, names: Sequence[str], category: str | None = None) -> DataFrame:
    """Rows of the tall KPI table by name(s) and, if given, category."""
    found = kpis.filter(F.col("kpi_name").isin(*names))
    return found if category is None else found.filter(F.col("category") == category)


def trip_history(trips: DataFrame, city: str, first_day: str, last_day: str) -> DataFrame:
    """Serving trips of a city between two days; prunes when partitioned by day."""
    return trips.filter((F.col("city") == city) & F.col("date_bucket").between(first_day, last_day))
