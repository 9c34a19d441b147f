"""Data-quality reports as tall (stage, metric, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.sources.zones import CITY_ZONES, Zone


def _tall(df: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    """One row per column of a one-row table."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                      for c in columns])
    return df.select(F.inline(cells))


def quality_report(trips: DataFrame, trip_id: str = "trip_id", month: str = "year_month",
                   zone: str = "zone_name", duration: str = "trip_duration_sec",
                   distance: str = "trip_distance_m") -> DataFrame:
    """Rows, months, zones, duplicate ids and the range of durations and distances.

    Rows are first reduced to one per trip id, which makes all distinct counts
    plain counts and spreads a frequent id map-side.
    """
    per_id = trips.groupBy(trip_id).agg(
        F.count(F.lit(1)).alias("n"), F.min(duration).alias("dmin"), F.max(duration).alias("dmax"),
        F.sum(duration).alias("dsum"), F.min(distance).alias("kmin"), F.max(distance).alias("kmax"),
        F.sum(distance).alias("ksum"))
    ids = per_id.agg(
        F.sum("n").alias("rows"), (F.sum("n") - F.count(F.lit(1))).alias("duplicate_trip_ids"),
        F.min("dmin").alias("min_duration"), F.max("dmax").alias("max_duration"),
        (F.sum("dsum") / F.sum("n")).alias("mean_duration"), F.min("kmin").alias("min_distance"),
        F.max("kmax").alias("max_distance"), (F.sum("ksum") / F.sum("n")).alias("mean_distance"))
    places = trips.groupBy(month, zone).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count_distinct(month).alias("months"), F.count_distinct(zone).alias("zones"))
    return _tall(ids, ids.columns, "metric", "value") \
        .unionByName(_tall(places, places.columns, "metric", "value"))


def stage_accounting(trips: DataFrame, trip_id: str = "trip_id", points: str = "points",
                     missing: str = "missing_data", epoch: str = "epoch_s") -> DataFrame:
    """Rows and distinct trips after each cleaning stage, from one pass per trip id.

    Stages: raw, clean (complete, with a trajectory), deduplicated, exploded to
    points, regrouped; plus the clean trips without a time.
    """
    clean = ~F.col(missing) & (F.coalesce(F.size(points), F.lit(0)) > 0)
    per_id = trips.groupBy(trip_id).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(clean).alias("clean"),
        # The kept copy is the one with the shortest, then smallest trajectory.
        F.min(F.when(clean, F.struct(F.size(points).alias("n"), F.col(epoch).alias("t")))).alias("one"))
    has_clean = F.col("clean") > 0
    totals = per_id.agg(
        F.sum("raw").alias("raw_rows"), F.count(F.lit(1)).alias("raw_ids"),
        F.sum("clean").alias("clean_rows"), F.count_if(has_clean).alias("dedup_rows"),
        F.coalesce(F.sum("one.n"), F.lit(0)).alias("exploded_rows"),
        F.count_if(has_clean).alias("regrouped_rows"),
        F.count_if(has_clean & F.col("one.t").isNull()).alias("null_times"))
    return _tall(totals, totals.columns, "stage", "value")


def reconcile_kpis(kpis: DataFrame, names: tuple[str, ...] = (
        "trips_per_zone", "peak_demand_hours", "trip_type_distribution", "weekly_trends")) -> DataFrame:
    """Sum of every counting KPI next to the trip total it must equal."""
    total = kpis.filter("kpi_name = 'total_trips'").select(F.max("value")).scalar()
    return kpis.filter(F.col("kpi_name").isin(*names)).groupBy("kpi_name") \
        .agg(F.sum("value").alias("kpi_sum")) \
        .withColumn("total_trips", total).withColumn("agrees", F.col("kpi_sum") == F.col("total_trips"))


def outside_centroids(df: DataFrame, zones: Sequence[Zone] = CITY_ZONES) -> DataFrame:
    """Rows whose position is not a zone centroid, i.e. that escaped anonymisation."""
    lat = geo.zone_attribute("zone_id", "centroid_lat", zones)
    lon = geo.zone_attribute("zone_id", "centroid_lon", zones)
    return df.filter(~(F.col("lat").eqNullSafe(lat) & F.col("lon").eqNullSafe(lon)))
