"""Trajectory tables: points, pings, speeds, remap checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.operators.ordered import previous_row, time_chunk

MOVING_ABOVE_KMH = 2


def explode_points(df: DataFrame, points: str = "points") -> DataFrame:
    """One row per trajectory point with its position."""
    return df.select("*", F.posexplode(points).alias("pos", "pt")).drop(points)


def explode_pings(df: DataFrame, points: str = "points", start: str = "timestamp",
                  interval_s: int = geo.POINT_INTERVAL_S) -> DataFrame:
    """Trajectory to ping table: event time = trip start + position x sampling interval."""
    pings = explode_points(df, points)
    epoch = F.col(start) + F.col("pos") * interval_s
    return pings.withColumn("epoch_s", epoch.cast("bigint")) \
        .withColumn("ts", F.timestamp_seconds("epoch_s")) \
        .withColumn("lon", F.get("pt", F.lit(0))).withColumn("lat", F.get("pt", F.lit(1))).drop("pt")


def ping_speed_kmh(df: DataFrame, key: str = "trip_id", time: str = "epoch_s",
                   order_by: Sequence[str] = ("epoch_s", "pos"),
                   moving_above: float = MOVING_ABOVE_KMH) -> DataFrame:
    """Speed between consecutive pings (0 for the first or for equal times) and a status."""
    near = previous_row(df, [key], list(order_by), time_chunk(time), ["lat", "lon", time], "prev")
    km = geo.haversine_km(F.col("prev.lat"), F.col("prev.lon"), F.col("lat"), F.col("lon"))
    seconds = F.col(time) - F.col(f"prev.{time}")
    speed = F.when(seconds != 0, km / F.nullif(seconds, F.lit(0)) * 3600).otherwise(F.lit(0.0))
    return near.withColumn("speed_kmh", speed) \
        .withColumn("status", F.when(F.col("speed_kmh") > moving_above, "MOVING").otherwise("IDLE")) \
        .drop("prev")


def collect_polyline(points: DataFrame, key: str = "trip_id", lon: str = "lon", lat: str = "lat",
                     pos: str = "pos") -> DataFrame:
    """Regroup points to the ordered trajectory text.

    Only for points that had to be joined one by one; a trajectory that is
    merely transformed is better changed in place. A group is one trip's
    points, i.e. what was a single row before it was exploded.
    """
    entry = F.struct(F.col(pos).alias("pos"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))
    ordered = F.array_sort(F.collect_list(entry))
    path = F.transform(ordered, lambda p: F.array(p["lon"], p["lat"]))
    return points.groupBy(key).agg(F.to_json(path).alias("POLYLINE"))


def segment_lengths(df: DataFrame, points: str = "points") -> DataFrame:
    """One row per consecutive pair of points with its length, computed inside the row."""
    pts = F.col(points)
    count = F.greatest(F.size(pts) - 1, F.lit(0))
    km = F.zip_with(F.slice(pts, 1, count), F.slice(pts, 2, count),
                    lambda a, b: geo.haversine_km(F.get(a, F.lit(1)), F.get(a, F.lit(0)),
                                                  F.get(b, F.lit(1)), F.get(b, F.lit(0))))
    return df.select("*", F.posexplode(km).alias("segment", "segment_km")).drop(points)


def with_trip_ends(df: DataFrame, points: str = "points") -> DataFrame:
    """Start and end coordinates, null for an empty trajectory."""
    first, last = geo.start_point(points), geo.end_point(points)
    return df.withColumns({
        "start_lon": F.get(first, F.lit(0)), "start_lat": F.get(first, F.lit(1)),
        "end_lon": F.get(last, F.lit(0)), "end_lat": F.get(last, F.lit(1)),
    })


def top_areas(df: DataFrame, area: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent areas; ties by name."""
    return df.groupBy(area).agg(F.count(F.lit(1)).alias("trips")) \
        .orderBy(F.desc("trips"), F.asc(area)).limit(k)


def length_distribution(df: DataFrame, before: Column, after: Column,
                        quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Trip lengths before and after a remap, in metres.

    Lengths are counted per whole metre first, so exact quantiles need one
    entry per distinct metre and not one per trip.
    """
    stages = F.array(
        F.struct(F.lit("before").alias("stage"), F.round(before * 1000).cast("bigint").alias("metres")),
        F.struct(F.lit("after").alias("stage"), F.round(after * 1000).cast("bigint").alias("metres")),
    )
    per_metre = df.select(F.inline(stages)).groupBy("stage", "metres") \
        .agg(F.count(F.lit(1)).alias("trips"))
    total = F.sum("trips")
    return per_metre.groupBy("stage").agg(
        total.alias("trips"), F.min("metres").alias("min_m"), F.max("metres").alias("max_m"),
        (F.sum(F.col("metres") * F.col("trips")) / total).alias("mean_m"),
        *[F.percentile("metres", F.lit(q), F.col("trips")).alias(f"p{round(q * 100):02d}_m")
          for q in quantiles],
    )
