"""Supply/demand per zone and event-time window, slot demand and spikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.functions.geo import zone_attribute
from cabstream.functions.labels import half_hour_slot, is_available
from cabstream.operators.ordered import trailing_mean
from cabstream.sources.zones import CITY, CITY_ZONES, Zone

DEMAND_WINDOW = "30 seconds"


def demand_events(gps: DataFrame, requests: DataFrame) -> DataFrame:
    """Zone-mapped vehicles and requests as one event type; requests of zone 0 are dropped.

    Both inputs carry the event clock ``ts``. On streams the union comes before
    the one watermark, so a silent input cannot hold time back. Vehicle events
    read from a topic pass ``clean.valid_vehicles`` first; those mapped in the
    same plan always have a zone.
    """
    vehicles = gps.select(
        F.col("zone_id").cast("int").alias("zone_id"), "ts", F.lit(True).alias("is_gps"),
        F.col("taxi_id"), is_available("status").alias("is_available"))
    demand = requests.select(
        F.col("origin_zone").cast("int").alias("zone_id"), "ts", F.lit(False).alias("is_gps"),
        F.lit("").alias("taxi_id"), F.lit(False).alias("is_available"))
    return vehicles.unionByName(demand.filter(F.col("zone_id") > 0))


def demand_windows(events: DataFrame, window: str = DEMAND_WINDOW,
                   zones: Sequence[Zone] = CITY_ZONES, city: str = CITY,
                   streaming: bool | None = None) -> DataFrame:
    """Distinct available taxis, requests and their ratio per zone and tumbling window.

    A stream counts distinct taxis through a set, because distinct aggregates
    are not offered there; the set is bounded by the taxis of one zone window.
    """
    taxi = F.when(F.col("is_gps") & F.col("is_available"), F.col("taxi_id"))
    on_stream = events.isStreaming if streaming is None else streaming
    active = F.size(F.collect_set(taxi)) if on_stream else F.count_distinct(taxi)
    counted = events.groupBy("zone_id", F.window("ts", window).alias("w")).agg(
        active.cast("int").alias("active_vehicles"),
        F.count(F.when(~F.col("is_gps"), 1)).cast("int").alias("pending_requests"))
    return counted.select(
        F.lit(city).alias("city"), "zone_id", F.col("w.start").alias("window_start"),
        "active_vehicles", "pending_requests",
        (F.col("pending_requests") / F.greatest("active_vehicles", F.lit(1))).alias("ratio"),
        F.coalesce(zone_attribute("zone_id", "centroid_lat", zones), F.lit(0.0)).alias("centroid_lat"),
        F.coalesce(zone_attribute("zone_id", "centroid_lon", zones), F.lit(0.0)).alias("centroid_lon"),
    )


def slot_demand(trips: DataFrame, zone: str = "zone_id", ts: str = "ts", trip_id: str = "trip_id",
                minutes: int = 30) -> DataFrame:
    """Trips per zone and half-hour slot."""
    return trips.filter(F.col(zone).isNotNull()) \
        .groupBy(F.col(zone).alias("zone_id"), half_hour_slot(ts, minutes).alias("time_slot_30min")) \
        .agg(F.count(trip_id).alias("demand_count"))


def demand_spikes(windows: DataFrame, count: str = "pending_requests", trailing: int = 10,
                  factor: float = 3.0, long_zones: bool = False) -> DataFrame:
    """Flag zone windows whose count reaches ``factor`` x the mean of the preceding windows.

    The input is already one row per zone and window, so a zone's rows are few;
    where they aren't, ``long_zones`` takes the means from running sums of ranges.
    """
    if long_zones:
        measured = trailing_mean(windows, ["zone_id"], ["window_start"], count, trailing, "trailing_mean")
    else:
        before = Window.partitionBy("zone_id").orderBy("window_start").rowsBetween(-trailing, -1)
        measured = windows.withColumn("trailing_mean", F.avg(count).over(before))
    return measured.withColumn("trailing_mean", F.coalesce("trailing_mean", F.lit(0.0))).withColumn(
        "is_spike", (F.col("trailing_mean") > 0) & (F.col(count) >= F.col("trailing_mean") * factor))


def citywide_surges(windows: DataFrame, count: str = "pending_requests", trailing: int = 10,
                    factor: float = 1.4) -> DataFrame:
    """Windows whose city total reaches ``factor`` x the mean of the preceding windows."""
    city = windows.groupBy("city", "window_start").agg(F.sum(count).alias(count))
    before = Window.partitionBy("city").orderBy("window_start").rowsBetween(-trailing, -1)
    mean = F.avg(count).over(before)
    return city.withColumn("trailing_mean", F.coalesce(mean, F.lit(0.0))).withColumn(
        "is_surge", (F.col("trailing_mean") > 0) & (F.col(count) >= F.col("trailing_mean") * factor))


def spike_quality(flagged: DataFrame, labelled: DataFrame, by: Sequence[str] = ("zone_id", "window_start"),
                  flag: str = "is_spike") -> DataFrame:
    """Precision and recall of spike flags against windows known to hold an anomaly."""
    truth = labelled.select(*by).distinct().withColumn("_true", F.lit(True))
    judged = flagged.join(truth, list(by), "left").select(
        F.col(flag).alias("said"), F.coalesce("_true", F.lit(False)).alias("was"))
    hits = F.count_if(F.col("said") & F.col("was"))
    return judged.agg(
        hits.alias("hits"), F.count_if("said").alias("flagged"), F.count_if("was").alias("labelled"),
    ).withColumn("precision", F.coalesce(F.try_divide("hits", "flagged"), F.lit(0.0))) \
        .withColumn("recall", F.coalesce(F.try_divide("hits", "labelled"), F.lit(0.0)))
