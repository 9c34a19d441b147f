"""Trip matching on batch tables: availability, supply, rounds, final status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabstream.functions import geo
from cabstream.functions.labels import is_available, is_uuid
from cabstream.operators.latest import latest_per_key
from cabstream.operators.ordered import asof_join
from cabstream.session import work_folder
from cabstream.sources.zones import CITY, CITY_ZONES, Zone

MATCH_WINDOW = "5 minutes"
ETA_TARGETS = ("destination", "pickup")


def window_start(ts: Column | str, window: str = MATCH_WINDOW) -> Column:
    return F.window(ts, window)["start"]


def vehicle_state(pings: DataFrame, order_by: Sequence[str] = ("timestamp",),
                  by: Sequence[str] = (), allow_ghosts: bool = False) -> DataFrame:
    """Available vehicles with their zone and ``last_seen``, from each vehicle's last event.

    A vehicle is in one zone, that of its last event, and gone when that event
    is not an available one. ``allow_ghosts`` judges every zone on its own, so
    that a vehicle which moved on still counts where it was last free.
    ``by`` adds grouping columns such as the matching window.
    """
    keys = ["taxi_id", *by, *(["zone_id"] if allow_ghosts else [])]
    needed = dict.fromkeys([*keys, *order_by, "zone_id", "lat", "lon", "status"])
    last = latest_per_key(pings.select(*[c for c in needed if c in pings.columns]), keys, list(order_by))
    return last.filter(is_available("status")).withColumn("last_seen", F.col(order_by[0]))


def asof_vehicle(requests: DataFrame, pings: DataFrame, request_time: str = "requested_at",
                 ping_time: str = "timestamp", tie: Sequence[str] = ("taxi_id",),
                 chunk_seconds: int | None = None) -> DataFrame:
    """Last free vehicle reported in the request's zone at or before the request (as-of join)."""
    free = pings.filter(is_available("status")).withColumn("origin_zone", F.col("zone_id"))
    joined = asof_join(requests, free, ["origin_zone"], request_time, ping_time, list(tie),
                       ["taxi_id", ping_time], "vehicle", chunk_seconds)
    return joined.withColumn("asof_taxi_id", F.col("vehicle.taxi_id")) \
        .withColumn("asof_age_s", F.col(request_time) - F.col(f"vehicle.{ping_time}")).drop("vehicle")


def supply_by_zone(vehicles: DataFrame, by: Sequence[str] = ("window_start", "zone_id")) -> DataFrame:
    """Free vehicles per zone: how many, and the longest idle one (ties by taxi id)."""
    idle = F.min(F.struct("last_seen", "taxi_id"))
    return vehicles.groupBy(*by).agg(F.count(F.lit(1)).alias("free_vehicles"),
                                     idle.alias("_idle")) \
        .select(*by, "free_vehicles", F.col("_idle.taxi_id").alias("longest_idle_taxi"),
                F.col("_idle.last_seen").alias("longest_idle_since"))


def candidate_supply(requests: DataFrame, supply: DataFrame, edges: DataFrame) -> DataFrame:
    """For each request the free supply of its own and its neighbouring zones.

    Supply is one row per (window, zone), so a request meets a handful of zone
    rows and never single vehicles.
    """
    paths = edges.select(F.col("zone_id").alias("origin_zone"), "search_order",
                         F.col("neighbour_id").alias("zone_id"))
    return requests.join(paths, "origin_zone").join(supply, ["window_start", "zone_id"], "left") \
        .withColumn("free_vehicles", F.coalesce("free_vehicles", F.lit(0)))


def uncovered_requests(requests: DataFrame, supply: DataFrame, edges: DataFrame) -> DataFrame:
    """Requests with no free vehicle in their own or a neighbouring zone (anti join)."""
    reachable = supply.select("window_start", F.col("zone_id").alias("neighbour_id")) \
        .join(edges.select("neighbour_id", F.col("zone_id").alias("origin_zone")), "neighbour_id") \
        .select("window_start", "origin_zone").distinct()
    return requests.join(reachable, ["window_start", "origin_zone"], "left_anti")


def unmatched_requests(matches: DataFrame) -> DataFrame:
    """Requests without a match; the matcher reports every request once, so they are the other half of its rows."""
    return matches.filter(~F.col("matched"))


def with_eta(df: DataFrame, zones: Sequence[Zone] = CITY_ZONES, eta_target: str = "destination",
             speed_kmh: float = geo.AVG_SPEED_KMH, lat: str = "lat", lon: str = "lon",
             dest: str = "dest_zone", origin: str = "origin_zone") -> DataFrame:
    """``eta_seconds`` from the vehicle to a zone centroid; unknown zone or vehicle gives 0.

    The default target is the destination; ``pickup`` measures to the origin.
    """
    if eta_target not in ETA_TARGETS:
        raise ValueError(f"eta_target is one of {ETA_TARGETS}, not {eta_target!r}")
    target = dest if eta_target == "destination" else origin
    km = geo.haversine_km(lat, lon, geo.zone_attribute(target, "centroid_lat", zones),
                          geo.zone_attribute(target, "centroid_lon", zones))
    return df.withColumn("eta_seconds", F.coalesce(geo.eta_seconds(km, speed_kmh), F.lit(0)))


def match_trips_rounds(requests: DataFrame, vehicles: DataFrame,
                       zones: Sequence[Zone] = CITY_ZONES, eta_target: str = "destination",
                       speed_kmh: float = geo.AVG_SPEED_KMH) -> DataFrame:
    """Match requests to free vehicles window by window, own zone first.

    ``requests``: window_start, trip_id, origin_zone, destination_zone,
    requested_at (+ rider_id, fare kept if present). ``vehicles``: window_start,
    taxi_id, zone_id, last_seen, lat, lon, one row per window and taxi.

    Round r serves the still open requests from the r-th zone of their search
    path: inside (window, zone) open requests are ranked by request time and
    free vehicles by idle time, and equal ranks meet. The number of rounds is
    that of the longest search path.

    A rank is taken in two steps, inside a second and then over the counts of
    the seconds, so that no task ranks all that a busy zone sees in a window;
    equal ranks meet in groups of two rows. Each round is stored, and what it
    has settled takes no part in the next one.
    """
    paths = {z.zone_id: list(dict.fromkeys((z.zone_id, *z.adjacency))) for z in zones}
    rounds = max(len(p) for p in paths.values())
    lookup = F.expr("map(" + ", ".join(
        f"{z}, array({', '.join(map(str, p))})" for z, p in paths.items()) + ")")
    extra = [c for c in ("rider_id", "fare", "call_type") if c in requests.columns]
    vehicle_type = "struct<taxi_id:string,last_seen:bigint,lat:double,lon:double>"

    demand = requests.select(
        "window_start", F.lit(0).alias("side"), F.col("requested_at").cast("bigint").alias("since"),
        F.col("trip_id").cast("string").alias("id"), F.col("origin_zone").cast("int").alias("zone"),
        F.coalesce(F.element_at(lookup, F.col("origin_zone").cast("int")),
                   F.array(F.col("origin_zone").cast("int"))).alias("path"),
        F.struct(F.col("destination_zone").cast("int").alias("dest_zone"), *extra).alias("request"),
        F.lit(None).cast(vehicle_type).alias("vehicle"))
    supply = vehicles.select(
        "window_start", F.lit(1).alias("side"), F.col("last_seen").cast("bigint").alias("since"),
        F.col("taxi_id").cast("string").alias("id"), F.col("zone_id").cast("int").alias("zone"),
        F.lit(None).cast("array<int>").alias("path"), F.lit(None).cast(demand.schema["request"].dataType).alias("request"),
        F.struct(F.col("taxi_id").cast("string").alias("taxi_id"),
                 F.col("last_seen").cast("bigint").alias("last_seen"), "lat", "lon").alias("vehicle"))
    state, served = demand.unionByName(supply), []
    for number in range(rounds):
        met = _stored_round(_met(state, number))
        found = (F.col("side") == 0) & F.col("near").isNotNull()
        served.append(met.filter(found | ((F.col("side") == 0) & F.col("last"))).select(
            "window_start", "since", "id", "zone", "request", F.col("near").alias("vehicle"),
            F.when(F.col("near").isNotNull(), F.col("cell")).alias("matched_zone"), F.lit(number).alias("round")))
        left = met.filter(F.when(F.col("side") == 0, F.col("near").isNull() & ~F.col("last")).otherwise(F.col("asked") == 0))
        waiting, free = left.agg(F.count_if(F.col("side") == 0), F.count_if(F.col("side") == 1)).first()
        state = left.select(*demand.columns)
        if not waiting or not free:
            break
    served.append(state.filter("side = 0").select(
        "window_start", "since", "id", "zone", "request", "vehicle", F.lit(None).cast("int").alias("matched_zone"),
        F.lit(rounds).alias("round")))
    rows = served[0]
    for more in served[1:]:
        rows = rows.unionByName(more)
    matched = F.col("vehicle").isNotNull()
    rows = rows.select(
        "window_start", F.col("id").alias("trip_id"), F.col("zone").alias("origin_zone"),
        "request.*", F.col("since").alias("requested_at"), F.coalesce("vehicle.taxi_id", F.lit("")).alias("taxi_id"),
        matched.alias("matched"), F.coalesce("matched_zone", F.lit(0)).alias("matched_zone"),
        F.when(matched, F.col("round")).otherwise(F.lit(-1)).alias("search_order"),
        F.col("vehicle.lat").alias("lat"), F.col("vehicle.lon").alias("lon"))
    return with_eta(rows, zones, eta_target, speed_kmh).drop("lat", "lon")


def _met(state: DataFrame, number: int) -> DataFrame:
    """One round: open rows with the vehicle (``near``) or the number of requests (``asked``) of their rank.

    ``last`` marks requests whose search path has no zone after this one.
    """
    cell = F.coalesce(F.when(F.col("side") == 1, F.col("zone")).otherwise(F.get("path", F.lit(number))), -1 - F.col("side"))
    rows = state.withColumn("cell", cell).withColumn("last", F.coalesce(F.size("path") <= number + 1, F.lit(False)))
    second = Window.partitionBy("window_start", "cell", "side", "since")
    inside = rows.withColumn("_rank", F.row_number().over(second.orderBy("id")))
    before = Window.partitionBy("window_start", "cell", "side").orderBy("since").rowsBetween(Window.unboundedPreceding, -1)
    keys = ["window_start", "cell", "side", "since"]
    starts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = inside.join(starts, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).withColumn(
        "rank", F.col("_rank") + F.col("_before"))
    pair = Window.partitionBy("window_start", "cell", "rank")
    return ranked.select(
        "*", F.max(F.when(F.col("side") == 1, F.col("vehicle"))).over(pair).alias("near"),
        F.count(F.when(F.col("side") == 0, 1)).over(pair).alias("asked")).drop("_rank", "_before", "rank", *[f"_{k}" for k in keys])


def _stored_round(met: DataFrame) -> DataFrame:
    path = work_folder(met.sparkSession, "match-round")
    met.write.parquet(path)
    return met.sparkSession.read.schema(met.schema).parquet(path)


def final_match_status(records: DataFrame, order: str = "emit_order",
                       key: str = "trip_id") -> DataFrame:
    """One row per trip from the several a trip can emit: a match wins, then the latest."""
    return latest_per_key(records, [key], ["matched", order])


def serving_trips(matches: DataFrame, city: str = CITY, created_s: str = "requested_at") -> DataFrame:
    """Serving rows: UTC day bucket, creation time, status; ids that are no UUID are skipped."""
    created = F.timestamp_seconds(created_s)
    return matches.filter(is_uuid("trip_id")).select(
        F.lit(city).alias("city"), F.date_format(created, "yyyy-MM-dd").alias("date_bucket"),
        created.alias("created_at"), "trip_id",
        F.when(F.col("matched"), F.col("taxi_id")).otherwise(F.lit("")).alias("taxi_id"),
        "origin_zone", "dest_zone", "rider_id",
        F.when(F.col("matched"), "matched").otherwise("unmatched").alias("status"),
        F.when(F.col("matched"), F.col("eta_seconds")).otherwise(F.lit(0)).alias("eta_seconds"),
    )


def match_rates(matches: DataFrame) -> DataFrame:
    """Match rate, share served from a neighbouring zone and mean ETA per origin zone."""
    fallback = F.col("matched") & (F.col("matched_zone") != F.col("origin_zone"))
    return matches.groupBy("origin_zone").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("matched").alias("matched"),
        F.count_if(fallback).alias("from_neighbour"),
        (F.count_if("matched") / F.count(F.lit(1))).alias("match_rate"),
        F.avg(F.when(F.col("matched"), F.col("eta_seconds"))).alias("avg_eta_s"),
    )


def corridor_eta(corridors: DataFrame, zones: Sequence[Zone] = CITY_ZONES,
                 origin: str = "origin_zone", dest: str = "destination_zone",
                 speed_kmh: float = geo.AVG_SPEED_KMH) -> DataFrame:
    """Centroid distance and ETA of every zone pair in ``corridors``."""
    spot = [geo.zone_attribute(z, f, zones) for z in (origin, dest)
            for f in ("centroid_lat", "centroid_lon")]
    return corridors.withColumn("km", geo.haversine_km(*spot)) \
        .withColumn("eta_seconds", geo.eta_seconds("km", speed_kmh))
