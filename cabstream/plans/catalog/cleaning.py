"""Queries: parsing, validity, cleaning, dimension joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.functions import labels
from cabstream.operators import clean, enrich
from cabstream.plans.catalog.registry import (
    DEDUP_ORDER, DEDUP_SQL, FREE, VALID_GPS_SQL, city_edges, city_zones, normalized_gps, query, r6,
    valid_gps, valid_requests)
from cabstream.plans.views import table, view
from cabstream.sources import parsers
from cabstream.sources.sinks import iso_instant, to_json_events


@query("event_props_parsed", """
select event_id, coalesce(cast(json_extract(props, '$.k') as int), 0) as k,
       coalesce(json_extract_string(props, '$.absent'), 'UNKNOWN') as absent from events""")
def _(spark, sf):
    fields = {"k": ("int", 0), "absent": ("string", "UNKNOWN")}
    parsed = parsers.parse_json_fields(table(spark, sf, "events"), "props", fields, ("event_id",))
    return parsers.good_records(parsed)


def _gps_json(spark, sf):
    """GPS events as broker text; those of a starting blackout arrive damaged."""
    rows = view(spark, sf, "v_gps").withColumn("timestamp", F.col("epoch_s")) \
        .withColumn("event_time", iso_instant("ts"))
    fields = ["taxi_id", "trip_id", "timestamp", "event_time", "lat", "lon", "speed", "status"]
    text = F.to_json(F.struct(*fields))
    return rows.select("event_id", F.when(F.col("status") == "BLACKOUT_START", F.concat(F.lit("not json "), "trip_id"))
                       .otherwise(text).alias("value"))


@query("gps_json_parsed", """
select event_id, taxi_id, trip_id, epoch_s as timestamp, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as event_time,
       lat, lon, speed, status, false as late_arrival, ts
from v_gps where status <> 'BLACKOUT_START'""", ["v_gps"])
def _(spark, sf):
    parsed = parsers.good_records(parsers.parse_gps(_gps_json(spark, sf), keep=("event_id",)))
    return parsed.drop("anomaly", "blackout_duration_s")


@query("gps_json_quarantined", "select concat('not json ', trip_id) as text from v_gps where status = 'BLACKOUT_START'",
       ["v_gps"])
def _(spark, sf):
    return parsers.quarantined(parsers.parse_gps(_gps_json(spark, sf)))


@query("request_json_parsed", """
select trip_id, rider_id, origin_zone, destination_zone, requested_at, call_type, 0e0 as fare, ts
from v_requests""", ["v_requests"])
def _(spark, sf):
    # Street hails carry only the ISO time, as the trip service writes it.
    rows = view(spark, sf, "v_requests").withColumn(
        "event_time", F.when(F.col("call_type") == "C", iso_instant("ts"))).withColumn(
        "requested_at", F.when(F.col("call_type") != "C", F.col("requested_at")))
    text = to_json_events(rows, columns=["trip_id", "rider_id", "origin_zone", "destination_zone",
                                         "requested_at", "event_time", "call_type"])
    parsed = parsers.good_records(parsers.parse_trip_request(text))
    return parsed.select("trip_id", "rider_id", "origin_zone", "destination_zone", "requested_at",
                         "call_type", "fare", "ts")


@query("gps_valid", f"select event_id, taxi_id, epoch_s, lat, lon, speed, status from ({VALID_GPS_SQL}) g",
       ["v_gps"])
def _(spark, sf):
    return valid_gps(spark, sf).select("event_id", "taxi_id", "epoch_s", "lat", "lon", "speed", "status")


@query("gps_reject_reasons", """
select reason, count(*) as events from (select case
  when taxi_id = '' or lower(taxi_id) = 'unknown' then 'taxi_id' when not epoch_s > 0 then 'timestamp'
  when not lat between 33.4e0 and 33.7e0 then 'lat' when not lon between -7.8e0 and -7.4e0 then 'lon'
  when not speed between 0 and 150 then 'speed' else 'valid' end as reason from v_gps) r group by reason""",
       ["v_gps"])
def _(spark, sf):
    reason = F.coalesce(clean.gps_reject_reason(timestamp="epoch_s"), F.lit("valid"))
    return view(spark, sf, "v_gps").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("events"))


@query("requests_valid", "select trip_id, origin_zone, destination_zone, requested_at from v_requests "
       "where trip_id <> '' and origin_zone > 0", ["v_requests"])
def _(spark, sf):
    return valid_requests(spark, sf).select("trip_id", "origin_zone", "destination_zone", "requested_at")


@query("vehicle_availability", f"""
select status, {FREE} as available, count(*) as events from v_gps group by status""", ["v_gps"])
def _(spark, sf):
    return view(spark, sf, "v_gps").groupBy("status", labels.is_available("status").alias("available")) \
        .agg(F.count(F.lit(1)).alias("events"))


@query("gps_anonymized", """
select event_id, taxi_id, epoch_s, lat, lon, 'casablanca' as city, zone_id, zone_name from v_norm""",
       ["v_gps", "v_zones", "v_norm"])
def _(spark, sf):
    return normalized_gps(spark, sf).select("event_id", "taxi_id", "epoch_s", "lat", "lon", "city",
                                            "zone_id", "zone_name")


@query("trips_complete", "select trip_id, taxi_id, zone_id, epoch_s from v_trips where not missing_data",
       ["v_trips"])
def _(spark, sf):
    return clean.drop_missing(view(spark, sf, "v_trips"), "missing_data") \
        .select("trip_id", "taxi_id", "zone_id", "epoch_s")


@query("trips_deduplicated", DEDUP_SQL, ["v_trips"])
def _(spark, sf):
    # Exact copies on top of ids that repeat with other attributes.
    trips = view(spark, sf, "v_trips")
    copies = trips.unionByName(trips)
    return clean.dedup_trips(copies, "trip_id", DEDUP_ORDER)


@query("trajectories_non_empty", "select vec_id, cast(len(points) as int) as n_points from v_poly where len(points) > 0",
       ["v_poly"])
def _(spark, sf):
    text = view(spark, sf, "v_poly").withColumn("POLYLINE", F.to_json("points")).drop("points")
    return clean.non_empty_trajectory(text).select("vec_id", F.size("points").alias("n_points"))


@query("trip_projection", """
select trip_id as TRIP_ID, cast(taxi_id as varchar) as taxi, cast(zone_id as double) as zone_id,
       trip_duration_sec from v_trips""", ["v_trips"])
def _(spark, sf):
    return view(spark, sf, "v_trips").withColumnRenamed("trip_id", "TRIP_ID").select(
        "TRIP_ID", F.col("taxi_id").cast("string").alias("taxi"),
        F.col("zone_id").cast("double").alias("zone_id"), "trip_duration_sec")


@query("call_type_labels", """
select call_type, case call_type when 'A' then 'Central dispatch' when 'B' then 'Taxi stand' else 'Street hail' end
  as type_label, count(*) as trips from v_trips group by call_type""", ["v_trips"])
def _(spark, sf):
    return view(spark, sf, "v_trips").groupBy("call_type").agg(F.count(F.lit(1)).alias("trips")) \
        .withColumn("type_label", labels.call_type_label("call_type"))


@query("null_defaults", """
select trip_id, coalesce(case when passenger_count < 3 then null else passenger_count end, 0) as passengers,
       coalesce(case when call_type = 'C' then null else call_type end, 'UNKNOWN') as call_type
from v_trips""", ["v_trips"])
def _(spark, sf):
    rows = view(spark, sf, "v_trips").select(
        "trip_id", F.when(F.col("passenger_count") >= 3, F.col("passenger_count")).alias("passengers"),
        F.when(F.col("call_type") != "C", F.col("call_type")).alias("call_type"))
    return clean.apply_defaults(rows, {"passengers": 0, "call_type": "UNKNOWN"})


@query("trips_with_zone_names", """
select t.trip_id, t.zone_id, z.zone_name, z.zone_type, t.epoch_s from v_trips t left join v_zones z using (zone_id)""",
       ["v_trips", "v_zones"])
def _(spark, sf):
    return enrich.enrich_zone(view(spark, sf, "v_trips"), city_zones(spark)) \
        .select("trip_id", "zone_id", "zone_name", "zone_type", "epoch_s")


@query("trips_with_zone_features", """
select t.trip_id, t.zone_id, z.population_density,
  case when zone_type = 'residential' then 1 else 0 end as is_residential,
  case when zone_type = 'commercial' then 1 else 0 end as is_commercial,
  case when zone_type = 'industrial' then 1 else 0 end as is_industrial,
  case when zone_type = 'transit_hub' then 1 else 0 end as is_transit_hub
from v_trips t left join v_zones z using (zone_id)""", ["v_trips", "v_zones"])
def _(spark, sf):
    return enrich.enrich_zone_features(view(spark, sf, "v_trips").select("trip_id", "zone_id"),
                                       city_zones(spark))


@query("trips_with_weather", """
select trip_id, epoch_s, coalesce(nullif(w.temperature_2m, 20e0), 15e0) as temperature_2m, coalesce(w.rain, 0e0) as rain
from v_trips t left join v_weather w
  on w.time_slot_1h = date_trunc('hour', t.ts)""", ["v_trips", "v_weather"])
def _(spark, sf):
    # A reading of exactly 20 degrees stands for a missing one and takes the default.
    weather = view(spark, sf, "v_weather").withColumn("temperature_2m", F.nullif("temperature_2m", F.lit(20.0)))
    return enrich.enrich_weather(view(spark, sf, "v_trips"), weather, "ts") \
        .select("trip_id", "epoch_s", "temperature_2m", "rain")


@query("derived_joined_back", f"""
with one as ({DEDUP_SQL}) select trip_id, taxi_id, fare_cents, round(cast(fare_cents as double) / trip_duration_sec, 6) as cents_per_s
from one""", ["v_trips"])
def _(spark, sf):
    trips = clean.dedup_trips(view(spark, sf, "v_trips"), "trip_id", DEDUP_ORDER)
    derived = trips.select("trip_id", r6(F.col("fare_cents") / F.col("trip_duration_sec")).alias("cents_per_s"))
    return enrich.join_back(trips.select("trip_id", "taxi_id", "fare_cents"), derived, "trip_id")


@query("request_search_zones", """
select r.trip_id, e.search_order, e.neighbour_id as zone_id from v_requests r
join v_edges e on e.zone_id = r.origin_zone""", ["v_requests", "v_edges"])
def _(spark, sf):
    edges = city_edges(spark).select(F.col("zone_id").alias("origin_zone"), "search_order",
                                     F.col("neighbour_id").alias("zone_id"))
    return view(spark, sf, "v_requests").join(edges, "origin_zone").select("trip_id", "search_order", "zone_id")

