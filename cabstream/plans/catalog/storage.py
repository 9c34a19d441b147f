"""Queries that go through the sources, sinks and stores: what is written is read back as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.operators import serving, sketches
from cabstream.operators.demand import demand_events
from cabstream.plans.catalog.demand import GPS_VIEWS, WINDOWS_SQL
from cabstream.plans.catalog.matches import FINAL_SQL, MATCHES_SQL, MV, final, matches
from cabstream.plans.catalog.registry import SQL, city_zones, normalized_gps, query, valid_requests
from cabstream.plans.views import table, view
from cabstream.session import work_folder
from cabstream.sources import keyed, readers, sinks, zones
from cabstream.streaming import jobs
from cabstream.streaming.outbox import Outbox, folder_route
from cabstream.streaming.thinning import LiveThinning


@query("trips_from_csv", """select cast(trip_id as varchar) as "TRIP_ID", call_type as "CALL_TYPE",
  cast(taxi_id as int) as "TAXI_ID", cast(epoch_s as bigint) as "TIMESTAMP", missing_data as "MISSING_DATA",
  concat('[[-8.', zone_id, ',41.', dest_zone, ']]') as "POLYLINE" from v_trips""", ["v_trips"])
def _(spark, sf):
    path = work_folder(spark, "trips-csv")
    text = F.concat(F.lit("[[-8."), "zone_id", F.lit(",41."), "dest_zone", F.lit("]]"))
    none = F.lit(None).cast("int")
    raw = view(spark, sf, "v_trips").select(
        F.col("trip_id").cast("string").alias("TRIP_ID"), F.col("call_type").alias("CALL_TYPE"), none.alias("ORIGIN_CALL"),
        none.alias("ORIGIN_STAND"), F.col("taxi_id").cast("int").alias("TAXI_ID"), F.col("epoch_s").alias("TIMESTAMP"),
        F.lit("A").alias("DAY_TYPE"), F.col("missing_data").alias("MISSING_DATA"), text.alias("POLYLINE"))
    raw.write.option("header", True).option("quoteAll", True).csv(path)
    return readers.read_trips_csv(spark, path).select("TRIP_ID", "CALL_TYPE", "TAXI_ID", "TIMESTAMP", "MISSING_DATA", "POLYLINE")


@query("events_from_archive", "select event_id, user_id, event_type, value, props from events")
def _(spark, sf):
    folder, own = work_folder(spark, "archive"), jobs.configure_streaming(spark.newSession(), 4)
    options = {"path": sf, "pathGlobFilter": "events.parquet", "recursiveFileLookup": "true"}
    stream = readers.stream_events(own, "parquet", options, table(spark, sf, "events").schema)
    sinks.archive_events(stream.drop("ts"), f"{folder}/raw", f"{folder}/checkpoint", "events",
                         trigger={"availableNow": True}).awaitTermination()
    schema = table(spark, sf, "events").drop("ts").schema
    return readers.read_event_archive(spark, f"{folder}/raw", schema, "events").select(*schema.names)


@query("reachable_requests_per_zone", """select e.neighbour_id as zone_id, count(*) as requests
from v_requests q join v_edges e on e.zone_id = q.origin_zone where origin_zone > 0 group by 1""", ["v_requests", "v_edges"])
def _(spark, sf):
    path = work_folder(spark, "zones")
    listed = city_zones(spark).withColumn("adjacency_list", F.to_json("adjacency")).drop("adjacency")
    listed.write.option("header", True).option("quoteAll", True).csv(path)
    edges = zones.zone_edges(zones.load_zones(spark, path)).withColumnsRenamed({"zone_id": "origin_zone", "neighbour_id": "zone_id"})
    return valid_requests(spark, sf).join(edges, "origin_zone").groupBy("zone_id").agg(F.count(F.lit(1)).alias("requests"))


@query("trips_partitioned_by_month", """select strftime(ts, '%Y-%m') as year_month, count(*) as trips,
  sum(fare_cents)::bigint as fares, count(distinct taxi_id) as taxis from v_trips group by 1""", ["v_trips"])
def _(spark, sf):
    path = work_folder(spark, "trips-by-month")
    trips = view(spark, sf, "v_trips").withColumn("year_month", F.date_format("ts", "yyyy-MM"))
    sinks.write_partitioned(trips, path, "year_month")
    first = trips.agg(F.min("year_month")).first()[0]
    sinks.write_partitioned(trips.filter(F.col("year_month") == first), path, "year_month")  # a rerun of one month
    return readers.read_table(spark, path).groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.count(F.lit(1)).alias("trips"), F.sum("fare_cents").alias("fares"), F.count_distinct("taxi_id").alias("taxis"))


@query("matches_published", f"""{MATCHES_SQL} select trip_id, taxi_id, matched_zone,
  case when matched then 'matched' else 'unmatched' end as route from matches""", MV)
def _(spark, sf):
    folder = work_folder(spark, "published")
    routes = {name: folder_route(lambda rows, half=half: rows.filter(F.col("matched") == half), ["trip_id"], f"{folder}/{name}")
              for name, half in (("matched", True), ("unmatched", False))}
    result = matches(spark, sf).select("window_start", "trip_id", "taxi_id", "matched_zone", "matched")
    result.write.parquet(f"{folder}/result")
    stored = spark.read.parquet(f"{folder}/result")
    for _attempt in range(2):  # the second finds everything published
        Outbox(spark, f"{folder}/outbox", routes).publish([0], lambda _number: stored)
    sent = [spark.read.parquet(f"{folder}/{name}").withColumn("route", F.lit(name)) for name in routes]
    return sent[0].unionByName(sent[1]).select("trip_id", "taxi_id", "matched_zone", "route")


@query("stream_demand_corrected", WINDOWS_SQL, GPS_VIEWS)
def demand_corrected(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """Events in batches that aren't in the order of time: windows close early and are put right."""
    events = demand_events(normalized_gps(spark, sf_dir), valid_requests(spark, sf_dir)).withColumn("epoch_s", F.unix_timestamp("ts"))
    windows = jobs.demand_corrected(spark, work_folder(spark, "corrected"), window_s=3600, lateness_s=0, keep_s=10 ** 9, idle_s=10 ** 9)
    for number in range(batches):
        windows.stage(events.filter(F.pmod(F.xxhash64("epoch_s", "taxi_id", "zone_id"), F.lit(batches)) == number), number)
        windows.close(everything=number == batches - 1)
    return windows.results()


@query("trip_lookup", f"""{FINAL_SQL} select trip_id, case when matched then 'matched' else 'unmatched' end as status,
  case when matched then eta_seconds else 0 end as eta_seconds, 1::bigint as files from fin
  where trip_id = (select max(trip_id) from fin)""", ["v_match_records"])
def _(spark, sf):
    path = work_folder(spark, "trip-status")
    status = serving.trip_status(final(spark, sf))
    keyed.write_keyed(status, path, ["trip_id"], files=16)
    wanted = keyed.read_keyed(spark, path).agg(F.max("trip_id")).first()[0]
    files = len(keyed.candidate_files(spark, path, trip_id=wanted))
    return keyed.read_key(spark, path, trip_id=wanted).withColumn("files", F.lit(files).cast("bigint"))


@query("live_gps_thinned", SQL["gps_thinned"])
def _(spark, sf):
    pings = normalized_gps(spark, sf).select("taxi_id", "event_id", "epoch_s")
    low, high = pings.agg(F.min("epoch_s"), F.max("epoch_s")).first()
    live = LiveThinning(spark, work_folder(spark, "live"), time="epoch_s", order=["event_id"])
    for number in range(3):  # three micro-batches in the order of time
        part = F.floor((F.col("epoch_s") - (low or 0)) * 3 / ((high or 0) - (low or 0) + 1))
        live(pings.filter(part == number), number)
    return live.results().select("taxi_id", "event_id", "epoch_s")


@query("taxi_sketches_per_month", """select strftime(ts, '%Y-%m') as year_month, count(*) as trips, count(distinct taxi_id) as taxis,
  true as taxis_close, true as p95_close from v_trips group by 1""", ["v_trips"])
def _(spark, sf):
    """Sketches of days merged by month, held against the exact figures: 5 % of the taxis, 2.5 % of the ranks."""
    trips = view(spark, sf, "v_trips").withColumn("year_month", F.date_format("ts", "yyyy-MM"))
    path = work_folder(spark, "sketches")
    for number in range(2):
        part = trips.filter(F.pmod(F.xxhash64("trip_id"), F.lit(2)) == number)
        daily = sketches.daily_sketches(part, F.to_date("ts"), ["year_month"], {"taxis": "taxi_id"}, {"seconds": "trip_duration_sec"})
        sketches.add_batch(daily, path, number)
    about = sketches.merged(sketches.read_sketches(spark, path), ["year_month"], ["taxis"], {"seconds": [0.95]}) \
        .withColumnsRenamed({"taxis": "estimate"})
    per_value = trips.groupBy("year_month", "trip_duration_sec").agg(F.count(F.lit(1)).alias("n"))
    shares = per_value.join(about, "year_month").groupBy("year_month").agg(
        (F.sum(F.when(F.col("trip_duration_sec") <= F.col("seconds_p95"), F.col("n"))) / F.sum("n")).alias("upto"),
        (F.coalesce(F.sum(F.when(F.col("trip_duration_sec") < F.col("seconds_p95"), F.col("n"))), F.lit(0)) / F.sum("n")).alias("below"))
    exact = trips.groupBy("year_month").agg(F.count(F.lit(1)).alias("trips"), F.count_distinct("taxi_id").alias("taxis"))
    near = F.abs(F.col("estimate") - F.col("taxis")) <= 0.05 * F.col("taxis") + 1
    return exact.join(about, "year_month").join(shares, "year_month").select(
        "year_month", "trips", "taxis", near.alias("taxis_close"), ((F.col("upto") >= 0.925) & (F.col("below") <= 0.975)).alias("p95_close"))
