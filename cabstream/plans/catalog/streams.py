"""Queries run as streams over the tables: staged by window, closed once, equal to the batch form's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.operators import clean
from cabstream.operators.demand import demand_events
from cabstream.plans.catalog.demand import GPS_VIEWS, WINDOWS_SQL
from cabstream.plans.catalog.matches import IN_ORDER, IN_ORDER_SQL, MATCHES_SQL
from cabstream.plans.catalog.matches import MV as MATCH_VIEWS
from cabstream.plans.catalog.registry import SQL, query, r6
from cabstream.plans.views import table, view
from cabstream.session import configure, hadoop_path, work_folder
from cabstream.sources import parsers
from cabstream.sources.readers import stream_events
from cabstream.streaming import jobs


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream, so its settings stay off the caller's."""
    return jobs.configure_streaming(spark.newSession(), int(spark.conf.get("spark.sql.shuffle.partitions")))


def _event_stream(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    """The table as a stream, be it a file or a folder of files."""
    schema = table(spark, sf_dir, "events").schema
    files, where = hadoop_path(spark, f"{sf_dir}/events.parquet")
    folder = files.getFileStatus(where).isDirectory()
    options = {"path": f"{sf_dir}/events.parquet"} if folder else {"path": sf_dir, "pathGlobFilter": "events.parquet"}
    if per_batch:
        options["maxFilesPerTrigger"] = str(per_batch)
    return stream_events(spark, "parquet", options, schema)


def _streams(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    events = _event_stream(spark, sf_dir, per_batch)
    gps = clean.validate_gps(view(spark, sf_dir, "v_gps", events), timestamp="epoch_s")
    return gps, view(spark, sf_dir, "v_requests", events)


def demand_windows(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    own, folder = _stream_session(spark), work_folder(spark, "demand")
    gps, requests = _streams(own, sf_dir, per_batch)
    events = demand_events(clean.valid_vehicles(clean.anonymize_to_centroid(gps)), requests)
    staged = jobs.demand_replay(own, folder)
    jobs.replay(events.withColumn("epoch_s", F.unix_timestamp("ts")), staged, f"{folder}/checkpoint")
    return staged.results(configure(spark))


def gps_thinned(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    own, folder = _stream_session(spark), work_folder(spark, "thinned")
    gps, _requests = _streams(own, sf_dir, per_batch)
    rows = clean.anonymize_to_centroid(gps).select("taxi_id", "event_id", "epoch_s")
    staged = jobs.replay(rows, jobs.thinning_replay(own, folder, ["event_id"]), f"{folder}/checkpoint")
    return staged.results(configure(spark))


def trip_matches(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    own, folder = _stream_session(spark), work_folder(spark, "rounds")
    gps, requests = _streams(own, sf_dir, per_batch)
    events = jobs.match_events(clean.anonymize_to_centroid(gps), requests, order="event_id")
    staged = jobs.replay(events, jobs.match_replay(own, folder), f"{folder}/checkpoint")
    return staged.results(configure(spark)).drop("fare")


def trip_matches_in_order(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    own, folder = _stream_session(spark), work_folder(spark, "in-order")
    gps, requests = _streams(own, sf_dir, per_batch)
    events = jobs.match_events(clean.anonymize_to_centroid(gps), requests, order="event_id")
    staged = jobs.replay(events, jobs.match_arrivals(own, folder), f"{folder}/checkpoint")
    return staged.results(configure(spark)).select(*IN_ORDER)


def gps_normalized(spark: SparkSession, sf_dir: str, per_batch: int | None = None) -> DataFrame:
    """The whole first job: JSON text to validated, thinned, zone-mapped and anonymised events."""
    own, folder = _stream_session(spark), work_folder(spark, "normalized")
    raw = view(own, sf_dir, "v_gps", _event_stream(own, sf_dir, per_batch)).withColumn("timestamp", F.col("epoch_s"))
    fields = F.struct("taxi_id", "trip_id", "timestamp", "lat", "lon", "speed", "status")
    text = raw.select("event_id", F.to_json(fields).alias("value"))
    parsed = parsers.good_records(parsers.parse_gps(text, keep=("event_id",)))
    rows = clean.anonymize_to_centroid(clean.validate_gps(parsed))
    staged = jobs.thinning_replay(own, folder, ["event_id"], time="timestamp")
    jobs.replay(rows, staged, f"{folder}/checkpoint")
    return staged.results(configure(spark)).select(
        "event_id", "taxi_id", "trip_id", "timestamp", r6("speed").alias("speed"), "lat", "lon", "zone_id", "zone_name",
        "status", "city")


query("stream_demand_windows", WINDOWS_SQL, GPS_VIEWS)(demand_windows)
query("stream_gps_thinned", SQL["gps_thinned"])(gps_thinned)
query("stream_trip_matches_rounds", f"{MATCHES_SQL} select * exclude (call_type) from matches", MATCH_VIEWS)(trip_matches)
query("stream_trip_matches_in_order", f"{IN_ORDER_SQL} select * exclude (call_type) from inorder", MATCH_VIEWS)(trip_matches_in_order)
query("stream_gps_normalized", f"""select n.event_id, n.taxi_id, n.trip_id, n.epoch_s as timestamp,
  round(n.speed, 6) as speed, n.lat, n.lon, n.zone_id, n.zone_name, n.status, 'casablanca' as city
  from ({SQL['gps_thinned']}) t join v_norm n on n.event_id = t.event_id""", ["v_gps", "v_zones", "v_norm"])(gps_normalized)
