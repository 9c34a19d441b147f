"""Command line: ``python -m cabstream JOB --input PATH --output PATH [...]``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream import schemas
from cabstream.operators import clean, forecast
from cabstream.operators.demand import demand_events
from cabstream.plans import etl
from cabstream.session import configure, drop_work
from cabstream.sources import parsers, readers, sinks, zones
from cabstream.streaming import jobs, outbox
from cabstream.streaming.thinning import LiveThinning

BATCH = ("curate", "snap", "zone-demand", "kpis", "features", "train", "forecast")
STREAM = ("normalize", "demand", "match", "archive")


def _arguments() -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cabstream")
    p.add_argument("job", choices=(*BATCH, *STREAM))
    p.add_argument("--input", required=True, help="input path, or broker servers for streams")
    p.add_argument("--output", required=True, help="output path, or output topic for streams")
    p.add_argument("--zones", help="zone CSV; the built-in zones otherwise")
    p.add_argument("--weather", help="hourly weather Parquet")
    p.add_argument("--references", help="reference points Parquet (ref_id, lat, lon) for snap")
    p.add_argument("--model", help="model folder for forecast")
    p.add_argument("--at", help="time to forecast, e.g. '2024-01-05 09:00:00'")
    p.add_argument("--lag-mode", default="rows", choices=("rows", "calendar", "dense"))
    p.add_argument("--last-train-month", default="2013-09")
    p.add_argument("--gps-topic", default="raw.gps")
    p.add_argument("--request-topic", default="raw.trips")
    p.add_argument("--checkpoint", help="checkpoint folder of a stream")
    p.add_argument("--work", help="shared folder of the streams' state, windows and publish notes")
    p.add_argument("--matching", default="arrival", choices=("arrival", "rounds"),
                   help="match requests in the order of events, or window by window in rounds")
    p.add_argument("--unmatched", default="unmatched.trips", help="topic of requests that found no vehicle")
    p.add_argument("--patience", type=int, help="seconds for which a request may wait; 5 in order of events, else 300")
    p.add_argument("--state-partitions", type=int, default=200, help="state partitions, fixed at the first start")
    return p.parse_args()


def _run_batch(spark: SparkSession, a: argparse.Namespace) -> None:
    dimension = zones.load_zones(spark, a.zones) if a.zones else zones.zones_df(spark)
    known = dimension if a.zones else zones.CITY_ZONES
    if a.job == "curate":
        etl.write_curated(readers.read_trips_csv(spark, a.input), a.output, zones=known)
    elif a.job == "snap":
        refs = readers.read_table(spark, a.references)
        rows = etl.snap_trajectories(readers.read_trips_csv(spark, a.input), refs, known)
        sinks.write_partitioned(rows, a.output)
    elif a.job == "zone-demand":
        etl.write_zone_demand(readers.read_table(spark, a.input), a.output)
    elif a.job == "kpis":
        etl.write_kpis(spark, readers.read_table(spark, a.input), a.output).show(truncate=False)
    elif a.job == "features":
        weather = readers.read_table(spark, a.weather, schemas.WEATHER_HOUR)
        etl.write_features(readers.read_table(spark, a.input), dimension, weather, a.output, a.lag_mode)
    elif a.job == "train":
        model, metrics, per_zone = etl.train(readers.read_table(spark, a.input), a.last_train_month)
        metrics.show()
        per_zone.orderBy("zone_id").show(100)
        forecast.feature_importances(model, spark).show(5, truncate=False)
        forecast.save_model(model, a.output)
    else:
        at = F.lit(a.at).cast("timestamp") if a.at else F.current_timestamp()
        rows = forecast.forecast_zones(readers.read_table(spark, a.input),
                                       forecast.load_model(a.model), at, dimension)
        sinks.write_partitioned(rows, a.output)


def _run_stream(spark: SparkSession, a: argparse.Namespace) -> None:
    def topic(name: str):
        return readers.stream_events(spark, "kafka", {"kafka.bootstrap.servers": a.input,
                                                      "subscribe": name})

    if a.job == "archive":
        running = [sinks.archive_events(topic(t), a.output, f"{a.checkpoint}/{t}", t) for t in (a.gps_topic, a.request_topic)]
        for query in running:
            query.awaitTermination()
        return
    if a.job == "match":
        gps = parsers.good_records(parsers.parse_normalized_gps(topic(a.gps_topic)))
        requests = parsers.good_records(parsers.parse_trip_request(topic(a.request_topic)))

        if a.matching == "arrival":
            windows = jobs.match_arrivals(spark, a.work, timeout_s=5 if a.patience is None else a.patience)
        else:
            windows = jobs.match_carrying(spark, a.work, patience_s=300 if a.patience is None else a.patience)
        halves = {True: a.output, False: a.unmatched}
        routes = {to: outbox.topic_route(spark, a.input, to, _half(matched), ["trip_id"]) for matched, to in halves.items()}
        events = jobs.match_events(gps, requests)
    elif a.job == "demand":
        gps = parsers.good_records(parsers.parse_normalized_gps(topic(a.gps_topic)))
        requests = parsers.good_records(parsers.parse_trip_request(topic(a.request_topic)))
        windows = jobs.demand_corrected(spark, a.work)
        key = ["zone_id", "window_start", "op", "version"]
        routes = {a.output: outbox.topic_route(spark, a.input, a.output, lambda rows: rows, key)}
        events = demand_events(clean.valid_vehicles(gps), requests).withColumn("epoch_s", F.unix_timestamp("ts"))
    else:
        events = jobs.normalized_gps(topic(a.gps_topic))
        live = LiveThinning(spark, a.work)
        routes = {a.output: outbox.topic_route(spark, a.input, a.output, lambda rows: rows, ["taxi_id", "timestamp"])}
    sent = outbox.Outbox(spark, f"{a.work}/outbox", routes)
    run = jobs.thinning_live(live, sent) if a.job == "normalize" else jobs.staging(windows, sent)
    stream = events.writeStream.option("checkpointLocation", a.checkpoint).foreachBatch(run)
    stream.trigger(processingTime="60 seconds" if a.job == "match" else "30 seconds").start().awaitTermination()


def _half(matched: bool):
    def pick(rows: DataFrame) -> DataFrame:
        return rows.filter("not waits").drop("waits").filter(F.col("matched") == matched)

    return pick


def main() -> None:
    a = _arguments()
    spark = SparkSession.builder.appName(f"cabstream-{a.job}").getOrCreate()
    if a.job in BATCH:
        try:
            _run_batch(configure(spark), a)
        finally:
            drop_work(spark)
    else:
        _run_stream(jobs.configure_streaming(spark, a.state_partitions), a)


if __name__ == "__main__":
    main()
