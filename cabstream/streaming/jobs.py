"""The stream jobs, and running a stream over what is there now."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabstream.functions.labels import is_available
from cabstream.operators import clean
from cabstream.operators.arrivals import TIMEOUT_S, match_in_order
from cabstream.operators.demand import demand_events, demand_windows
from cabstream.operators.latest import latest_per_key
from cabstream.operators.matching import match_trips_rounds, vehicle_state
from cabstream.operators.thinning import thin_by_interval
from cabstream.session import configure, ship_package
from cabstream.sources import parsers
from cabstream.sources.zones import CITY, CITY_ZONES, Zone
from cabstream.streaming.outbox import Outbox
from cabstream.streaming.processors import ThinningProcessor
from cabstream.streaming.thinning import LiveThinning
from cabstream.streaming.windows import CorrectedWindows, StagedWindows

VEHICLE_EVENT, REQUEST_EVENT = 0, 1
MATCH_WINDOW_S = 300

GPS_LATENESS = "3 minutes"
DEMAND_LATENESS = "1 minute"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure_streaming(spark: SparkSession, state_partitions: int) -> SparkSession:
    """Settings of stateful streams: RocksDB state with changelog checkpoints.

    The number of state partitions is fixed for the life of a query when it
    first starts, so it has to be chosen for the cluster that is meant to run
    it, not for the cores at hand.
    """
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    # A batch goes to two folders, timely and late rows: no sort to write one after the other.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
    return spark


def thin_stream(gps: DataFrame, time: str = "timestamp", order: Sequence[str] | None = None,
                interval_s: int = 2, drop_late: bool = False, lateness: str = GPS_LATENESS,
                ttl_ms: int | None = None) -> DataFrame:
    """Per-vehicle thinning of a stream that carries ``taxi_id``, ``ts`` and epoch seconds.

    ``order`` names the columns that order a vehicle's events within a
    micro-batch; event time by default, or e.g. a broker offset. ``ttl_ms``
    expires idle vehicles of a running query; processing-time state keeps such
    a query awake, so leave it out when draining a source once.
    """
    ship_package(gps.sparkSession)
    rows = gps.withWatermark("ts", lateness) if drop_late else gps
    return rows.groupBy("taxi_id").transformWithStateInPandas(
        ThinningProcessor(time, order or [time], interval_s, drop_late, ttl_ms), gps.schema,
        "Append", "EventTime" if drop_late else "ProcessingTime" if ttl_ms else "None")


def normalized_gps(text: DataFrame, zones: Sequence[Zone] = CITY_ZONES, city: str = CITY) -> DataFrame:
    """Raw GPS JSON (column ``value``) to validated, zone-mapped, anonymised events, not thinned yet."""
    parsed = clean.validate_gps(parsers.good_records(parsers.parse_gps(text)))
    return clean.anonymize_to_centroid(parsed, zones, city).select(
        "taxi_id", "trip_id", "timestamp", "event_time", "lat", "lon", "speed", "status", "city",
        "zone_id", "zone_name", "late_arrival")


def thinning_live(live: LiveThinning, outbox: Outbox) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of the normalizer: thin a batch of events and publish what isn't published."""

    def run(batch: DataFrame, batch_id: int) -> None:
        live(batch, batch_id)
        outbox.publish(live.batches(), live.result)

    return run


def normalize_gps_stream(text: DataFrame, zones: Sequence[Zone] = CITY_ZONES, city: str = CITY,
                         interval_s: int = 2, drop_late: bool = False) -> DataFrame:
    """Raw GPS JSON (column ``value``) to validated, thinned, zone-mapped, anonymised events, as one stateful stream."""
    parsed = parsers.good_records(parsers.parse_gps(text))
    thinned = thin_stream(clean.validate_gps(parsed), interval_s=interval_s, drop_late=drop_late)
    return clean.anonymize_to_centroid(thinned, zones, city).select(
        "taxi_id", "trip_id", "timestamp", "event_time", "lat", "lon", "speed", "status", "city",
        "zone_id", "zone_name", "late_arrival")


def demand_stream(gps: DataFrame, requests: DataFrame, zones: Sequence[Zone] = CITY_ZONES,
                  lateness: str = DEMAND_LATENESS) -> DataFrame:
    """Supply/demand windows of two streams; rows behind a closed window are dropped."""
    events = demand_events(clean.valid_vehicles(gps), requests).withWatermark("ts", lateness)
    return demand_windows(events, zones=zones)


def demand_stream_from_text(gps_text: DataFrame, request_text: DataFrame) -> DataFrame:
    """Demand windows straight from the two broker topics."""
    gps = parsers.good_records(parsers.parse_normalized_gps(gps_text))
    requests = parsers.good_records(parsers.parse_trip_request(request_text))
    return demand_stream(gps, requests)


def match_events(gps: DataFrame, requests: DataFrame, city: str = CITY,
                 order: str | None = None) -> DataFrame:
    """Vehicle events and requests as one tagged stream for the matcher.

    ``order`` names a number in both inputs that orders events of one second.
    """
    seq = (F.col(order) if order else F.lit(0)).cast("bigint").alias("seq")
    fare = F.col("fare") if "fare" in requests.columns else F.lit(0.0)
    vehicles = clean.valid_vehicles(gps).select(
        F.lit(city).alias("city"), "ts", F.lit(VEHICLE_EVENT).alias("kind"),
        F.unix_timestamp("ts").alias("epoch_s"), seq, F.col("taxi_id").alias("id"),
        F.col("zone_id").cast("int").alias("zone"), "lat", "lon",
        is_available("status").alias("available"), F.lit(0).alias("dest_zone"),
        F.lit("").alias("rider_id"), F.lit(0.0).alias("fare"))
    asked = clean.valid_requests(requests).select(
        F.lit(city).alias("city"), "ts", F.lit(REQUEST_EVENT).alias("kind"),
        F.unix_timestamp("ts").alias("epoch_s"), seq, F.col("trip_id").alias("id"),
        F.col("origin_zone").cast("int").alias("zone"), F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"), F.lit(False).alias("available"),
        F.col("destination_zone").cast("int").alias("dest_zone"), "rider_id", fare.alias("fare"))
    return vehicles.unionByName(asked)


def _requests(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind") == REQUEST_EVENT).select(
        F.col("id").alias("trip_id"), F.col("zone").alias("origin_zone"), F.col("dest_zone").alias("destination_zone"),
        F.col("epoch_s").alias("requested_at"), "rider_id", "fare", "seq")


def _pings(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind") == VEHICLE_EVENT).select(
        F.col("id").alias("taxi_id"), F.col("zone").alias("zone_id"), "epoch_s", "seq", "lat", "lon",
        F.when(F.col("available"), "IDLE").otherwise("BUSY").alias("status"))


def demand_replay(spark: SparkSession, folder: str, zones: Sequence[Zone] = CITY_ZONES, **timing: int) -> StagedWindows:
    """Supply/demand windows of a staged stream of ``demand_events``; carries nothing."""

    def compute(events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        return demand_windows(events, zones=zones)

    return StagedWindows(spark, folder, compute, **timing)


def demand_corrected(spark: SparkSession, folder: str, zones: Sequence[Zone] = CITY_ZONES, window_s: int = 30,
                     **timing) -> CorrectedWindows:
    """Supply/demand windows of a staged stream of ``demand_events``, put right when late rows come.

    Vehicles and requests are sources with a clock each.
    """

    def compute(events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        return demand_windows(events, zones=zones)

    return CorrectedWindows(spark, folder, compute, window_s=window_s, **{"source": "is_gps", **timing})


def thinning_replay(spark: SparkSession, folder: str, order: Sequence[str] = (), interval_s: int = 2,
                    time: str = "epoch_s", **timing: int) -> StagedWindows:
    """Per-vehicle thinning of a staged stream.

    Only events kept in the last ``interval_s`` seconds can thin later ones;
    they are carried on, put before the next rows and left out of the result.
    """

    def compute(rows: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        fresh = rows.withColumn("_carried", F.lit(False))
        if carried is not None:
            fresh = fresh.unionByName(carried.withColumn("_carried", F.lit(True)))
        return thin_by_interval(fresh, time=time, order_by=order, interval=interval_s).filter("not _carried").drop("_carried")

    def carry(kept: DataFrame, rows: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        return kept.filter(F.col(time) > end - interval_s)

    return StagedWindows(spark, folder, compute, carry, time=time, **timing)


def match_replay(spark: SparkSession, folder: str, zones: Sequence[Zone] = CITY_ZONES,
                 window_s: int = MATCH_WINDOW_S, lateness_s: int = 60) -> StagedWindows:
    """Round matching of a staged stream of ``match_events``, each window on its own as in the batch query."""

    def compute(events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        asked = _requests(events).withColumn("window_start", _start("requested_at", window_s))
        pings = _pings(events).withColumn("window_start", _start("epoch_s", window_s))
        vehicles = vehicle_state(pings, ["epoch_s", "seq"], ["window_start"])
        return match_trips_rounds(asked, vehicles, zones)

    return StagedWindows(spark, folder, compute, window_s=window_s, lateness_s=lateness_s)


def _start(seconds: str, window_s: int):
    return F.timestamp_seconds(F.floor(F.col(seconds) / window_s) * window_s)


def match_carrying(spark: SparkSession, folder: str, zones: Sequence[Zone] = CITY_ZONES, window_s: int = MATCH_WINDOW_S,
                   lateness_s: int = 60, patience_s: int = 0) -> StagedWindows:
    """Round matching that carries free vehicles and open requests from window to window.

    Windows are matched one after the other, each once. A free vehicle stays
    free until it is used or its next event; a used one comes back with its
    next event. A request that finds none is tried again in the following
    windows until ``patience_s`` seconds have passed since it was made, and is
    reported once: when it is matched, or unmatched when its patience ends.
    """
    state = ["taxi_id", "zone_id", "epoch_s", "seq", "lat", "lon", "status"]
    asked = ["trip_id", "origin_zone", "destination_zone", "requested_at", "rider_id", "fare"]

    def inputs(events: DataFrame, carried: DataFrame | None, end: int) -> tuple[DataFrame, DataFrame]:
        requests, pings = _requests(events).select(*asked), _pings(events).select(*state)
        if carried is not None:
            requests = requests.unionByName(carried.filter("taxi_id is null").select(*asked))
            pings = pings.unionByName(carried.filter("taxi_id is not null").select(*state))
        last = latest_per_key(pings, ["taxi_id"], ["epoch_s", "seq"]).filter(is_available("status"))
        return requests, last.withColumn("last_seen", F.col("epoch_s"))

    def matched(events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        requests, vehicles = inputs(events, carried, end)
        start = F.timestamp_seconds(F.lit(end - window_s))
        rows = match_trips_rounds(requests.withColumn("window_start", start), vehicles.withColumn("window_start", start), zones)
        return rows.withColumn("waits", ~F.col("matched") & (F.col("requested_at") + patience_s > end))

    def carry(result: DataFrame, events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        _requests_, vehicles = inputs(events, carried, end)
        used = result.filter("matched").select("taxi_id")
        free = vehicles.join(used, "taxi_id", "left_anti").select(*state)
        waiting = result.filter("waits").withColumnRenamed("dest_zone", "destination_zone").select(*asked)
        return free.unionByName(waiting, allowMissingColumns=True)

    return StagedWindows(spark, folder, matched, carry, window_s=window_s, lateness_s=lateness_s, stepwise=True)


def match_arrivals(spark: SparkSession, folder: str, zones: Sequence[Zone] = CITY_ZONES, timeout_s: int = TIMEOUT_S,
                   window_s: int = 30, **timing) -> StagedWindows:
    """Matching in the order of events (``match_in_order``) of a staged stream of ``match_events``.

    However many windows close together, they are one computation; free
    vehicles and waiting requests are carried on, so where windows are cut
    doesn't matter. A request that ``waits`` at the end of a result is reported
    again by the next one. Vehicles and requests are sources with a clock each.
    """
    state = ["taxi_id", "zone_id", "epoch_s", "seq", "lat", "lon", "status"]
    asked = ["trip_id", "origin_zone", "destination_zone", "requested_at", "rider_id", "fare", "seq"]

    def inputs(events: DataFrame, carried: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        requests, pings = _requests(events).select(*asked), _pings(events).select(*state)
        if carried is not None:
            requests = requests.unionByName(carried.filter("taxi_id is null").select(*asked))
            pings = pings.unionByName(carried.filter("taxi_id is not null").select(*state))
        return requests, pings

    def matched(events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        rows = match_in_order(*inputs(events, carried), zones, timeout_s)
        return rows.withColumn("waits", ~F.col("matched") & (F.col("requested_at") + timeout_s >= end))

    def carry(result: DataFrame, events: DataFrame, carried: DataFrame | None, end: int) -> DataFrame:
        _asked, pings = inputs(events, carried)
        last = latest_per_key(pings, ["taxi_id"], ["epoch_s", "seq", "zone_id"]).filter(is_available("status"))
        used = result.filter("matched").select("taxi_id", F.col("vehicle_s").alias("epoch_s"), F.col("vehicle_seq").alias("seq"))
        free = last.join(used, ["taxi_id", "epoch_s", "seq"], "left_anti").select(*state)
        waiting = result.filter("waits").withColumnRenamed("dest_zone", "destination_zone").select(*asked)
        return free.unionByName(waiting, allowMissingColumns=True)

    return StagedWindows(spark, folder, matched, carry, window_s=window_s, **{"source": "kind", **timing})


def replay(stream: DataFrame, windows: StagedWindows, checkpoint: str, everything: bool = True) -> StagedWindows:
    """Stage all that the source holds now, then close the windows.

    ``everything`` closes the last windows too, as at the end of an archive;
    without it they stay open for the rows of a later run.
    """
    run_available(stream, checkpoint, batch_writer=windows.stage)
    windows.close(everything)
    return windows


def staging(windows: StagedWindows, outbox: Outbox) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of a running job: stage a batch, close what is due and publish what isn't published.

    What a run that broke off has left, stored but not published, goes out with the next call.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        windows.stage(batch, batch_id)
        windows.close()
        outbox.publish(windows.ends(), windows.result)

    return run


def run_available(df: DataFrame, checkpoint: str, mode: str = "append",
                  batch_writer: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None, fmt: str = "parquet") -> None:
    """Process everything the sources hold now, then stop; reruns continue from the checkpoint."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True)
    if batch_writer is not None:
        query: StreamingQuery = writer.foreachBatch(batch_writer).start()
    else:
        query = writer.format(fmt).option("path", path).start()
    query.awaitTermination()

