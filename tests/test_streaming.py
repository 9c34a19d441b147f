import json
import os
import random

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from cabstream import schemas
from cabstream.operators import clean, events, matching
from cabstream.plans.catalog import QUERIES
from cabstream.plans.catalog import streams as streams_catalog
from cabstream.operators.demand import demand_events, demand_windows
from cabstream.sources import parsers, readers, sinks
from cabstream.sources.zones import CITY_ZONES, Zone
from cabstream.streaming import jobs
from cabstream.streaming.windows import StagedWindows

T0 = 1704067200
LINE = [Zone(1, "a", "x", 1, 33.50, -7.60, (2,)), Zone(2, "b", "x", 1, 33.55, -7.60, (1, 3)),
        Zone(3, "c", "x", 1, 33.60, -7.60, (2,))]


@pytest.fixture(scope="module")
def streams(spark):
    return jobs.configure_streaming(spark.newSession(), 2)


class Feed:
    """A folder of JSON-line files, one micro-batch each, in a fixed order."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir(parents=True, exist_ok=True)

    def add(self, *records):
        path = self.folder / f"{self.n:04d}.json"
        path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))
        os.utime(path, (T0 + self.n * 10, T0 + self.n * 10))
        self.n += 1

    def text(self, spark):
        return readers.stream_events(spark, "text", {"path": str(self.folder), "maxFilesPerTrigger": "1"})


def ping(taxi, t, lat=33.57, lon=-7.60, speed=30.0, status="IDLE", **more):
    return {"taxi_id": taxi, "trip_id": "x", "timestamp": T0 + t, "event_time": "", "lat": lat, "lon": lon,
            "speed": speed, "status": status, **more}


def zoned(taxi, t, zone, status="IDLE"):
    return {"taxi_id": taxi, "zone_id": zone, "timestamp": T0 + t, "lat": LINE[zone - 1].centroid_lat,
            "lon": LINE[zone - 1].centroid_lon, "status": status}


def ask(trip, t, origin, dest=3):
    return {"trip_id": trip, "rider_id": "r", "origin_zone": origin, "destination_zone": dest,
            "requested_at": T0 + t, "call_type": "A"}


def run(df, tmp_path, name="out", mode="append"):
    jobs.run_available(df, str(tmp_path / f"{name}.checkpoint"), mode, path=str(tmp_path / name))
    return str(tmp_path / name)


def test_normalizer_thins_across_batches_and_restarts(spark, streams, tmp_path):
    feed = Feed(tmp_path / "gps")
    feed.add(ping("T1", 100), ping("T1", 101), ping("T1", 102), "not json", ping("unknown", 100))
    feed.add(ping("T1", 103), ping("T1", 104), ping("T2", 104, lat=40.0))
    out = run(jobs.normalize_gps_stream(feed.text(streams)), tmp_path)
    assert rows(spark.read.parquet(out), "taxi_id", "timestamp") == [("T1", T0 + t) for t in (100, 102, 104)]
    # Restart on the same checkpoint: state survives, nothing is repeated; a late event at distance is kept.
    feed.add(ping("T1", 105))
    feed.add(ping("T1", 97))
    run(jobs.normalize_gps_stream(feed.text(streams)), tmp_path)
    got = spark.read.parquet(out)
    assert rows(got, "timestamp") == [(T0 + t,) for t in (97, 100, 102, 104)]
    centroids = {(z.centroid_lat, z.centroid_lon) for z in CITY_ZONES}
    assert {(r.lat, r.lon) for r in got.collect()} <= centroids


def test_late_events(spark, streams, tmp_path):
    for drop, kept in ((False, {1000, 880, 700}), (True, {1000, 880})):
        feed = Feed(tmp_path / f"gps{drop}")
        feed.add(ping("T1", 1000))
        feed.add(ping("T2", 1000))
        feed.add(ping("T1", 880), ping("T2", 700))  # 2 and 5 minutes late
        out = run(jobs.normalize_gps_stream(feed.text(streams), drop_late=drop), tmp_path, f"late{drop}")
        assert {r.timestamp - T0 for r in spark.read.parquet(out).collect()} == kept


def test_blackout_recovery(spark, streams, tmp_path):
    feed = Feed(tmp_path / "gps")
    feed.add(ping("T1", 10), ping("T1", 20, lat=0.0, lon=0.0, status="BLACKOUT_START", anomaly="gps_blackout"))
    feed.add(ping("T1", 140, lat=0.0, lon=0.0, status="BLACKOUT_END"), ping("T1", 141), ping("T1", 141))
    out = run(jobs.normalize_gps_stream(feed.text(streams)), tmp_path)
    assert rows(spark.read.parquet(out), "timestamp") == [(T0 + 10,), (T0 + 141,)]
    raw = parsers.good_records(parsers.parse_gps(spark.read.text(str(tmp_path / "gps"))))
    found = events.blackout_intervals(raw).first()
    assert (found.duration_s, found.is_open) == (120, False)


def _random_feeds(tmp_path):
    rnd = random.Random(2)
    gps, trips = Feed(tmp_path / "g"), Feed(tmp_path / "t")
    for batch in range(4):
        times = [batch * 60 + rnd.randrange(60) for _ in range(40)]
        gps.add(*[zoned(f"T{rnd.randrange(6)}", t, rnd.randrange(1, 4), rnd.choice(["idle", "MOVING"])) for t in times])
        trips.add(*[ask(f"r{batch}-{i}", batch * 60 + rnd.randrange(60), rnd.randrange(0, 4)) for i in range(15)])
    return gps, trips


def test_streamed_windows_equal_batch_windows(spark, streams, tmp_path):
    gps, trips = _random_feeds(tmp_path)
    out = jobs.demand_stream_from_text(gps.text(streams), trips.text(streams))
    keys = ["city", "zone_id", "window_start"]
    path = str(tmp_path / "table")
    jobs.run_available(out, str(tmp_path / "c"), "update", sinks.upsert_writer(path, keys, ["pending_requests"]))
    g = parsers.good_records(parsers.parse_normalized_gps(spark.read.text(str(tmp_path / "g"))))
    r = parsers.good_records(parsers.parse_trip_request(spark.read.text(str(tmp_path / "t"))))
    batch = demand_windows(demand_events(clean.valid_vehicles(g), r))
    assert rows(sinks.read_upserted(spark, path, keys)) == rows(batch)
    last = sinks.compact_upserted(spark, path, keys)
    current = sinks.read_upserted(spark, path, keys)
    assert rows(current, *batch.columns) == rows(batch)
    assert all(f"/base/upto={last}/" in f for f in current.inputFiles())  # batches folded in are gone


def test_rows_behind_a_closed_window_are_dropped(spark, streams, tmp_path):
    gps, trips = Feed(tmp_path / "g"), Feed(tmp_path / "t")
    gps.add(zoned("A", 5, 1))
    gps.add(zoned("B", 300, 1))
    gps.add(zoned("B", 330, 1))
    gps.add(zoned("C", 6, 1), zoned("D", 290, 1))
    trips.add(ask("r", 5, 1))
    df = jobs.demand_stream_from_text(gps.text(streams), trips.text(streams))
    out = spark.read.parquet(run(df, tmp_path))
    got = {(r.window_start.minute, r.window_start.second): r.active_vehicles for r in out.collect()}
    assert got[0, 0] == 1  # C came after the window had closed


def _events_in_files(spark, folder, files):
    """The events table as a folder of files that aren't in the order of time."""
    table = spark.read.parquet(f"{DATA}/events.parquet")
    path = str(folder / "events.parquet")
    table.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    return str(folder)


@pytest.mark.parametrize("files", [1, 5])
def test_replay_gives_the_batch_result_whatever_the_files(spark, tmp_path, files):
    sf = _events_in_files(spark, tmp_path, files)
    matched = rows(QUERIES["trip_matches"](spark, DATA).drop("call_type"))
    got = streams_catalog.trip_matches(spark, sf, 1)
    assert rows(got, *QUERIES["trip_matches"](spark, DATA).drop("call_type").columns) == matched
    used = got.filter("matched").groupBy(F.window(F.timestamp_seconds("requested_at"), "5 minutes"), "taxi_id").count()
    assert used.filter("count > 1").count() == 0
    batch = QUERIES["demand_windows"](spark, DATA)
    assert rows(streams_catalog.demand_windows(spark, sf, 1), *batch.columns[:5]) == rows(batch, *batch.columns[:5])
    thinned = QUERIES["gps_thinned"](spark, DATA)
    assert rows(streams_catalog.gps_thinned(spark, sf, 1), "event_id") == rows(thinned, "event_id")
    assert rows(streams_catalog.gps_normalized(spark, sf, 1), "event_id") == rows(thinned, "event_id")


def test_windows_close_once_and_late_rows_are_kept_apart(spark, tmp_path):
    def count(part, carried, end):
        before = 0 if carried is None else carried.first()[0]
        return part.agg(F.count("*").alias("n")).withColumns({"end": F.lit(end), "before": F.lit(before)})

    def carry(result, part, carried, end):
        return result.select(F.col("n") + F.col("before"))

    windows = StagedWindows(spark, str(tmp_path / "w"), count, carry, "t", 10, 5)
    batch = lambda *t: spark.createDataFrame([(x,) for x in t], "t long")
    windows.stage(batch(1, 3, 12), 0)
    windows.stage(batch(1, 3, 12), 0)  # delivered again
    assert windows.close() == []
    windows.stage(batch(16, 2, None), 1)
    assert windows.close() == [10]
    windows.stage(batch(4, 31), 2)  # 4 is late
    assert windows.close() == [20] and windows.close() == []
    assert windows.close(everything=True) == [40]
    assert rows(windows.results(), "n", "before", "end") == [(1, 5, 40), (2, 3, 20), (3, 0, 10)]
    assert rows(windows.late(), "t") == [(4,), (None,)]


def _simulated(events_, window, patience):
    """Windows one by one: own zone first in every round, carried vehicles and requests included."""
    near = {z.zone_id: (z.zone_id, *z.adjacency) for z in LINE}
    free, waiting, out = {}, [], {}
    for end in sorted({(t // window + 1) * window for _k, t, *_ in events_}):
        for kind, t, name, zone, available in sorted(x for x in events_ if end - window <= x[1] < end):
            if kind == jobs.VEHICLE_EVENT:
                free.pop(name, None)
                if available:
                    free[name] = (zone, t)
            else:
                waiting.append((t, name, zone))
        for step in range(3):
            for zone in near:
                queue = sorted(r for r in waiting if len(near[r[2]]) > step and near[r[2]][step] == zone)
                cars = sorted((t, n) for n, (z, t) in free.items() if z == zone)
                for request, (_t, car) in zip(queue, cars):
                    waiting.remove(request)
                    del free[car]
                    out[request[1]] = car
        for request in [r for r in waiting if r[0] + patience <= end]:
            waiting.remove(request)
            out[request[1]] = ""
    return out


def test_carried_vehicles_and_requests_equal_a_simulation(spark, tmp_path):
    rnd = random.Random(4)
    made = [(rnd.randrange(2), t, "", rnd.randrange(1, 4), rnd.random() < 0.6) for t in range(240)]
    made = [(k, t, f"T{t % 25:02d}" if k == jobs.VEHICLE_EVENT else f"r{t}", z, a) for k, t, _n, z, a in made]
    feed = spark.createDataFrame(
        [("c", k, T0 + t, 0, n, z, 33.5, -7.6, a, 1, "r", 0.0) for k, t, n, z, a in made],
        "city string, kind int, epoch_s long, seq long, id string, zone int, lat double, lon double, available boolean, "
        "dest_zone int, rider_id string, fare double")
    windows = jobs.match_carrying(spark, str(tmp_path / "w"), LINE, window_s=60, lateness_s=0, patience_s=100)
    for i in range(3):
        windows.stage(feed.filter(F.col("epoch_s") % 3 == i), i)
    windows.close(everything=True)
    final = windows.results().filter("not waits")
    got = {r.trip_id: r.taxi_id for r in final.collect()}
    want = _simulated([(k, T0 + t, n, z, a) for k, t, n, z, a in made], 60, 100)
    assert final.count() == len(got) and got == want
    assert any(got.values()) and not all(got.values())


def _rounds(spark, cars, asked):
    w = F.lit("2024-01-01").cast("timestamp")
    v = spark.createDataFrame([(i, z, t, 33.5, -7.6) for _k, t, i, z, _a in cars],
                              "taxi_id STRING, zone_id INT, last_seen LONG, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame([(i, z, 1, t) for _k, t, i, z, _a in asked],
                              "trip_id STRING, origin_zone INT, destination_zone INT, requested_at LONG")
    got = matching.match_trips_rounds(r.withColumn("window_start", w), v.withColumn("window_start", w), LINE)
    return rows(got.filter("matched"), "trip_id", "taxi_id")


def test_rounds_serve_the_own_zone_first(spark):
    cars = [(0, 0, "A", 2, True), (0, 1, "B", 3, True)]
    contested = [(1, 2, "from1", 1, False), (1, 3, "from2", 2, False)]
    assert _rounds(spark, cars, contested) == [("from2", "A")]  # zone 1 reaches only zone 2
    calm = [(1, 2, "from2", 2, False), (1, 3, "from3", 3, False)]
    assert _rounds(spark, cars, calm) == [("from2", "A"), ("from3", "B")]


def test_routing_archive_and_replay(spark, streams, tmp_path):
    trips = Feed(tmp_path / "t")
    trips.add(ask("a", 1, 1), ask("b", 2, 2))
    trips.add(ask("c", 3, 3))
    query = sinks.archive_events(
        parsers.good_records(parsers.parse_trip_request(trips.text(streams))).drop("ts"),
        str(tmp_path / "archive"), str(tmp_path / "ac"), "raw.trips", trigger={"availableNow": True})
    query.awaitTermination()
    folders = {p.name.split("=")[0] for p in (tmp_path / "archive").rglob("*=*")}
    assert folders == {"topic", "year", "month", "day", "hour"}
    replayed = readers.read_event_archive(spark, str(tmp_path / "archive"), schemas.TRIP_REQUEST, "raw.trips")
    assert rows(replayed, "trip_id") == [("a",), ("b",), ("c",)]
    text = readers.read_event_text(spark, str(tmp_path / "archive"))
    assert parsers.good_records(parsers.parse_trip_request(text)).count() == 3

    results = parsers.good_records(parsers.parse_trip_request(trips.text(streams))) \
        .withColumn("matched", F.col("origin_zone") == 2)
    yes, no = str(tmp_path / "yes"), str(tmp_path / "no")
    jobs.run_available(results, str(tmp_path / "rc"), batch_writer=sinks.routing_writer(yes, no))
    assert rows(spark.read.parquet(yes), "trip_id") == [("b",)]
    assert rows(spark.read.parquet(no), "trip_id") == [("a",), ("c",)]


def test_upsert_is_idempotent_and_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    write = sinks.upsert_writer(path, ["k"], ["t"])
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 9, "z")], "k STRING, t INT, v STRING")
    write(first, 0)
    write(first, 0)
    write(spark.createDataFrame([("a", 1, "late")], first.schema), 1)
    assert rows(sinks.read_upserted(spark, path, ["k"])) == [("a", 1, "late"), ("b", 9, "z")]


def test_json_sink_format(spark):
    df = spark.createDataFrame([("a", 1704067200)], "k STRING, t LONG").withColumn(
        "event_time", sinks.iso_instant(F.timestamp_seconds("t")))
    got = sinks.to_json_events(df, "k").first()
    assert got.key == "a" and json.loads(got.value) == {"k": "a", "t": 1704067200, "event_time": "2024-01-01T00:00:00Z"}
