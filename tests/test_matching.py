import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.operators import matching
from cabstream.sources.zones import CITY_ZONES, Zone

W = "2024-01-01 00:00:00"
LINE = [Zone(1, "a", "x", 1, 33.50, -7.60, (2,)), Zone(2, "b", "x", 1, 33.55, -7.60, (1, 3)),
        Zone(3, "c", "x", 1, 33.60, -7.60, (2,))]


def requests(spark, data):
    df = spark.createDataFrame(data, "trip_id STRING, origin_zone INT, destination_zone INT, requested_at LONG")
    return df.withColumn("window_start", F.lit(W).cast("timestamp"))


def vehicles(spark, data):
    df = spark.createDataFrame(data, "taxi_id STRING, zone_id INT, last_seen LONG")
    return df.withColumns({"window_start": F.lit(W).cast("timestamp"), "lat": F.lit(33.5), "lon": F.lit(-7.6)})


def brute_rounds(reqs, cabs, zones):
    path = {z.zone_id: [z.zone_id, *z.adjacency] for z in zones}
    free, out = {z: sorted((s, t) for t, zz, s in cabs if zz == z) for z in {c[1] for c in cabs}}, {}
    for r in range(max(map(len, path.values()))):
        wanting = {}
        for trip, origin, _d, at in reqs:
            p = path.get(origin, [origin])
            if trip not in out and r < len(p):
                wanting.setdefault(p[r], []).append((at, trip))
        for zone, queue in wanting.items():
            for (_at, trip), (_s, taxi) in zip(sorted(queue), list(free.get(zone, [])), strict=False):
                out[trip] = (taxi, zone, r)
                free[zone].remove((_s, taxi))
    return out


def test_rounds_equal_brute_force(spark):
    rnd = random.Random(9)
    # A third of the requests start in one zone.
    reqs = [(f"r{i}", rnd.choice([7] * 8 + list(range(1, 18))), rnd.randrange(1, 17), rnd.randrange(300)) for i in range(150)]
    cabs = [(f"t{i}", rnd.randrange(1, 17), rnd.randrange(300)) for i in range(90)]
    got = matching.match_trips_rounds(requests(spark, reqs), vehicles(spark, cabs)).collect()
    want = brute_rounds(reqs, cabs, CITY_ZONES)
    assert len(got) == len(reqs)
    assert {r.trip_id: (r.taxi_id, r.matched_zone, r.search_order) for r in got if r.matched} == want
    used = [r.taxi_id for r in got if r.matched]
    assert len(used) == len(set(used)) == len(want)
    assert all(r.taxi_id == "" and r.eta_seconds == 0 for r in got if not r.matched)


def test_longest_idle_first_and_neighbour_order(spark):
    reqs = [("early", 2, 3, 5), ("late", 2, 3, 9), ("far", 2, 3, 20), ("none", 3, 1, 1)]
    cabs = [("busyer", 2, 50), ("idle", 2, 10), ("left", 1, 1)]
    got = {r.trip_id: r for r in matching.match_trips_rounds(
        requests(spark, reqs), vehicles(spark, cabs), LINE).collect()}
    assert (got["early"].taxi_id, got["late"].taxi_id) == ("idle", "busyer")
    assert (got["far"].taxi_id, got["far"].matched_zone, got["far"].search_order) == ("left", 1, 1)
    assert not got["none"].matched


def test_eta_targets(spark):
    reqs, cabs = requests(spark, [("r", 1, 3, 1)]), vehicles(spark, [("t", 1, 1)])
    far = matching.match_trips_rounds(reqs, cabs, LINE).first().eta_seconds
    near = matching.match_trips_rounds(reqs, cabs, LINE, eta_target="pickup").first().eta_seconds
    assert near == 0 and far == pytest.approx(33.6 * 0 + 11.119 / 25 * 3600, abs=2)
    with pytest.raises(ValueError):
        matching.match_trips_rounds(reqs, cabs, LINE, eta_target="nowhere")


def test_ghost_vehicles_are_an_option(spark):
    pings = spark.createDataFrame([("t", 1, 10, "IDLE"), ("t", 2, 20, "IDLE"), ("u", 1, 5, "IDLE"), ("u", 1, 6, "MOVING")],
                                  "taxi_id STRING, zone_id INT, timestamp LONG, status STRING")
    assert rows(matching.vehicle_state(pings), "taxi_id", "zone_id") == [("t", 2)]
    assert rows(matching.vehicle_state(pings, allow_ghosts=True), "taxi_id", "zone_id") == [("t", 1), ("t", 2)]


def test_final_status(spark):
    data = [("a", False, 0), ("a", False, 3), ("b", False, 0), ("b", True, 1), ("b", False, 2)]
    df = spark.createDataFrame(data, "trip_id STRING, matched BOOLEAN, emit_order INT")
    assert rows(matching.final_match_status(df)) == [("a", False, 3), ("b", True, 1)]


def test_anti_joins(spark):
    reqs = requests(spark, [("x", 1, 2, 1), ("y", 3, 2, 1)])
    supply = matching.supply_by_zone(vehicles(spark, [("t", 2, 1)]))
    edges = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (3, 0, 3)], "zone_id INT, search_order INT, neighbour_id INT")
    assert rows(matching.uncovered_requests(reqs, supply, edges), "trip_id") == [("y",)]
    matches = spark.createDataFrame([("x", True), ("y", False)], "trip_id STRING, matched BOOLEAN")
    assert rows(matching.unmatched_requests(matches), "trip_id") == [("y",)]


def test_a_cell_with_all_rows_of_a_window(spark):
    """Ranks go on from second to second; ties of a second go by id."""
    import random

    from cabstream.sources.zones import CITY_ZONES

    draw = random.Random(3)
    asked = [(f"r{i:04d}", 1, 2, draw.randrange(40)) for i in range(600)]
    cars = [(f"T{i:04d}", draw.choice([1, 1, 1, 2, 3]), draw.randrange(40), 33.5, -7.6) for i in range(500)]
    w = F.lit("2024-01-01").cast("timestamp")
    r = spark.createDataFrame(asked, "trip_id STRING, origin_zone INT, destination_zone INT, requested_at LONG").withColumn("window_start", w)
    v = spark.createDataFrame(cars, "taxi_id STRING, zone_id INT, last_seen LONG, lat DOUBLE, lon DOUBLE").withColumn("window_start", w)
    got = {x.trip_id: (x.taxi_id, x.matched_zone) for x in matching.match_trips_rounds(r, v).collect()}
    queue, want = sorted(asked, key=lambda q: (q[3], q[0])), {}
    for zone in (1, *CITY_ZONES[0].adjacency):
        idle = sorted((c for c in cars if c[1] == zone), key=lambda c: (c[2], c[0]))
        for q, c in zip(queue, idle):
            want[q[0]] = (c[0], zone)
        queue = queue[len(idle):]
    want |= {q[0]: ("", 0) for q in queue}
    assert got == want and len(queue) == 100
