"""Matching in the order of events against a replay of all events one by one."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.operators import arrivals
from cabstream.sources.zones import CITY_ZONES, Zone

T0 = 1704067200
# Zone 4 looks for vehicles in 1, but 1 isn't told to look for requests of 4.
ZONES = [Zone(1, "a", "x", 1, 33.50, -7.60, (2,)), Zone(2, "b", "x", 1, 33.55, -7.60, (1, 3)),
         Zone(3, "c", "x", 1, 33.60, -7.60, (2, 4)), Zone(4, "d", "x", 1, 33.65, -7.60, (1, 3))]


def simulated(pings, asked, zones, timeout):
    """All events in order: (trip, t) -> (taxi, zone, matched_at)."""
    path = {z.zone_id: list(dict.fromkeys((z.zone_id, *z.adjacency))) for z in zones}
    line = sorted([(t, 0, seq, taxi, zone, free) for taxi, zone, t, seq, free in pings]
                  + [(t, 1, seq, trip, zone, None) for trip, zone, t, seq in asked])
    pool, waiting, out = {}, [], {}

    def take(zone):
        near = min(((seen, car) for car, (z, seen) in pool.items() if z == zone), default=None)
        if near:
            del pool[near[1]]
        return near and near[1]

    for t, kind, seq, name, zone, free in line:
        if kind == 0:
            pool.pop(name, None)
            if free:
                pool[name] = (zone, t)
            for request in list(waiting):
                trip, since, origin, number = request
                if since + timeout >= t and origin in path.get(zone, [zone]) and (car := take(zone)):
                    waiting.remove(request)
                    out[trip, since, number] = (car, zone, t)
        else:
            for z in path.get(zone, [zone]):
                if car := take(z):
                    out[name, t, seq] = (car, z, t)
                    break
            else:
                waiting.append((name, t, zone, seq))
    return {(trip, t, seq): out.get((trip, t, seq), ("", 0, None)) for trip, _zone, t, seq in asked}


def tables(spark, pings, asked, files=1):
    p = spark.createDataFrame([(a, z, T0 + t, s, 33.5 + z / 100, -7.6, "IDLE" if f else "BUSY") for a, z, t, s, f in pings],
                              "taxi_id string, zone_id int, epoch_s long, seq long, lat double, lon double, status string")
    q = spark.createDataFrame([(a, z, 3, T0 + t, s, "r") for a, z, t, s in asked],
                              "trip_id string, origin_zone int, destination_zone int, requested_at long, seq long, rider_id string")
    return q.repartition(files), p.repartition(files)


def result(df):
    found = df.withColumn("at", F.col("matched_at") - T0).collect()
    return {(r.trip_id, r.requested_at - T0): (r.taxi_id, r.matched_zone, r.at) for r in found}, found


def made(seed, cars, events, seconds, share=0.4, zones=4):
    draw = random.Random(seed)
    pings, asked = [], []
    for i in range(events):
        t, zone = draw.randrange(seconds), draw.randrange(1, zones + 1)
        if draw.random() < share:
            asked.append((f"r{i:05d}", zone, t, i))
        else:
            pings.append((f"T{draw.randrange(cars):03d}", zone, t, i, draw.random() < 0.7))
    return pings, asked


@pytest.mark.parametrize("seed, cars, seconds, per_slice, files", [
    (1, 20, 300, 100, 1), (2, 5, 300, 60, 5), (3, 12, 60, 400, 2)])
def test_matches_equal_a_replay_of_all_events(spark, seed, cars, seconds, per_slice, files):
    pings, asked = made(seed, cars, 300, seconds)
    want = {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ZONES, 5).items()}
    got, found = result(arrivals.match_in_order(*tables(spark, pings, asked, files), ZONES, rows_per_slice=per_slice))
    assert got == want and len(found) == len(asked)
    assert any(v[0] for v in want.values()) and not all(v[0] for v in want.values())
    assert any(v[2] and v[2] > t for (_trip, t), v in want.items())  # some had to wait
    assert all(r.search_order >= 0 or not r.matched or r.matched_zone not in (r.origin_zone, *ZONES[r.origin_zone - 1].adjacency)
               for r in found)


def test_a_chain_of_zones_that_contest_vehicles(spark):
    """Every request takes the last vehicle that the next one would have had."""
    ring = [Zone(i, str(i), "x", 1, 33.5, -7.6, (i % 12 + 1,)) for i in range(1, 13)]
    pings = [(f"T{i:02d}", i, 0, 0, True) for i in range(2, 13)]
    asked = [(f"r{i:02d}", i, 10 + i, 0) for i in range(1, 13)]
    got, _ = result(arrivals.match_in_order(*tables(spark, pings, asked), ring, rows_per_slice=4))
    want = {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ring, 5).items()}
    assert got == want and got["r12", 22] == ("", 0, None)


def test_waiting_ends_with_the_timeout(spark):
    pings = [("A", 1, 15, 0, True), ("B", 1, 16, 0, True), ("C", 2, 17, 0, False)]
    asked = [("in time", 1, 10, 0), ("too late", 1, 10, 1), ("patient", 2, 12, 0)]
    got, _ = result(arrivals.match_in_order(*tables(spark, pings, asked), ZONES, timeout_s=5))
    assert got == {("in time", 10): ("A", 1, 15), ("too late", 10): ("", 0, None), ("patient", 12): ("B", 1, 16)}


def test_one_zone_with_all_events_is_many_slices(spark):
    pings, asked = made(9, 15, 400, 900, zones=1)
    requests, seen = tables(spark, pings, asked)
    slices = arrivals._slices(arrivals.numbered_events(requests, seen, 10), 5)
    sizes = [r["count"] for r in slices.groupBy("slice").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 100
    got, _ = result(arrivals.match_in_order(requests, seen, ZONES[:1], rows_per_slice=40))
    assert got == {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ZONES[:1], 5).items()}


def test_only_what_is_carried_is_stored_beside_the_events(spark, monkeypatch):
    """The free vehicles carried are those whose last event in a slice shows them free, up to the slice of their next one."""
    pings, asked = made(11, 15, 300, 600)
    events = arrivals.numbered_events(*tables(spark, pings, asked), 8)
    stored, store = [], arrivals._stored
    monkeypatch.setattr(arrivals, "_stored", lambda df, purpose: stored.append(store(df, purpose)) or stored[-1])
    slices = arrivals._slices(events, 5)
    assert sum(df.count() for df in stored) == slices.where(F.col("step") <= arrivals.POOL).count() < events.count()
    line, later = {}, set()
    for r in events.where(F.col("kind") == arrivals.SEEN).orderBy("at").collect():
        line.setdefault(r["id"], []).append((r["slice"], r["at"], r["available"]))
    for car, seen in line.items():
        for (own, at, free), (until, *_) in zip(seen, [*seen[1:], (7,)], strict=True):
            later |= {(car, at, s) for s in range(own + 1, until + 1) if free}
    pool = slices.where(F.col("step") == arrivals.POOL).select("id", "at", "slice").collect()
    assert {tuple(r) for r in pool} == later and len(pool) == len(later) > 0


def test_few_rounds_do_where_vehicles_report_often(spark, monkeypatch):
    """Scarce vehicles, contested between zones all the time."""
    draw, pings, asked = random.Random(3), [], []
    for t in range(600):
        pings += [(f"T{i:02d}", draw.randrange(1, 5), t, len(pings) + i, draw.random() < 0.5) for i in range(8) if (t + i) % 4 == 0]
        asked += [(f"r{t:03d}", draw.randrange(1, 5), t, t)]
    rounds, known = [], arrivals._gone
    monkeypatch.setattr(arrivals, "_gone", lambda *a: rounds.append(1) or known(*a))
    got, _ = result(arrivals.match_in_order(*tables(spark, pings, asked), ZONES, rows_per_slice=200))
    assert got == {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ZONES, 5).items()}
    assert len(rounds) <= 5


def test_rows_that_are_no_events_repeated_rows_and_empty_tables(spark):
    pings, asked = made(5, 8, 120, 100)
    requests, seen = tables(spark, pings, asked)
    odd_requests = requests.limit(3).withColumn("requested_at", F.lit(None).cast("long")).unionAll(
        requests.limit(3).withColumn("origin_zone", F.lit(0))).unionAll(requests.limit(2).withColumn("trip_id", F.lit("")))
    odd_pings = seen.limit(3).withColumn("taxi_id", F.lit(None).cast("string"))
    got, found = result(arrivals.match_in_order(requests.unionAll(odd_requests), seen.unionAll(odd_pings).unionAll(seen), ZONES))
    assert got == {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ZONES, 5).items()}
    twice = arrivals.match_in_order(requests.unionAll(requests), seen, ZONES).collect()
    assert len(twice) == 2 * len(asked)
    used = [(r.taxi_id, r.vehicle_s, r.vehicle_seq) for r in twice if r.matched]
    assert len(used) == len(set(used))
    assert arrivals.match_in_order(requests.limit(0), seen, ZONES).count() == 0
    assert arrivals.match_in_order(requests.limit(0), seen.limit(0), ZONES).count() == 0
    alone = arrivals.match_in_order(requests, seen.limit(0), CITY_ZONES)
    assert rows(alone.select("matched").distinct()) == [(False,)]


def test_rounds_grow_with_the_logarithm_of_slices_that_all_depend_on_the_first(spark, monkeypatch):
    """No vehicle reports again, so every slice needs to know what all before it have used."""
    pings = [(f"T{i:02d}", 1, 0, i, True) for i in range(16)]
    asked = [(f"r{i:02d}", 1, 10 + i, i) for i in range(24)]
    rounds, known = [], arrivals._gone
    monkeypatch.setattr(arrivals, "_gone", lambda *a: rounds.append(1) or known(*a))
    got, _ = result(arrivals.match_in_order(*tables(spark, pings, asked), ZONES[:1], rows_per_slice=3))
    assert got == {(trip, t): v for (trip, t, _s), v in simulated(pings, asked, ZONES[:1], 5).items()}
    assert len(rounds) <= 6  # of 14 slices


def test_a_slice_holds_no_more_than_the_vehicles(spark):
    city = arrivals.Replay(*arrivals.reach(ZONES), 5)
    for t in range(50_000):
        city.event(arrivals.SEEN, t, t, f"T{t % 20}", 1 + t % 4, True)
    assert len(city.free) == 20 and sum(map(len, city.idle.values())) <= 1100
    city.event(arrivals.ASKED, 50_000, 50_000, "r", 1, False)
    assert [s[2:] for s in city.served] == [(49_980, 1, 50_000)]
