"""Staged windows: publishing once, a clock per source, corrections for late rows, matching across windows."""

import random

import pytest
from pyspark.sql import functions as F
from test_arrivals import T0, ZONES, made, simulated

from cabstream.operators.demand import demand_windows
from cabstream.streaming import jobs
from cabstream.streaming.outbox import Outbox, Route, folder_route
from cabstream.streaming.windows import CorrectedWindows, StagedWindows


def rows(df, *columns):
    """Row tuples in order of their values."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


class Broken(Exception):
    pass


class Topic:
    """A folder to which rows are only ever added; sends break off as told."""

    def __init__(self, spark, path, trouble=()):
        self.spark, self.path, self.trouble = spark, path, list(trouble)

    def send(self, found):
        step = self.trouble.pop(0) if self.trouble else None
        if step == "before":
            raise Broken
        found = found.drop("x") if "x" in found.columns else found
        part = found.filter(F.col("t") % 2 == 0) if step == "middle" else found
        part.write.mode("append").parquet(self.path)
        if step in ("middle", "after"):
            raise Broken

    def arrived(self, number, since_ms, kinds):
        return self.read().filter(F.col("published_in") == number)

    def read(self):
        try:
            return self.spark.read.parquet(self.path)
        except Exception:
            return self.spark.createDataFrame([], "t long, even boolean, published_in long")


def halves(spark, tmp_path, trouble_a=(), trouble_b=()):
    a, b = Topic(spark, str(tmp_path / "a"), trouble_a), Topic(spark, str(tmp_path / "b"), trouble_b)
    return a, b, {"a": Route(lambda r: r.filter("even"), ["t"], a.send, a.arrived),
                  "b": Route(lambda r: r.filter("not even"), ["t"], b.send, b.arrived)}


BATCHES = [(1, 2, 3, 4, 12), (13, 14, 25, 26), (27, 28, 41), (42, 43, 44, 55)]


def batch(spark, times):
    return spark.createDataFrame([(t,) for t in times], "t long")


STEPS = ["compute", "carry", "mark", "staged", *[(topic, step) for topic in "ab" for step in ("before", "middle", "after")]]


@pytest.mark.parametrize("step", STEPS, ids=str)
def test_every_row_is_published_once_wherever_a_run_breaks_off(spark, tmp_path, step):
    left = [step] if isinstance(step, str) else []

    def breaks(name):
        if name in left:
            left.remove(name)
            raise Broken

    def compute(part, carried, end):
        breaks("compute")
        return part.withColumn("even", (F.col("t") / 4).cast("int") % 2 == 0)

    def carry(result, part, carried, end):
        breaks("carry")
        return result.agg(F.count("*").alias("n"))

    class Windows(StagedWindows):
        def _mark(self, name):
            if name.startswith("closed"):
                breaks("mark")
            super()._mark(name)

        def close(self, everything=False):
            breaks("staged")
            return super().close(everything)

    trouble = {"a": [], "b": []}
    if not isinstance(step, str):
        trouble[step[0]] = [None, step[1]]
    a, b, routes = halves(spark, tmp_path, trouble["a"], trouble["b"])
    windows = Windows(spark, str(tmp_path / "w"), compute, carry, "t", 10, 0)
    run = jobs.staging(windows, Outbox(spark, str(tmp_path / "o"), routes))
    broken = 0
    for number, times in enumerate(BATCHES):
        try:
            run(batch(spark, times), number)
        except Broken:
            broken += 1
            run(batch(spark, times), number)  # the source delivers the batch again
    run(batch(spark, [100]), len(BATCHES))
    assert broken == 1
    want = [t for times in BATCHES for t in times]
    assert rows(a.read(), "t") == sorted((t,) for t in want if t // 4 % 2 == 0)
    assert rows(b.read(), "t") == sorted((t,) for t in want if t // 4 % 2)
    assert rows(windows.results(), "t") == sorted((t,) for t in want)
    assert windows.late() is None


def test_a_crash_is_mended_by_a_new_process(spark, tmp_path):
    def windows():
        return StagedWindows(spark, str(tmp_path / "w"), lambda p, c, e: p.withColumn("even", F.col("t") % 2 == 0), None, "t", 10, 0)

    a, b, routes = halves(spark, tmp_path, (), ["before"])
    with pytest.raises(Broken):
        jobs.staging(windows(), Outbox(spark, str(tmp_path / "o"), routes))(batch(spark, (1, 2, 11)), 0)
    jobs.staging(windows(), Outbox(spark, str(tmp_path / "o"), routes))(batch(spark, (12,)), 1)
    assert rows(a.read(), "t") == [(2,)] and rows(b.read(), "t") == [(1,)]


def test_folders_are_replaced_by_a_second_send(spark, tmp_path):
    route = folder_route(lambda r: r, ["t"], str(tmp_path / "f"))
    for _ in range(2):  # the note that it was sent is lost
        Outbox(spark, str(tmp_path / "o"), {"f": route})._send(route, "f", 5, batch(spark, (1, 2)))
    Outbox(spark, str(tmp_path / "o"), {"f": route}).publish([4, 5], lambda n: batch(spark, (n,)))
    assert rows(spark.read.parquet(str(tmp_path / "f")), "t", "published_in") == [(1, 5), (2, 5), (4, 4)]


def sourced(spark, *pairs):
    return spark.createDataFrame(list(pairs), "s string, t long")


def test_a_silent_source_holds_nothing_back_and_a_slow_one_loses_no_row(spark, tmp_path):
    now = [1000.0]
    windows = StagedWindows(spark, str(tmp_path / "w"), lambda p, c, e: p, None, "t", 10, 0, source="s", idle_s=30, now=lambda: now[0])
    windows.stage(sourced(spark, ("fast", 55), ("slow", 5)), 0)
    assert windows.clock() == 5 and windows.close() == []
    now[0] += 10
    windows.stage(sourced(spark, ("fast", 95), ("slow", 21)), 1)
    assert windows.close() == [20]  # as far as the slow one has come
    windows.stage(sourced(spark, ("slow", 24), ("slow", 31)), 2)
    assert windows.close() == [30] and windows.late() is None
    now[0] += 40
    windows.stage(sourced(spark, ("fast", 120)), 3)  # the slow one is silent now
    assert windows.clock() == 120 and windows.close() == [120]
    windows.stage(sourced(spark, ("slow", 60), ("slow", 125)), 4)  # and back, with a row that is late
    assert windows.close() == [] and rows(windows.late(), "s", "t") == [("slow", 60)]
    now[0] += 100
    assert windows.clock() == 125  # all are silent: nothing older is to be expected
    assert rows(windows.results(), "t") == sorted((t,) for t in (5, 21, 24, 31, 55, 95))


def test_a_batch_delivered_again_is_judged_as_when_it_came(spark, tmp_path):
    windows = StagedWindows(spark, str(tmp_path / "w"), lambda p, c, e: p, None, "t", 10, 0)
    windows.stage(batch(spark, (1, 12)), 0)
    assert windows.close() == [10]
    windows.stage(batch(spark, (1, 12)), 0)
    assert windows.late() is None and windows.close() == []
    windows.stage(batch(spark, (2, 33)), 1)
    assert windows.close() == [30] and rows(windows.late(), "t") == [(2,)]
    assert rows(windows.results(), "t") == [(1,), (12,)]


def test_late_rows_keep_no_batch_of_others(spark, tmp_path):
    windows = StagedWindows(spark, str(tmp_path / "w"), lambda p, c, e: p, None, "t", 10, 0)
    for number, times in enumerate([(5, 31), (6, 32, 45), (7, 33, 61), (8, 99)]):
        windows.stage(batch(spark, times), number)
        windows.close()
    assert rows(windows.late(), "t") == [(6,), (7,), (8,), (33,)]
    assert rows(windows._staged(), "t") == [(99,)]


def demand_rows(seed, n=300, seconds=600):
    draw = random.Random(seed)
    return [(draw.randrange(1, 4), T0 + draw.randrange(seconds), draw.random() < 0.6, f"T{draw.randrange(9)}", draw.random() < 0.7)
            for _ in range(n)]


def demand_table(spark, some):
    df = spark.createDataFrame(some, "zone_id int, epoch_s long, is_gps boolean, taxi_id string, is_available boolean")
    return df.withColumn("ts", F.timestamp_seconds("epoch_s"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_corrected_windows_end_as_the_batch_result_in_any_order(spark, tmp_path, seed):
    made_rows = demand_rows(seed)
    columns = ["zone_id", "window_start", "active_vehicles", "pending_requests", "ratio"]
    want = rows(demand_windows(demand_table(spark, made_rows)), *columns)
    random.Random(seed).shuffle(made_rows)
    windows = jobs.demand_corrected(spark, str(tmp_path / "w"), lateness_s=0)
    sent = []
    route = Route(lambda r: r, ["zone_id", "window_start", "op"], lambda found: sent.extend(found.collect()))
    run = jobs.staging(windows, Outbox(spark, str(tmp_path / "o"), {"t": route}))
    for number in range(6):
        part = demand_table(spark, made_rows[number::6])
        run(part, number)
        if number == 3:
            run(part, number)  # delivered again
    windows.close(everything=True)
    assert rows(windows.results(), *columns) == want
    assert len(windows.ends()) > 3 and windows.changes().filter("op = 'delete'").count() > 0
    standing = windows.changes().groupBy(*columns).agg(F.sum(F.when(F.col("op") == "insert", 1).otherwise(-1)).alias("n"))
    assert rows(standing.filter("n != 0"), *columns) == want and standing.filter("n not in (0, 1)").count() == 0
    assert {r.version for r in sent} == set(windows.ends()[:-1])


def test_rows_beyond_the_time_kept_change_nothing(spark, tmp_path):
    windows = CorrectedWindows(spark, str(tmp_path / "w"), lambda p, c, e: p.groupBy(
        F.timestamp_seconds(F.floor(F.col("t") / 10) * 10).alias("window_start")).agg(F.count("*").alias("n")),
        time="t", window_s=10, lateness_s=0, keep_s=50)
    for number, times in enumerate([(1, 2, 41), (3, 45, 52), (4, 5, 101), (6, 60, 111)]):
        windows.stage(batch(spark, times), number)
        windows.close()
    got = windows.results().select((F.unix_timestamp("window_start")).alias("w"), "n")
    assert rows(got) == [(0, 3), (40, 2), (50, 1), (60, 1), (100, 1)]
    assert rows(windows.late(), "t") == [(3,), (4,), (5,), (6,), (60,)]
    with pytest.raises(ValueError):
        CorrectedWindows(spark, "x", None, carry=lambda *a: None)


def test_matches_do_not_depend_on_where_windows_are_cut(spark, tmp_path):
    pings, asked = made(11, 12, 300, 400)
    want = {trip: v[0] for (trip, _t, _s), v in simulated(pings, asked, ZONES, 20).items()}
    feed = spark.createDataFrame(
        [("c", jobs.VEHICLE_EVENT, T0 + t, s, a, z, 33.5, -7.6, f, 0, "", 0.0) for a, z, t, s, f in pings]
        + [("c", jobs.REQUEST_EVENT, T0 + t, s, a, z, 0.0, 0.0, False, 3, "r", 0.0) for a, z, t, s in asked],
        "city string, kind int, epoch_s long, seq long, id string, zone int, lat double, lon double, available boolean, "
        "dest_zone int, rider_id string, fare double")
    windows = jobs.match_arrivals(spark, str(tmp_path / "w"), ZONES, timeout_s=20, window_s=30, lateness_s=0)
    for number in range(4):  # in order of time, but shuffled inside
        windows.stage(feed.filter(F.floor((F.col("epoch_s") - T0) / 100) == number), number)
        windows.close(everything=number == 3)
    final = windows.results().filter("not waits").collect()
    assert len(windows.ends()) > 2
    assert {r.trip_id: r.taxi_id for r in final} == want and len(final) == len(want)
