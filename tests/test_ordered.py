import random

import pytest
from pyspark.sql import functions as F

from cabstream.operators import events, thinning
from cabstream.operators.latest import first_per_key, latest_per_key
from cabstream.operators.ordered import (
    RANGE, asof_join, last_known, next_row, numbered_sums, previous_row, range_chunks, running_max, time_chunk, trailing_mean)


@pytest.fixture(scope="module")
def history():
    """One key holds most rows; times repeat and leave long holes."""
    rnd = random.Random(11)
    out = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.7 else rnd.choice("abc")
        out.append((key, rnd.choice((0, 40, 5000)) + rnd.randrange(60), i, rnd.choice((None, rnd.randrange(9)))))
    return out


@pytest.fixture(scope="module")
def frame(spark, history):
    return spark.createDataFrame(history, "k STRING, t LONG, i INT, v INT").repartition(6)


def ordered(history):
    keys = {}
    for row in sorted(history, key=lambda r: (r[0], r[1], r[2])):
        keys.setdefault(row[0], []).append(row)
    return keys


@pytest.mark.parametrize("chunk", [1, 7, 100000])
def test_neighbours(frame, history, chunk):
    prev = {r.i: r.prev.i if r.prev else None for r in previous_row(
        frame, ["k"], ["t", "i"], time_chunk("t", chunk), ["i"]).collect()}
    nxt = {r.i: r.next.i if r.next else None for r in next_row(
        frame, ["k"], ["t", "i"], time_chunk("t", chunk), ["i"]).collect()}
    for rows in ordered(history).values():
        ids = [r[2] for r in rows]
        assert [prev[i] for i in ids] == [None, *ids[:-1]]
        assert [nxt[i] for i in ids] == [*ids[1:], None]


@pytest.mark.parametrize("chunk", [1, 7, 100000])
def test_last_known_and_running_max(frame, history, chunk):
    last = {r.i: r.x for r in last_known(frame, ["k"], ["t", "i"], time_chunk("t", chunk), F.col("v"), "x").collect()}
    top = {r.i: r.x for r in running_max(frame, ["k"], ["t", "i"], time_chunk("t", chunk), F.col("v"), "x").collect()}
    for rows in ordered(history).values():
        known = best = None
        for _k, _t, i, v in rows:
            assert top[i] == best
            known = v if v is not None else known
            best = v if best is None else max(best, v if v is not None else best)
            assert last[i] == known


@pytest.mark.parametrize("chunk", [3, 100000])
def test_asof(spark, chunk):
    rnd = random.Random(3)
    left = [(rnd.choice("ab"), rnd.randrange(200), i) for i in range(80)]
    right = [(rnd.choice("ab"), rnd.randrange(200), 1000 + i) for i in range(40)]
    a = spark.createDataFrame(left, "k STRING, lt LONG, id INT")
    b = spark.createDataFrame(right, "k STRING, rt LONG, rid INT")
    got = {r.id: r.asof.rid if r.asof else None for r in asof_join(
        a, b, ["k"], "lt", "rt", ["rid"], ["rid", "rt"], chunk_seconds=chunk).collect()}
    for k, t, i in left:
        seen = [(rt, rid) for rk, rt, rid in right if rk == k and rt <= t]
        assert got[i] == (max(seen)[1] if seen else None)
    assert len(got) == len(left)


def thin(times, interval):
    last, kept = None, []
    for t in sorted(times):
        if last is None or t - last >= interval:
            kept.append(t)
            last = t
    return kept


@pytest.mark.parametrize("interval, chunk", [(2, 10), (2, 3600), (3, 4), (7, 10), (5, 5), (20, 25)])
def test_thinning_equals_sequential_rule(spark, interval, chunk):
    rnd = random.Random(interval * 100 + chunk)
    data = [("dense", t, 0) for t in range(0, 400)] + [("dense", t, 1) for t in range(0, 400, 3)]
    data += [("sparse", rnd.randrange(3000), i) for i in range(300)]
    data += [("holes", base + rnd.randrange(40), i) for i in range(60) for base in (0, 500)]
    df = spark.createDataFrame(data, "taxi_id STRING, timestamp LONG, n INT").repartition(5)
    out = thinning.thin_by_interval(df, order_by=["n"], interval=interval, chunk_seconds=chunk).collect()
    for key in ("dense", "sparse", "holes"):
        got = sorted(r.timestamp for r in out if r.taxi_id == key)
        assert got == thin([t for k, t, _ in data if k == key], interval)
    for r in out:
        assert r.n == min(n for k, t, n in data if (k, t) == (r.taxi_id, r.timestamp))


def test_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, None)], "k STRING, t INT, v STRING")
    assert {tuple(r) for r in latest_per_key(df, ["k"], ["t"]).collect()} == {("a", 2, "z"), ("b", 5, None)}
    assert {tuple(r) for r in first_per_key(df, ["k"], ["t"]).collect()} == {("a", 1, "x"), ("b", 5, None)}


def test_late_rows(spark):
    data = [(1, 1000, 1000), (2, 880, 1010), (3, 700, 1020), (4, 1300, 1300), (5, 1120, 1310), (6, 1119, 1320)]
    df = spark.createDataFrame(data, "id INT, event_s LONG, ingest_s LONG")
    kept = {r.id for r in events.drop_late(df, 180).collect()}
    # 2 minutes late stays, 5 minutes late goes; exactly 180 s behind stays, 181 s goes.
    assert kept == {1, 2, 4, 5}


def test_blackouts_gaps_sessions(spark):
    raw = [("T", 100, "IDLE"), ("T", 110, "BLACKOUT_START"), ("T", 230, "BLACKOUT_END"), ("T", 300, "IDLE"),
           ("T", 9000, "BLACKOUT_START"), ("U", 50, "BLACKOUT_START"), ("U", 60, "BLACKOUT_START"),
           ("U", 70, "BLACKOUT_END")]
    df = spark.createDataFrame(raw, "taxi_id STRING, timestamp LONG, status STRING")
    got = {(r.taxi_id, r.start_s): (r.end_s, r.duration_s, r.is_open) for r in events.blackout_intervals(df).collect()}
    assert got == {("T", 110): (230, 120, False), ("T", 9000): (None, None, True),
                   ("U", 50): (None, None, True), ("U", 60): (70, 10, False)}
    gaps = {tuple(r) for r in events.silent_gaps(df).collect()}
    assert gaps == {("T", 110, 230, 120), ("T", 230, 300, 70), ("T", 300, 9000, 8700)}
    mine = {(r.taxi_id, r.session_start_s, r.session_end_s, r.events)
            for r in events.activity_sessions(df, gap_seconds=60).collect()}
    timed = df.withColumn("ts", F.timestamp_seconds("timestamp"))
    built_in = timed.groupBy("taxi_id", F.session_window("ts", "60 seconds").alias("w")).count().select(
        "taxi_id", F.unix_timestamp("w.start"), F.unix_timestamp("w.end"), "count")
    assert mine == {tuple(r) for r in built_in.collect()}


def test_row_chunks_stay_small_whatever_the_skew(spark):
    # Nine tenths of the rows arrive in one second and belong to one key.
    df = spark.range(4000).selectExpr("if(id % 10 = 0, id, 7) as key", "if(id % 10 = 0, id, 5) as ingest_s", "id",
                                      "(id * 7919) % 1000 as event_s")
    cut = range_chunks(df, ["key"], ["ingest_s", "id"], 16)
    assert cut.groupBy("key", RANGE).count().agg(F.max("count")).first()[0] < 600
    kept = events.drop_late(df, 180, arrival_order=["ingest_s", "id"])
    newest, want = None, set()
    for r in sorted(df.collect(), key=lambda r: (r.ingest_s, r.id)):
        if newest is None or r.event_s >= newest - 180:
            want.add(r.id)
        newest = r.event_s if newest is None else max(newest, r.event_s)
    assert {r.id for r in kept.collect()} == want


def test_numbers_sums_and_trailing_means(frame, history):
    got = {r.i: (r._at, r._before) for r in numbered_sums(frame, ["k"], ["t", "i"], F.col("v")).collect()}
    means = {r.i: r.m for r in trailing_mean(frame.fillna(0, ["v"]), ["k"], ["t", "i"], "v", 7, "m").collect()}
    assert len(got) == len(means) == len(history)
    for rows in ordered(history).values():
        values = [r[3] or 0 for r in rows]
        for n, r in enumerate(rows):
            assert got[r[2]] == (n + 1, sum(values[:n]))
            last = values[max(0, n - 7):n]
            assert means[r[2]] == (pytest.approx(sum(last) / len(last)) if last else None)


def test_long_zones_give_the_same_lags_and_spikes(spark):
    from cabstream.operators import demand, features

    rnd = random.Random(2)
    rows = [(z, 1700000000 + 1800 * i, rnd.randrange(30)) for z in (1, 2, None) for i in range(400 if z else 20) if rnd.random() < 0.95]
    df = spark.createDataFrame(rows, "zone_id INT, s LONG, demand_count LONG").select(
        "zone_id", F.timestamp_seconds("s").alias(features.SLOT), "demand_count")
    known = df.where("zone_id is not null")

    def listed(x):
        return sorted(tuple(r) for r in x.select("zone_id", features.SLOT, *features.LAG_COLUMNS).collect())

    for a, b in zip(listed(features.add_row_lags(known)), listed(features.add_row_lags(known, long_zones=True)), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    windows = known.select("zone_id", F.col(features.SLOT).alias("window_start"), F.col("demand_count").alias("pending_requests"))
    both = [sorted(tuple(r) for r in demand.demand_spikes(windows, factor=1.5, long_zones=on).select(
        "zone_id", "window_start", "is_spike").collect()) for on in (False, True)]
    assert both[0] == both[1] and any(r[2] for r in both[0])
    plan = demand.demand_spikes(windows, long_zones=True)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_late_events_after_a_bulk_load(spark):
    """Even steps of the arrival time where that will do, ranges of rows where one second holds most of them."""
    from cabstream.operators.ordered import even_chunks

    rnd = random.Random(4)
    rows = [(i, rnd.choice([500, rnd.randrange(1000)]), rnd.randrange(2000)) for i in range(900)]
    df = spark.createDataFrame(rows, "event_id LONG, ingest_s LONG, event_s LONG")
    newest, want = None, set()
    for i, _arrived, t in sorted(rows, key=lambda r: (r[1], r[0])):
        if newest is None or t >= newest - 180:
            want.add(i)
        newest = t if newest is None else max(newest, t)
    kept = events.drop_late(df, 180, "event_s", ["ingest_s", "event_id"])
    assert {r.event_id for r in kept.collect()} == want
    assert even_chunks(df, "ingest_s") is not None and even_chunks(df, "ingest_s", chunks=100, least=50) is None
    ranged = events.drop_late(df, 180, "event_s", ["ingest_s", "event_id"], chunk=F.floor(F.col("ingest_s") / 7))
    assert {r.event_id for r in ranged.collect()} == want
    assert events.drop_late(df.limit(0), 180, "event_s", ["ingest_s", "event_id"]).count() == 0


def test_work_folders_can_be_dropped(spark, tmp_path):
    from cabstream.session import drop_work, work_folder

    path = work_folder(spark, "test")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    context, held = spark.sparkContext, spark.sparkContext._cabstream_folders
    context._cabstream_folders = [path]
    drop_work(spark)
    assert context._cabstream_folders == []
    context._cabstream_folders = held
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
