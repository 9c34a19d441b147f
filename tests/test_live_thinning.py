"""Live thinning as columns against a loop over pings, batch by batch."""

import random

import pytest
from pyspark.sql import functions as F
from test_streaming import T0, Feed, ping

from cabstream.streaming import jobs
from cabstream.streaming.outbox import Outbox, Route
from cabstream.streaming.thinning import LiveThinning


def rows(df, *columns):
    """Row tuples in order of their values."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def looped(batches, interval=2):
    last, out = {}, []
    for batch in batches:
        for taxi, t, number in sorted(batch, key=lambda r: (r[0], r[1], r[2])):
            if taxi not in last or abs(t - last[taxi]) >= interval:
                out.append((taxi, t, number))
                last[taxi] = t
    return sorted(out)


def table(spark, batch):
    return spark.createDataFrame(batch, "taxi_id string, timestamp long, event_id long")


@pytest.mark.parametrize("seed, interval", [(1, 2), (2, 5), (3, 40)])
def test_equals_a_loop_over_pings(spark, tmp_path, seed, interval):
    draw, batches = random.Random(seed), []
    for b in range(5):  # a third of the pings is of one vehicle, some are late
        batches.append([(draw.choice(["hot", "hot", *"abc"]), T0 + 60 * b + draw.randrange(-30, 60), 100 * b + i) for i in range(80)])
    live = LiveThinning(spark, str(tmp_path / "live"), order=["event_id"], interval_s=interval)
    for number, batch in enumerate(batches):
        live(table(spark, batch), number)
        if number == 2:
            live(table(spark, batch), number)  # delivered again
    assert rows(live.results(), "taxi_id", "timestamp", "event_id") == looped(batches, interval)
    assert live.batches() == list(range(5))
    live(table(spark, []), 5)
    live(table(spark, [("a", T0 + 9999, 1)]), 6)
    assert live.result(6).count() == 1


def test_late_pings_can_be_dropped_and_silent_vehicles_forgotten(spark, tmp_path):
    live = LiveThinning(spark, str(tmp_path / "live"), drop_late=True, lateness_s=180, forget_s=1000)
    live(table(spark, [("A", 1000, 1), ("B", 1, 2)]), 0)
    live(table(spark, [("A", 880, 3), ("C", 700, 4), ("C", 820, 5)]), 1)
    assert rows(live.results(), "taxi_id", "timestamp") == [("A", 880), ("A", 1000), ("B", 1), ("C", 820)]
    live(table(spark, [("A", 1500, 6)]), 2)
    assert rows(live._state(3), "taxi_id", "last") == [("A", 1500), ("C", 820)]


def test_normalizer_goes_on_after_a_restart_and_publishes_each_ping_once(spark, tmp_path):
    own, feed, sent = jobs.configure_streaming(spark.newSession(), 2), Feed(tmp_path / "gps"), []
    feed.add(ping("T1", 100), ping("T1", 101), ping("T1", 102), "not json", ping("unknown", 100))
    feed.add(ping("T1", 103), ping("T1", 104), ping("T2", 104, lat=40.0))

    def start():
        route = Route(lambda r: r, ["taxi_id", "timestamp"], lambda r: sent.extend((x.taxi_id, x.timestamp - T0) for x in r.collect()))
        live = LiveThinning(own, str(tmp_path / "live"))
        run = jobs.thinning_live(live, Outbox(own, str(tmp_path / "outbox"), {"gps": route}))
        jobs.run_available(jobs.normalized_gps(feed.text(own)), str(tmp_path / "checkpoint"), batch_writer=run)
        return live

    start()
    assert sorted(sent) == [("T1", 100), ("T1", 102), ("T1", 104)]
    feed.add(ping("T1", 105))
    feed.add(ping("T1", 97))
    live = start()
    assert sorted(sent) == [("T1", t) for t in (97, 100, 102, 104)]
    assert rows(live.results().select(F.col("timestamp") - T0)) == [(97,), (100,), (102,), (104,)]
    plan = live.results()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
