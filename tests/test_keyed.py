"""Keyed serving tables and mergeable sketches."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.operators import sketches
from cabstream.sources import keyed


@pytest.fixture
def trips(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("trip-"), F.lpad((F.col("id") * 7919 % 5000).cast("string"), 5, "0")).alias("trip_id"),
        (F.col("id") % 3).cast("int").alias("zone"), F.col("id").alias("n"))
    return df.repartition(4)


def test_one_key_opens_one_of_many_files(spark, trips, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_keyed(trips, path, ["trip_id"], files=20)
    assert len(set(keyed.read_keyed(spark, path).inputFiles())) == 20
    for wanted in ("trip-00000", "trip-02500", "trip-04999", "trip-00017"):
        assert len(keyed.candidate_files(spark, path, trip_id=wanted)) == 1
        got = keyed.read_key(spark, path, trip_id=wanted)
        assert len(got.inputFiles()) == 1 and rows(got) == rows(trips.filter(F.col("trip_id") == wanted)) and got.count() == 1
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [EqualNullSafe(trip_id" in plan
    assert keyed.read_key(spark, path, trip_id="trip-x").count() == 0
    assert keyed.candidate_files(spark, path, trip_id="zzz") == []
    assert rows(keyed.read_keyed(spark, path)) == rows(trips)


def test_a_hot_key_is_spread_over_files_and_found_whole(spark, trips, tmp_path):
    path = str(tmp_path / "t")
    hot = trips.withColumn("zone", F.when(F.col("n") % 3 > 0, F.lit(7)).otherwise((F.col("n") % 50).cast("int")))
    keyed.write_keyed(hot, path, ["zone", "trip_id"], within=["n"], files=12)
    assert len(keyed.candidate_files(spark, path, zone=7)) >= 6
    assert keyed.read_key(spark, path, zone=7).count() == hot.filter("zone = 7").count()
    one = hot.filter("zone = 7").first()
    assert len(keyed.candidate_files(spark, path, zone=7, trip_id=one.trip_id)) == 1
    assert rows(keyed.read_key(spark, path, zone=7, trip_id=one.trip_id)) == [tuple(one)]
    for wrong in ({}, {"trip_id": "x"}, {"n": 1}):
        with pytest.raises(ValueError):
            keyed.read_key(spark, path, **wrong)


def test_null_keys_upserts_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(None, 1, "x"), ("a", 1, "x"), ("b", 5, "x")], "k string, t int, v string")
    keyed.upsert_keyed(first, path, ["k"], ["t"], files=3)
    keyed.upsert_keyed(spark.createDataFrame([("a", 2, "y"), ("b", 4, "late"), ("c", 1, "y")], first.schema), path, ["k"], ["t"])
    assert rows(keyed.read_keyed(spark, path)) == [("a", 2, "y"), ("b", 5, "x"), ("c", 1, "y"), (None, 1, "x")]
    assert rows(keyed.read_key(spark, path, k="b")) == [("b", 5, "x")]
    keyed.drop_old(spark, path)
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 1 and keyed.read_key(spark, path, k="a").count() == 1
    keyed.write_keyed(first.limit(0), path, ["k"])
    assert keyed.read_keyed(spark, path).count() == 0 and keyed.read_key(spark, path, k="a").count() == 0


def test_sketches_of_days_merge_into_those_of_any_range(spark, tmp_path):
    draw = random.Random(5)
    made = [(f"d{draw.randrange(12):02d}", f"T{int(draw.paretovariate(0.4)) % 4000}", draw.lognormvariate(6, 1)) for _ in range(30_000)]
    df = spark.createDataFrame([*made, (None, None, None)], "day string, taxi string, seconds double")
    path = str(tmp_path / "s")
    for number in range(3):  # new rows of days that are there already
        part = df.filter(F.abs(F.xxhash64("day", "taxi", "seconds")) % 3 == number)
        daily = sketches.daily_sketches(part, F.col("day"), distinct={"taxis": "taxi"}, quantiles={"seconds": "seconds"})
        sketches.add_batch(daily, path, number)
        sketches.add_batch(daily, path, number)  # delivered again
    stored = sketches.read_sketches(spark, path)
    assert stored.count() <= 3 * 13
    for days in (["d03"], [f"d{i:02d}" for i in range(4, 9)], sorted({r[0] for r in made})):
        got = sketches.merged(stored.filter(F.col("day").isin(days)), (), ["taxis"], {"seconds": [0.5, 0.95]}).first()
        own = [r for r in made if r[0] in days]
        exact = len({r[1] for r in own})
        assert got.rows == len(own) and abs(got.taxis - exact) <= 0.05 * exact + 1
        for share, value in ((0.5, got.seconds_p50), (0.95, got.seconds_p95)):
            assert abs(sum(r[2] <= value for r in own) / len(own) - share) <= 0.025
    by_day = sketches.merged(stored.filter("day is not null"), ["day"], ["taxis"])
    assert by_day.count() == 12 and by_day.agg(F.sum("rows")).first()[0] == len(made)
    nothing = sketches.merged(stored.filter("day is null"), (), ["taxis"]).first()
    assert (nothing.rows, nothing.taxis) == (1, 0)
