import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.functions import labels
from cabstream.operators import demand, features, kpi, profile, quality, serving
from cabstream.sources.zones import zones_df

TRIPS = "trip_id INT, taxi_id INT, zone_id INT, zone_name STRING, call_type STRING, trip_duration_sec INT, ts TIMESTAMP"


def trips(spark, data):
    raw = spark.createDataFrame(data, TRIPS.replace("ts TIMESTAMP", "t STRING"))
    return raw.withColumn("ts", F.col("t").cast("timestamp")).drop("t")


def test_coverage_gap_labels(spark):
    data = [(i, 1, 1, "hot", "A", 60, "2013-07-01 09:00:00") for i in range(101)]
    data += [(200 + i, i, 2, "few", "A", 60, "2013-07-01 09:00:00") for i in range(4)]
    data += [(300 + i, i, 3, "fine", "A", 60, "2013-07-01 09:00:00") for i in range(5)]
    got = {r.zone_name: (r.trips_per_taxi, r.coverage_gap) for r in kpi.coverage_gap(trips(spark, data)).collect()}
    assert got == {"hot": (101.0, "underserved"), "few": (1.0, "critical"), "fine": (1.0, "adequate")}


def test_week_labels(spark):
    df = spark.createDataFrame([("2013-12-28",), ("2013-12-29",), ("2013-12-31",), ("2014-01-01",), ("2013-07-01",),
                                ("2016-12-31",)], "d STRING").select(F.col("d").cast("timestamp").alias("ts"))
    iso = [r[0] for r in df.select(labels.iso_year_week("ts")).collect()]
    old = [r[0] for r in df.select(labels.calendar_year_week("ts")).collect()]
    assert iso == ["2013-W52", "2013-W52", "2014-W01", "2014-W01", "2013-W27", "2016-W52"]
    # Sunday 2013-12-29 opens the week of 2014-01-01, still labelled with the old year.
    assert old == ["2013-W52", "2013-W01", "2013-W01", "2014-W01", "2013-W27", "2016-W53"]


def test_kpi_rows_and_reconciliation(spark):
    data = [(i, i % 3, i % 2 + 1, f"z{i % 2}", "ABX"[i % 3], 15 * i, f"2013-07-{i % 20 + 1:02d} {i % 24:02d}:00:00")
            for i in range(60)]
    table = kpi.kpi_table(trips(spark, data))
    assert all(r.agrees for r in quality.reconcile_kpis(table).collect())
    values = {(r.kpi_name, r.category): (r.subcategory, r.label, r.value) for r in table.collect()}
    assert values["total_trips", "total"][2] == 60
    assert values["trips_per_zone", "1"] == ("", "z0", 30.0)
    assert values["trip_type_distribution", "X"][1] == "X"
    assert values["coverage_gap", "1"][0] == "critical"
    assert rows(serving.kpi_lookup(table, ["peak_demand_hours"], "09:00"), "label", "value") == [("Hour 9", 3.0)]
    single = kpi.to_kpi_rows(spark.createDataFrame([(None, 1)], "c STRING, v INT"), "k", "c", "v")
    assert rows(single) == [("k", "null", "", "null", 1.0)]


def test_ratio_without_vehicles(spark):
    gps = spark.createDataFrame([("t", 1, "MOVING"), ("u", 2, "idle"), ("u", 2, "FREE")], "taxi_id STRING, zone_id INT, status STRING") \
        .withColumn("ts", F.lit("2024-01-01 00:00:29").cast("timestamp"))
    req = spark.createDataFrame([(1,), (1,), (2,), (0,)], "origin_zone INT") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = rows(demand.demand_windows(demand.demand_events(gps, req)), "zone_id", "active_vehicles", "pending_requests", "ratio")
    assert got == [(1, 0, 2, 2.0), (2, 1, 1, 1.0)]


def test_spikes(spark):
    base = [(1, i, 2) for i in range(5)] + [(1, 5, 6), (1, 6, 5)]
    df = spark.createDataFrame(base, "zone_id INT, w INT, pending_requests INT").withColumn(
        "window_start", F.timestamp_seconds(F.col("w") * 30))
    flagged = demand.demand_spikes(df)
    assert rows(flagged.filter("is_spike"), "w") == [(5,)]
    truth = df.filter("w in (5, 6)")
    assert demand.spike_quality(flagged, truth).first().asDict() == {
        "hits": 1, "flagged": 1, "labelled": 2, "precision": 1.0, "recall": 0.5}


def _matrix(spark, slots, mode):
    made = spark.createDataFrame([(1, s, n) for s, n in slots], "zone_id INT, s INT, n INT")
    spread = made.select("zone_id", F.explode(F.sequence(F.lit(1), "n")).alias("k"), "s") \
        .withColumn("ts", F.timestamp_seconds(F.lit(1372636800) + F.col("s") * 1800)) \
        .withColumn("trip_id", F.struct("s", "k").cast("string"))
    weather = spark.createDataFrame([(1372636800, 30.0, 1.0), (1372640400, 28.0, 0.0), (1372644000, 14.9, None)],
                                    "t LONG, temperature_2m DOUBLE, rain DOUBLE") \
        .withColumn("time_slot_1h", F.timestamp_seconds("t"))
    out = features.build_features(spread, zones_df(spark), weather, mode)
    epoch = ((F.unix_timestamp("time_slot_30min") - 1372636800) / 1800).cast("int").alias("s")
    return {r.s: r for r in out.filter("zone_id = 1").select(epoch, "*").collect()}


def test_lag_modes_differ_only_on_holes(spark):
    full = [(s, s % 5 + 1) for s in range(400)]
    a, b, c = (_matrix(spark, full, m) for m in ("rows", "calendar", "dense"))
    for s in range(400):
        for got in (a, b, c):
            assert got[s].demand_lag_1d == (full[s - 48][1] if s >= 48 else 0)
            assert got[s].demand_lag_7d == (full[s - 336][1] if s >= 336 else 0)
            past = [n for _, n in full[max(0, s - 336):s]]
            assert got[s].rolling_7d_mean == pytest.approx(sum(past) / len(past) if past else 0)
    holes = [(s, n) for s, n in full if s % 7]
    rowed, timed, dense = (_matrix(spark, holes, m) for m in ("rows", "calendar", "dense"))
    assert timed[337].demand_lag_1d == full[289][1] and dense[337].demand_lag_1d == full[289][1]
    assert rowed[337].demand_lag_1d != full[289][1] or full[289][1] == full[281][1]
    assert dense[336].demand_count == 0 and 336 not in rowed


def test_features_never_see_their_own_slot(spark):
    one = _matrix(spark, [(0, 3)], "rows")[0]
    assert (one.demand_count, one.demand_lag_1d, one.demand_lag_7d, one.rolling_7d_mean) == (3, 0, 0, 0)


def test_weather_bands_and_calendar(spark):
    got = _matrix(spark, [(0, 1), (2, 1), (4, 1), (6, 1)], "rows")
    assert (got[0].is_raining, got[0].temp_hot, got[0].temp_mild) == (1, 1, 0)
    assert (got[2].temp_mild, got[2].temp_hot, got[2].temp_cold) == (1, 0, 0)
    assert (got[4].temp_cold, got[4].rain) == (1, 0.0)
    assert (got[6].temperature_2m, got[6].temp_mild) == (15.0, 1)  # no weather row
    assert (got[0].day_of_week, got[0].is_weekend, got[0].is_friday, got[0].year_month) == (2, 0, 0, "2013-07")


def test_split_is_exhaustive(spark):
    df = spark.createDataFrame([("2013-09",), ("2013-10",), ("2014-01",)], "year_month STRING")
    early, late = features.temporal_split(df)
    assert (rows(early), rows(late)) == ([("2013-09",)], [("2013-10",), ("2014-01",)])


def test_profile_and_bounds(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b")], "x INT, y STRING")
    assert rows(profile.profile_columns(df)) == [("x", 1, 2), ("y", 2, 2)]
    assert rows(profile.profile_columns(df, approximate=True)) == [("x", 1, 2), ("y", 2, 2)]
    times = spark.range(1001).select((F.col("id") * 15).cast("int").alias("trip_duration_sec"))
    assert profile.duration_bounds(times).first() == (150.0, 14850.0)
    assert profile.duration_bounds(times, exact=False).first() == pytest.approx((150, 14850), rel=0.02)
    bins = profile.clipped_histogram(times).collect()
    assert len(bins) == 20 and sum(b.trips for b in bins) == 981
    flat = spark.createDataFrame([(30,)] * 5, "trip_duration_sec INT")
    assert [(b.bin, b.trips) for b in profile.clipped_histogram(flat).collect()] == [(0, 5)]
