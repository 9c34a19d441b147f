import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.functions.labels import call_type_label, is_available, is_uuid
from cabstream.operators import clean
from cabstream.operators.quality import outside_centroids
from cabstream.sources import parsers
from cabstream.sources.zones import CITY_ZONES

GPS = "id INT, taxi_id STRING, timestamp LONG, lat DOUBLE, lon DOUBLE, speed DOUBLE"
OK = (1, "T1", 1704067200, 33.57, -7.60, 30.0)


def gps(**change):
    base = dict(zip(("id", "taxi_id", "timestamp", "lat", "lon", "speed"), OK, strict=True))
    return tuple({**base, **change}.values())


@pytest.mark.parametrize("change, reason", [
    ({}, None), ({"lat": 33.4}, None), ({"lat": 33.7}, None), ({"lon": -7.8}, None),
    ({"lon": -7.4}, None), ({"speed": 0.0}, None), ({"speed": 150.0}, None),
    ({"lat": 33.39}, "lat"), ({"lat": 33.71}, "lat"), ({"lon": -7.81}, "lon"), ({"lon": -7.39}, "lon"),
    ({"speed": 150.01}, "speed"), ({"speed": -1.0}, "speed"), ({"taxi_id": ""}, "taxi_id"),
    ({"taxi_id": None}, "taxi_id"), ({"taxi_id": "Unknown"}, "taxi_id"), ({"timestamp": 0}, "timestamp"),
    ({"taxi_id": "", "lat": 0.0}, "taxi_id"), ({"lat": None}, "lat"),
])
def test_gps_rules(spark, change, reason):
    df = spark.createDataFrame([gps(**change)], GPS)
    assert df.select(clean.gps_reject_reason()).first()[0] == reason
    assert clean.validate_gps(df).count() == (1 if reason is None else 0)


def test_anonymised_rows_hold_only_centroids(spark):
    df = spark.range(500).select(
        F.lit("T").alias("taxi_id"), (33.4 + F.rand(1) * 0.3).alias("lat"), (-7.8 + F.rand(2) * 0.4).alias("lon"))
    out = clean.anonymize_to_centroid(df)
    assert outside_centroids(out).count() == 0
    assert outside_centroids(df.withColumn("zone_id", F.lit(1))).count() == 500
    pairs = {(z.centroid_lat, z.centroid_lon) for z in CITY_ZONES}
    assert {(r.lat, r.lon) for r in out.collect()} <= pairs


def test_missing_flag(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "TRIP_ID INT, MISSING_DATA BOOLEAN")
    assert rows(clean.drop_missing(df), "TRIP_ID") == [(2,)]


def test_dedup_is_total(spark):
    data = [("a", 5, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", 1, "q"), ("b", 1, "q")]
    df = spark.createDataFrame(data, "TRIP_ID STRING, t INT, v STRING")
    for part in (1, 3):
        assert rows(clean.dedup_trips(df.repartition(part), "TRIP_ID", ["t"])) == [("a", 3, "y"), ("b", 1, "q")]


@pytest.mark.parametrize("text, keep", [("[]", False), ("bad", False), (None, False), ("[[1.0]]", False),
                                        ("[[-8.6,41.1]]", True), ("[null,[-8.6,41.1]]", True)])
def test_trajectory_filter(spark, text, keep):
    df = spark.createDataFrame([(text,)], "POLYLINE STRING")
    assert (clean.non_empty_trajectory(df).count() == 1) is keep


def test_labels(spark):
    df = spark.createDataFrame([("idle", "A"), ("Free", "X"), ("AVAILABLE", "C"), ("MOVING", None), (None, "B")],
                               "s STRING, c STRING")
    assert [r[0] for r in df.select(is_available("s")).collect()] == [True, True, True, False, False]
    assert [r[0] for r in df.select(call_type_label("c")).collect()] == [
        "Central dispatch", None, "Street hail", None, "Taxi stand"]
    ids = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",), ("trip-1",), (None,)], "i STRING")
    assert [r[0] for r in ids.select(is_uuid("i")).collect()] == [True, False, False]


def test_sampled_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("TRIP_ID"))
    a = rows(clean.sampled_rows(df, 0.1, 42))
    assert a == rows(clean.sampled_rows(df, 0.1, 42)) and 60 < len(a) < 140


def test_tolerant_parsing(spark):
    texts = [
        '{"taxi_id":"T1","timestamp":1704067200,"lat":33.5,"lon":-7.6,"speed":3,"status":"IDLE"}',
        '{"taxi_id":"T2","timestamp":"1704067201","lat":"33.5","speed":"fast"}',
        '{"taxi_id":"T3","timestamp":12.7,"late_arrival":"true"}',
        "not json", '{"taxi_id":', None, "[1,2]",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    parsed = parsers.parse_gps(df)
    good = {r.taxi_id: r for r in parsers.good_records(parsed).collect()}
    assert set(good) == {"T1", "T2", "T3"}
    assert (good["T1"].lat, good["T1"].speed, good["T1"].late_arrival) == (33.5, 3.0, False)
    t2 = good["T2"]
    assert (t2.timestamp, t2.lat, t2.lon, t2.speed, t2.status) == (1704067201, 33.5, 0.0, 0.0, "UNKNOWN")
    assert (good["T3"].timestamp, good["T3"].late_arrival) == (12, True)
    assert parsers.quarantined(parsed).count() == 4


def test_request_time_falls_back_to_iso(spark):
    texts = ['{"trip_id":"a","origin_zone":1,"event_time":"2024-01-01T00:00:05"}',
             '{"trip_id":"b","origin_zone":1,"requested_at":7}', '{"trip_id":"c"}']
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    out = parsers.good_records(parsers.parse_trip_request(df))
    assert rows(out, "trip_id", "requested_at") == [("a", 1704067205), ("b", 7), ("c", 0)]
