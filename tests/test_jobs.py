import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cabstream.operators import features, forecast
from cabstream.plans import etl
from cabstream.sources import readers, sinks
from cabstream.sources.zones import zones_df

HEADER = '"TRIP_ID","CALL_TYPE","ORIGIN_CALL","ORIGIN_STAND","TAXI_ID","TIMESTAMP","DAY_TYPE","MISSING_DATA","POLYLINE"\n'


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("trips")
    path = [[-8.62, 41.15], [-8.63, 41.15], [-8.63, 41.16]]
    lines = [
        f'"a","A","","7","20000001","1372636858","A","False","{json.dumps(path)}"',
        f'"a","A","","7","20000001","1372636858","A","False","{json.dumps(path)}"',
        '"b","B","","","20000002","1372636900","A","True","[[-8.62,41.15]]"',
        '"c","C","","","20000003","1375315200","A","False","[]"',
        '"d","C","12","","20000004","1375315200","A","False","[[-8.62,41.15]]"',
        '"e","C","","","20000004","1375315300","A","False","[[-9.9,50.0],[-8.62]]"',
    ]
    (folder / "train.csv").write_text(HEADER + "\n".join(lines) + "\n")
    out = str(folder / "curated")
    etl.write_curated(readers.read_trips_csv(spark, str(folder / "train.csv")), out)
    return out


def test_curated_trips(spark, curated):
    got = {r.TRIP_ID: r for r in readers.read_table(spark, curated).collect()}
    assert set(got) == {"a", "d", "e"}
    a = got["a"]
    assert (a.trip_duration_sec, a.hour_of_day, a.day_of_week, a.year_month) == (45, 0, 2, "2013-07")
    assert a.trip_distance_km == pytest.approx(0.837 + 1.112, abs=0.01)
    assert len(json.loads(a.POLYLINE)) == 3 and a.ORIGIN_STAND == 7
    assert (got["d"].trip_distance_km, got["d"].trip_duration_sec, got["d"].year_month) == (0.0, 15, "2013-08")
    # The clamped corner of the box; the unusable point counts for duration only.
    assert (got["e"].trip_duration_sec, len(json.loads(got["e"].POLYLINE))) == (30, 1)
    assert got["e"].CASA_ORIGIN_ZONE == 2


def test_partitions_are_pruned_and_reruns_replace(spark, curated):
    table = readers.read_table(spark, curated)
    plan = table.filter("year_month = '2013-07'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    before = table.count()
    again = spark.createDataFrame(table.filter("year_month = '2013-08'").limit(1).collect(), table.schema)
    sinks.write_partitioned(again, curated, "year_month")
    after = rows(readers.read_table(spark, curated).groupBy("year_month").count())
    assert after == [("2013-07", 1), ("2013-08", 1)] and before == 3


def test_kpis_reconcile(spark, curated, tmp_path):
    result = etl.write_kpis(spark, readers.read_table(spark, curated), str(tmp_path / "kpis"))
    found = result.collect()
    assert len(found) == 4 and all(r.agrees for r in found)


def test_command_line_jobs(spark, curated, tmp_path):
    from argparse import Namespace

    from cabstream.__main__ import _run_batch

    weather = str(tmp_path / "weather")
    spark.createDataFrame([], "time_slot_1h TIMESTAMP, temperature_2m DOUBLE, rain DOUBLE").write.parquet(weather)
    for job, extra in (("kpis", {}), ("features", {"weather": weather, "lag_mode": "rows"})):
        _run_batch(spark, Namespace(job=job, input=curated, output=str(tmp_path / job), zones=None, **extra))
    table = spark.read.parquet(str(tmp_path / "kpis"))
    assert rows(table.filter("kpi_name = 'total_trips'"), "value") == [(2.0,)]
    matrix = spark.read.parquet(str(tmp_path / "features"))
    assert rows(matrix.groupBy("year_month").agg(F.sum("demand_count"))) == [("2013-07", 1), ("2013-08", 1)]


def test_snapped_trajectories(spark):
    raw = spark.createDataFrame([("a", "[[-8.62,41.15],[-8.62,41.15]]"), ("a", "[[-8.62,41.15]]"), ("b", "bad")],
                                "TRIP_ID STRING, POLYLINE STRING")
    refs = spark.createDataFrame([(1, 0.0, 0.0)], "ref_id INT, lat DOUBLE, lon DOUBLE")
    out = etl.snap_trajectories(raw, refs).collect()
    assert [(r.TRIP_ID, len(json.loads(r.POLYLINE))) for r in out] == [("a", 2)]
    assert out[0].CASA_ORIGIN_ZONE_NAME is not None


@pytest.fixture(scope="module")
def matrix(spark):
    hours = spark.range(0, 6000).select(
        (F.col("id") % 3 + 1).cast("int").alias("zone_id"), F.col("id").alias("trip_id"),
        F.timestamp_seconds(F.lit(1372636800) + F.col("id") * 1900).alias("ts"))
    weather = spark.createDataFrame([], "time_slot_1h TIMESTAMP, temperature_2m DOUBLE, rain DOUBLE")
    return features.build_features(hours, zones_df(spark), weather, "dense").cache()


@pytest.fixture(scope="module")
def trained(matrix):
    return etl.train(matrix, "2013-09", depths=(2, 3), folds=2, max_iter=3)


def test_training_and_artifacts(spark, matrix, trained, tmp_path):
    model, metrics, per_zone = trained
    m = metrics.first()
    assert m.rows > 0 and m.rmse > 0 and m.mae > 0 and m.beats_baseline == (m.rmse < m.baseline_rmse)
    assert per_zone.count() == 16
    ranked = forecast.feature_importances(model, spark).collect()
    assert [r.place for r in ranked] == list(range(1, 20))
    assert sum(r.importance for r in ranked) == pytest.approx(1.0, abs=1e-6)
    forecast.save_model(model, str(tmp_path / "m"))
    loaded = forecast.load_model(str(tmp_path / "m"))
    at = F.lit("2014-01-03 10:00:00").cast("timestamp")
    want, got = (rows(forecast.forecast_zones(matrix, x, at, zones_df(spark))) for x in (model, loaded))
    assert want == got and len(got) == 16


def test_forecast_inputs_use_defaults_and_spark_weekdays(spark, matrix):
    at = F.lit("2014-01-05 10:00:00").cast("timestamp")  # a Sunday
    known = forecast.forecast_inputs(matrix.filter("zone_id = 1"), at, zones_df(spark))
    by_zone = {int(r.zone_id): r for r in known.collect()}
    assert len(by_zone) == 16
    assert (by_zone[1].day_of_week, by_zone[1].is_weekend, by_zone[1].hour_of_day) == (1.0, 1.0, 10.0)
    assert (by_zone[2].demand_lag_1d, by_zone[2].population_density, by_zone[2].temp_mild) == (10.0, 5000.0, 1.0)


def test_month_folds_keep_months_together(matrix):
    folds = matrix.select("year_month", forecast.month_fold(3).alias("f")).distinct()
    assert folds.count() == folds.select("year_month").distinct().count()
    assert {r.f for r in folds.collect()} == {0, 1, 2}


def test_forecast_vs_actual(spark):
    actual = spark.createDataFrame([(1, 10, 4), (1, 20, 2)], "zone_id INT, window_start INT, pending_requests INT")
    made = spark.createDataFrame([(1, 10, 5.5)], "zone_id INT, window_start INT, forecasted_demand DOUBLE")
    got = forecast.forecast_vs_actual(actual, made)
    assert rows(got, "window_start", "error") == [(10, 1.5), (20, None)]
    assert rows(forecast.forecast_errors(got)) == [(1, 1, 1.5, 1.5)]


def test_points_of_trajectories_are_unfolded_once(spark):
    """Spots, spots without a reference and regrouping read them; the answer stays that of the nearest reference."""
    from cabstream.plans import etl

    raw = spark.createDataFrame([("a", "[[-8.62, 41.145], [-8.60, 41.15]]"), ("b", "[[-8.62, 41.145]]")], "TRIP_ID string, POLYLINE string")
    refs = spark.createDataFrame([(1, 33.5, -7.6), (2, 10.0, 10.0)], "ref_id long, lat double, lon double")
    out = etl.snap_trajectories(raw, refs, max_km=100.0)
    assert "posexplode" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["TRIP_ID"]: r["POLYLINE"] for r in out.collect()}
    assert got == {"a": "[[-7.6,33.5],[-7.6,33.5]]", "b": "[[-7.6,33.5]]"}
