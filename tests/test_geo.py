import json
import math

import pytest
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.operators import snapping, trajectory
from cabstream.sources import zones as Z


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6371 * math.asin(math.sqrt(min(1, max(0, h))))


def test_haversine(spark):
    pts = [(33.5, -7.6, 33.6, -7.5), (0.0, 0.0, 0.0, 180.0), (41.1, -8.6, 41.1, -8.6), (90.0, 0.0, -90.0, 0.0)]
    df = spark.createDataFrame(pts, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    got = [r[0] for r in df.select(geo.haversine_km("a", "b", "c", "d")).collect()]
    assert got == pytest.approx([haversine(*p) for p in pts], abs=1e-9)


def test_nearest_zone_ties_and_missing(spark):
    twin = [Z.Zone(7, "a", "x", 1, 1.0, 0.0, ()), Z.Zone(9, "b", "x", 1, -1.0, 0.0, ())]
    df = spark.createDataFrame([(0.0, 0.0), (-0.1, 0.0), (0.1, 5.0), (None, 1.0)], "lat DOUBLE, lon DOUBLE")
    def ids(zones):
        return [r.zone_id for r in geo.with_nearest_zone(df, "lat", "lon", zones).collect()]

    assert ids(twin) == [7, 9, 7, 0]
    assert ids(twin[:1]) == [7, 7, 7, 0]
    far = [Z.Zone(100 + i, "f", "x", 1, 80.0, i / 10, ()) for i in range(40)]
    assert ids(twin + far) == [7, 9, 7, 0]
    with pytest.raises(ValueError):
        ids([])


def test_zone_names_with_quotes(spark):
    got = spark.range(1).select(geo.zone_attribute(F.lit(13), "zone_name")).first()[0]
    assert got == "Ben M'Sick"


@pytest.mark.parametrize("points, km, seconds", [
    (None, 0.0, 0), ([], 0.0, 0), ([[-8.6, 41.1]], 0.0, 15),
    ([[-8.6, 41.1], [-8.61, 41.1], [-8.61, 41.12]], None, 45)])
def test_polyline_measures(spark, points, km, seconds):
    df = spark.createDataFrame([(points,)], "p ARRAY<ARRAY<DOUBLE>>")
    got = df.select(geo.polyline_distance_km("p"), geo.polyline_duration_sec("p")).first()
    want = km if km is not None else sum(
        haversine(a[1], a[0], b[1], b[0]) for a, b in zip(points, points[1:], strict=False))
    assert got[0] == pytest.approx(want, abs=1e-9) and got[1] == seconds


def test_remap_clamps(spark):
    df = spark.createDataFrame([(-9.0,), (-8.69,), (-8.62,), (-8.55,), (0.0,)], "x DOUBLE")
    got = [r[0] for r in df.select(geo.remap_linear("x", -8.69, -8.55, 0.0, 14.0)).collect()]
    assert got == pytest.approx([0, 0, 7, 14, 14])
    free = [r[0] for r in df.select(geo.remap_linear("x", -8.69, -8.55, 0.0, 14.0, clamp=False)).collect()]
    assert free[0] == pytest.approx(-31) and free[-1] == pytest.approx(869)


def test_eta_rounds_half_up(spark):
    df = spark.createDataFrame([(0.0,), (25.0,), (25.0 / 3600 * 1.5,), (25.0 / 3600 * 1.49,)], "km DOUBLE")
    assert [r[0] for r in df.select(geo.eta_seconds("km")).collect()] == [0, 3600, 2, 1]


def test_regroup_keeps_order(spark):
    pts = [(1, i, float(i), float(-i)) for i in range(12)]
    df = spark.createDataFrame(pts, "trip_id INT, pos INT, lon DOUBLE, lat DOUBLE").repartition(5)
    got = json.loads(trajectory.collect_polyline(df).first().POLYLINE)
    assert got == [[float(i), float(-i)] for i in range(12)]


def test_ping_speed_and_status(spark):
    df = spark.createDataFrame([("t", 0, 0, 33.5, -7.6), ("t", 15, 1, 33.51, -7.6), ("t", 15, 2, 33.6, -7.6)],
                               "trip_id STRING, epoch_s LONG, pos INT, lat DOUBLE, lon DOUBLE")
    out = {r.pos: r for r in trajectory.ping_speed_kmh(df).collect()}
    assert (out[0].speed_kmh, out[0].status) == (0.0, "IDLE")
    assert out[1].speed_kmh == pytest.approx(haversine(33.5, -7.6, 33.51, -7.6) / 15 * 3600)
    assert out[1].status == "MOVING" and out[2].speed_kmh == 0.0


@pytest.mark.parametrize("levels", [1, 3, None])
def test_snapping_equals_brute_force(spark, levels):
    import random

    rnd = random.Random(5)
    # A third of the references crowd one cell.
    refs = [(i, 33.5 + rnd.random() * 0.1, -7.6 + rnd.random() * 0.1) for i in range(60)]
    refs += [(100 + i, 33.55 + rnd.random() * 0.001, -7.55 + rnd.random() * 0.001) for i in range(30)]
    pts = [(i, 33.48 + rnd.random() * 0.14, -7.62 + rnd.random() * 0.14) for i in range(200)]
    p = spark.createDataFrame(pts, "pid INT, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame(refs, "rid INT, lat DOUBLE, lon DOUBLE")
    got = {x.pid: x.snapped_ref for x in
           snapping.snap_to_reference(p, r, "pid", "rid", 0.7, levels=levels).collect()}
    for pid, lat, lon in pts:
        km, ref = min((haversine(lat, lon, b, c), a) for a, b, c in refs)
        assert got[pid] == (ref if km <= 0.7 else None)


def test_a_reference_near_by_hides_none_that_is_nearer(spark):
    """References about as far apart as max_km: what a narrow cell finds first may be too far, another not."""
    import random

    rnd = random.Random(12)
    refs = [(i, 33.5 + rnd.random() * 0.05, -7.6 + rnd.random() * 0.05) for i in range(110)]
    pts = [(i, 33.5 + rnd.random() * 0.05, -7.6 + rnd.random() * 0.05) for i in range(600)]
    p = spark.createDataFrame(pts, "pid INT, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame(refs, "rid INT, lat DOUBLE, lon DOUBLE")
    for levels in (2, 4):
        got = {x.pid: x.snapped_ref for x in snapping.snap_to_reference(p, r, "pid", "rid", 0.5, levels=levels).collect()}
        for pid, lat, lon in pts:
            km, ref = min((haversine(lat, lon, b, c), a) for a, b, c in refs)
            assert got[pid] == (ref if km <= 0.5 else None)


def test_a_look_computes_the_cell_of_one_level_a_row(spark):
    p = spark.createDataFrame([(1, 33.5, -7.6)], "pid INT, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame([(1, 33.5, -7.6)], "rid INT, lat DOUBLE, lon DOUBLE")

    def angles(levels):
        snapped = snapping.snap_to_reference(p, r, "pid", "rid", 0.5, levels=levels)
        return snapped._jdf.queryExecution().optimizedPlan().toString().upper().count("ASIN(")

    assert angles(2) == angles(9)


def test_the_reference_index_is_made_by_several_tasks(spark):
    r = spark.range(2000).selectExpr("id rid", "33.5 + id * 1e-5 lat", "-7.6 + id * 1e-5 lon")
    assert len(snapping.reference_index(r, "rid", 0.5, 3).inputFiles()) > 1


def test_points_meet_few_references_however_dense_they_are(spark):
    import random

    rnd = random.Random(8)
    refs = [(i, 33.5 + rnd.random() * 0.002, -7.6 + rnd.random() * 0.002) for i in range(4000)]
    refs += [(9000 + i, 33.6, -7.5) for i in range(500)]  # one place
    pts = [(i, 33.499 + rnd.random() * 0.004, -7.601 + rnd.random() * 0.004) for i in range(100)] + [(500, 33.6, -7.5), (501, None, 1.0)]
    p = spark.createDataFrame(pts, "pid INT, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame(refs, "rid INT, lat DOUBLE, lon DOUBLE")
    levels = snapping.cell_levels(r.filter("rid < 9000"), 0.5)
    assert 5 < levels < 12
    index = snapping.reference_index(r, "rid", 0.5, levels)
    assert index.filter(f"level = {levels - 1}").groupBy("cell_lat", "cell_lon").count().agg(F.max("count")).first()[0] <= 9 * 8
    got = {x.pid: x.snapped_ref for x in snapping.snap_to_reference(p, r, "pid", "rid", 0.5).collect()}
    for pid, lat, lon in pts[:-1]:
        km, ref = min((haversine(lat, lon, b, c), a) for a, b, c in refs)
        assert got[pid] == (ref if km <= 0.5 else None)
    assert got[500] == 9000 and got[501] is None


def test_zone_loader(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("zone_id,zone_name,zone_type,population_density,centroid_lat,centroid_lon,adjacency_list\n"
                    '1,Anfa,commercial,8000,33.593,-7.632,"[2, 3, 9]"\n2,Solo,residential,5,33.5,-7.5,\n')
    loaded = Z.zone_list(Z.load_zones(spark, str(path)))
    assert loaded[0] == Z.CITY_ZONES[0] and loaded[1].adjacency == ()
    edges = {tuple(r) for r in Z.zone_edges(Z.zones_df(spark, loaded)).collect()}
    assert edges == {(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 9), (2, 0, 2)}


def test_nearest_in_a_table_of_any_size(spark):
    import random

    rnd = random.Random(3)
    zones = [(i, rnd.uniform(-50, 50), rnd.uniform(-80, 80)) for i in range(1500)]
    zones += [(5000 + i, 10 + rnd.random() / 1e3, 10 + rnd.random() / 1e3) for i in range(3500)]
    zones.append((9999, *zones[7][1:]))  # the smaller id wins
    spots = [(i, rnd.uniform(-60, 60), rnd.uniform(-90, 90)) for i in range(60)]
    spots += [(100 + i, 10 + rnd.random() / 1e3, 10 + rnd.random() / 1e3) for i in range(20)]
    spots += [(200, *zones[7][1:]), (201, None, 1.0), (202, 1.0, None)]
    got = snapping.nearest_in_table(spark.createDataFrame(spots, "pid INT, lat DOUBLE, lon DOUBLE"),
                                    spark.createDataFrame(zones, "zone_id INT, lat DOUBLE, lon DOUBLE"), "zone_id")
    found = {r.pid: r.zone_id for r in got.collect()}
    for pid, lat, lon in spots:
        near = None if None in (lat, lon) else min(((lat - y) ** 2 + (lon - x) ** 2, z) for z, y, x in zones)[1]
        assert found[pid] == near
    empty = spark.createDataFrame([], "zone_id INT, lat DOUBLE, lon DOUBLE")
    assert snapping.nearest_in_table(got.drop("zone_id"), empty, "zone_id").filter("zone_id is not null").count() == 0


def test_snapping_anywhere_on_the_globe(spark):
    import random

    rnd = random.Random(6)
    centres = [(75.0, 20.0), (-75.0, 179.9995), (0.0, -180.0), (89.999, 0.0), (-89.999, 90.0), (60.0, 180.0)]
    spots = [(i, max(-90.0, min(90.0, y + rnd.uniform(-1, 1) / 90)), (x + rnd.uniform(-1, 1) / 40 + 540) % 360 - 180)
             for i, (y, x) in enumerate(centres * 25)]
    refs = [(i, y, x) for i, y, x in spots[:75]]
    refs += [(1000, 89.9995, 180.0), (1001, -89.9995, -90.0)]  # across the poles
    p = spark.createDataFrame(spots[75:], "pid INT, lat DOUBLE, lon DOUBLE")
    r = spark.createDataFrame(refs, "rid INT, lat DOUBLE, lon DOUBLE")
    got = {x.pid: x.snapped_ref for x in snapping.snap_to_reference(p, r, "pid", "rid", 0.5).collect()}
    hits = 0
    for pid, lat, lon in spots[75:]:
        km, ref = min((haversine(lat, lon, b, c), a) for a, b, c in refs)
        assert got[pid] == (ref if km <= 0.5 else None)
        hits += km <= 0.5
    assert hits > 20
