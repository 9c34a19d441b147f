"""Queries: zones, distances, trajectories."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.operators import matching, snapping, trajectory
from cabstream.plans.catalog.registry import haversine_sql, query, r6, valid_gps
from cabstream.plans.views import view
from cabstream.sources.zones import CITY_ZONES

LENGTH_SQL = ("coalesce(list_sum(list_transform(range(1, len(points)), lambda i: "
              + haversine_sql("points[i][2]", "points[i][1]", "points[i+1][2]", "points[i+1][1]")
              + ")), 0e0)")
TARGET = geo.zone_box()


def remap_sql(expr: str, lo: float, hi: float, to_lo: float, to_hi: float, clamp: bool = True) -> str:
    value = f"greatest({lo!r}::double, least({expr}, {hi!r}::double))" if clamp else expr
    return (f"({to_lo!r}::double + (({value} - ({lo!r}::double)) / ({hi - lo!r}::double))"
            f" * ({to_hi - to_lo!r}::double))")


def remap_point_sql(point: str, src: geo.Box, dst: geo.Box, clamp: bool = True) -> str:
    lon = remap_sql(f"{point}[1]", src.lon_min, src.lon_max, dst.lon_min, dst.lon_max, clamp)
    lat = remap_sql(f"{point}[2]", src.lat_min, src.lat_max, dst.lat_min, dst.lat_max, clamp)
    return f"[{lon}, {lat}]"


REMAPPED_SQL = f"list_transform(points, lambda p: {remap_point_sql('p', geo.SOURCE_BOX, TARGET)})"


@query("nearest_zone_of_pings", "select event_id, zone_id, zone_name from v_norm",
       ["v_gps", "v_zones", "v_norm"])
def _(spark, sf):
    zoned = geo.with_nearest_zone(valid_gps(spark, sf))
    return zoned.select("event_id", "zone_id", geo.zone_attribute("zone_id", "zone_name").alias("zone_name"))


@query("ping_distance_to_centroid", f"""
select g.event_id, round({haversine_sql('g.lat', 'g.lon', 'n.lat', 'n.lon')}, 6) as km
from v_gps g join v_norm n using (event_id)""", ["v_gps", "v_zones", "v_norm"])
def _(spark, sf):
    km = geo.haversine_km("lat", "lon", geo.zone_attribute("zone_id", "centroid_lat"),
                          geo.zone_attribute("zone_id", "centroid_lon"))
    zoned = geo.with_nearest_zone(valid_gps(spark, sf))
    return zoned.select("event_id", r6(km).alias("km"))


@query("trajectory_length_duration", f"""
select vec_id, round({LENGTH_SQL}, 6) as km, cast(len(points) * 15 as int) as duration_s from v_poly""",
       ["v_poly"])
def _(spark, sf):
    # Through the JSON text, as trajectories are stored.
    text = view(spark, sf, "v_poly").select("vec_id", F.to_json("points").alias("text"))
    return text.withColumn("points", geo.parse_points("text")).select(
        "vec_id", r6(geo.polyline_distance_km("points")).alias("km"),
        geo.polyline_duration_sec("points").alias("duration_s"))


@query("trajectory_points", """
select vec_id, cast(pos as int) as pos, round(points[pos+1][1], 6) as lon, round(points[pos+1][2], 6) as lat
from (select *, unnest(range(0, len(points))) as pos from v_poly) p""", ["v_poly"])
def _(spark, sf):
    points = trajectory.explode_points(view(spark, sf, "v_poly"))
    return points.select("vec_id", "pos", r6(F.get("pt", F.lit(0))).alias("lon"),
                         r6(F.get("pt", F.lit(1))).alias("lat"))


@query("trajectory_remapped", f"""
select vec_id, cast(pos as int) as pos, round(q[pos+1][1], 6) as lon, round(q[pos+1][2], 6) as lat
from (select vec_id, {REMAPPED_SQL} as q, unnest(range(0, len(points))) as pos from v_poly) p""", ["v_poly"])
def _(spark, sf):
    mapped = view(spark, sf, "v_poly").withColumn("points", geo.remap_polyline("points"))
    return trajectory.explode_points(mapped).select(
        "vec_id", "pos", r6(F.get("pt", F.lit(0))).alias("lon"), r6(F.get("pt", F.lit(1))).alias("lat"))


@query("trajectory_replay_calibration", f"""
select vec_id, round(q[1][1], 6) as start_lon, round(q[1][2], 6) as start_lat, cast(len(q) as int) as n
from (select vec_id, list_transform(points, lambda p: {remap_point_sql(
        'p', geo.REPLAY_SOURCE_BOX, geo.REPLAY_TARGET_BOX, clamp=False)}) as q
      from v_poly where len(points) > 0) p""", ["v_poly"])
def _(spark, sf):
    rows = view(spark, sf, "v_poly").filter(F.size("points") > 0)
    mapped = geo.remap_polyline("points", geo.REPLAY_SOURCE_BOX, geo.REPLAY_TARGET_BOX, clamp=False)
    start = geo.start_point("q")
    return rows.withColumn("q", mapped).select(
        "vec_id", r6(F.get(start, F.lit(0))).alias("start_lon"), r6(F.get(start, F.lit(1))).alias("start_lat"),
        F.size("q").alias("n"))


@query("trajectory_regrouped", f"""
select vec_id, cast(len(points) as int) as n, round({LENGTH_SQL}, 6) as km from v_poly where len(points) > 0""",
       ["v_poly"])
def _(spark, sf):
    points = trajectory.explode_points(view(spark, sf, "v_poly")).select(
        "vec_id", "pos", F.get("pt", F.lit(0)).alias("lon"), F.get("pt", F.lit(1)).alias("lat"))
    regrouped = trajectory.collect_polyline(points, "vec_id") \
        .withColumn("points", geo.parse_points("POLYLINE"))
    return regrouped.select("vec_id", F.size("points").alias("n"),
                            r6(geo.polyline_distance_km("points")).alias("km"))


@query("trip_ends", """
select vec_id, round(points[1][1], 6) as start_lon, round(points[1][2], 6) as start_lat,
       round(points[len(points)][1], 6) as end_lon, round(points[len(points)][2], 6) as end_lat
from v_poly""", ["v_poly"])
def _(spark, sf):
    return trajectory.with_trip_ends(view(spark, sf, "v_poly")).select(
        "vec_id", *[r6(c).alias(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")])


def _areas(end: str) -> str:
    at = "points[1]" if end == "start" else "points[len(points)]"
    return f"""
select concat(round({at}[2], 2), ',', round({at}[1], 2)) as area, count(*) as trips
from v_poly where len(points) > 0 group by 1 order by trips desc, area limit 10"""


@query("top_origin_areas", _areas("start"), ["v_poly"])
def _(spark, sf):
    rows = trajectory.with_trip_ends(view(spark, sf, "v_poly").filter(F.size("points") > 0))
    return trajectory.top_areas(rows.withColumn("area", geo.grid_cell("start_lat", "start_lon")), "area")


@query("top_destination_areas", _areas("end"), ["v_poly"])
def _(spark, sf):
    rows = trajectory.with_trip_ends(view(spark, sf, "v_poly").filter(F.size("points") > 0))
    return trajectory.top_areas(rows.withColumn("area", geo.grid_cell("end_lat", "end_lon")), "area")


SNAP_KM = haversine_sql("p.lat", "p.lon", "r.lat", "r.lon")


@query("points_snapped", f"""
with p as (select event_id, lat, lon from v_gps),
r as (select vec_id as ref_id, {remap_sql('points[1][2]', 41.1, 41.19, TARGET.lat_min, TARGET.lat_max)} as lat,
             {remap_sql('points[1][1]', -8.69, -8.55, TARGET.lon_min, TARGET.lon_max)} as lon
      from v_poly where len(points) > 0),
pairs as (select p.event_id, p.lat, p.lon, r.ref_id, r.lat as rlat, r.lon as rlon, {SNAP_KM} as km from p, r),
best as (select *, row_number() over (partition by event_id order by km, ref_id) as rn from pairs)
select event_id, round(case when km <= 0.5e0 then rlat else lat end, 6) as snapped_lat,
       round(case when km <= 0.5e0 then rlon else lon end, 6) as snapped_lon,
       case when km <= 0.5e0 then ref_id else -1 end as snapped_ref
from best where rn = 1""", ["v_gps", "v_poly"])
def _(spark, sf):
    points = view(spark, sf, "v_gps").select("event_id", "lat", "lon")
    start = geo.start_point(geo.remap_polyline("points"))
    refs = view(spark, sf, "v_poly").filter(F.size("points") > 0).select(
        F.col("vec_id").alias("ref_id"), F.get(start, F.lit(1)).alias("lat"), F.get(start, F.lit(0)).alias("lon"))
    snapped = snapping.snap_to_reference(points, refs, "event_id", "ref_id", max_km=0.5)
    return snapped.select("event_id", r6("snapped_lat").alias("snapped_lat"), r6("snapped_lon").alias("snapped_lon"),
                          F.coalesce("snapped_ref", F.lit(-1).cast("bigint")).alias("snapped_ref"))


_PINGS_SQL = """
pings as (select trip_id, cast(pos as int) as pos, epoch_s + pos * 15 as epoch_s,
  make_timestamp((epoch_s + pos * 15) * 1000000) as ts, points[pos+1][1] as lon, points[pos+1][2] as lat
  from (select *, unnest(range(0, len(points))) as pos from v_poly) p)"""


@query("trajectory_pings", f"""
with {_PINGS_SQL} select trip_id, pos, epoch_s, ts, round(lon, 6) as lon, round(lat, 6) as lat from pings""",
       ["v_poly"])
def _(spark, sf):
    pings = trajectory.explode_pings(view(spark, sf, "v_poly"), start="epoch_s")
    return pings.select("trip_id", "pos", "epoch_s", "ts", r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("ping_speeds", f"""
with {_PINGS_SQL}, near as (select *, lag(lat) over w as plat, lag(lon) over w as plon, lag(epoch_s) over w as pt
  from pings window w as (partition by trip_id order by epoch_s, pos)),
speeds as (select trip_id, pos, case when pt is null or epoch_s = pt then 0e0
  else {haversine_sql('plat', 'plon', 'lat', 'lon')} / (epoch_s - pt) * 3600 end as kmh from near)
select trip_id, pos, round(kmh, 6) as speed_kmh, case when kmh > 2 then 'MOVING' else 'IDLE' end as status
from speeds""", ["v_poly"])
def _(spark, sf):
    pings = trajectory.explode_pings(view(spark, sf, "v_poly"), start="epoch_s")
    return trajectory.ping_speed_kmh(pings).select("trip_id", "pos", r6("speed_kmh").alias("speed_kmh"), "status")


@query("trajectory_segments", f"""
select vec_id, cast(s - 1 as int) as segment, round({haversine_sql(
    'points[s][2]', 'points[s][1]', 'points[s+1][2]', 'points[s+1][1]')}, 6) as segment_km
from (select *, unnest(range(1, len(points))) as s from v_poly) p""", ["v_poly"])
def _(spark, sf):
    return trajectory.segment_lengths(view(spark, sf, "v_poly")).select(
        "vec_id", "segment", r6("segment_km").alias("segment_km"))


@query("corridor_eta", f"""
with od as (select origin_zone, destination_zone, count(*) as trip_count from v_requests
            where origin_zone > 0 group by all),
d as (select od.*, {haversine_sql('o.centroid_lat', 'o.centroid_lon', 't.centroid_lat', 't.centroid_lon')} as d_km
  from od join v_zones o on o.zone_id = od.origin_zone join v_zones t on t.zone_id = od.destination_zone)
select origin_zone, destination_zone, trip_count, round(d_km, 6) as km,
       cast(floor(d_km / 25e0 * 3600 + 0.5e0) as int) as eta_seconds from d""", ["v_requests", "v_zones"])
def _(spark, sf):
    corridors = view(spark, sf, "v_requests").filter("origin_zone > 0") \
        .groupBy("origin_zone", "destination_zone").agg(F.count(F.lit(1)).alias("trip_count"))
    return matching.corridor_eta(corridors, CITY_ZONES).withColumn("km", r6("km"))


@query("remap_length_distribution", f"""
with both_ends as (
  select 'before' as stage, points from v_poly
  union all select 'after', {REMAPPED_SQL} from v_poly),
lengths as (select stage, cast(round({LENGTH_SQL} * 1000) as bigint) as metres from both_ends)
select stage, cast(count(*) as bigint) as trips, min(metres) as min_m, max(metres) as max_m,
       round(sum(metres) / count(*), 6) as mean_m, round(quantile_cont(metres, 0.25), 6) as p25_m,
       round(quantile_cont(metres, 0.5), 6) as p50_m, round(quantile_cont(metres, 0.75), 6) as p75_m
from lengths group by stage""", ["v_poly"])
def _(spark, sf):
    rows = view(spark, sf, "v_poly")
    dist = trajectory.length_distribution(rows, geo.polyline_distance_km("points"),
                                          geo.polyline_distance_km(geo.remap_polyline("points")))
    return dist.withColumns({c: r6(c) for c in ("mean_m", "p25_m", "p50_m", "p75_m")})
