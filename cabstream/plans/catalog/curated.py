"""Queries: the curated-trip job and trajectory snapping, end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.plans import etl
from cabstream.plans.catalog.geospatial import LENGTH_SQL, REMAPPED_SQL, TARGET, remap_sql
from cabstream.plans.catalog.registry import haversine_sql, query, r6
from cabstream.plans.views import view


def raw_trips(spark, sf):
    """Trajectories in the historical layout: every trip twice, flagged and empty trips among them."""
    rows = view(spark, sf, "v_poly")
    twice = rows.unionByName(rows.withColumn("epoch_s", F.col("epoch_s") + 60))
    return twice.select(
        F.col("vec_id").cast("string").alias("TRIP_ID"), F.lit("A").alias("CALL_TYPE"),
        F.lit(None).cast("int").alias("ORIGIN_CALL"), F.lit(None).cast("int").alias("ORIGIN_STAND"),
        F.col("label").alias("TAXI_ID"), F.col("epoch_s").alias("TIMESTAMP"), F.lit("A").alias("DAY_TYPE"),
        (F.col("label") == 0).alias("MISSING_DATA"), F.to_json("points").alias("POLYLINE"))


@query("curated_trips", f"""
with one as (select * from v_poly where label <> 0 and len(points) > 0),
m as (select *, {LENGTH_SQL} as km, {REMAPPED_SQL} as mapped, make_timestamp(epoch_s * 1000000) as ts from one),
z as (select m.*, v_zones.zone_id, zone_name, zone_type, row_number() over (partition by vec_id order by
    (mapped[1][2] - centroid_lat)*(mapped[1][2] - centroid_lat) + (mapped[1][1] - centroid_lon)*(mapped[1][1] - centroid_lon),
    v_zones.zone_id) as near from m, v_zones)
select cast(vec_id as varchar) as TRIP_ID, epoch_s as TIMESTAMP, cast(hour(ts) as int) as hour_of_day,
  cast(dayofweek(ts) + 1 as int) as day_of_week, strftime(ts, '%Y-%m') as year_month, round(km, 6) as trip_distance_km,
  cast(len(points) * 15 as int) as trip_duration_sec, cast(len(mapped) as int) as n_points,
  zone_id as CASA_ORIGIN_ZONE, zone_name as CASA_ORIGIN_ZONE_NAME, zone_type as CASA_ORIGIN_ZONE_TYPE
from z where near = 1""", ["v_poly", "v_zones"])
def _(spark, sf):
    curated = etl.curate_trips(raw_trips(spark, sf))
    return curated.select(
        "TRIP_ID", "TIMESTAMP", "hour_of_day", "day_of_week", "year_month",
        r6("trip_distance_km").alias("trip_distance_km"), "trip_duration_sec",
        F.size(geo.parse_points("POLYLINE")).alias("n_points"), "CASA_ORIGIN_ZONE",
        "CASA_ORIGIN_ZONE_NAME", "CASA_ORIGIN_ZONE_TYPE")


def _spot(point: str, box: geo.Box = geo.SOURCE_BOX) -> tuple[str, str]:
    lat = remap_sql(f"{point}[2]", box.lat_min, box.lat_max, TARGET.lat_min, TARGET.lat_max)
    lon = remap_sql(f"{point}[1]", box.lon_min, box.lon_max, TARGET.lon_min, TARGET.lon_max)
    return lat, lon


@query("trajectories_snapped", f"""
with refs as (select vec_id as ref_id, {_spot('points[1]')[0]} as lat, {_spot('points[1]')[1]} as lon
  from v_poly where len(points) > 0),
pts as (select vec_id, pos, round({_spot('points[pos]')[0]}, 6) as lat, round({_spot('points[pos]')[1]}, 6) as lon
  from (select *, unnest(range(1, len(points) + 1)) as pos from v_poly) p),
spots as (select distinct lat, lon from pts),
pairs as (select s.lat, s.lon, r.ref_id, r.lat as rlat, r.lon as rlon,
  {haversine_sql('s.lat', 's.lon', 'r.lat', 'r.lon')} as km from spots s, refs r),
near as (select *, row_number() over (partition by lat, lon order by km, ref_id) as rn from pairs),
moved as (select p.vec_id, pos, case when km <= 0.5e0 then rlat else p.lat end as lat,
  case when km <= 0.5e0 then rlon else p.lon end as lon
  from pts p join near n on n.lat = p.lat and n.lon = p.lon and n.rn = 1)
select cast(vec_id as varchar) as TRIP_ID, cast(count(*) as int) as n_points, round(sum(lat), 4) as lat_sum,
  round(sum(lon), 4) as lon_sum from moved group by 1""", ["v_poly"])
def _(spark, sf):
    rows = view(spark, sf, "v_poly").select(F.col("vec_id").cast("string").alias("TRIP_ID"), "label",
                                            F.to_json("points").alias("POLYLINE"))
    start = geo.start_point(geo.remap_polyline("points"))
    refs = view(spark, sf, "v_poly").filter(F.size("points") > 0).select(
        F.col("vec_id").alias("ref_id"), F.get(start, F.lit(1)).alias("lat"), F.get(start, F.lit(0)).alias("lon"))
    snapped = etl.snap_trajectories(rows, refs).withColumn("p", geo.parse_points("POLYLINE"))

    def total(i: int):
        values = F.transform("p", lambda x: F.get(x, F.lit(i)))
        return F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 4)

    return snapped.select("TRIP_ID", F.size("p").alias("n_points"), total(1).alias("lat_sum"),
                          total(0).alias("lon_sum"))
