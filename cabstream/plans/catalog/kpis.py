"""Queries: KPIs, profiling, data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.operators import kpi, profile, quality, serving
from cabstream.plans.catalog.registry import ZONED_TRIPS_SQL, query, r6, trips_with_zone
from cabstream.plans.views import view

ZONED = f"with {ZONED_TRIPS_SQL}"
ZV = ["v_trips", "v_zones"]
HOUR = "cast(hour(ts) as int)"
ISO_WEEK = "concat(cast(isoyear(ts) as varchar), '-W', lpad(cast(week(ts) as varchar), 2, '0'))"
DOW = "cast((isodow(ts) - 1) as int)"


@query("trips_per_zone", f"{ZONED} select zone_id, zone_name, count(*) as trip_count from zoned group by all", ZV)
def _(spark, sf):
    return kpi.trips_per_zone(trips_with_zone(spark, sf))


@query("avg_duration_per_zone", f"""{ZONED} select zone_id, zone_name, round(avg(trip_duration_sec), 6)
  as avg_duration_sec from zoned group by all""", ZV)
def _(spark, sf):
    return kpi.avg_duration_per_zone(trips_with_zone(spark, sf)) \
        .withColumn("avg_duration_sec", r6("avg_duration_sec"))


@query("peak_demand_hours", f"""select {HOUR} as hour_of_day, count(*) as trip_count,
  concat(lpad(cast(hour(ts) as varchar), 2, '0'), ':00') as hour_label from v_trips group by all""", ["v_trips"])
def _(spark, sf):
    return kpi.peak_demand_hours(view(spark, sf, "v_trips"))


@query("coverage_gap", f"""{ZONED}, s as (select zone_id, zone_name, count(*) as trip_count,
    count(distinct taxi_id) as unique_taxis from zoned group by all),
  r as (select *, round(trip_count / greatest(unique_taxis, 1), 1) as trips_per_taxi from s)
select *, case when trips_per_taxi > 100 then 'underserved' when unique_taxis < 5 then 'critical'
  else 'adequate' end as coverage_gap from r""", ZV)
def _(spark, sf):
    return kpi.coverage_gap(trips_with_zone(spark, sf))


@query("uncovered_zones", """
select zone_id, dest_zone, count(*) as demand, count(distinct taxi_id) as vehicles from v_trips
group by all having count(*) > 100 and count(distinct taxi_id) < 7""", ["v_trips"])
def _(spark, sf):
    corridors = ("zone_id", "dest_zone")
    return kpi.uncovered_zones(view(spark, sf, "v_trips"), corridors, demand_above=100, vehicles_below=7)


@query("trip_type_distribution", """
select call_type, count(*) as trip_count, case call_type when 'A' then 'Central dispatch'
  when 'B' then 'Taxi stand' when 'C' then 'Street hail' end as type_label from v_trips group by all""", ["v_trips"])
def _(spark, sf):
    return kpi.trip_type_distribution(view(spark, sf, "v_trips"))


@query("trip_type_share", """
select call_type, count(*) as trip_count, round(count(*) / sum(count(*)) over () * 100, 2) as percentage
from v_trips group by call_type""", ["v_trips"])
def _(spark, sf):
    return kpi.trip_type_share(view(spark, sf, "v_trips"))


@query("weekly_trends", f"select {ISO_WEEK} as year_week, count(*) as trip_count from v_trips group by 1", ["v_trips"])
def _(spark, sf):
    return kpi.weekly_trends(view(spark, sf, "v_trips"))


@query("weekly_trends_calendar_label", """
with d as (select year(ts) as y, dayofweek(make_date(year(ts), 1, 1)) as j1,
  dayofyear(ts) as doy, dayofweek(make_date(year(ts) + 1, 1, 1)) as j2,
  date_diff('day', cast(ts as date), make_date(year(ts) + 1, 1, 1)) as to_next from v_trips)
select concat(cast(y as varchar), '-W', lpad(cast(case when to_next <= j2 then 1
  else (doy - 1 + j1) // 7 + 1 end as varchar), 2, '0')) as year_week, count(*) as trip_count
from d group by 1""", ["v_trips"])
def _(spark, sf):
    return kpi.weekly_trends(view(spark, sf, "v_trips"), calendar_label=True)


@query("week_over_week", f"""
with w as (select {ISO_WEEK} as year_week, count(*) as trip_count from v_trips group by 1)
select year_week, trip_count, coalesce(lag(trip_count) over (order by year_week), 0) as previous_count,
  coalesce(trip_count - lag(trip_count) over (order by year_week), 0) as change from w""", ["v_trips"])
def _(spark, sf):
    return kpi.week_over_week(kpi.weekly_trends(view(spark, sf, "v_trips")))


@query("zone_hour_month_demand", f"""
select zone_id, {HOUR} as hour_of_day, strftime(ts, '%Y-%m') as month, count(*) as trip_count,
  avg(fare_cents) as avg_fare, avg(trip_distance_m) as avg_distance, avg(passenger_count) as avg_passenger_count
from v_trips group by all""", ["v_trips"])
def _(spark, sf):
    return kpi.zone_hour_month_demand(view(spark, sf, "v_trips"), "zone_id", "ts", "fare_cents",
                                      "trip_distance_m", "passenger_count")


@query("od_matrix", "select zone_id, dest_zone, count(*) as trip_count from v_trips group by all", ["v_trips"])
def _(spark, sf):
    return kpi.od_matrix(view(spark, sf, "v_trips"), "zone_id", "dest_zone")


@query("demand_curve", f"""
with h as (select {HOUR} as hour_of_day, count(*) as trip_count,
  count(*) filter (where isodow(ts) = 5) as friday_count from v_trips group by 1)
select hour_of_day, trip_count, round(trip_count / avg(trip_count) over (), 6) as multiplier,
  round(coalesce((friday_count / nullif(sum(friday_count) over (), 0))
    / (trip_count / sum(trip_count) over ()), 0), 6) as friday_factor from h""", ["v_trips"])
def _(spark, sf):
    return kpi.demand_curve(view(spark, sf, "v_trips")) \
        .withColumns({c: r6(c) for c in ("multiplier", "friday_factor")})


KPI_SQL = f"""{ZONED}, gaps as (select zone_id, zone_name,
    round(count(*) / greatest(count(distinct taxi_id), 1), 1) as per_taxi, count(distinct taxi_id) as taxis
    from zoned group by all),
kpis as (
select 'trips_per_zone' as kpi_name, cast(zone_id as varchar) as category, '' as subcategory,
  zone_name as label, cast(count(*) as double) as value from zoned group by zone_id, zone_name
union all select 'avg_duration_per_zone', cast(zone_id as varchar), '', zone_name,
  round(sum(trip_duration_sec) / count(*), 6) from zoned group by zone_id, zone_name
union all select 'peak_demand_hours', concat(lpad(cast(hour(ts) as varchar), 2, '0'), ':00'), '',
  concat('Hour ', cast(hour(ts) as varchar)), count(*) from zoned group by hour(ts)
union all select 'coverage_gap', cast(zone_id as varchar), case when per_taxi > 100 then 'underserved'
  when taxis < 5 then 'critical' else 'adequate' end, zone_name, per_taxi from gaps
union all select 'trip_type_distribution', call_type, '', case call_type when 'A' then 'Central dispatch'
  when 'B' then 'Taxi stand' else 'Street hail' end, count(*) from zoned group by call_type
union all select 'weekly_trends', {ISO_WEEK}, '', {ISO_WEEK}, count(*) from zoned group by {ISO_WEEK}
union all select 'total_trips', 'total', '', 'Total trips', count(*) from zoned
union all select 'avg_duration_overall', 'overall', '', 'Average duration',
  round(sum(trip_duration_sec) / count(*), 6) from zoned)"""


def kpi_rows(spark, sf):
    return kpi.kpi_table(trips_with_zone(spark, sf)).withColumn("value", r6("value"))


@query("kpi_table", f"{KPI_SQL} select * from kpis", ZV)
def _(spark, sf):
    return kpi_rows(spark, sf)


@query("kpi_headlines", f"""{KPI_SQL}, placed as (select *, row_number() over (partition by kpi_name
  order by value desc, category) as place from kpis where kpi_name in ('peak_demand_hours', 'trips_per_zone'))
select case kpi_name when 'peak_demand_hours' then 'peak_hour_top' else 'top_zone' end as kpi_name, category,
  subcategory, label, value from placed
where (kpi_name = 'peak_demand_hours' and place = 1) or (kpi_name = 'trips_per_zone' and place <= 3)""", ZV)
def _(spark, sf):
    return kpi.headline_rows(kpi_rows(spark, sf))


@query("kpi_lookup", f"{KPI_SQL} select label, value, category from kpis where kpi_name in ('trips_per_zone', 'total_trips')",
       ZV)
def _(spark, sf):
    return serving.kpi_lookup(kpi_rows(spark, sf), ["trips_per_zone", "total_trips"]) \
        .select("label", "value", "category")


@query("kpi_reconciliation", f"""{KPI_SQL} select kpi_name, sum(value) as kpi_sum,
  (select count(*) from v_trips)::double as total_trips, sum(value) = (select count(*) from v_trips) as agrees
from kpis where kpi_name in ('trips_per_zone', 'peak_demand_hours', 'trip_type_distribution', 'weekly_trends')
group by kpi_name""", ZV)
def _(spark, sf):
    return quality.reconcile_kpis(kpi_rows(spark, sf))


@query("busiest_zones", f"""{ZONED} select zone_id, zone_name, count(*) as trip_count from zoned group by all
order by trip_count desc, zone_id limit 10""", ZV)
def _(spark, sf):
    return kpi.top_k(kpi.trips_per_zone(trips_with_zone(spark, sf)), "trip_count", 10, "zone_id")


_PROFILED = ["taxi_id", "call_type", "zone_id", "passenger_count", "trip_duration_sec", "missing_kind"]


@query("column_profile", "with p as (select *, case when missing_data then null else call_type end as missing_kind from v_trips) "
       + " union all ".join(
           f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
           f"count(distinct {c}) as n_unique from p" for c in _PROFILED), ["v_trips"])
def _(spark, sf):
    trips = view(spark, sf, "v_trips").withColumn("missing_kind", F.when(~F.col("missing_data"), F.col("call_type")))
    return profile.profile_columns(trips.select(*_PROFILED))


@query("missing_rate", """select count(*) as rows,
  round(count(*) filter (where missing_data) / count(*) * 100, 6) as missing_data_pct from v_trips""", ["v_trips"])
def _(spark, sf):
    return profile.missing_rate(view(spark, sf, "v_trips")).withColumn("missing_data_pct", r6("missing_data_pct"))


@query("trips_per_taxi_summary", """with t as (select taxi_id, count(*) as n from v_trips group by 1)
select count(*) as taxis, round(avg(n), 6) as mean_trips, round(stddev_samp(n), 6) as stddev_trips,
  min(n) as min_trips, max(n) as max_trips from t""", ["v_trips"])
def _(spark, sf):
    return profile.trips_per_taxi_summary(view(spark, sf, "v_trips")) \
        .withColumns({c: r6(c) for c in ("mean_trips", "stddev_trips")})


@query("calendar_distribution", f"""select {HOUR} as hour, {DOW} as dow, count(*) as trips,
  isodow(ts) in (6, 7) as is_weekend from v_trips group by all""", ["v_trips"])
def _(spark, sf):
    return profile.calendar_distribution(view(spark, sf, "v_trips"))


@query("active_taxis_per_hour", f"select {HOUR} as hour, count(distinct taxi_id) as active_taxis from v_trips group by 1",
       ["v_trips"])
def _(spark, sf):
    return profile.active_taxis_per_hour(view(spark, sf, "v_trips"))


_SLICES = """count(*) as rows, count(*) filter (where isodow(ts) = 5) as friday_trips,
  count(*) filter (where isodow(ts) = 5 and hour(ts) between 12 and 14) as friday_12_14_trips,
  count(*) filter (where hour(ts) between 12 and 14) as all_12_14_trips,
  count(*) filter (where hour(ts) between 7 and 9) as morning_peak_07_09_trips,
  count(*) filter (where hour(ts) between 17 and 19) as evening_peak_17_19_trips"""
_SHARES = ("round(coalesce(friday_12_14_trips / nullif(friday_trips, 0) * 100, 0), 6) as friday_12_14_share_pct, "
           "round(all_12_14_trips / rows * 100, 6) as {0}")


@query("time_slice_shares", f"with s as (select {_SLICES} from v_trips) select *, "
       + _SHARES.format("all_12_14_share_pct") + " from s", ["v_trips"])
def _(spark, sf):
    return profile.time_slice_shares(view(spark, sf, "v_trips")) \
        .withColumns({c: r6(c) for c in ("friday_12_14_share_pct", "all_12_14_share_pct")})


@query("duration_bounds", """select round(quantile_cont(trip_duration_sec, 0.01), 6) as low,
  round(quantile_cont(trip_duration_sec, 0.99), 6) as high from v_trips""", ["v_trips"])
def _(spark, sf):
    return profile.duration_bounds(view(spark, sf, "v_trips")).select(r6("low").alias("low"), r6("high").alias("high"))


@query("duration_histogram", """
with b as (select quantile_cont(trip_duration_sec, 0.01) as lo, quantile_cont(trip_duration_sec, 0.99) as hi from v_trips),
t as (select trip_duration_sec as d, lo, (hi - lo) / 20 as w from v_trips, b where trip_duration_sec between lo and hi),
n as (select cast(least(floor((d - lo) / w), 19) as int) as bin, lo, w from t)
select bin, round(lo + bin * w, 6) as from_value, cast(count(*) as bigint) as trips from n group by bin, lo, w""", ["v_trips"])
def _(spark, sf):
    return profile.clipped_histogram(view(spark, sf, "v_trips")).withColumn("from_value", r6("from_value"))


@query("dataset_summary", f"""with s as (select {_SLICES}, count(distinct taxi_id) as unique_taxis,
    avg(trip_duration_sec) as d, avg(trip_distance_m) as k, count(*) filter (where missing_data) as m from v_trips)
select rows, unique_taxis, round(d, 6) as avg_duration_seconds, round(k, 6) as avg_distance,
  round(m / rows * 100, 6) as missing_data_pct,
  (select {HOUR} from v_trips group by 1 order by count(*) desc, 1 limit 1) as peak_hour,
  (select call_type from v_trips group by 1 order by count(*) desc, 1 limit 1) as top_call_type,
  morning_peak_07_09_trips, evening_peak_17_19_trips, {_SHARES.format('all_data_12_14_share_pct')},
  (select concat('area ', zone_id) from v_trips group by 1 order by count(*) desc, 1 limit 1) as top_origin_area,
  (select concat('area ', dest_zone) from v_trips group by 1 order by count(*) desc, 1 limit 1) as top_destination_area
from s""", ["v_trips"])
def _(spark, sf):
    trips = view(spark, sf, "v_trips").withColumns({
        "origin_area": F.concat(F.lit("area "), F.col("zone_id").cast("string")),
        "dest_area": F.concat(F.lit("area "), F.col("dest_zone").cast("string"))})
    rounded = ("avg_duration_seconds", "avg_distance", "missing_data_pct", "friday_12_14_share_pct",
               "all_data_12_14_share_pct")
    return profile.dataset_summary(trips, distance="trip_distance_m").withColumns({c: r6(c) for c in rounded})


@query("quality_report", f"""{ZONED}, m as (select count(*)::double as rows,
  (count(*) - count(distinct trip_id))::double as duplicate_trip_ids, min(trip_duration_sec)::double as min_duration,
  max(trip_duration_sec)::double as max_duration, round(avg(trip_duration_sec), 6) as mean_duration,
  min(trip_distance_m)::double as min_distance, max(trip_distance_m)::double as max_distance,
  round(avg(trip_distance_m), 6) as mean_distance, count(distinct strftime(ts, '%Y-%m'))::double as months,
  count(distinct zone_name)::double as zones from zoned)
unpivot m on columns(*) into name metric value value""", ZV)
def _(spark, sf):
    trips = trips_with_zone(spark, sf).withColumn("year_month", F.date_format("ts", "yyyy-MM"))
    return quality.quality_report(trips).withColumn("value", r6("value"))


@query("stage_accounting", """
with raw as (select label as trip_id, points, epoch_s, len(points) > 25 as missing from v_poly),
clean as (select * from raw where not missing and len(points) > 0),
one as (select trip_id, min(len(points)) as n from clean group by 1)
select 'raw_rows' as stage, count(*)::double as value from raw
union all select 'raw_ids', count(distinct trip_id) from raw union all select 'clean_rows', count(*) from clean
union all select 'dedup_rows', count(*) from one union all select 'exploded_rows', sum(n) from one
union all select 'regrouped_rows', count(*) from one
union all select 'null_times', count(*) filter (where epoch_s is null) from clean""", ["v_poly"])
def _(spark, sf):
    trips = view(spark, sf, "v_poly").withColumn("trip_id", F.col("label")) \
        .withColumn("missing_data", F.size("points") > 25)
    return quality.stage_accounting(trips)
