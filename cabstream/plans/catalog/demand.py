"""Queries: demand windows, spikes, lateness, blackouts, thinning."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.operators import demand, events, kpi, serving, thinning
from cabstream.plans.catalog.registry import FREE, normalized_gps, query, r6, valid_requests
from cabstream.plans.views import view

GPS_VIEWS = ["v_gps", "v_requests", "v_zones", "v_norm"]


def window_ctes(source: str = "v_norm", requests: str = "v_requests where origin_zone > 0") -> str:
    return f"""ev as (
  select zone_id, ts, case when {FREE} then taxi_id end as taxi, 0 as req from {source}
  union all select origin_zone, ts, null, 1 from {requests}),
win as (select zone_id, time_bucket(interval 30 seconds, ts) as window_start,
  cast(count(distinct taxi) as int) as active_vehicles, cast(sum(req) as int) as pending_requests
  from ev group by all),
dw as (select 'casablanca' as city, zone_id, window_start, active_vehicles, pending_requests,
  pending_requests / greatest(active_vehicles, 1) as ratio,
  coalesce(centroid_lat, 0e0) as centroid_lat, coalesce(centroid_lon, 0e0) as centroid_lon
  from win left join v_zones using (zone_id))"""


WINDOWS_SQL = f"with {window_ctes()} select * from dw"


def windows(spark, sf):
    gps, requests = normalized_gps(spark, sf), valid_requests(spark, sf)
    return demand.demand_windows(demand.demand_events(gps, requests))


@query("demand_windows", WINDOWS_SQL, GPS_VIEWS)
def _(spark, sf):
    return windows(spark, sf)


@query("demand_latest", f"""with {window_ctes()} select * exclude (rn) from (select *,
  row_number() over (partition by city, zone_id order by window_start desc) as rn from dw) d where rn = 1""", GPS_VIEWS)
def _(spark, sf):
    return serving.latest_demand(windows(spark, sf))


@query("demand_recent", f"""with {window_ctes()}, last_one as (select max(window_start) as t from dw)
select zone_id, window_start, active_vehicles, pending_requests, ratio from dw, last_one
where window_start between t - interval 2 minutes and t""", GPS_VIEWS)
def _(spark, sf):
    rows = windows(spark, sf)
    newest = rows.select(F.max("window_start")).scalar()
    return serving.recent_demand(rows, newest).select("zone_id", "window_start", "active_vehicles",
                                                      "pending_requests", "ratio")


_TRAILING = "rows between 10 preceding and 1 preceding"


@query("demand_spikes", f"""with {window_ctes()}, t as (select zone_id, window_start, pending_requests,
  coalesce(avg(pending_requests) over (partition by zone_id order by window_start {_TRAILING}), 0) as m from dw)
select zone_id, window_start, pending_requests, round(m, 6) as trailing_mean,
  m > 0 and pending_requests >= m * 3 as is_spike from t""", GPS_VIEWS)
def _(spark, sf):
    return demand.demand_spikes(windows(spark, sf)).select(
        "zone_id", "window_start", "pending_requests", r6("trailing_mean").alias("trailing_mean"), "is_spike")


@query("citywide_surges", f"""with {window_ctes()},
c as (select window_start, cast(sum(pending_requests) as bigint) as n from dw group by 1),
t as (select *, coalesce(avg(n) over (order by window_start {_TRAILING}), 0) as m from c)
select window_start, n as pending_requests, round(m, 6) as trailing_mean, m > 0 and n >= m * 1.4e0 as is_surge from t""",
       GPS_VIEWS)
def _(spark, sf):
    return demand.citywide_surges(windows(spark, sf)).select(
        "window_start", "pending_requests", r6("trailing_mean").alias("trailing_mean"), "is_surge")


@query("spike_quality", f"""with {window_ctes()}, t as (select zone_id, window_start, pending_requests as n,
  coalesce(avg(pending_requests) over (partition by zone_id order by window_start {_TRAILING}), 0) as m from dw),
truth as (select distinct origin_zone as zone_id, time_bucket(interval 30 seconds, ts) as window_start
  from v_requests where destination_zone = origin_zone and origin_zone > 0),
j as (select m > 0 and n >= m * 3 as said, truth.zone_id is not null as was
  from t left join truth using (zone_id, window_start))
select count(*) filter (where said and was) as hits, count(*) filter (where said) as flagged,
  count(*) filter (where was) as labelled,
  round(coalesce(count(*) filter (where said and was) / nullif(count(*) filter (where said), 0), 0), 6) as precision,
  round(coalesce(count(*) filter (where said and was) / nullif(count(*) filter (where was), 0), 0), 6) as recall
from j""", GPS_VIEWS)
def _(spark, sf):
    flagged = demand.demand_spikes(windows(spark, sf))
    labelled = valid_requests(spark, sf).filter("destination_zone = origin_zone").select(
        F.col("origin_zone").alias("zone_id"), F.window("ts", "30 seconds")["start"].alias("window_start"))
    return demand.spike_quality(flagged, labelled).withColumns({c: r6(c) for c in ("precision", "recall")})


@query("gps_thinned", """
with recursive seconds as (select taxi_id, epoch_s, min(event_id) as event_id from v_norm group by 1, 2),
numbered as (select *, row_number() over (partition by taxi_id order by epoch_s) as rn from seconds),
kept as (
  select taxi_id, rn, epoch_s, event_id, epoch_s as last_kept, true as keep from numbered where rn = 1
  union all
  select n.taxi_id, n.rn, n.epoch_s, n.event_id,
    case when n.epoch_s - k.last_kept >= 2 then n.epoch_s else k.last_kept end, n.epoch_s - k.last_kept >= 2
  from kept k join numbered n on n.taxi_id = k.taxi_id and n.rn = k.rn + 1)
select taxi_id, event_id, epoch_s from kept where keep""", ["v_gps", "v_zones", "v_norm"])
def _(spark, sf):
    pings = normalized_gps(spark, sf).select("taxi_id", "event_id", "epoch_s")
    return thinning.thin_by_interval(pings, time="epoch_s", order_by=["event_id"])


@query("gps_thinned_wide", """
with recursive seconds as (select zone_id, epoch_s, min(event_id) as event_id from v_norm group by 1, 2),
numbered as (select *, row_number() over (partition by zone_id order by epoch_s) as rn from seconds),
kept as (
  select zone_id, rn, epoch_s, event_id, epoch_s as last_kept, true as keep from numbered where rn = 1
  union all
  select n.zone_id, n.rn, n.epoch_s, n.event_id,
    case when n.epoch_s - k.last_kept >= 45 then n.epoch_s else k.last_kept end, n.epoch_s - k.last_kept >= 45
  from kept k join numbered n on n.zone_id = k.zone_id and n.rn = k.rn + 1)
select zone_id, event_id, epoch_s from kept where keep""", ["v_gps", "v_zones", "v_norm"])
def _(spark, sf):
    # Few keys, long chains, small chunks: every chunk depends on the one before it.
    pings = normalized_gps(spark, sf).select("zone_id", "event_id", "epoch_s")
    return thinning.thin_by_interval(pings, key="zone_id", time="epoch_s", order_by=["event_id"],
                                     interval=45, chunk_seconds=300)


@query("late_events_dropped", """
select event_id, event_s, ingest_s from (select *, max(event_s) over (order by ingest_s, event_id
  rows between unbounded preceding and 1 preceding) as newest from v_arrivals) a
where newest is null or event_s >= newest - 180""", ["v_arrivals"])
def _(spark, sf):
    rows = view(spark, sf, "v_arrivals").select("event_id", "event_s", "ingest_s")
    return events.drop_late(rows, 180, arrival_order=["ingest_s", "event_id"])


@query("lateness_histogram", """
select cast((ingest_s - event_s) // 60 * 60 as bigint) as delay_from_s, count(*) as events,
  min(ingest_s - event_s) as min_delay_s, max(ingest_s - event_s) as max_delay_s,
  round(avg(ingest_s - event_s), 6) as mean_delay_s from v_arrivals group by 1""", ["v_arrivals"])
def _(spark, sf):
    return events.lateness_histogram(view(spark, sf, "v_arrivals")) \
        .withColumn("mean_delay_s", r6("mean_delay_s"))


@query("sla_metrics", """with l as (select ingest_s - event_s as s from v_arrivals)
select cast(count(*) as bigint) as events, round(quantile_cont(s, 0.95), 6) as p95_s, round(avg(s), 6) as mean_s,
  max(s) as max_s, round(count(*) filter (where s <= 5) / count(*), 6) as within_5s,
  round(count(*) filter (where s <= 15) / count(*), 6) as within_15s from l""", ["v_arrivals"])
def _(spark, sf):
    rows = kpi.sla_metrics(view(spark, sf, "v_arrivals"))
    return rows.withColumns({c: r6(c) for c in ("p95_s", "mean_s", "within_5s", "within_15s")})


def _on_clock(spark, sf, clock):
    rows = view(spark, sf, "v_arrivals").withColumn("ts", F.timestamp_seconds(clock))
    requests = rows.filter("is_request").withColumn("origin_zone", F.col("zone_id"))
    return demand.demand_events(rows.filter("not is_request"), requests)


def _clock_sql(clock: str, name: str) -> str:
    return f"""{name} as (select zone_id, time_bucket(interval 30 seconds, make_timestamp({clock} * 1000000)) as window_start,
  cast(count(distinct case when not is_request and {FREE} then taxi_id end) as int) as act,
  cast(count(*) filter (where is_request) as int) as pend from v_arrivals group by 1, 2)"""


@query("event_vs_arrival_windows", f"""with {_clock_sql('event_s', 'e')}, {_clock_sql('ingest_s', 'a')}
select zone_id, window_start, coalesce(e.act, 0) as event_active, coalesce(a.act, 0) as arrival_active,
  coalesce(e.pend, 0) as event_pending, coalesce(a.pend, 0) as arrival_pending,
  coalesce(e.act, 0) - coalesce(a.act, 0) as active_delta, coalesce(e.pend, 0) - coalesce(a.pend, 0) as pending_delta
from e full join a using (zone_id, window_start)""", ["v_arrivals"])
def _(spark, sf):
    return events.event_vs_arrival_windows(_on_clock(spark, sf, "event_s"), _on_clock(spark, sf, "ingest_s"))


_NAMED = "v_gps where taxi_id not in ('', 'unknown')"


def _named_gps(spark, sf):
    return view(spark, sf, "v_gps").filter("taxi_id not in ('', 'unknown')")


@query("blackout_intervals", f"""with m as (select taxi_id, epoch_s, event_id, status,
  lead(status) over w as ns, lead(epoch_s) over w as ne from {_NAMED} and status like 'BLACKOUT%'
  window w as (partition by taxi_id order by epoch_s, event_id))
select taxi_id, epoch_s as start_s, coalesce(case when ns = 'BLACKOUT_END' then ne end, -1) as end_s,
  coalesce(case when ns = 'BLACKOUT_END' then ne - epoch_s end, -1) as duration_s,
  coalesce(ns <> 'BLACKOUT_END', true) as is_open from m where status = 'BLACKOUT_START'""", ["v_gps"])
def _(spark, sf):
    found = events.blackout_intervals(_named_gps(spark, sf), time="epoch_s", tie=["event_id"])
    return found.fillna(-1, ["end_s", "duration_s"])


@query("silent_gaps", f"""with g as (select taxi_id, epoch_s,
  lag(epoch_s) over (partition by taxi_id order by epoch_s, event_id) as p from {_NAMED})
select taxi_id, p as silent_from_s, epoch_s as silent_to_s, epoch_s - p as gap_s from g where epoch_s - p > 60""",
       ["v_gps"])
def _(spark, sf):
    return events.silent_gaps(_named_gps(spark, sf), time="epoch_s")


@query("activity_sessions", f"""with g as (select taxi_id, epoch_s, epoch_s - lag(epoch_s) over
    (partition by taxi_id order by epoch_s) as d from {_NAMED}),
s as (select *, sum(case when d is null or d >= 600 then 1 else 0 end) over (partition by taxi_id order by epoch_s
  rows unbounded preceding) as k from g)
select taxi_id, min(epoch_s) as session_start_s, max(epoch_s) + 600 as session_end_s, cast(count(*) as bigint) as events
from s group by taxi_id, k""", ["v_gps"])
def _(spark, sf):
    return events.activity_sessions(_named_gps(spark, sf), time="epoch_s", gap_seconds=600)
