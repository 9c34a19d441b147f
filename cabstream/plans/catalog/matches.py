"""Queries: trip matching and the serving reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabstream.operators import arrivals, kpi, matching, serving
from cabstream.plans.catalog.registry import (
    FREE, city_edges, haversine_sql, normalized_gps, query, r6, valid_requests)
from cabstream.plans.views import view
from cabstream.sources.zones import CITY_ZONES

MV = ["v_gps", "v_requests", "v_zones", "v_edges", "v_norm"]
ROUNDS = max(len(z.adjacency) for z in CITY_ZONES) + 1
BUCKET = "time_bucket(interval 5 minutes, ts)"
SUPPLY_SQL = f"""req as (select {BUCKET} as window_start, * from v_requests where origin_zone > 0),
lastping as (select *, {BUCKET} as window_start, row_number() over (partition by taxi_id, {BUCKET}
  order by epoch_s desc, event_id desc) as rn from v_norm),
veh as (select window_start, taxi_id, zone_id, epoch_s as last_seen, lat, lon from lastping where rn = 1 and {FREE}),
supply as (select window_start, zone_id, count(*) as free_vehicles,
  arg_min(taxi_id, (last_seen, taxi_id)) as longest_idle_taxi, min(last_seen) as longest_idle_since
  from veh group by all)"""


def rounds_sql() -> str:
    """The round matcher as a chain of CTEs."""
    parts = [SUPPLY_SQL]
    open_, free = "req", "veh"
    for r in range(ROUNDS):
        parts.append(f"""rq{r} as (select q.window_start, q.trip_id, e.neighbour_id as zone_id, row_number() over (
    partition by q.window_start, e.neighbour_id order by q.requested_at, q.trip_id) as k
  from {open_} q join v_edges e on e.zone_id = q.origin_zone and e.search_order = {r}),
vh{r} as (select *, row_number() over (partition by window_start, zone_id order by last_seen, taxi_id) as k from {free}),
m{r} as materialized (select rq{r}.window_start, trip_id, taxi_id, zone_id, lat, lon, {r} as search_order
  from rq{r} join vh{r} using (window_start, zone_id, k)),
o{r} as materialized (select * from {open_} q where not exists (select 1 from m{r} m where m.trip_id = q.trip_id)),
f{r} as materialized (select * from {free} v where not exists (
  select 1 from m{r} m where m.taxi_id = v.taxi_id and m.window_start = v.window_start))""")
        open_, free = f"o{r}", f"f{r}"
    parts.append("allm as (" + " union all ".join(f"select * from m{r}" for r in range(ROUNDS)) + ")")
    km = haversine_sql("m.lat", "m.lon", "z.centroid_lat", "z.centroid_lon")
    parts.append(f"""matches as (select q.window_start, q.trip_id, q.origin_zone, q.destination_zone as dest_zone,
  q.rider_id, q.call_type, q.requested_at, coalesce(m.taxi_id, '') as taxi_id, m.taxi_id is not null as matched,
  coalesce(m.zone_id, 0) as matched_zone, coalesce(m.search_order, -1) as search_order,
  coalesce(cast(floor({km} / 25e0 * 3600 + 0.5e0) as int), 0) as eta_seconds
  from req q left join allm m on m.trip_id = q.trip_id left join v_zones z on z.zone_id = q.destination_zone)""")
    return ",\n".join(parts)


MATCHES_SQL = f"with {rounds_sql()}"


def window_requests(spark, sf):
    return valid_requests(spark, sf).withColumn("window_start", matching.window_start("ts"))


def window_vehicles(spark, sf):
    pings = normalized_gps(spark, sf).withColumn("window_start", matching.window_start("ts"))
    return matching.vehicle_state(pings, ["epoch_s", "event_id"], ["window_start"])


def matches(spark, sf):
    return matching.match_trips_rounds(window_requests(spark, sf), window_vehicles(spark, sf))


@query("vehicle_state", f"with {SUPPLY_SQL} select * from veh", MV)
def _(spark, sf):
    return window_vehicles(spark, sf).select("window_start", "taxi_id", "zone_id", "last_seen", "lat", "lon")


@query("supply_by_zone", f"with {SUPPLY_SQL} select * from supply", MV)
def _(spark, sf):
    return matching.supply_by_zone(window_vehicles(spark, sf))


@query("candidate_supply", f"""with {SUPPLY_SQL} select q.trip_id, e.search_order, e.neighbour_id as zone_id,
  coalesce(s.free_vehicles, 0) as free_vehicles, coalesce(s.longest_idle_taxi, '') as longest_idle_taxi
from req q join v_edges e on e.zone_id = q.origin_zone
left join supply s on s.window_start = q.window_start and s.zone_id = e.neighbour_id""", MV)
def _(spark, sf):
    supply = matching.supply_by_zone(window_vehicles(spark, sf))
    return matching.candidate_supply(window_requests(spark, sf), supply, city_edges(spark)).select(
        "trip_id", "search_order", "zone_id", "free_vehicles",
        F.coalesce("longest_idle_taxi", F.lit("")).alias("longest_idle_taxi"))


@query("uncovered_requests", f"""with {SUPPLY_SQL} select trip_id, origin_zone, window_start from req q
where not exists (select 1 from v_edges e join supply s on s.zone_id = e.neighbour_id
  where e.zone_id = q.origin_zone and s.window_start = q.window_start)""", MV)
def _(spark, sf):
    supply = matching.supply_by_zone(window_vehicles(spark, sf))
    return matching.uncovered_requests(window_requests(spark, sf), supply, city_edges(spark)) \
        .select("trip_id", "origin_zone", "window_start")


@query("asof_vehicle", f"""
select r.trip_id, r.origin_zone, coalesce(v.taxi_id, '') as asof_taxi_id, coalesce(r.requested_at - v.epoch_s, -1) as asof_age_s
from (select * from v_requests where origin_zone > 0) r asof left join (
  select zone_id, epoch_s, max(taxi_id) as taxi_id from v_norm where {FREE} group by 1, 2) v
on v.zone_id = r.origin_zone and v.epoch_s <= r.requested_at""", ["v_gps", "v_requests", "v_zones", "v_norm"])
def _(spark, sf):
    pings = normalized_gps(spark, sf)
    joined = matching.asof_vehicle(valid_requests(spark, sf), pings, ping_time="epoch_s")
    return joined.select("trip_id", "origin_zone", F.coalesce("asof_taxi_id", F.lit("")).alias("asof_taxi_id"),
                         F.coalesce("asof_age_s", F.lit(-1).cast("bigint")).alias("asof_age_s"))


@query("trip_matches", f"{MATCHES_SQL} select * from matches", MV)
def _(spark, sf):
    return matches(spark, sf)


# All events one by one: a step of the recursion is one event, its state the free vehicles and the waiting requests.
KM_TO_DEST = haversine_sql("v.lat", "v.lon", "z.centroid_lat", "z.centroid_lon")
IN_ORDER_SQL = f"""with recursive ev as (select row_number() over (order by t, kind, seq, id) as k, * from (
  select epoch_s as t, 0 as kind, event_id as seq, taxi_id as id, zone_id as zone, {FREE} as free from v_norm
  union all select requested_at, 1, event_id, trip_id, origin_zone, false from v_requests where origin_zone > 0) e),
paths as (select zone_id, list(neighbour_id order by search_order) as path from v_edges group by zone_id),
line as (select ev.*, coalesce(p.path, [zone]) as path from ev left join paths p on p.zone_id = ev.zone),
sim as (select 0::bigint as k, []::struct(s bigint, id varchar, z int, ev bigint)[] as cars,
    []::struct(ev bigint, t bigint, z int)[] as waits, []::struct(q bigint, car bigint, z int)[] as got
  union all select k, list_filter(c1, lambda c: not list_contains(list_transform(pool[1:n], lambda p: p.ev), c.ev)) as cars,
    case when kind = 0 then list_filter(w1, lambda w: not list_contains(list_transform(asks[1:n], lambda a: a.ev), w.ev))
      when n = 0 then list_concat(w1, asks) else w1 end as waits,
    list_transform(range(1, n + 1), lambda i: {{'q': asks[i].ev, 'car': pool[i].ev, 'z': pool[i].z}}) as got
  from (select *, case when kind = 0 then least(len(pool), len(asks)) else least(len(pool), 1) end as n from (
    select *, list_sort(list_transform(list_filter(c1, lambda c: list_contains(case when kind = 0 then [zone] else path end, c.z)),
        lambda c: {{'p': case when kind = 0 then 0 else list_position(path, c.z) end, 's': c.s, 'id': c.id, 'z': c.z, 'ev': c.ev}})) as pool,
      case when kind = 0 then list_filter(w1, lambda w: list_contains(path, w.z)) else [{{'ev': k, 't': t, 'z': zone}}] end as asks
    from (select l.k, l.kind, l.t, l.zone, l.path, case when l.kind = 1 then s.cars when l.free then list_append(
        list_filter(s.cars, lambda c: c.id <> l.id), {{'s': l.t, 'id': l.id, 'z': l.zone, 'ev': l.k}})
        else list_filter(s.cars, lambda c: c.id <> l.id) end as c1,
      case when l.kind = 0 then list_filter(s.waits, lambda w: w.t + 5 >= l.t) else s.waits end as w1
      from sim s join line l on l.k = s.k + 1) a) b) c),
found as (select k, unnest(got) as g from sim),
inorder as (select r.trip_id, r.origin_zone, r.destination_zone as dest_zone, r.rider_id, r.call_type, r.requested_at,
  coalesce(v.taxi_id, '') as taxi_id, f.k is not null as matched, coalesce(f.g.z, 0) as matched_zone,
  cast(coalesce(list_position(q.path, f.g.z) - 1, -1) as int) as search_order, m.t as matched_at, v.epoch_s as vehicle_s,
  coalesce(cast(floor({KM_TO_DEST} / 25e0 * 3600 + 0.5e0) as int), 0) as eta_seconds
  from v_requests r join line q on q.kind = 1 and q.seq = r.event_id left join found f on f.g.q = q.k
  left join line m on m.k = f.k left join line c on c.k = f.g.car left join v_norm v on v.event_id = c.seq
  left join v_zones z on z.zone_id = r.destination_zone)"""
IN_ORDER = ["trip_id", "origin_zone", "dest_zone", "rider_id", "requested_at", "taxi_id", "matched", "matched_zone", "search_order",
            "matched_at", "vehicle_s", "eta_seconds"]


@query("trip_matches_in_order", f"{IN_ORDER_SQL} select * from inorder", MV)
def _(spark, sf):
    asked = valid_requests(spark, sf).withColumn("seq", F.col("event_id")).select(
        "trip_id", "origin_zone", "destination_zone", "rider_id", "call_type", "requested_at", "seq")
    seen = normalized_gps(spark, sf).withColumn("seq", F.col("event_id"))
    return arrivals.match_in_order(asked, seen).select(*IN_ORDER, "call_type")


@query("unmatched_requests", f"{MATCHES_SQL} select trip_id, origin_zone, requested_at from matches where not matched", MV)
def _(spark, sf):
    return matching.unmatched_requests(matches(spark, sf)) \
        .select("trip_id", "origin_zone", "requested_at")


@query("match_rates", f"""{MATCHES_SQL} select origin_zone, count(*) as requests, count(*) filter (where matched) as matched,
  count(*) filter (where matched and matched_zone <> origin_zone) as from_neighbour,
  round(count(*) filter (where matched) / count(*), 6) as match_rate,
  round(avg(eta_seconds) filter (where matched), 6) as avg_eta_s from matches group by 1""", MV)
def _(spark, sf):
    return matching.match_rates(matches(spark, sf)).withColumns({c: r6(c) for c in ("match_rate", "avg_eta_s")})


FINAL_SQL = """with fin as (select * exclude (rn) from (select *, row_number() over (partition by trip_id
  order by matched desc, emit_order desc) as rn from v_match_records) r where rn = 1)"""


def final(spark, sf):
    return matching.final_match_status(view(spark, sf, "v_match_records"))


@query("final_match_status", f"{FINAL_SQL} select * from fin", ["v_match_records"])
def _(spark, sf):
    return final(spark, sf)


@query("trip_status", f"""{FINAL_SQL} select trip_id, case when matched then 'matched' else 'unmatched' end as status,
  case when matched then eta_seconds else 0 end as eta_seconds from fin""", ["v_match_records"])
def _(spark, sf):
    return serving.trip_status(final(spark, sf))


def _uuid_trips(spark, sf):
    """Ids as UUID text, except those of trips within one zone, which stay no UUID and are skipped."""
    number = F.regexp_extract("trip_id", "(\\d+)", 1)
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(number, 12, "0"))
    rows = final(spark, sf)
    return matching.serving_trips(rows.withColumn(
        "trip_id", F.when(F.col("origin_zone") == F.col("dest_zone"), F.col("trip_id")).otherwise(uuid)))


SERVING_SQL = f"""{FINAL_SQL}, n as (select *, regexp_extract(trip_id, '(\\d+)', 1) as num from fin),
served as (select 'casablanca' as city, strftime(make_timestamp(requested_at * 1000000), '%Y-%m-%d') as date_bucket,
  make_timestamp(requested_at * 1000000) as created_at, concat('00000000-0000-4000-8000-', lpad(num, 12, '0')) as trip_id,
  taxi_id, origin_zone, dest_zone, rider_id, case when matched then 'matched' else 'unmatched' end as status,
  eta_seconds from n where origin_zone <> dest_zone)"""


@query("serving_trips", f"{SERVING_SQL} select * from served", ["v_match_records"])
def _(spark, sf):
    return _uuid_trips(spark, sf)


@query("trip_history", f"{SERVING_SQL} select * from served where date_bucket between '2024-01-01' and '2024-01-02'",
       ["v_match_records"])
def _(spark, sf):
    return serving.trip_history(_uuid_trips(spark, sf), "casablanca", "2024-01-01", "2024-01-02")


@query("match_kpis", f"""{FINAL_SQL} select
  count(*) filter (where requested_at > (select max(requested_at) from fin) - 86400) as trips_24h,
  round(avg(eta_seconds) filter (where matched), 6) as avg_eta,
  round(count(*) filter (where matched and matched_at - requested_at <= 5) / count(*) * 100, 6) as match_rate_5s
from fin""", ["v_match_records"])
def _(spark, sf):
    return kpi.match_kpis(final(spark, sf)).withColumns({c: r6(c) for c in ("avg_eta", "match_rate_5s")})


NV = ["v_gps", "v_zones", "v_norm"]


@query("vehicles_seen_recently", """with n as (select *, row_number() over (partition by taxi_id
    order by epoch_s desc, event_id desc) as rn from v_norm
  where epoch_s between (select max(epoch_s) from v_norm) - 300 and (select max(epoch_s) from v_norm))
select taxi_id, zone_id, lat, lon, speed, epoch_s from n where rn = 1""", NV)
def _(spark, sf):
    pings = normalized_gps(spark, sf)
    now = pings.select(F.max("epoch_s")).scalar()
    return serving.vehicles_in_zone(pings, now, max_age_s=300, time="epoch_s", tie=["event_id"]) \
        .select("taxi_id", "zone_id", "lat", "lon", "speed", "epoch_s")


@query("latest_position_per_zone", """select zone_id, taxi_id, epoch_s, status from (select *, row_number() over (
  partition by zone_id order by epoch_s desc, event_id desc) as rn from v_norm) n where rn = 1""", NV)
def _(spark, sf):
    return serving.latest_position(normalized_gps(spark, sf), "zone", "epoch_s", ["event_id"]) \
        .select("zone_id", "taxi_id", "epoch_s", "status")


@query("latest_position_per_taxi", """select taxi_id, zone_id, epoch_s, status from (select *, row_number() over (
  partition by taxi_id order by epoch_s desc, event_id desc) as rn from v_norm) n where rn = 1""", NV)
def _(spark, sf):
    return serving.latest_position(normalized_gps(spark, sf), "taxi", "epoch_s", ["event_id"]) \
        .select("taxi_id", "zone_id", "epoch_s", "status")
