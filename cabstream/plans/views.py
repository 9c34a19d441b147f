"""Mobility-shaped views of the benchmark tables, in one text for both SQL dialects.

The tables hold no taxis; these deterministic projections give `events`,
`lineitem` and `embeddings` the schemas of GPS pings, requests, trips and
trajectories. Every view is a plain projection of its table, row for row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabstream.session import configure
from cabstream.sources.zones import CITY_ZONES

EPOCH_2024 = 1704067200000000


def view_sql(engine: str) -> dict[str, str]:
    """View texts by name for ``spark`` or ``duckdb``."""
    spark = engine == "spark"
    div = "div" if spark else "//"
    text = "string" if spark else "varchar"

    def micros(x: str) -> str:
        return f"unix_micros(cast({x} as timestamp))" if spark else f"epoch_us({x})"

    def stamp(x: str) -> str:
        return f"timestamp_micros({x})" if spark else f"make_timestamp({x})"

    clock = f"({EPOCH_2024} + ({micros('ts')} - {EPOCH_2024}) {div} 100)"
    second = f"({clock} {div} 1000000)"
    shipped = (f"({micros('l_shipdate')} {div} 1000000 + (l_partkey % 24)*3600 "
               "+ l_linenumber*600)")
    views = {
        "v_gps": f"""
select event_id,
  case when event_id % 97 = 0 then 'unknown' when event_id % 101 = 0 then ''
       else concat('TAXI-', cast(user_id as {text})) end as taxi_id,
  concat('trip-', cast(event_id as {text})) as trip_id,
  {second} as epoch_s, {stamp(f'{second} * 1000000')} as ts,
  33.39e0 + ((event_id*7919) % 1000)/1e3*0.32e0 as lat,
  -7.82e0 + ((event_id*104729) % 1000)/1e3*0.44e0 as lon,
  value as speed,
  case event_type when 'view' then 'AVAILABLE' when 'click' then 'idle' when 'signup' then 'Free'
       when 'purchase' then 'MOVING'
       else case when event_id % 2 = 0 then 'BLACKOUT_START' else 'BLACKOUT_END' end end as status
from events""",
        "v_requests": f"""
select event_id, concat('trip-', cast(event_id as {text})) as trip_id,
  concat('rider_', cast(user_id as {text})) as rider_id,
  cast(event_id % 17 as int) as origin_zone, cast((event_id*31) % 16 + 1 as int) as destination_zone,
  {second} as requested_at, {stamp(f'{second} * 1000000')} as ts,
  case event_id % 3 when 0 then 'A' when 1 then 'B' else 'C' end as call_type
from events where event_type in ('signup','purchase')""",
        # Every 11th event arrives up to 400 s late, the others within 20 s.
        "v_arrivals": f"""
select event_id, concat('TAXI-', cast(user_id as {text})) as taxi_id,
  {second} as ingest_s,
  {second} - case when event_id % 11 = 0 then (event_id*13) % 400 else event_id % 20 end as event_s,
  cast(event_id % 16 + 1 as int) as zone_id,
  case event_type when 'view' then 'AVAILABLE' when 'click' then 'IDLE' else 'MOVING' end as status,
  event_type in ('signup','purchase') as is_request
from events""",
        # What a matcher emits per request: unmatched at once, then a time-out or a late match.
        "v_match_records": f"""
select concat('trip-', cast(event_id as {text})) as trip_id, cast(event_id % 16 + 1 as int) as origin_zone,
  cast((event_id*31) % 16 + 1 as int) as dest_zone, concat('rider_', cast(user_id as {text})) as rider_id,
  step as emit_order, (step = event_id % 4) as matched,
  case when step = event_id % 4 then concat('TAXI-', cast(user_id as {text})) else '' end as taxi_id,
  cast(case when step = event_id % 4 then 60 + event_id % 900 else 0 end as int) as eta_seconds,
  cast(case when step = event_id % 4 then (event_id*7) % 16 + 1 else 0 end as int) as matched_zone,
  {second} as requested_at, {second} + step * (event_id % 6) as matched_at
from EVENTS_BY_STEP where event_type in ('signup','purchase')""",
        "v_trips": f"""
select l_orderkey*10 + l_linenumber as trip_id, l_suppkey as taxi_id,
  case l_returnflag when 'A' then 'A' when 'N' then 'B' else 'C' end as call_type,
  (l_partkey % 50 = 0) as missing_data, {shipped} as epoch_s,
  {stamp(f'{shipped} * 1000000')} as ts, cast(l_partkey % 16 + 1 as int) as zone_id,
  cast((l_partkey * 7 + l_suppkey) % 16 + 1 as int) as dest_zone,
  cast(l_quantity as int)*15 as trip_duration_sec,
  cast(round(l_extendedprice*100) as bigint) as fare_cents,
  cast(round(l_extendedprice) as bigint) as trip_distance_m,
  cast(l_quantity as int) % 6 + 1 as passenger_count
from lineitem""",
        # One row per hour that has a trip.
        "v_weather": f"""
select h*3600 as hour_s, {stamp('h * 3600000000')} as time_slot_1h,
  cast((h*37) % 30 + 5 as double) as temperature_2m,
  case when h % 5 = 0 then (h % 7)/2e0 else 0e0 end as rain
from (select distinct {shipped} {div} 3600 as h from lineitem) hours""",
    }
    unfold = "explode(array(0, 1, 2))" if spark else "unnest([0, 1, 2])"
    views["v_match_records"] = views["v_match_records"].replace(
        "EVENTS_BY_STEP", f"(select *, {unfold} as step from events) e")
    return views


def duckdb_zones() -> str:
    """The zone dimension as an inline relation."""
    rows = ", ".join(
        "({}, '{}', '{}', {}, {!r}::double, {!r}::double)".format(
            z.zone_id, z.zone_name.replace("'", "''"), z.zone_type, z.population_density,
            z.centroid_lat, z.centroid_lon) for z in CITY_ZONES)
    return ("select * from (values " + rows + ") z(zone_id, zone_name, zone_type, "
            "population_density, centroid_lat, centroid_lon)")


def duckdb_edges() -> str:
    """Zone adjacency; order 0 is the zone itself."""
    rows = ", ".join(f"({z.zone_id}, {order}, {near})" for z in CITY_ZONES
                     for order, near in enumerate((z.zone_id, *z.adjacency)))
    return f"select * from (values {rows}) e(zone_id, search_order, neighbour_id)"


GPS_RULES = ("taxi_id <> '' and lower(taxi_id) <> 'unknown' and epoch_s > 0 and lat between 33.4e0 "
             "and 33.7e0 and lon between -7.8e0 and -7.4e0 and speed between 0 and 150")

# Valid pings moved to the centroid of the nearest zone (needs v_gps and v_zones in front).
DUCKDB_NORMALIZED = f"""
select event_id, taxi_id, trip_id, epoch_s, ts, centroid_lat as lat, centroid_lon as lon, speed,
       status, zone_id, zone_name
from (select g.*, z.zone_id, z.zone_name, z.centroid_lat, z.centroid_lon,
             row_number() over (partition by event_id order by
               (g.lat - z.centroid_lat)*(g.lat - z.centroid_lat)
               + (g.lon - z.centroid_lon)*(g.lon - z.centroid_lon), z.zone_id) as rn
      from v_gps g, v_zones z where {GPS_RULES}) near where rn = 1"""

DUCKDB_POLY = """
select vec_id, cast(vec_id as bigint) as trip_id, label,
  1704067200 + vec_id * 1000 as epoch_s,
  list_transform(range(1, case label when 0 then 1 when 1 then 2 else len(embedding) // 2 + 1 end), lambda i:
    [-8.62e0 + cast(embedding[2*i-1] as double)*0.1e0, 41.145e0 + cast(embedding[2*i] as double)*0.1e0]) as points
from embeddings"""

SPARK_POLY = """
select vec_id, vec_id as trip_id, label, 1704067200 + vec_id * 1000 as epoch_s,
  transform(filter(sequence(1, size(embedding) div 2), i -> label > 1 or i <= label), i -> array(
    -8.62e0 + cast(embedding[2*i-2] as double)*0.1e0,
    41.145e0 + cast(embedding[2*i-1] as double)*0.1e0)) as points
from embeddings"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, rows: DataFrame | None = None) -> DataFrame:
    """One of the views as a Spark DataFrame; ``rows`` replaces its table, e.g. by a stream."""
    configure(spark)
    source = {"v_poly": "embeddings", "v_trips": "lineitem", "v_weather": "lineitem"}.get(name, "events")
    text = SPARK_POLY if name == "v_poly" else view_sql("spark")[name]
    text = text.replace(f"from {source}", f"from {{{source}}}")
    return spark.sql(text, **{source: table(spark, sf_dir, source) if rows is None else rows})


def with_views(body: str, *names: str) -> str:
    """DuckDB statement: the named views as CTEs in front of ``body``."""
    texts = {**view_sql("duckdb"), "v_poly": DUCKDB_POLY, "v_zones": duckdb_zones(),
             "v_edges": duckdb_edges(), "v_norm": DUCKDB_NORMALIZED}
    ctes = ",\n".join(f"{n} as ({texts[n].strip()})" for n in names)
    text = body.strip()
    if text.lower().startswith("with recursive "):
        return f"with recursive {ctes},\n{text[15:]}"
    if text.lower().startswith("with "):
        return f"with {ctes},\n{text[5:]}"
    return f"with {ctes}\n{text}"
