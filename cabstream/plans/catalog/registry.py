"""Named queries over the benchmark tables with equivalent reference SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabstream.operators import clean
from cabstream.plans.views import GPS_RULES, view, with_views
from cabstream.sources.zones import CITY_ZONES, zone_edges, zones_df

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query; ``views`` are put in front of its SQL as CTEs."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql, *views) if views else sql
        return fn

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Times without a zone, as the reference SQL returns them."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat, dlon = f"sin(radians(({lat2}) - ({lat1})) / 2)", f"sin(radians(({lon2}) - ({lon1})) / 2)"
    inner = f"{dlat}*{dlat} + cos(radians({lat1}))*cos(radians({lat2}))*{dlon}*{dlon}"
    return f"2*6371e0*asin(sqrt(least(greatest({inner}, 0e0), 1e0)))"


# Shared relations ---------------------------------------------------------------------------

VALID_GPS_SQL = f"select * from v_gps where {GPS_RULES}"
FREE = "upper(status) in ('AVAILABLE', 'FREE', 'IDLE')"
DEDUP_SQL = """
select * exclude (rn) from (select *, row_number() over (partition by trip_id order by epoch_s, taxi_id,
  zone_id, fare_cents, trip_duration_sec, call_type, dest_zone, trip_distance_m, passenger_count,
  missing_data) as rn from v_trips) d where rn = 1"""
DEDUP_ORDER = ["epoch_s", "taxi_id", "zone_id", "fare_cents", "trip_duration_sec", "call_type",
               "dest_zone", "trip_distance_m", "passenger_count", "missing_data"]


def valid_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.validate_gps(view(spark, sf_dir, "v_gps"), timestamp="epoch_s")


def normalized_gps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.anonymize_to_centroid(valid_gps(spark, sf_dir))


def valid_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_requests(view(spark, sf_dir, "v_requests"))


def city_zones(spark: SparkSession) -> DataFrame:
    return zones_df(spark, CITY_ZONES)


def city_edges(spark: SparkSession) -> DataFrame:
    return zone_edges(city_zones(spark))


def trips_with_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = city_zones(spark).select("zone_id", "zone_name", "zone_type")
    return view(spark, sf_dir, "v_trips").join(names, "zone_id", "left")


ZONED_TRIPS_SQL = ("zoned as (select t.*, z.zone_name, z.zone_type from v_trips t "
                   "left join v_zones z using (zone_id))")
