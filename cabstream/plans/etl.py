"""Batch jobs: curated trips, snapped trajectories, zone demand, KPIs, features, training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.operators import clean, enrich, features, forecast, kpi, snapping, trajectory
from cabstream.operators.quality import reconcile_kpis
from cabstream.session import work_folder
from cabstream.sources.sinks import write_partitioned
from cabstream.sources.zones import CITY_ZONES, Zone, zones_df

ZONE_COLUMN = "CASA_ORIGIN_ZONE"
#: The zones of a city as a list, or any number of them as a table.
Zones = Sequence[Zone] | DataFrame


def _calendar(epoch: str) -> dict[str, Column]:
    ts = F.timestamp_seconds(epoch)
    return {"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts),
            "year_month": F.date_format(ts, "yyyy-MM")}


def _target_box(zones: Zones, dst: geo.Box | None) -> geo.Box:
    if dst is not None or not isinstance(zones, DataFrame):
        return dst or geo.zone_box(zones)
    sides = zones.agg(F.min("centroid_lat") - 0.002, F.max("centroid_lat") + 0.002, F.min("centroid_lon"), F.max("centroid_lon"))
    return geo.Box(*sides.first())


def _with_origin_zone(df: DataFrame, path: str, zones: Zones) -> DataFrame:
    """Origin zone, its name and type from the first point of a remapped trajectory.

    A list of zones becomes literals; a table of zones, whatever its size, is searched through cells and joined.
    """
    start = geo.start_point(path)
    first = df.withColumns({"_lon": F.get(start, F.lit(0)), "_lat": F.get(start, F.lit(1))})
    if isinstance(zones, DataFrame):
        table = zones.select("zone_id", "zone_name", "zone_type")
        centres = zones.select("zone_id", F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon"))
        placed = snapping.nearest_in_table(first.withColumnsRenamed({"_lat": "lat", "_lon": "lon"}), centres, "zone_id") \
            .drop("lat", "lon").withColumn(ZONE_COLUMN, F.coalesce("zone_id", F.lit(0))).drop("zone_id")
    else:
        table = zones_df(df.sparkSession, zones)
        placed = geo.with_nearest_zone(first, "_lat", "_lon", zones, ZONE_COLUMN).drop("_lon", "_lat")
    return enrich.enrich_zone(placed, table, ZONE_COLUMN, f"{ZONE_COLUMN}_") \
        .withColumnRenamed(f"{ZONE_COLUMN}_name", f"{ZONE_COLUMN}_NAME") \
        .withColumnRenamed(f"{ZONE_COLUMN}_type", f"{ZONE_COLUMN}_TYPE")


def curate_trips(raw: DataFrame, zones: Zones = CITY_ZONES, src: geo.Box = geo.SOURCE_BOX,
                 dst: geo.Box | None = None, order_by: Sequence[str] = ("TIMESTAMP",)) -> DataFrame:
    """Historical trips to curated trips.

    Flagged trips are dropped, ids made unique, trajectories parsed and trips
    without a usable point dropped. The length is measured on the source points
    as recorded; the zone is that of the first point after clamping and
    remapping. Every listed point counts 15 seconds, usable or not. One shuffle
    (the ids); everything else is a projection.
    """
    trips = clean.dedup_trips(clean.drop_missing(raw), "TRIP_ID", order_by)
    parsed = clean.non_empty_trajectory(trips, "POLYLINE", "_listed", "_points")
    measured = parsed.withColumns({
        **_calendar("TIMESTAMP"),
        "trip_distance_km": geo.polyline_distance_km("_points"),
        "trip_duration_sec": geo.polyline_duration_sec("_listed"),
        "_mapped": geo.remap_polyline("_points", src, _target_box(zones, dst)),
    })
    zoned = _with_origin_zone(measured, "_mapped", zones)
    return zoned.withColumn("POLYLINE", F.to_json("_mapped")).drop("_listed", "_points", "_mapped")


def snap_trajectories(raw: DataFrame, refs: DataFrame, zones: Zones = CITY_ZONES,
                      src: geo.Box = geo.SOURCE_BOX, dst: geo.Box | None = None,
                      max_km: float = 0.5, key: str = "TRIP_ID") -> DataFrame:
    """Remap trajectories, move every point to its nearest reference point, assign the zone.

    ``refs`` has ``ref_id``, ``lat``, ``lon``. Points are rounded to six digits
    and each distinct spot is snapped once, so a taxi rank with a third of all
    points costs one lookup. Ids are made unique first: regrouping points by a
    repeated id would mix its copies' trajectories.
    """
    unique = clean.dedup_trips(raw, key)
    trips = clean.non_empty_trajectory(unique, "POLYLINE")
    mapped = trips.select(key, geo.remap_polyline("usable_points", src, _target_box(zones, dst)).alias("points"))
    points = trajectory.explode_points(mapped).select(
        key, "pos", F.struct(F.round(F.get("pt", F.lit(1)), 6).alias("lat"),
                             F.round(F.get("pt", F.lit(0)), 6).alias("lon")).alias("spot"))
    # Read for the spots, for those without a reference and for regrouping: the texts are parsed for one of them only.
    path = work_folder(raw.sparkSession, "trajectory-points")
    points.write.parquet(path)
    points = raw.sparkSession.read.schema(points.schema).parquet(path)
    spots = points.select("spot").distinct().select("spot", "spot.lat", "spot.lon")
    snapped = snapping.snap_to_reference(spots, refs, "spot", "ref_id", max_km) \
        .select("spot", F.col("snapped_lat").alias("lat"), F.col("snapped_lon").alias("lon"))
    regrouped = trajectory.collect_polyline(points.join(snapped, "spot"), key)
    zoned = _with_origin_zone(regrouped.withColumn("_path", geo.parse_points("POLYLINE")), "_path", zones)
    return enrich.join_back(unique.drop("POLYLINE"), zoned.drop("_path"), key)


def write_curated(raw: DataFrame, path: str, **options) -> None:
    write_partitioned(curate_trips(raw, **options), path, "year_month")


def write_zone_demand(records: DataFrame, path: str) -> None:
    """Zone x hour x month demand of trip records, one folder per month."""
    write_partitioned(kpi.zone_hour_month_demand(records), path, "month")


def as_trips(curated: DataFrame) -> DataFrame:
    """Curated trips under the names the KPI and feature operators use."""
    return curated.select(
        F.col("TRIP_ID").alias("trip_id"), F.col("TAXI_ID").alias("taxi_id"),
        F.col("CALL_TYPE").alias("call_type"), F.col(ZONE_COLUMN).alias("zone_id"),
        F.col(f"{ZONE_COLUMN}_NAME").alias("zone_name"), "trip_duration_sec",
        F.timestamp_seconds("TIMESTAMP").alias("ts"))


def write_kpis(spark: SparkSession, curated: DataFrame, path: str) -> DataFrame:
    """Store the tall KPI table, one folder per KPI, and return its reconciliation."""
    write_partitioned(kpi.kpi_table(as_trips(curated)), path, "kpi_name")
    return reconcile_kpis(spark.read.parquet(path))


def write_features(curated: DataFrame, zones: DataFrame, weather: DataFrame, path: str,
                   lag_mode: str = "rows") -> None:
    """Store the feature matrix, one folder per month so that a split prunes folders."""
    matrix = features.build_features(as_trips(curated), zones, weather, lag_mode)
    write_partitioned(matrix, path, "year_month")


def train(matrix: DataFrame, last_train_month: str = "2013-09", depths: Sequence[int] = (5, 7),
          folds: int = 3, max_iter: int = 50) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on the early months; returns the best model, its metrics and per-zone metrics."""
    early, late = features.temporal_split(matrix, last_train_month)
    model = forecast.cross_validate(early, depths, folds, max_iter).bestModel
    scored = model.transform(forecast.as_model_input(late))
    return model, forecast.forecast_metrics(scored), forecast.zone_metrics(scored)
