"""Geospatial and trajectory expressions; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstream.functions.plan import evaluated_once
from cabstream.sources.zones import CITY_ZONES, Zone

EARTH_RADIUS_KM = 6371.0
AVG_SPEED_KMH = 25.0
POINT_INTERVAL_S = 15
POINTS_TYPE = "array<array<double>>"


class Box(NamedTuple):
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# Source city box, target city validity box, replay calibration boxes.
SOURCE_BOX = Box(41.100, 41.190, -8.690, -8.550)
CITY_BOX = Box(33.4, 33.7, -7.8, -7.4)
REPLAY_SOURCE_BOX = Box(41.13, 41.19, -8.68, -8.55)
REPLAY_TARGET_BOX = Box(33.48, 33.63, -7.68, -7.53)


def zone_box(zones: Sequence[Zone] = CITY_ZONES, lat_margin: float = 0.002) -> Box:
    """Box spanned by the zone centroids, widened in latitude."""
    lats = [z.centroid_lat for z in zones]
    lons = [z.centroid_lon for z in zones]
    return Box(min(lats) - lat_margin, max(lats) + lat_margin, min(lons), max(lons))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str,
                 lon2: Column | str) -> Column:
    """Great-circle distance; the inner term is clamped to [0, 1] against rounding."""
    lat1, lon1, lat2, lon2 = _col(lat1), _col(lon1), _col(lat2), _col(lon2)
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    h = (half_dlat * half_dlat
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon)
    return F.asin(F.sqrt(F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def eta_seconds(km: Column | str, speed_kmh: float = AVG_SPEED_KMH) -> Column:
    """Travel time in whole seconds, halves rounded up."""
    return F.floor(_col(km) / F.lit(float(speed_kmh)) * 3600 + 0.5).cast("int")


def _sql_literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def _squared_distances(lat: str, lon: str, zones: Sequence[Zone]) -> str:
    """SQL text of the array of squared degree distances to all zones, in list order."""
    if not zones:
        raise ValueError("a zone list has at least one zone")
    return "array(" + ", ".join(
        f"(`{lat}` - {z.centroid_lat!r}D) * (`{lat}` - {z.centroid_lat!r}D) + "
        f"(`{lon}` - {z.centroid_lon!r}D) * (`{lon}` - {z.centroid_lon!r}D)".replace("- -", "+ ")
        for z in zones) + ")"


def with_nearest_zone(df: DataFrame, lat: str = "lat", lon: str = "lon",
                      zones: Sequence[Zone] = CITY_ZONES, name: str = "zone_id") -> DataFrame:
    """Add the zone with the smallest squared degree distance; the first zone wins ties.

    Literals only: no join, no shuffle, valid on streams. The list is that of
    one city; a zone table of any size goes through ``nearest_in_table``. A missing coordinate
    gives zone 0, so the column is never null. The distances are computed once
    per row however often the zone is used or filtered on, which also keeps the
    generated method small enough for the JVM to compile it.
    """
    ids = ", ".join(str(z.zone_id) for z in zones)
    measured = evaluated_once(df, "_away", F.expr(_squared_distances(lat, lon, zones)))
    place = "cast(array_position(_away, array_min(_away)) as int)"
    return measured.withColumn(name, F.expr(f"coalesce(get(array({ids}), {place} - 1), 0)")).drop("_away")


def zone_attribute(zone_id: Column | str, field: str,
                   zones: Sequence[Zone] = CITY_ZONES) -> Column:
    """Look up one attribute of a zone id from the bounded zone list; unknown id gives null."""
    pairs = ", ".join(f"{z.zone_id}, {_sql_literal(getattr(z, field))}" for z in zones)
    return F.element_at(F.expr(f"map({pairs})"), _col(zone_id))


def remap_linear(value: Column | str, src_min: float, src_max: float, dst_min: float,
                 dst_max: float, clamp: bool = True) -> Column:
    """Map ``[src_min, src_max]`` linearly onto ``[dst_min, dst_max]``."""
    value = _col(value)
    if clamp:
        value = F.greatest(F.lit(src_min), F.least(value, F.lit(src_max)))
    share = (value - F.lit(src_min)) / F.lit(src_max - src_min)
    return F.lit(dst_min) + share * F.lit(dst_max - dst_min)


def remap_point(point: Column, src: Box, dst: Box, clamp: bool = True) -> Column:
    """Remap one ``[lon, lat]`` point from box to box."""
    return F.array(
        remap_linear(F.get(point, F.lit(0)), src.lon_min, src.lon_max, dst.lon_min, dst.lon_max, clamp),
        remap_linear(F.get(point, F.lit(1)), src.lat_min, src.lat_max, dst.lat_min, dst.lat_max, clamp),
    )


def parse_points(text: Column | str) -> Column:
    """Trajectory JSON text to points; malformed text gives null."""
    return F.from_json(_col(text), POINTS_TYPE)


def usable_points(points: Column | str) -> Column:
    """Points with both coordinates."""
    return F.filter(_col(points), lambda p: p.isNotNull() & (F.size(p) >= 2)
                    & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())


def remap_polyline(points: Column | str, src: Box = SOURCE_BOX, dst: Box | None = None,
                   clamp: bool = True) -> Column:
    """Remap every point of a trajectory in place (no explode, no shuffle)."""
    target = dst or zone_box()
    return F.transform(_col(points), lambda p: remap_point(p, src, target, clamp))


def polyline_distance_km(points: Column | str) -> Column:
    """Sum of segment lengths over ``[lon, lat]`` points; fewer than two points give 0."""
    pts = _col(points)
    steps = F.greatest(F.coalesce(F.size(pts), F.lit(0)) - 1, F.lit(0))
    segments = F.zip_with(
        F.slice(pts, 1, steps), F.slice(pts, 2, steps),
        lambda a, b: haversine_km(F.get(a, F.lit(1)), F.get(a, F.lit(0)),
                                  F.get(b, F.lit(1)), F.get(b, F.lit(0))),
    )
    total = F.aggregate(segments, F.lit(0.0), lambda acc, km: acc + km)
    return F.when(steps > 0, total).otherwise(F.lit(0.0))


def polyline_duration_sec(points: Column | str, interval_s: int = POINT_INTERVAL_S) -> Column:
    """Every listed point counts for one sampling interval; null counts as empty."""
    return F.greatest(F.coalesce(F.size(_col(points)), F.lit(0)), F.lit(0)) * interval_s


def start_point(points: Column | str) -> Column:
    """First point, null when there is none."""
    return F.get(_col(points), F.lit(0))


def end_point(points: Column | str) -> Column:
    """Last point, null when there is none."""
    return F.get(_col(points), F.size(_col(points)) - 1)


def grid_cell(lat: Column | str, lon: Column | str, digits: int = 2) -> Column:
    """Rounded ``lat,lon`` text naming an area."""
    return F.concat(F.round(_col(lat), digits).cast("string"), F.lit(","),
                    F.round(_col(lon), digits).cast("string"))
