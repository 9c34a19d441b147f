"""Snap points to the nearest entry of a reference-point table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.functions import geo
from cabstream.session import work_folder

#: References of one cell at the last level of the index, and the width in km below which no cell is cut.
REFS_PER_CELL, LEAST_KM = 8, 0.001
# A degree of latitude is a little over 111 km; the margin absorbs rounding.
KM_PER_DEGREE = 111.0
MARGIN = 1.01


def _per_level(values: list[float]) -> Column:
    """The value of a row's level (column level), the widest level's first."""
    return F.get(F.lit(values), F.col("level"))


def _widths(max_km: float, levels: int) -> list[float]:
    """Least width in km of the cells of each level, with the margin; each level halves it."""
    return [max_km / 2 ** level * MARGIN for level in range(levels)]


def _band(widths: list[float]) -> Column:
    """Number of the latitude band of a place (columns lat, level), each at least as high as the level's cells are wide."""
    return F.floor((F.col("lat") + 90) * KM_PER_DEGREE / _per_level(widths)).cast("int")


def _columns(band: str, widths: list[float]) -> Column:
    """Cells around the globe in a band, each at least as wide as the level's width in it and the bands beside it.

    Two places of latitude up to p within a distance d differ in longitude by
    at most 2 asin(sin(d / 2R) / cos p); at the poles by anything, so there is
    one cell.
    """
    height = _per_level([km / KM_PER_DEGREE for km in widths])
    furthest = F.least(F.greatest(F.abs((F.col(band) - 1) * height - 90), F.abs((F.col(band) + 2) * height - 90)), F.lit(90.0))
    share = _per_level([math.sin(km / (2 * geo.EARTH_RADIUS_KM)) for km in widths]) / F.cos(F.radians(furthest))
    width = F.degrees(F.asin(F.least(share, F.lit(1.0)))) * 2
    return F.greatest(F.floor(F.lit(360.0) / (width * MARGIN)), F.lit(1)).cast("int")


def _cell(lon: Column, columns: Column) -> Column:
    """Column of a longitude; the date line is an edge like any other."""
    return F.pmod(F.floor((lon + 180) / 360 * columns), columns.cast("bigint")).cast("int")


def _at_levels(places: DataFrame, levels: int) -> DataFrame:
    """Each row once a level."""
    return places.select("*", F.explode(F.lit(list(range(levels)))).alias("level"))


def _in_cell(places: DataFrame, widths: list[float]) -> DataFrame:
    """Add the cell (cell_lat, cell_lon) that a place is in at its level. Plain columns, for generated code."""
    return places.withColumn("cell_lat", _band(widths)).withColumn("_columns", _columns("cell_lat", widths)).withColumn(
        "cell_lon", _cell(F.col("lon"), F.col("_columns"))).drop("_columns")


def _around(places: DataFrame, widths: list[float]) -> DataFrame:
    """The rows once for each of the cells around a place at its level, its own among them."""
    bands = places.withColumn("_band", _band(widths))
    rows = bands.select("*", F.explode(F.array(*[F.col("_band") + d for d in (-1, 0, 1)])).alias("cell_lat"))
    rows = rows.withColumn("_columns", _columns("cell_lat", widths)).withColumn("_own", _cell(F.col("lon"), F.col("_columns")))
    near = F.array_distinct(F.array(*[F.pmod(F.col("_own") + d, F.col("_columns")) for d in (-1, 0, 1)]))
    return rows.select("*", F.explode(near).alias("cell_lon")).drop("_band", "_columns", "_own")


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cell_levels(refs: DataFrame, max_km: float, refs_per_cell: int = REFS_PER_CELL) -> int:
    """Levels of cells needed until none has more than ``refs_per_cell`` references; each halves the cells' width."""
    most = max(1, math.floor(math.log2(max_km / LEAST_KM)) + 1)
    placed = _in_cell(_at_levels(refs.select("lat", "lon"), most), _widths(max_km, most))
    counts = placed.groupBy("level", "cell_lat", "cell_lon").count()
    crowded = counts.filter(F.col("count") > refs_per_cell).agg(F.max("level")).first()[0]
    return 1 if crowded is None else min(crowded + 2, most)


def reference_index(refs: DataFrame, ref_id: str, max_km: float, levels: int) -> DataFrame:
    """Stored rows (level, cell_lat, cell_lon, ref, ref_lat, ref_lon): references in the cells they may be looked for.

    At each level a reference is written to its cell and those around it, so
    that a place finds every reference within a cell's width in the one cell it is in.
    Of references at one place only that with the smallest id can be the answer.
    """
    spark = refs.sparkSession
    # Few bytes become many rows, so the spots are dealt anew.
    spots = refs.groupBy("lat", "lon").agg(F.min(ref_id).alias("ref")).repartition(_tasks(spark), "ref")
    spread = _around(_at_levels(spots, levels), _widths(max_km, levels)).select(
        "level", "cell_lat", "cell_lon", "ref", F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"))
    path = work_folder(spark, "reference-index")
    spread.write.parquet(path)
    return spark.read.schema(spread.schema).parquet(path)


def snap_to_reference(points: DataFrame, refs: DataFrame, point_id: str, ref_id: str,
                      max_km: float = 0.5, levels: int | None = None) -> DataFrame:
    """Move each point to the nearest reference point within ``max_km``, else leave it.

    Both sides carry ``lat``/``lon``; ``point_id`` is unique. References lie in
    a hierarchy of cells: the widest are at least ``max_km`` high and wide at
    every latitude and wrap around the globe, each level halves them, and there
    are as many levels as the densest area needs (``cell_levels``). A point
    takes the narrowest level at which anything is near it; the nearest there
    bounds the distance, and a second look at the narrowest level whose cells
    are as wide as that bound finds the answer. So a point meets a handful of
    references whatever their density, and ``max_km`` only says when to give
    up. All joins are on cells; Spark broadcasts the index if it is small and
    splits hot cells otherwise.

    Adds ``snapped_lat``, ``snapped_lon``, ``snapped_ref`` (null when nothing is
    near) and ``snap_km``; ties go to the smaller ``ref_id``. A point or
    reference without a coordinate is near nothing.
    """
    known = refs.dropna(subset=["lat", "lon"])
    levels = cell_levels(known, max_km) if levels is None else levels
    index = reference_index(known, ref_id, max_km, levels)
    cell = ["level", "cell_lat", "cell_lon"]
    km = geo.haversine_km("lat", "lon", "ref_lat", "ref_lon")
    widths = _widths(max_km, levels)

    places = points.select(F.col(point_id).alias("_id"), "lat", "lon").dropna(subset=["lat", "lon"])
    tried = _in_cell(_at_levels(places, levels), widths).join(index.select(*cell).distinct(), cell)
    # Few bytes a place, but many references to compare it with: dealt anew, or adaptive execution makes one task of them.
    first = tried.groupBy("_id", "lat", "lon").agg(F.max("level").alias("level")).repartition(
        _tasks(points.sparkSession), "_id")
    met = _in_cell(first, widths).join(index, cell)
    bound = met.groupBy("_id", "lat", "lon").agg(F.least(F.min(km), F.lit(float(max_km))).alias("_km"), F.first("level").alias("_level"))
    wide = F.when(F.col("_km") > 0, F.floor(F.log2(F.lit(float(max_km)) / F.col("_km")))).otherwise(F.col("_level"))
    again = bound.withColumn("level", F.greatest(F.lit(0), F.least(F.col("_level"), wide)).cast("int")).drop("_level")
    # Latitudes alone rule most references out, without a sine.
    band = F.abs(F.col("lat") - F.col("ref_lat")) * KM_PER_DEGREE <= F.col("_km") * MARGIN + 1e-9
    near = _in_cell(again, widths).join(index, cell).filter(band) \
        .withColumn("km", km).filter(F.col("km") <= F.col("_km"))
    best = near.groupBy("_id").agg(F.min(F.struct("km", "ref", "ref_lat", "ref_lon")).alias("_best"))
    return points.join(best, points[point_id] == best["_id"], "left").select(
        *points.columns, F.coalesce("_best.ref_lat", "lat").alias("snapped_lat"),
        F.coalesce("_best.ref_lon", "lon").alias("snapped_lon"), F.col("_best.ref").alias("snapped_ref"),
        F.col("_best.km").alias("snap_km"))


def nearest_in_table(points: DataFrame, refs: DataFrame, ref_id: str) -> DataFrame:
    """Add ``ref_id`` of the reference with the smallest squared degree distance, for a table of any size.

    Both sides carry ``lat``/``lon``; ties go to the smaller id, a missing
    coordinate or an empty table gives null. Distinct places search the cell
    they are in and the eight around it, at first with about one reference a
    cell; a place whose best is nearer than a cell's width is done, the others
    go on with cells four times as wide, until none is left. The work follows
    the density around a place, and each round is written to shared storage.
    """
    spark = points.sparkSession
    targets = refs.select(F.col("lat").alias("y"), F.col("lon").alias("x"), F.col(ref_id).alias("ref")).dropna()
    places = points.select("lat", "lon").dropna().distinct()
    area = targets.agg(F.min("y"), F.max("y"), F.min("x"), F.max("x"), F.count("*").alias("n")).first()
    wide = places.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    if not area["n"] or wide[0] is None:
        return points.withColumn(ref_id, F.lit(None).cast(refs.schema[ref_id].dataType))
    span = max(max(area[1], wide[1]) - min(area[0], wide[0]), max(area[3], wide[3]) - min(area[2], wide[2]), 1e-6)
    size, left, done = max(area[1] - area[0], area[3] - area[2], 1e-6) / math.sqrt(area["n"]), places, []
    while True:
        cell = [F.floor(F.col(c) / size).alias(n) for c, n in (("lat", "cy"), ("lon", "cx"))]
        offsets = F.array(*[F.struct((F.floor(F.col("y") / size) + a).alias("cy"), (F.floor(F.col("x") / size) + b).alias("cx"))
                            for a in (-1, 0, 1) for b in (-1, 0, 1)])
        away = (F.col("lat") - F.col("y")) * (F.col("lat") - F.col("y")) + (F.col("lon") - F.col("x")) * (F.col("lon") - F.col("x"))
        met = left.select("lat", "lon", *cell).join(targets.select("y", "x", "ref", F.inline(offsets)), ["cy", "cx"], "left")
        path = work_folder(spark, "nearest")
        met.groupBy("lat", "lon").agg(F.min(F.struct(away.alias("d"), "ref")).alias("best")).write.parquet(path)
        best = spark.read.parquet(path)
        near = F.coalesce(F.col("best.d") <= size * size, F.lit(False)) | F.lit(size > 2 * span)
        done.append(best.filter(near & F.col("best.d").isNotNull()).select("lat", "lon", F.col("best.ref").alias(ref_id)))
        left = best.filter(~near).select("lat", "lon")
        if size > 2 * span or left.isEmpty():
            break
        size *= 4
    found = done[0]
    for part in done[1:]:
        found = found.unionAll(part)
    return points.join(found, ["lat", "lon"], "left").select(*points.columns, ref_id)
