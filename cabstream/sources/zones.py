"""The zone dimension: loading, adjacency edges and the search path of a zone."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Zone(NamedTuple):
    zone_id: int
    zone_name: str
    zone_type: str
    population_density: int
    centroid_lat: float
    centroid_lon: float
    adjacency: tuple[int, ...]


# The city's 16 zones.
CITY = "casablanca"
CITY_ZONES: tuple[Zone, ...] = (
    Zone(1, "Anfa", "commercial", 8000, 33.593, -7.632, (2, 3, 9)),
    Zone(2, "Maarif", "commercial", 15000, 33.585, -7.640, (1, 5, 9, 14)),
    Zone(3, "Sidi Belyout", "commercial", 9500, 33.592, -7.618, (1, 5, 7, 8)),
    Zone(4, "El Fida", "residential", 35000, 33.570, -7.608, (5, 13, 14)),
    Zone(5, "Mers Sultan", "residential", 30000, 33.575, -7.612, (3, 4, 8, 13)),
    Zone(6, "Ain Sebaa", "industrial", 10000, 33.606, -7.540, (7, 11, 12)),
    Zone(7, "Hay Mohammadi", "residential", 40000, 33.596, -7.570, (3, 6, 8, 12)),
    Zone(8, "Roches Noires", "industrial", 12000, 33.600, -7.585, (3, 5, 7, 13)),
    Zone(9, "Hay Hassani", "residential", 22000, 33.560, -7.675, (1, 2, 10, 14)),
    Zone(10, "Ain Chock", "transit_hub", 18000, 33.542, -7.614, (9, 14, 15, 16)),
    Zone(11, "Sidi Bernoussi", "industrial", 16000, 33.590, -7.490, (6, 12)),
    Zone(12, "Sidi Moumen", "residential", 25000, 33.575, -7.525, (6, 7, 11, 15, 16)),
    Zone(13, "Ben M'Sick", "residential", 38000, 33.555, -7.580, (4, 5, 8, 14, 16)),
    Zone(14, "Sbata", "residential", 34000, 33.550, -7.590, (2, 4, 9, 10, 13)),
    Zone(15, "Moulay Rachid", "residential", 28000, 33.540, -7.550, (10, 12, 16)),
    Zone(16, "Sidi Othmane", "residential", 26000, 33.545, -7.570, (10, 12, 13, 15)),
)


def zones_df(spark: SparkSession, zones: Sequence[Zone] = CITY_ZONES) -> DataFrame:
    """Zones as a local relation, whose size Spark knows when planning a join."""
    kinds = (pa.int32(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.float64(),
             pa.list_(pa.int32()))
    columns = zip(*[tuple(z) for z in zones], strict=True)
    arrays = [pa.array([list(v) if isinstance(v, tuple) else v for v in col], kind)
              for col, kind in zip(columns, kinds, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(Zone._fields)))


def load_zones(spark: SparkSession, path: str) -> DataFrame:
    """Read a zone CSV whose adjacency column is quoted text such as ``"[2, 3, 9]"``."""
    raw = (
        spark.read.option("header", True).option("quote", '"')
        .schema("zone_id INT, zone_name STRING, zone_type STRING, population_density INT, "
                "centroid_lat DOUBLE, centroid_lon DOUBLE, adjacency_list STRING")
        .csv(path)
    )
    return raw.withColumn(
        "adjacency", F.coalesce(F.from_json("adjacency_list", "array<int>"),
                                F.array().cast("array<int>"))
    ).drop("adjacency_list")


def zone_list(zones: DataFrame) -> list[Zone]:
    """The zones of one city as a list, for literal expressions.

    A dimension of any other size stays a table: ``snapping.nearest_in_table``
    finds nearest zones there and joins look up attributes.
    """
    rows = zones.orderBy("zone_id").collect()
    return [Zone(r.zone_id, r.zone_name, r.zone_type, r.population_density, r.centroid_lat,
                 r.centroid_lon, tuple(r.adjacency or ())) for r in rows]


def search_path(zone_id: Column | str, adjacency: Column | str) -> Column:
    """Zones to look for a vehicle in: the own zone, then its neighbours in list order."""
    zone_id = F.col(zone_id) if isinstance(zone_id, str) else zone_id
    adjacency = F.col(adjacency) if isinstance(adjacency, str) else adjacency
    none = F.array().cast("array<int>")
    return F.array_distinct(F.concat(F.array(zone_id.cast("int")), F.coalesce(adjacency, none)))


def zone_edges(zones: DataFrame) -> DataFrame:
    """``(zone_id, search_order, neighbour_id)``; order 0 is the zone itself."""
    return zones.select(
        "zone_id",
        F.posexplode(search_path("zone_id", "adjacency")).alias("search_order", "neighbour_id"),
    )
