"""Point-of-interest counting and radius catchment (range join)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from citymarts.operators.joins import bounded_broadcast

EARTH_RADIUS_M = 6371000.0

# The OSM tag tests behind each infrastructure count.
# (output column, tag key, tag value); a node is tested against every entry,
# so one node tagged highway=bus_stop and amenity=fuel counts in both.
POI_TAGS = [
    ("bus_stops", "highway", "bus_stop"),
    ("transit_stations", "amenity", "bus_station"),
    ("fuel_stations_total", "amenity", "fuel"),
    ("commercial_banks", "amenity", "bank"),
    ("commercial_marketplaces", "amenity", "marketplace"),
]

_ELEMENTS = ArrayType(StructType([StructField("tags", MapType(StringType(), StringType()), True)]))


def _tag_test(key: str, value: str):
    def test(e):
        return F.coalesce(e["tags"][key] == F.lit(value), F.lit(False))

    return test


def poi_counts(df: DataFrame, json_col: str, keep: Sequence[str] = (), path: str = "$.elements") -> DataFrame:
    """Count tagged elements of each payload's ``elements[]`` array.

    Counting uses higher-order ``filter`` on the parsed array inside the row,
    so there is no explode and no shuffle. Adds the derived totals
    ``transit_nodes_total`` and ``commercial_nodes_total``.
    """
    elements = F.coalesce(
        F.from_json(F.get_json_object(F.col(json_col), path), _ELEMENTS), F.array().cast(_ELEMENTS)
    )
    parsed = df.select(*keep, elements.alias("_elements"))  # parse once, count five times
    counts = [
        F.size(F.filter(F.col("_elements"), _tag_test(k, v))).cast("bigint").alias(name) for name, k, v in POI_TAGS
    ]
    out = parsed.select(*keep, *counts)
    return out.withColumn("transit_nodes_total", F.col("bus_stops") + F.col("transit_stations")).withColumn(
        "commercial_nodes_total", F.col("commercial_banks") + F.col("commercial_marketplaces")
    )


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi, dlmb = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def radius_catchment(
    points: DataFrame,
    centres: DataFrame,
    radius_m: float,
    point_lat: str = "lat",
    point_lon: str = "lon",
    centre_id: str = "city_id",
    centre_lat: str = "latitude",
    centre_lon: str = "longitude",
    max_centres: int = 100_000,
) -> DataFrame:
    """Points within ``radius_m`` of each centre, with their distance.

    A grid range join: points get one cell id (cell side = the radius in
    latitude degrees); each centre is expanded to the cells its bounding box
    touches (longitude span widened by 1/cos(latitude)). The equi-join on the
    cell replaces a cross join; the exact haversine test then drops the
    corners. Only candidates inside a centre's box are ever paired.

    A box that crosses longitude +-180 is also laid out shifted by 360
    degrees, so it covers the cells on the other side of the date line; the
    (centre, cell) list is made distinct, so a point (one cell) meets each
    centre at most once.
    """
    cell = radius_m / (math.pi * EARTH_RADIUS_M / 180.0)  # degrees of latitude per radius
    lat, lon = F.col(centre_lat), F.col(centre_lon)
    edge_lat = F.least(F.lit(89.999), F.abs(lat) + F.lit(cell))
    dlon = F.least(F.lit(180.0), F.lit(cell) / F.cos(F.radians(edge_lat)))
    shifted = centres.select(
        F.col(centre_id).alias("_cid"),
        lat.alias("_clat"),
        lon.alias("_clon"),
        dlon.alias("_dlon"),
        F.explode(F.transform(F.array(F.lit(0.0), F.lit(-360.0), F.lit(360.0)), lambda s: lon + s)).alias("_blon"),
    ).where((F.col("_blon") - F.col("_dlon") <= 180.0) & (F.col("_blon") + F.col("_dlon") >= -180.0))
    blon, bdlon = F.col("_blon"), F.col("_dlon")
    cells = (
        shifted.select(
            "_cid",
            "_clat",
            "_clon",
            F.explode(F.sequence(F.floor((F.col("_clat") - cell) / cell), F.floor((F.col("_clat") + cell) / cell))).alias(
                "_glat"
            ),
            F.sequence(F.floor((blon - bdlon) / cell), F.floor((blon + bdlon) / cell)).alias("_glons"),
        )
        .select("_cid", "_clat", "_clon", "_glat", F.explode("_glons").alias("_glon"))
        .dropDuplicates(["_cid", "_glat", "_glon"])
    )
    cells = bounded_broadcast(cells, max_centres * 16)
    pts = points.withColumn("_glat", F.floor(F.col(point_lat) / cell)).withColumn(
        "_glon", F.floor(F.col(point_lon) / cell)
    )
    joined = pts.join(cells, ["_glat", "_glon"], "inner")
    dist = haversine_m(F.col(point_lat), F.col(point_lon), F.col("_clat"), F.col("_clon"))
    return (
        joined.withColumn("distance_m", dist)
        .where(F.col("distance_m") <= F.lit(float(radius_m)))
        .withColumnRenamed("_cid", centre_id)
        .drop("_glat", "_glon", "_clat", "_clon")
    )
