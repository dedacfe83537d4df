"""Boundaries: exterior rings of GeoJSON features as rows of vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = T.ArrayType(T.DoubleType())
_RING = T.ArrayType(_POINT)
_GEOMETRY = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
FEATURE = T.StructType(
    [
        T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField(
            "geometry",
            T.StructType([*_GEOMETRY.fields, T.StructField("geometries", T.ArrayType(_GEOMETRY))]),
        ),
    ]
)
COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])


def _exterior(kind: Column, coordinates: Column) -> Column:
    """Exterior rings of one plain geometry: the first ring of every polygon, holes ignored."""
    polygon = F.from_json(coordinates, T.ArrayType(_RING))
    multi = F.from_json(coordinates, T.ArrayType(T.ArrayType(_RING)))
    return (
        F.when(kind == "Polygon", F.array(F.get(polygon, F.lit(0))))
        .when(kind == "MultiPolygon", F.transform(multi, lambda p: F.get(p, F.lit(0))))
        .otherwise(F.array().cast(T.ArrayType(_RING)))
    )


def parse_collections(df: DataFrame, text: str) -> DataFrame:
    """One row per feature from a column of FeatureCollection texts."""
    parsed = df.select(F.from_json(F.col(text), COLLECTION).alias("c"))
    return parsed.select(F.explode("c.features").alias("f")).select(
        F.col("f.properties.name").alias("name"), F.col("f.geometry").alias("geometry")
    )


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON files; each file is one document."""
    return parse_collections(spark.read.text(path, wholetext=True), "value")


def rings(features: DataFrame) -> DataFrame:
    """Exterior rings, numbered per feature: Polygon, MultiPolygon, and a collection of those."""
    g = F.col("geometry")
    members = F.flatten(
        F.transform(
            F.coalesce(g["geometries"], F.array().cast(T.ArrayType(_GEOMETRY))),
            lambda m: _exterior(m["type"], m["coordinates"]),
        )
    )
    found = F.when(g["type"] == "GeometryCollection", members).otherwise(_exterior(g["type"], g["coordinates"]))
    return features.select("name", F.posexplode(found).alias("ring", "vertices"))


def vertices(ring_rows: DataFrame) -> DataFrame:
    return ring_rows.select("name", "ring", F.posexplode("vertices").alias("place", "p")).select(
        "name", "ring", "place", F.get("p", F.lit(0)).alias("lon"), F.get("p", F.lit(1)).alias("lat")
    )


def ring_anchors(ring_rows: DataFrame) -> DataFrame:
    """Label point of a feature: the mean vertex of its first ring."""
    return (
        vertices(ring_rows.where("ring = 0")).groupBy("name")
        .agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("n_vertices"))
    )


def padded_box(ring_rows: DataFrame, pad: float = 0.04) -> DataFrame:
    """Bounding box of all rings, widened by a share of its size on every side."""
    x, y = F.col("lon"), F.col("lat")
    box = vertices(ring_rows).agg(
        F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")
    )
    dx, dy = (F.col("x1") - F.col("x0")) * pad, (F.col("y1") - F.col("y0")) * pad
    return box.select(
        (F.col("x0") - dx).alias("x_min"), (F.col("x1") + dx).alias("x_max"),
        (F.col("y0") - dy).alias("y_min"), (F.col("y1") + dy).alias("y_max"),
    )
