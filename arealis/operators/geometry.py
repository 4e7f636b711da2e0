"""Dissolve, rings, formats and area names of boundary layers.

A layer is a table with ``parts array<array<array<array<double>>>>``: parts of
a multi-polygon, rings of a part (outer ring first), points of a ring.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.operators.overlay import union_outline
from arealis.operators.rings import TILE_EDGES, build_rings, outer_rings
from arealis.operators.sets import stack
from arealis.schemas import GEO_ID
from arealis.session import scratch_path
from arealis.specs import GeometryLevel

def _doubled_area(points: Column) -> Column:
    """Shoelace sum of a closed ring; positive when it runs counter-clockwise."""
    size = F.size(points)
    products = F.zip_with(
        F.slice(points, 1, size - 1),
        F.slice(points, 2, size - 1),
        lambda a, b: a[0] * b[1] - b[0] * a[1],
    )
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def ring_edges(layer: DataFrame, group: list[str], parts: str = "parts") -> DataFrame:
    """Directed edges of all rings with the inside on their left."""
    rings = (
        layer.select(*group, F.explode(parts).alias("rings"))
        .select(*group, F.posexplode("rings").alias("ring_no", "open"))
        .withColumn(
            "points",
            F.when(
                F.element_at("open", 1) == F.element_at("open", -1), F.col("open")
            ).otherwise(F.concat("open", F.slice("open", 1, 1))),
        )
    )
    counter_clockwise = _doubled_area(F.col("points")) > 0
    wanted = F.when(counter_clockwise == (F.col("ring_no") == 0), F.col("points")).otherwise(
        F.reverse("points")
    )
    turned = rings.select(*group, wanted.alias("points"))
    count = F.size("points")
    edges = F.zip_with(
        F.slice("points", 1, count - 1),
        F.slice("points", 2, count - 1),
        lambda a, b: F.struct(
            a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")
        ),
    )
    return turned.select(*group, F.inline(edges)).filter("ax <> bx or ay <> by")


def dissolve_edges(edges: DataFrame, group: list[str]) -> DataFrame:
    """Edges on the outline of each group's union, see :func:`union_outline`."""
    return union_outline(edges, group)


def outline_measures(outline: DataFrame, group: list[str]) -> DataFrame:
    """Area, number of outline edges and bounding box per group, holes subtracted."""
    return outline.groupBy(*group).agg(
        (F.sum(F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")) / 2).alias("area"),
        F.count(F.lit(1)).alias("n_edges"),
        F.min("ax").alias("min_x"),
        F.min("ay").alias("min_y"),
        F.max("ax").alias("max_x"),
        F.max("ay").alias("max_y"),
    )


def ring_table(points: DataFrame, group: list[str]) -> DataFrame:
    """One row per ring: its closed coordinates, area and whether it is a hole."""
    ring = ["r_ax", "r_ay", "r_bx", "r_by"]
    ordered = F.array_sort(F.collect_list(F.struct("seq", "x", "y", "ix", "iy")))
    rings = points.groupBy(*group, *ring).agg(ordered.alias("ordered")).select(
        *group,
        *ring,
        F.transform("ordered", lambda p: F.array(p["x"], p["y"])).alias("open"),
        F.transform("ordered", lambda p: F.struct(p["ix"].alias("x"), p["iy"].alias("y"))).alias("grid_points"),
    )
    closed = rings.withColumn("coordinates", F.concat("open", F.slice("open", 1, 1))).drop("open")
    area = _doubled_area(F.col("coordinates")) / 2
    return closed.withColumn("area", area).withColumn("is_hole", F.col("area") < 0)


def assign_holes(rings: DataFrame, group: list[str]) -> DataFrame:
    """Add ``part``: the name of the outer ring a ring belongs to."""
    named = rings.withColumn("ring", F.struct("r_ax", "r_ay", "r_bx", "r_by"))
    parts = outer_rings(named, group)
    return named.join(parts, [*group, "ring"]).drop("ring", "grid_points")


def assemble_parts(rings: DataFrame, group: list[str]) -> DataFrame:
    """One row per area with its multi-polygon; outer ring first in each part."""
    ordered = F.array_sort(
        F.collect_list(F.struct("is_hole", "r_ax", "r_ay", "r_bx", "r_by", "coordinates"))
    )
    parts = rings.groupBy(*group, "part").agg(
        F.transform(ordered, lambda r: r["coordinates"]).alias("rings")
    )
    all_parts = F.array_sort(F.collect_list(F.struct("part", "rings")))
    return parts.groupBy(*group).agg(F.transform(all_parts, lambda p: p["rings"]).alias("parts"))


def dissolve(
    layer: DataFrame,
    by: str | list[str],
    first_of: list[str] | None = None,
    row_order: str | None = None,
    tile_edges: int = TILE_EDGES,
) -> DataFrame:
    """Union of the areas that share ``by``, with the first of other attributes."""
    group = [by] if isinstance(by, str) else by
    outline = dissolve_edges(ring_edges(layer, group), group)
    rings = ring_table(build_rings(outline, group, tile_edges), group)
    shapes = assemble_parts(assign_holes(rings, group), group)
    if not first_of:
        return shapes
    order = F.col(row_order) if row_order else F.struct(*first_of)
    keyed = layer
    for g in group:
        keyed = keyed.filter(F.col(g).isNotNull())
    firsts = keyed.groupBy(*group).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in first_of]
    )
    return shapes.join(firsts, group)


def dissolve_layers(layers: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """Boundary tables of several layers, each given with its id column.

    All layers go through one dissolve, whose result is written to the shared
    folder once: publishing writes every boundary in more than one format.
    """
    spark = next(iter(layers.values()))[0].sparkSession
    stacked = stack(
        [
            layer.select(
                F.lit(name).alias("layer"), F.col(geo).cast("string").alias(GEO_ID), "parts"
            )
            for name, (layer, geo) in layers.items()
        ]
    )
    path = scratch_path(spark, "boundaries")
    dissolve(stacked, ["layer", GEO_ID]).write.partitionBy("layer").parquet(path)
    dissolved = spark.read.parquet(path)
    return {
        name: dissolved.filter(F.col("layer") == name).select(GEO_ID, "parts") for name in layers
    }


def level_boundaries(layer: DataFrame, level: GeometryLevel) -> DataFrame:
    """Boundary table of one level: exactly ``GEO_ID`` and ``parts``."""
    return dissolve(layer, level.geo_id_column).select(
        F.col(level.geo_id_column).cast("string").alias(GEO_ID), "parts"
    )


def level_names(layer: DataFrame, level: GeometryLevel) -> DataFrame:
    """Names table of one level: ``GEO_ID`` and one column per language."""
    return (
        layer.select(
            F.col(level.geo_id_column).cast("string").alias(GEO_ID),
            *[F.col(c).cast("string").alias(code) for code, c in level.name_columns.items()],
        )
        .filter(F.col(GEO_ID).isNotNull())
        .distinct()
    )


def geojson_feature(parts: Column, properties: dict[str, Column]) -> Column:
    """GeoJSON feature text; one part is written as a polygon."""
    shown = F.struct(*[c.alias(n) for n, c in properties.items()])

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                shown.alias("properties"),
                geometry.alias("geometry"),
            ),
            {"ignoreNullFields": "false"},
        )

    return F.when(F.size(parts) == 1, feature("Polygon", parts[0])).otherwise(
        feature("MultiPolygon", parts)
    )


def _wkb(parts) -> bytes | None:
    """Little-endian WKB multi-polygon; no geometry, no bytes."""
    if parts is None:
        return None
    out = [struct.pack("<BII", 1, 6, len(parts))]
    for rings in parts:
        out.append(struct.pack("<BII", 1, 3, len(rings)))
        for ring in rings:
            flat = [v for point in ring for v in point]
            out.append(struct.pack(f"<I{len(flat)}d", len(ring), *flat))
    return b"".join(out)


@F.pandas_udf(T.BinaryType())
def to_wkb(parts: pd.Series) -> pd.Series:
    return parts.map(_wkb)

