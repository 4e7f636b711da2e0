"""Boundary layers from landed GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.operators.sets import require_equal_sets

_PROPERTIES = T.MapType(T.StringType(), T.StringType())
_POINT = T.ArrayType(T.DoubleType())
_RING = T.ArrayType(_POINT)


def parse_feature(feature: Column) -> Column:
    """GeoJSON feature text -> ``(properties map, parts array<array<ring>>)``.

    A polygon becomes a multi-polygon with one part.
    """
    kind = F.get_json_object(feature, "$.geometry.type")
    coordinates = F.get_json_object(feature, "$.geometry.coordinates")
    many = F.from_json(coordinates, T.ArrayType(T.ArrayType(_RING)))
    one = F.array(F.from_json(coordinates, T.ArrayType(_RING)))
    parts = F.when(kind == "MultiPolygon", many).when(kind == "Polygon", one)
    properties = F.from_json(F.get_json_object(feature, "$.properties"), _PROPERTIES)
    return F.struct(properties.alias("properties"), parts.alias("parts"))


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON text sequence: one feature per line, so files split across tasks."""
    return features_from_text(spark.read.text(path), "value")


def features_from_text(df: DataFrame, text: str) -> DataFrame:
    clean = F.replace(F.col(text), F.lit("\u001e"), F.lit(""))
    return (
        df.filter(F.trim(F.col(text)) != "")
        .select(parse_feature(clean).alias("f"))
        .select("f.properties", "f.parts")
    )


def read_feature_collections(spark: SparkSession, path: str) -> DataFrame:
    """Whole GeoJSON documents, one per file."""
    documents = spark.read.text(path, wholetext=True)
    return features_from_collections(documents, "value")


def features_from_collections(df: DataFrame, text: str) -> DataFrame:
    features = F.from_json(
        F.get_json_object(F.col(text), "$.features"), T.ArrayType(T.StringType())
    )
    return features_from_text(df.select(F.explode(features).alias("feature")), "feature")


def with_properties(features: DataFrame, names: list[str]) -> DataFrame:
    """Named properties as columns, next to ``parts``."""
    return features.select(*[F.col("properties")[n].alias(n) for n in names], "parts")


def require_layers(found: DataFrame, expected: list[str], name: str = "layer") -> None:
    """Raise unless the layer names are exactly the expected ones."""
    spark = found.sparkSession
    listed = spark.createDataFrame([(e,) for e in expected], f"{name} string")
    require_equal_sets(listed, found.select(name).distinct(), name)


def described_attributes(description: Column, names: list[str]) -> dict[str, Column]:
    """Cells next to the named headings of an HTML table in a description field; empty if there is none."""
    pair = F.lit(r"<th>([^<]*)</th>\s*<td>([^<]*)</td>")
    headings, cells = (F.regexp_extract_all(description, pair, F.lit(k)) for k in (1, 2))
    return {
        n: F.coalesce(F.get(cells, (F.array_position(headings, n) - 1).cast("int")), F.lit(""))
        for n in names
    }
