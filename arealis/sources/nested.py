"""Nested JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.codes import age_band, count_from_text
from arealis.functions.urls import with_level_parameter

ROW_SCHEMA = (
    "array<struct<rowNo:string,rowText:string,columns:array<struct<key:string,"
    "columns:array<struct<key:string,value:string>>>>>>"
)


def nested_rows(documents: DataFrame, text: str, path: str = "$.Data.row") -> DataFrame:
    """``row -> columns -> columns`` documents as flat ``(row_no, row_text, outer, inner, value)``."""
    rows = F.from_json(F.get_json_object(F.col(text), path), ROW_SCHEMA)
    return (
        documents.select(F.inline(rows))
        .select("rowNo", "rowText", F.inline("columns"))
        .select(
            F.col("rowNo").alias("row_no"),
            F.col("rowText").alias("row_text"),
            F.col("key").alias("outer_key"),
            F.inline("columns"),
        )
        .select("row_no", "row_text", "outer_key", F.col("key").alias("inner_key"), "value")
    )


def subzone_population(documents: DataFrame, text: str = "value") -> DataFrame:
    """Population per subzone, gender and age band; regions (``1``) are left out."""
    rows = nested_rows(documents, text).filter(F.col("row_no").rlike(r"^\d+\.\d+$"))
    band = age_band(F.col("inner_key"))
    return rows.select(
        F.upper("row_text").alias("subzone"),
        F.col("outer_key").alias("gender"),
        band["age_min"].alias("age_min"),
        band["age_max"].alias("age_max"),
        count_from_text(F.col("value")).alias("population"),
    )


def table_metadata(document: Column) -> dict[str, Column]:
    """Catalogue fields out of a table metadata document."""
    title = F.get_json_object(document, "$['dc:title']")
    return {
        "table_id": F.substring_index(title, ":", 1),
        "human_readable_name": title,
        "description": F.get_json_object(document, "$['dc:description']"),
        "url": F.get_json_object(document, "$.url"),
        "table_schema": F.get_json_object(document, "$.tableSchema"),
    }


def level_catalogue(documents: DataFrame, levels: list[str], text: str = "value") -> DataFrame:
    """Catalogue of table metadata documents times geography levels."""
    fields = documents.select(
        F.col("url").alias("node"),
        *[c.alias(n if n != "url" else "table_url") for n, c in table_metadata(F.col(text)).items()],
    )
    expanded = fields.withColumn("geo_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    return expanded.select(
        "node",
        "table_id",
        "geo_level",
        F.concat_ws("/", "geo_level", "table_id").alias("partition_key"),
        "human_readable_name",
        "description",
        with_level_parameter(F.col("table_url"), F.col("geo_level")).alias("source_download_url"),
        F.col("node").alias("source_documentation_url"),
        "table_schema",
    )
