"""Open boundary datasets of Great Britain: dataset list and boundary layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.operators.quality import profile
from arealis.operators.sets import stack
from arealis.sources import boundaries
from arealis.sources.landed import with_dataset_name

_DOWNLOADS = "https://api.os.uk/downloads/v1/products/"
_PAGES = "https://osdatahub.os.uk/downloads/open/"

# Description, product name and format; no format means there is
# no single download.
DATASETS = [
    ("1:250 000 Scale Colour Raster", "250kScaleColourRaster", "TIFF-LZW"),
    ("Boundary-Line", "BoundaryLine", "GeoPackage"),
    ("Code-Point® Open", "CodePointOpen", "GeoPackage"),
    ("GB Overview Maps", "GBOverviewMaps", "GeoTIFF&subformat=Full+Colour"),
    ("MiniScale®", "MiniScale", "Zip+file+%28containing+EPS%2C+Illustrator+and+TIFF-LZW%29"),
    ("OS Open Built Up Areas", "BuiltUpAreas", "GeoPackage"),
    ("OS Open Greenspace", "OpenGreenspace", "GeoPackage"),
    ("OS Open Linked Identifiers", "LIDS", None),
    ("OS Open Names", "OpenNames", "GeoPackage"),
    ("OS Open Rivers", "OpenRivers", "GeoPackage"),
    ("OS Open Roads", "OpenRoads", "GeoPackage"),
    ("OS Open TOID", "OpenTOID", None),
    ("OS Open UPRN", "OpenUPRN", "GeoPackage"),
    ("OS Open USRN", "OpenUSRN", "GeoPackage"),
    ("OS Open Zoomstack", "OpenZoomstack", "GeoPackage"),
    ("OS OpenMap - Local", "OpenMapLocal", "GeoPackage"),
    ("OS Terrain® 50", "Terrain50", "GeoPackage"),
    ("OS VectorMap® District", "VectorMapDistrict", "GeoPackage"),
]

# Layers of the boundary dataset.
LAYERS = [
    "boundary_line_ceremonial_counties",
    "boundary_line_historic_counties",
    "community_ward",
    "country_region",
    "county",
    "county_electoral_division",
    "district_borough_unitary",
    "district_borough_unitary_ward",
    "english_region",
    "greater_london_const",
    "high_water",
    "historic_european_region",
    "parish",
    "polling_districts_england",
    "scotland_and_wales_const",
    "scotland_and_wales_region",
    "unitary_electoral_division",
    "westminster_const",
]


def datasets(spark: SparkSession) -> DataFrame:
    """All datasets with the slug they are picked by."""
    listed = spark.createDataFrame(DATASETS, "description string, product string, format string")
    query = F.concat(F.lit("/downloads?area=GB&format="), "format", F.lit("&redirect"))
    return with_dataset_name(
        listed.select(
            "description",
            F.concat(F.lit(_DOWNLOADS), "product", query).alias("download_url"),
            F.concat(F.lit(_PAGES), "product").alias("landpage_url"),
        )
    )


def read_layers(spark: SparkSession, landed: str, expected: list[str] = LAYERS) -> DataFrame:
    """All layers of a landed dataset in one table with a ``layer`` column.

    Landed as ``layer=<name>/*.geojsonseq``; the layer names must be exactly
    the expected ones.
    """
    lines = spark.read.option("basePath", landed).text(f"{landed}/layer=*")
    boundaries.require_layers(lines.select("layer").distinct(), expected)
    return lines.filter(F.trim("value") != "").select(
        "layer", boundaries.parse_feature(F.replace("value", F.lit("\u001e"), F.lit(""))).alias("f")
    ).select("layer", "f.properties", "f.parts")


def layer_profiles(layers: DataFrame, names: list[str]) -> DataFrame:
    """Record count per layer."""
    return stack([profile(layers.filter(F.col("layer") == n).drop("layer"), n) for n in names])
