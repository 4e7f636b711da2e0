"""Published column names and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

GEO_ID = "GEO_ID"

_S, _D = T.StringType(), T.DateType()

# Field name, published column name and type of the five
# metadata tables.  Computed columns carry no field name.
COUNTRY_FIELDS = [
    ("name_short_en", "country_name_short_en", _S),
    ("name_official", "country_name_official", _S),
    ("iso3", "country_iso3", _S),
    ("iso2", "country_iso2", _S),
    ("iso3166_2", "country_iso3166_2", _S),
]
PUBLISHER_FIELDS = [
    ("name", "data_publisher_name", _S),
    ("url", "data_publisher_url", _S),
    ("description", "data_publisher_description", _S),
    ("countries_of_interest", "data_publisher_countries_of_interest", T.ArrayType(_S)),
]
GEOMETRY_FIELDS = [
    ("validity_period_start", "geometry_validity_period_start", _D),
    ("validity_period_end", "geometry_validity_period_end", _D),
    ("level", "geometry_level", _S),
    ("hxl_tag", "geometry_hxl_tag", _S),
]
RELEASE_FIELDS = [
    ("name", "source_data_release_name", _S),
    ("date_published", "source_data_release_date_published", _D),
    ("reference_period_start", "source_data_release_reference_period_start", _D),
    ("reference_period_end", "source_data_release_reference_period_end", _D),
    ("collection_period_start", "source_data_release_collection_period_start", _D),
    ("collection_period_end", "source_data_release_collection_period_end", _D),
    ("expect_next_update", "source_data_release_expect_next_update", _D),
    ("url", "source_data_release_url", _S),
    ("data_publisher_id", "source_data_release_data_publisher_id", _S),
    ("description", "source_data_release_description", _S),
    ("geometry_metadata_id", "source_data_release_geometry_metadata_id", _S),
]
METRIC_FIELDS = [
    ("human_readable_name", "metric_human_readable_name", _S),
    ("source_metric_id", "metric_source_id", _S),
    ("description", "metric_description", _S),
    ("hxl_tag", "metric_hxl_tag", _S),
    ("metric_parquet_path", "metric_parquet_path", _S),
    ("parquet_column_name", "metric_parquet_column_name", _S),
    ("parquet_margin_of_error_column", "metric_parquet_margin_of_error_column", _S),
    ("parquet_margin_of_error_file", "metric_parquet_margin_of_error_file", _S),
    ("potential_denominator_ids", "metric_potential_denominator_ids", T.ArrayType(_S)),
    ("parent_metric_id", "metric_parent_metric_id", _S),
    ("source_data_release_id", "metric_source_data_release_id", _S),
    ("source_download_url", "metric_source_download_url", _S),
    ("source_archive_file_path", "metric_source_archive_file_path", _S),
    ("source_documentation_url", "metric_source_documentation_url", _S),
]

#: kind -> (computed columns, described fields)
TABLES = {
    "country": (["country_id"], COUNTRY_FIELDS),
    "publisher": (["data_publisher_id"], PUBLISHER_FIELDS),
    "geometry": (["geometry_id", "geometry_filepath_stem"], GEOMETRY_FIELDS),
    "release": (["source_data_release_id"], RELEASE_FIELDS),
    "metric": (["metric_id"], METRIC_FIELDS),
}

#: kind -> file name under the country folder
FILE_NAMES = {
    "country": "country_metadata.parquet",
    "publisher": "data_publishers.parquet",
    "geometry": "geometry_metadata.parquet",
    "release": "source_data_releases.parquet",
    "metric": "metric_metadata.parquet",
}


def field_schema(kind: str) -> T.StructType:
    """Schema of incoming records, with field names."""
    return T.StructType([T.StructField(f, t, True) for f, _, t in TABLES[kind][1]])


def published_schema(kind: str) -> T.StructType:
    """Schema of the published table, computed columns first."""
    computed, fields = TABLES[kind]
    return T.StructType(
        [T.StructField(c, _S, True) for c in computed]
        + [T.StructField(p, t, True) for _, p, t in fields]
    )


def published_names(kind: str) -> dict[str, str]:
    """Field name -> published column name."""
    return {f: p for f, p, _ in TABLES[kind][1]}


TRIPLE_SCHEMA = T.StructType(
    [T.StructField(c, _S, True) for c in ("s", "p", "o", "lang", "datatype")]
)

MATERIALISATION_SCHEMA = T.StructType(
    [
        T.StructField("asset_key", _S, True),
        T.StructField("partition", _S, True),
        T.StructField("run_id", _S, True),
        T.StructField("ts", T.TimestampType(), True),
    ]
)
