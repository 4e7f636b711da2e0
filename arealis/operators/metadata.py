"""The five linked metadata tables."""

from __future__ import annotations

from dataclasses import asdict
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.codes import column_to_variable, variable_to_column
from arealis.functions.ids import content_id, country_id, geometry_path_stem
from arealis.functions.text import (
    human_name,
    hxl_population_tag,
    hxl_universe_tag,
    join_key,
    key_value_description,
    survey_human_name,
)
from arealis.operators.columns import quoted
from arealis.operators.joins import lookup_or_default
from arealis.schemas import METRIC_FIELDS, TABLES, field_schema, published_names, published_schema
from arealis.specs import CountryRecord, DerivedMetric, GeometryLevel, PublisherRecord, ReleaseTemplate


def publish_names(kind: str, df: DataFrame) -> DataFrame:
    """Rows with field names -> published table with its content id.

    The id covers the described fields under their field names, nulls included.
    Absent fields are null.
    """
    fields = TABLES[kind][1]
    present = set(df.columns)
    values = {
        f: (F.col(f) if f in present else F.lit(None)).cast(t) for f, _, t in fields
    }
    names = published_names(kind)
    described = [values[f].alias(names[f]) for f in values]
    computed = {
        "country": lambda: {
            "country_id": country_id(values["iso3166_2"], values["iso3"])
        },
        "publisher": lambda: {"data_publisher_id": content_id(values)},
        "geometry": lambda: {
            "geometry_id": content_id(values),
            "geometry_filepath_stem": geometry_path_stem(
                F.col("country_id"), values["level"], values["validity_period_start"]
            ),
        },
        "release": lambda: {"source_data_release_id": content_id(values)},
        "metric": lambda: {"metric_id": content_id(values)},
    }[kind]()
    out = df.select(*[c.alias(n) for n, c in computed.items()], *described)
    return out.to(published_schema(kind))


def from_records(spark: SparkSession, kind: str, records: list[dict]) -> DataFrame:
    """A non-empty list of records of one kind -> published table."""
    if not records:
        raise ValueError(f"no {kind} records")
    schema = field_schema(kind)
    if kind == "geometry":
        schema = schema.add("country_id", "string")
    rows = [tuple(r.get(f.name) for f in schema) for r in records]
    return publish_names(kind, spark.createDataFrame(rows, schema))


def country_table(spark: SparkSession, country: CountryRecord) -> DataFrame:
    return from_records(spark, "country", [asdict(country)])


def publisher_table(spark: SparkSession, publisher: PublisherRecord) -> DataFrame:
    record = {**asdict(publisher), "countries_of_interest": list(publisher.countries_of_interest)}
    return from_records(spark, "publisher", [record])


def geometry_table(
    spark: SparkSession, country: str, levels: list[GeometryLevel], start: date, end: date
) -> DataFrame:
    return from_records(
        spark,
        "geometry",
        [
            {
                "country_id": country,
                "validity_period_start": start,
                "validity_period_end": end,
                "level": level.level,
                "hxl_tag": level.hxl_tag,
            }
            for level in levels
        ],
    )


def release_rows(
    geometries: DataFrame, templates: list[ReleaseTemplate], publisher_id: Column | str
) -> DataFrame:
    """One release per geometry and template, with ``release_key`` and ``geometry_level``.

    Templates are a fixed list, so they ride along as an exploded constant.
    """
    publisher = F.lit(publisher_id) if isinstance(publisher_id, str) else publisher_id
    structs = [
        F.struct(
            F.lit(t.key).alias("release_key"),
            F.lit(t.name).alias("name"),
            *[
                F.lit(getattr(t, d)).cast("date").alias(d)
                for d in (
                    "date_published",
                    "reference_period_start",
                    "reference_period_end",
                    "collection_period_start",
                    "collection_period_end",
                    "expect_next_update",
                )
            ],
            F.lit(t.url).alias("url"),
            F.lit(t.description).alias("description"),
        )
        for t in templates
    ]
    rows = geometries.select(
        "geometry_level",
        F.col("geometry_id").alias("geometry_metadata_id"),
        publisher.alias("data_publisher_id"),
        F.explode(F.array(*structs)).alias("t"),
    ).select("geometry_level", "geometry_metadata_id", "data_publisher_id", "t.*")
    values = {f.name: F.col(f.name) for f in field_schema("release")}
    names = published_names("release")
    return rows.select(
        "release_key",
        "geometry_level",
        content_id(values).alias("source_data_release_id"),
        *[c.alias(names[f]) for f, c in values.items()],
    )


def valid_periods(releases: DataFrame) -> Column:
    """Both periods of a release start on or before they end."""
    p = "source_data_release_"
    return F.coalesce(
        (F.col(p + "reference_period_start") <= F.col(p + "reference_period_end"))
        & (F.col(p + "collection_period_start") <= F.col(p + "collection_period_end")),
        F.lit(False),
    )


def source_metric_rows(
    catalogue: DataFrame, releases: DataFrame, on: list[str], overrides: dict[str, Column]
) -> DataFrame:
    """Template metric per catalogue row: names and urls from the catalogue, release by key."""
    joined = catalogue.join(releases.select(*on, "source_data_release_id"), on)
    fields = {
        "parent_metric_id": F.lit("unknown_at_this_stage"),
        "metric_parquet_path": F.lit("unknown_at_this_stage"),
        **overrides,
    }
    return joined.withColumns(fields)


def metric_rows_from_keys(
    df: DataFrame, keys: list[str], path: Column, parent: Column, separator: str = "_",
    key_names: list[str] | None = None,
) -> DataFrame:
    """One metadata row per key combination: column name, tag, readable name.

    Comes from the distinct keys of the long table; the pivoted names are never
    split again.
    """
    columns = [F.col(quoted(k)) for k in keys]
    names = key_names or keys
    rows = df.select(*columns).distinct()
    for k in keys:
        rows = rows.filter(F.col(quoted(k)).isNotNull())
    return rows.select(
        join_key(*columns, separator=separator).alias("parquet_column_name"),
        hxl_population_tag(names, columns).alias("hxl_tag"),
        human_name(names, columns).alias("human_readable_name"),
        path.alias("metric_parquet_path"),
        parent.alias("parent_metric_id"),
    )


def metric_rows_from_templates(
    df: DataFrame, keys: list[str], name_sql: str, tag_sql: str, path: Column, parent: Column,
    separator: str = "_",
) -> DataFrame:
    """As above, with readable name and tag given as SQL over the key columns."""
    columns = [F.col(quoted(k)) for k in keys]
    rows = df.select(*columns).distinct()
    for k in keys:
        rows = rows.filter(F.col(quoted(k)).isNotNull())
    return rows.select(
        join_key(*columns, separator=separator).alias("parquet_column_name"),
        F.expr(tag_sql).alias("hxl_tag"),
        F.expr(name_sql).alias("human_readable_name"),
        path.alias("metric_parquet_path"),
        parent.alias("parent_metric_id"),
    )


def metric_rows_from_specs(
    spark: SparkSession, specs: list[DerivedMetric], path: str, parent: str | None
) -> DataFrame:
    """One metadata row per derived metric."""
    return spark.createDataFrame(
        [(s.name, s.hxl_tag, s.label, path, parent) for s in specs],
        "parquet_column_name string, hxl_tag string, human_readable_name string, "
        "metric_parquet_path string, parent_metric_id string",
    )


def metric_rows_from_columns(df: DataFrame, path: str, parent: str, geo: str = "GEO_ID") -> DataFrame:
    """One metadata row per existing column, details unknown."""
    columns = [c for c in df.columns if c != geo]
    return df.sparkSession.createDataFrame(
        [(c, "#population+details_unknown", c, path, parent) for c in columns],
        "parquet_column_name string, hxl_tag string, human_readable_name string, "
        "metric_parquet_path string, parent_metric_id string",
    )


def survey_metric_rows(
    columns: DataFrame, dictionary: DataFrame, table_urls: DataFrame, year: str, period: str
) -> DataFrame:
    """Metadata of survey estimate columns from the variable dictionary.

    ``columns`` has ``parquet_column_name``; ``table_urls`` gives the download
    url per table id, ``TBD`` when a table is not listed.  The margin column is
    the ``M`` twin of the estimate, in the same file.  A column whose variable
    the dictionary lacks is an error.
    """
    variable = column_to_variable(F.col("parquet_column_name"))
    facts = ["table_id", "unique_id", "universe", "table_name", "variable_name", "variable_extended_name"]
    joined = columns.withColumns(
        {"unique_id": variable, "url_table": F.substring_index("parquet_column_name", "_", 1)}
    ).join(dictionary.select(*facts, F.lit(True).alias("_known")), "unique_id", "left")
    joined = joined.withColumn(
        "unique_id",
        F.when(F.col("_known"), F.col("unique_id")).otherwise(
            F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col("parquet_column_name"))).cast("string")
        ),
    ).drop("_known")
    located = lookup_or_default(joined, table_urls, ["url_table"], "source_download_url")
    return located.select(
        "parquet_column_name",
        survey_human_name(
            F.col("universe"), F.col("table_name"), F.lit(year), F.lit(period), F.col("variable_name")
        ).alias("human_readable_name"),
        key_value_description(facts, [F.col(f) for f in facts]).alias("description"),
        hxl_universe_tag(F.col("universe"), F.col("variable_extended_name")).alias("hxl_tag"),
        variable_to_column(F.col("unique_id"), "M").alias("parquet_margin_of_error_column"),
        F.lit("TBD").alias("source_metric_id"),
        "source_download_url",
        F.lit("TBD").alias("source_documentation_url"),
    )


def complete_metric_rows(rows: DataFrame, source: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Fill metric rows from the source template and publish them with ids.

    Columns the rows already have win.  Without ``on`` the template is a single
    row, read once and added as constants.
    """
    fields = [f for f, _, _ in METRIC_FIELDS]
    if on is None:
        template = source.limit(2).collect()
        if len(template) != 1:
            raise ValueError(f"expected one source template, found {len(template)} rows or more")
        known = template[0].asDict()
        types = {f.name: f.dataType for f in source.schema}
        filled = rows.withColumns(
            {
                f: _constant(known[f], types[f])
                for f in fields
                if f not in rows.columns and f in known
            }
        )
    else:
        extra = [f for f in fields if f in source.columns and f not in rows.columns]
        filled = rows.join(source.select(*on, *extra), on)
    return publish_names("metric", filled)


def _constant(value, data_type) -> Column:
    if isinstance(value, list):
        return F.array(*[F.lit(v) for v in value]).cast(data_type)
    return F.lit(value).cast(data_type)
