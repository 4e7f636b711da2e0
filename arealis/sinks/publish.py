"""Writers of the published country folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.operators.columns import quoted
from arealis.operators.geometry import geojson_feature, to_wkb
from arealis.operators.quality import (
    require_boundary_columns,
    require_metric_columns,
    require_name_columns,
    require_no_rows,
    path_problems,
)
from arealis.operators.sets import stack
from arealis.schemas import FILE_NAMES, GEO_ID, published_schema
from arealis.session import scratch_path


def _join(base: str, relative: str) -> str:
    return f"{base.rstrip('/')}/{relative}"


def write_table(df: DataFrame, base: str, relative: str) -> str:
    """Parquet at ``base/relative``, replacing what is there."""
    path = _join(base, relative)
    df.write.mode("overwrite").parquet(path)
    return path


def kind_of(df: DataFrame) -> str:
    """Which metadata table this is, by its columns."""
    for kind in FILE_NAMES:
        if df.columns == published_schema(kind).fieldNames():
            return kind
    raise ValueError(f"not a metadata table: {df.columns}")


def write_metadata(df: DataFrame | list[DataFrame], base: str, country: str) -> str:
    """One metadata table, or several pieces of the same kind, into its fixed file."""
    pieces = df if isinstance(df, list) else [df]
    kinds = {kind_of(p) for p in pieces}
    if len(kinds) != 1:
        raise ValueError(f"expected pieces of one kind, found {sorted(kinds)}")
    table = stack(pieces)
    if table.isEmpty():
        raise ValueError("metadata to publish is empty")
    return write_table(table, base, f"{country}/{FILE_NAMES[kinds.pop()]}")


def metric_output(metrics: DataFrame) -> DataFrame:
    """Metric table with text ids."""
    if GEO_ID not in metrics.columns:
        raise ValueError(f"metrics need a {GEO_ID} column, found {metrics.columns}")
    return metrics.withColumn(GEO_ID, F.col(GEO_ID).cast("string"))


def write_metrics(outputs: list[tuple[DataFrame, DataFrame]], base: str, country: str) -> list[str]:
    """Metric tables at their metadata's path, and all metric metadata in one file.

    ``outputs`` pairs metrics with published metadata.  Every check runs before
    anything is published.  Metadata usually comes out of the whole source
    table, so it is computed once into the shared folder and checked there.
    """
    if not outputs:
        raise ValueError("no metrics to publish")
    spark = outputs[0][0].sparkSession
    staged = scratch_path(spark, "metric-metadata")
    stack([metadata.withColumn("output", F.lit(i)) for i, (_, metadata) in enumerate(outputs)]).write.parquet(staged)
    everything = spark.read.parquet(staged)
    for i, (metrics, _) in enumerate(outputs):
        require_metric_columns(metrics, everything.filter(F.col("output") == i))
    require_no_rows(path_problems(everything, "output"), "metric paths clash")
    paths = {
        r["output"]: r["metric_parquet_path"]
        for r in everything.select("output", "metric_parquet_path").distinct().collect()
    }
    write_table(everything.drop("output"), base, f"{country}/{FILE_NAMES['metric']}")
    return [
        write_table(metric_output(metrics), base, paths[i]) for i, (metrics, _) in enumerate(outputs)
    ]


def write_long_metrics(df: DataFrame, base: str, name: str = "metrics_long") -> str:
    """All partitions of all countries in one write, one folder per partition.

    Rows are rebalanced by partition: adaptive execution splits a large one into
    files of the advisory size and puts small ones together.  Only the folders
    present in ``df`` are replaced.  Keys in folder names are text: read them
    with :func:`read_long_metrics`, which keeps them so.
    """
    path = _join(base, name)
    (
        df.hint("rebalance", "country_id", "partition_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("country_id", "partition_key")
        .parquet(path)
    )
    return path


def read_long_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Long metrics with both keys as the text they were written with, ``01001`` too.

    The types of the other columns come from the files.
    """
    inside = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    keys = "country_id string, partition_key string"
    names = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in inside)
    return spark.read.schema(f"{names}, {keys}").parquet(path)


def write_partition(metrics: DataFrame, metadata: DataFrame, base: str) -> str | None:
    """One partition's metric table; a table without columns is skipped."""
    if not metrics.columns:
        return None
    paths = [r[0] for r in metadata.select("metric_parquet_path").distinct().limit(2).collect()]
    if len(paths) != 1:
        raise ValueError(f"a partition has one path, found {paths}")
    return write_table(metric_output(metrics), base, paths[0])


def feature_lines(boundaries: DataFrame, properties: list[str] | None = None) -> DataFrame:
    """GeoJSON features, one per row."""
    shown = {c: F.col(quoted(c)) for c in (properties or [GEO_ID])}
    return boundaries.select(geojson_feature(F.col("parts"), shown).alias("value"))


def write_geojson_lines(boundaries: DataFrame, path: str) -> str:
    """One feature per line."""
    feature_lines(boundaries).write.mode("overwrite").text(path)
    return path


def write_wkb(boundaries: DataFrame, path: str) -> str:
    """Parquet with the geometry as WKB."""
    boundaries.select(GEO_ID, to_wkb("parts").alias("geometry")).write.mode("overwrite").parquet(path)
    return path


def write_boundaries(boundaries: DataFrame, fmt: str, path: str) -> str:
    """Write a boundary layer in a named format."""
    writers = {"parquet": write_wkb, "geojsonseq": write_geojson_lines}
    if fmt.lower() not in writers:
        raise ValueError(f"'{fmt}' is not supported")
    return writers[fmt.lower()](boundaries, path)


def write_geometry(
    outputs: list[tuple[str, DataFrame, DataFrame]],
    geometry_metadata: DataFrame,
    languages: DataFrame,
    base: str,
    country: str,
) -> list[str]:
    """Boundaries and names of all levels at their file stem, and their metadata.

    ``outputs`` holds (file stem, boundaries, names).
    """
    for _, boundaries, names in outputs:
        require_boundary_columns(boundaries)
        require_name_columns(names, languages)
    written = []
    for stem, boundaries, names in outputs:
        text_names = names.select(*[F.col(quoted(c)).cast("string").alias(c) for c in names.columns])
        layer = boundaries.withColumn(GEO_ID, F.col(GEO_ID).cast("string"))
        written.append(write_geojson_lines(layer, _join(base, f"{stem}.geojsonseq")))
        written.append(write_wkb(layer, _join(base, f"{stem}.wkb.parquet")))
        written.append(write_table(text_names, base, f"{stem}.parquet"))
    written.append(write_metadata(geometry_metadata, base, country))
    return written


def country_list(metadata: DataFrame) -> DataFrame:
    """Folder names of all countries, in order."""
    return metadata.select(F.col("country_id").alias("value")).distinct().orderBy("value")


def write_country_list(metadata: DataFrame, base: str) -> str:
    """``countries.txt``: there are a few hundred countries at most, so one file."""
    path = _join(base, "countries.txt")
    country_list(metadata).coalesce(1).write.mode("overwrite").text(path)
    return path
