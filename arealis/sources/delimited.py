"""Scans of delimited text and parquet."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.operators.columns import quoted, survey_columns
from arealis.operators.joins import concat_columns
from arealis.operators.ordered import drop_last_rows
from arealis.schemas import GEO_ID
from arealis.specs import DelimitedFormat


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    fmt: DelimitedFormat = DelimitedFormat(),
) -> DataFrame:
    """A text table with a stated schema, so no pass over the data is spent on inference."""
    reader = (
        spark.read.schema(schema)
        .option("sep", fmt.separator)
        .option("encoding", fmt.encoding)
        .option("header", str(fmt.header).lower())
        .option("quote", '"' if fmt.quoted else "")
        .option("escape", '"' if fmt.quoted else "\\")
    )
    return reader.csv(path)


def read_named(
    spark: SparkSession,
    path: str,
    type_of: Callable[[str], T.DataType],
    fmt: DelimitedFormat = DelimitedFormat(),
) -> DataFrame:
    """A table whose columns are known by rule only: names from its header, types from ``type_of``."""
    names = (
        spark.read.option("sep", fmt.separator)
        .option("encoding", fmt.encoding)
        .option("quote", '"' if fmt.quoted else "")
        .option("header", "true")
        .csv(path)
        .columns
    )
    schema = T.StructType([T.StructField(n, type_of(n), True) for n in names])
    return read_delimited(spark, path, schema, fmt)


def replacement_characters(df: DataFrame) -> DataFrame:
    """Number of text cells holding U+FFFD: bytes the encoding could not read."""
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    hits = [F.contains(F.col(quoted(c)), F.lit("�")).cast("bigint") for c in text]
    total = F.lit(0).cast("bigint")
    for hit in hits:
        total = total + F.coalesce(hit, F.lit(0))
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("bad_cells"))


def read_with_encodings(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    encodings: list[str],
    fmt: DelimitedFormat = DelimitedFormat("|", quoted=False),
) -> DataFrame:
    """The first encoding in the list that reads every text cell.

    Every candidate tried costs one pass over the text columns; name the likely
    one first.
    """
    for encoding in encodings:
        df = read_delimited(spark, path, schema, replace(fmt, encoding=encoding))
        if replacement_characters(df).first()["bad_cells"] == 0:
            return df
    raise ValueError(f"none of {encodings} reads {path}")


def with_source_order(df: DataFrame) -> DataFrame:
    """Add ``source_file``, ``file_offset`` and ``row_index`` to a file scan.

    Inside a file, rows sorted by (file_offset, row_index) are in file order.
    ``file_offset`` is the start of the split a task reads, so it also cuts
    the file into chunks no larger than one split.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("file_offset"),
        F.monotonically_increasing_id().alias("row_index"),
    )


def read_sheet(
    spark: SparkSession,
    path: str,
    names: list[str],
    footer_rows: int = 0,
    header: bool = False,
) -> DataFrame:
    """A spreadsheet sheet landed as CSV: given names, optional footer cut."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = read_delimited(spark, path, schema, DelimitedFormat(header=header))
    if footer_rows == 0:
        return df
    placed = with_source_order(df).withColumn("_order", F.struct("file_offset", "row_index"))
    return drop_last_rows(placed, ["source_file"], "_order", footer_rows).select(*names)


def widen_parquets(
    spark: SparkSession, paths: list[str], key: str = GEO_ID, kind: str = "E"
) -> DataFrame:
    """Estimate columns of several parquet tables side by side by key."""
    frames = []
    for path in paths:
        df = spark.read.parquet(path)
        frames.append(df.select(key, *[F.col(quoted(c)) for c in survey_columns(df, kind)]))
    return concat_columns(frames, [key])


# File formats in the order they are preferred, with the suffix
# of the table inside a zip of that format.
FORMAT_ROOT = "http://publications.europa.eu/resource/authority/file-type/"
FORMAT_SUFFIX = {
    "TXT": ".txt",
    "GEOJSON": "",
    "GML": ".gml",
    "BIN": "",
    "CSV": ".csv",
    "MDB": ".mdb",
    "SHP": ".shp",
    "XLSX": ".xlsx",
}


def scan_by_format(
    fmt: str, readers: dict[str, Callable[[], DataFrame]]
) -> DataFrame:
    """Run the reader registered for a format; a format without one is an error."""
    name = fmt.removeprefix(FORMAT_ROOT)
    if name not in readers:
        raise ValueError(f"no reader for format {name}")
    return readers[name]()
