"""Checks before publication, skip rules and profiles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.operators.columns import quoted
from arealis.schemas import GEO_ID


class AssumptionsOutdated(ValueError):
    """The source no longer looks the way the job assumes."""


def require_metric_columns(metrics: DataFrame, metadata: DataFrame) -> None:
    """The metric columns are exactly those the metadata describes.

    Names of metadata come back whole: they are as many as the columns of a table.
    """
    if GEO_ID not in metrics.columns:
        raise ValueError(f"metrics need a {GEO_ID} column, found {metrics.columns}")
    have = [c for c in metrics.columns if c != GEO_ID]
    described = metadata.select("metric_parquet_column_name").distinct()
    rows = described.collect()
    names = {r[0] for r in rows}
    if names != set(have):
        raise ValueError(
            f"columns without metadata: {sorted(set(have) - names)}; "
            f"metadata without column: {sorted(n for n in names if n not in have)}"
        )


def require_boundary_columns(boundaries: DataFrame, geometry: str = "parts") -> None:
    if set(boundaries.columns) != {GEO_ID, geometry}:
        raise ValueError(f"a boundary layer has {GEO_ID} and {geometry} only, found {boundaries.columns}")


def require_name_columns(names: DataFrame, languages: DataFrame, code: str = "code") -> None:
    """A names table has ``GEO_ID`` and at least one ISO 639-3 column."""
    columns = [c for c in names.columns if c != GEO_ID]
    if GEO_ID not in names.columns or not columns:
        raise ValueError(f"a names table has {GEO_ID} and a name column, found {names.columns}")
    bad = unknown_codes(
        names.sparkSession.createDataFrame([(c,) for c in columns], f"{code} string"), languages, code
    ).collect()
    if bad:
        raise ValueError(f"not ISO 639-3 codes: {sorted(r[0] for r in bad)}")


def unknown_codes(codes: DataFrame, known: DataFrame, code: str = "code") -> DataFrame:
    """Codes in use that the landed code table lacks."""
    return codes.select(code).distinct().join(known.select(code), code, "left_anti")


def path_problems(metadata: DataFrame, output: str) -> DataFrame:
    """Outputs with several paths, and paths used by several outputs."""
    pairs = metadata.groupBy(output, "metric_parquet_path").agg(F.count(F.lit(1)).alias("n"))
    several = (
        pairs.groupBy(F.col(output).cast("string").alias("subject"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("subject", F.lit("several paths in one output").alias("problem"))
    )
    shared = (
        pairs.groupBy(F.col("metric_parquet_path").alias("subject"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("subject", F.lit("path used by several outputs").alias("problem"))
    )
    return several.unionByName(shared)


def require_no_rows(problems: DataFrame, message: str, error: type[Exception] = ValueError) -> None:
    """Raise with the number of rows and a few examples if there is any row."""
    rows = problems.limit(5).collect()
    if rows:
        raise error(f"{message}: {problems.count()} rows, such as {[r.asDict() for r in rows]}")


def assumption(condition: Column, value: Column, message: str, data_type: str) -> Column:
    """The value where the condition holds; anywhere else the job fails."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast(data_type))


def apply_known_lists(
    catalogue: DataFrame,
    key: str,
    failing: list[str] | None = None,
    required: list[str] | None = None,
    overrides: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """Drop known-bad tables, keep required ones, correct single values.

    ``overrides`` maps a column to ``{sql condition: new value}``.
    """
    out = catalogue
    if failing:
        out = out.filter(~F.col(key).isin(failing))
    if required is not None:
        out = out.filter(F.col(key).isin(required))
    for column, rules in (overrides or {}).items():
        value = F.col(column)
        for condition, corrected in rules.items():
            value = F.when(F.expr(condition), corrected).otherwise(value)
        out = out.withColumn(column, value)
    return out


def output_status(known: Column, n_rows: Column, has_source_column: Column) -> Column:
    """Why a partition is skipped, or ``ok``."""
    return (
        F.when(~F.coalesce(known, F.lit(False)), "unknown partition")
        .when(F.coalesce(n_rows, F.lit(0)) == 0, "empty table")
        .when(~F.coalesce(has_source_column, F.lit(False)), "source column missing")
        .otherwise("ok")
    )


def profile(df: DataFrame, title: str) -> DataFrame:
    """One row: title, record count and column list; column list comes from the schema."""
    listed = "\n".join(f"- '`{c}`'" for c in df.columns)
    return df.agg(F.count(F.lit(1)).alias("num_records")).select(
        F.lit(title).alias("title"), "num_records", F.lit(listed).alias("columns")
    )


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the non-null count and extremes as text, in one pass over the table."""
    packed = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(quoted(c)).alias("n_present"),
            F.min(quoted(c)).cast("string").alias("low"),
            F.max(quoted(c)).cast("string").alias("high"),
        )
        for c in columns
    ]
    return df.agg(F.array(*packed).alias("profiles")).select(F.inline("profiles"))


def partition_outcomes(df: DataFrame, partition: str, parsed: Column, raw: Column) -> DataFrame:
    """Per partition: rows, rows that did not parse, and ``ok`` or ``failed``.

    A partition with one bad row is failed as a whole and is left out of
    publication; the others go on.
    """
    bad = raw.isNotNull() & parsed.isNull()
    return (
        df.groupBy(partition)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"))
        .withColumn("outcome", F.when(F.col("n_bad") > 0, "failed").otherwise("ok"))
    )


def only_successful(df: DataFrame, outcomes: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions that did not fail."""
    failed = outcomes.filter("outcome = 'failed'").select(partition)
    return df.join(failed, partition, "left_anti")


def valid_metric_path(path: str) -> bool:
    """Relative path below a country's ``metrics`` folder."""
    return re.fullmatch(r"[a-z0-9_]+/metrics/[^/]+\.parquet", path) is not None
