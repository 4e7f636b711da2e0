"""Grouping, counting, batching and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.operators.ordered import dense_row_number


def first_by(value: Column, order: Column) -> Column:
    """Value of the first row in ``order``; a plain ``first`` would depend on timing."""
    return F.min_by(value, order)


def ordered_concat(value: Column, order: Column, separator: str = ", ") -> Column:
    """All values of a group as one text, in ``order``."""
    pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.transform(pairs, lambda p: p["v"].cast("string")), separator)


def output_counts(metadata: DataFrame, group: list[str]) -> DataFrame:
    """Metrics and parquet files per group."""
    return metadata.groupBy(*group).agg(
        F.count(F.lit(1)).alias("num_metrics"),
        F.count_distinct("metric_parquet_path").alias("num_parquets"),
    )


def batches(
    df: DataFrame, group: list[str], item: str, order: list[str], size: int
) -> DataFrame:
    """Lists of ``size`` items per group in the given order, numbered from 0."""
    numbered = dense_row_number(df.select(*{*group, item, *order}), group, order)
    placed = numbered.withColumn("batch", F.floor((F.col("row_number") - 1) / size).cast("int"))
    pairs = F.array_sort(F.collect_list(F.struct("row_number", F.col(item).alias("item"))))
    return placed.groupBy(*group, "batch").agg(
        F.transform(pairs, lambda p: p["item"]).alias("items")
    )


def split_levels(
    df: DataFrame, levels: dict[str, int], column: str = "SUMLEVEL"
) -> dict[str, DataFrame]:
    """One table per summary level; each is a pushed-down filter of the same input."""
    return {
        name: df.filter(F.col(column) == code).drop(column) for name, code in levels.items()
    }


def level_name(column: Column, levels: dict[str, int]) -> Column:
    """Level name of a summary code, null for other levels."""
    chosen = None
    for name, code in levels.items():
        hit = column == code
        chosen = F.when(hit, name) if chosen is None else chosen.when(hit, name)
    return chosen


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: number of rows, of distinct keys, and whether they agree.

    Counts per key first, so no task sees all values of a column.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.coalesce(F.max("n"), F.lit(1)) == 1).alias("is_unique"),
    )


def flatten(df: DataFrame, nested: str) -> DataFrame:
    """One row per element of an array-of-struct column, its fields as columns."""
    kept = [c for c in df.columns if c != nested]
    return df.select(*kept, F.inline(nested))
