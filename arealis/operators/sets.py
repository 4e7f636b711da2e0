"""Set operations on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Rows of all tables below each other, matched by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames
    )


def union_with_precedence(
    preferred: DataFrame, other: DataFrame, key: str
) -> DataFrame:
    """All preferred rows, then the other rows whose key the preferred ones lack."""
    extra = other.join(preferred.select(key), key, "left_anti")
    return preferred.unionByName(extra.select(*other.columns), allowMissingColumns=True)


def differences(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, as ``missing`` or ``extra``.

    Folded by aggregation, so duplicates on either side never multiply.
    """
    sides = expected.select(F.col(key), F.lit("missing").alias("side")).unionByName(
        found.select(F.col(key), F.lit("extra").alias("side"))
    )
    return (
        sides.groupBy(key)
        .agg(F.min("side").alias("low"), F.max("side").alias("high"))
        .filter("low = high")
        .select(key, F.col("low").alias("difference"))
    )


def require_equal_sets(expected: DataFrame, found: DataFrame, key: str) -> None:
    """Raise with the missing and extra names if the two key sets differ."""
    # as many rows as there are names that differ, which is at most the two schemas
    rows = differences(expected, found, key).orderBy("difference", key).collect()
    if rows:
        lines = [f"- {r['difference']}: {r[key]}" for r in rows]
        raise ValueError("\n".join(["names differ from what is expected", *lines]))
