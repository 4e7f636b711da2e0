"""Joins: lookups, N-way joins, cardinality checks and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.operators.columns import quoted

def lookup_join(
    left: DataFrame, lookup: DataFrame, on: list[str] | str, how: str = "inner"
) -> DataFrame:
    """Enrich ``left`` from a lookup.

    Whether the lookup is broadcast is left to Spark's threshold and adaptive execution, which also
    splits hot keys where it is not.
    """
    return left.join(lookup, on, how)


def join_on_names(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "inner"
) -> DataFrame:
    """Equi-join on differently named keys; both keys stay in the result."""
    return left.join(right, left[left_on] == right[right_on], how)


def null_matching_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "inner"
) -> DataFrame:
    """As :func:`join_on_names`, with null matching null."""
    return left.join(right, left[left_on].eqNullSafe(right[right_on]), how)


def join_all(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """N-way inner join on one key.

    All joins share the key, so Spark keeps one partitioning through the chain
    and each input is shuffled once.
    """
    return reduce(lambda left, right: left.join(right, on), frames)


def outer_join_all(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """N-way full outer join on one key, null keys matching each other.

    The key must be unique in every table, which is checked in the same pass: all tables go below each
    other and one aggregation brings the rows of a key together, so every table is read and shuffled
    once.
    """
    values = [[c for c in f.columns if c not in on] for f in frames]
    packed = [
        f.select(
            *on,
            *[
                F.struct(*[F.col(quoted(c)) for c in values[i]], F.lit(True).alias("_there")).alias(f"_{i}")
            ],
        )
        for i, f in enumerate(frames)
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)
    wide = rows.groupBy(*on).agg(
        *[F.first(f"_{i}", ignorenulls=True).alias(f"_{i}") for i in range(len(frames))],
        F.greatest(F.lit(0), *[F.count(f"_{i}") for i in range(len(frames))]).alias("_most"),
    )
    repeated = F.concat(F.lit("a key is repeated in one table: "), F.to_json(F.struct(*on)))
    sure = F.when(F.col("_most") <= 1, F.lit(True)).otherwise(F.raise_error(repeated).cast("boolean"))
    return wide.filter(sure).select(
        *on, *[F.col(f"_{i}.{quoted(c)}").alias(c) for i, names in enumerate(values) for c in names]
    )


def concat_columns(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Put tables side by side by key; a key absent from one table gives nulls."""
    return frames[0] if len(frames) == 1 else outer_join_all(frames, on)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique_keys(df: DataFrame, keys: list[str], what: str = "table") -> DataFrame:
    """Return ``df`` if its keys are unique, raise otherwise."""
    found = duplicate_keys(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"{what} is not one row per {keys}: {found[0].asDict()}")
    return df


def one_to_one_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """Join that first checks that the key is unique on both sides."""
    require_unique_keys(left, on, "left side")
    require_unique_keys(right, on, "right side")
    return left.join(right, on, how)


def chain_lookups(
    base: DataFrame, lookups: list[tuple[DataFrame, list[str]]], how: str = "inner"
) -> DataFrame:
    """Enrich ``base`` through one lookup after the other."""
    return reduce(lambda df, step: lookup_join(df, step[0], step[1], how), lookups, base)


def keep_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed."""
    return df.join(listed, on, "left_semi")


def drop_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not listed."""
    return df.join(listed, on, "left_anti")


def lookup_or_fail(
    left: DataFrame, lookup: DataFrame, on: list[str], value: str
) -> DataFrame:
    """Lookup that fails the job when a key has no entry."""
    joined = left.join(lookup, on, "left")
    shown = F.concat_ws("/", *[F.col(c).cast("string") for c in on])
    data_type = lookup.schema[value].dataType
    return joined.withColumn(
        value,
        F.when(F.col(value).isNotNull(), F.col(value)).otherwise(
            F.raise_error(F.concat(F.lit(f"no {value} for "), shown)).cast(data_type)
        ),
    )


def lookup_or_default(
    left: DataFrame, lookup: DataFrame, on: list[str], value: str, default: str = "TBD"
) -> DataFrame:
    """Lookup with a default for missing keys."""
    joined = left.join(lookup, on, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def expand_dimension(df: DataFrame, name: str, values: list) -> DataFrame:
    """One output row per input row and value of a fixed dimension."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def coverage_audit(
    metrics: DataFrame, boundaries: DataFrame, key: str = "GEO_ID"
) -> DataFrame:
    """Each area id with ``matched``, ``metric only`` or ``geometry only``.

    One aggregation over the union of both key columns: duplicates fold before
    the shuffle, so a heavily repeated id cannot build a hot join key.
    """
    sides = (
        metrics.select(key, F.lit(1).alias("in_metrics"), F.lit(0).alias("in_boundaries"))
        .unionByName(
            boundaries.select(key, F.lit(0).alias("in_metrics"), F.lit(1).alias("in_boundaries"))
        )
        .filter(F.col(key).isNotNull())
    )
    seen = sides.groupBy(key).agg(
        F.max("in_metrics").alias("m"), F.max("in_boundaries").alias("b")
    )
    status: Column = (
        F.when((F.col("m") == 1) & (F.col("b") == 1), "matched")
        .when(F.col("m") == 1, "metric only")
        .otherwise("geometry only")
    )
    return seen.select(key, status.alias("status"))


def flat_catalogue(
    metrics: DataFrame,
    releases: DataFrame,
    publishers: DataFrame,
    geometries: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """All five metadata tables joined along their links, one row per metric and country.

    The publisher lists its countries in an array, so that link is exploded
    into an equi-join instead of being tested pair by pair.  A geometry id does
    not cover the country, so geometries match on the country folder as well.
    """
    publisher_countries = publishers.withColumn(
        "country_id", F.explode("data_publisher_countries_of_interest")
    ).withColumnRenamed("data_publisher_id", "source_data_release_data_publisher_id")
    placed = geometries.withColumn(
        "country_id", F.substring_index("geometry_filepath_stem", "/", 1)
    ).withColumnRenamed("geometry_id", "source_data_release_geometry_metadata_id")
    described = (
        releases.join(publisher_countries, "source_data_release_data_publisher_id")
        .join(placed, ["country_id", "source_data_release_geometry_metadata_id"])
        .join(countries, "country_id")
    )
    return metrics.join(
        described,
        F.col("metric_source_data_release_id") == F.col("source_data_release_id"),
    )
