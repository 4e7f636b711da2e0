"""Order-dependent operators.

None of them puts a whole group into one task.  A group is cut into chunks
along its order; chunks are worked on in parallel and only one summary row per
chunk is looked at in sequence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arealis.session import ensure_checkpoint_dir


def dense_row_number(
    df: DataFrame, group: list[str], order: list[str], partitions: int | None = None
) -> DataFrame:
    """``row_number`` from 1 per group, without one task per group.

    Rows are range-partitioned by (group, order) and numbered inside their
    partition; a row's number is that position plus the rows its group has in
    earlier partitions.  Partition bounds come from a sample, so the
    partitioned rows are checkpointed: both uses see the same bounds, also
    after an executor is lost.  ``order`` must be unique within a group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [*group, *order]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_id", 33))
    )
    pieces = placed.groupBy(*group, "_part").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_part").alias("_p"),
        "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return placed.join(offsets, same).select(
        *df.columns,
        (F.col("_offset") + F.col("_id") - F.col("_first") + 1).alias("row_number"),
    )


def same_group(group: list[str], suffix: str = "_other") -> Column:
    """Equality of group columns with their suffixed twins, null matching null."""
    return reduce(
        lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"{g}{suffix}")) for g in group], F.lit(True)
    )


def carry_forward(
    df: DataFrame,
    group: list[str],
    chunk: Column,
    order: list[Column],
    values: dict[str, Column],
) -> DataFrame:
    """Last non-null value so far, per group, for each named column.

    ``chunk`` must grow with the order (a file offset, or the row index divided
    by a chunk size).  Inside a chunk a window carries values along; across
    chunks only the last value of each chunk is carried.
    """
    rows = df.withColumn("_chunk", chunk)
    upto = (
        W.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    )
    inside = rows.withColumns(
        {f"_in_{n}": F.last(v, ignorenulls=True).over(upto) for n, v in values.items()}
    )
    sequence = F.struct(*order)
    ends = rows.groupBy(*group, "_chunk").agg(
        *[
            F.max_by(v, F.when(v.isNotNull(), sequence)).alias(f"_end_{n}")
            for n, v in values.items()
        ]
    )
    earlier = W.partitionBy(*group).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        *[F.col(g).alias(f"{g}_other") for g in group],
        F.col("_chunk").alias("_chunk_other"),
        *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_pre_{n}") for n in values],
    )
    joined = inside.join(carried, same_group([*group, "_chunk"]))
    kept = [c for c in df.columns if c not in values]
    return joined.select(
        *kept, *[F.coalesce(f"_in_{n}", f"_pre_{n}").alias(n) for n in values]
    )


def stub_paths(
    df: DataFrame,
    group: list[str],
    chunk: Column,
    order: Column,
    stub: str,
) -> DataFrame:
    """Path of each stub below its ``label:`` headings, as ``variable_extended_name``.

    A stub with a colon is a heading.  Until the first plain stub of a file
    every heading goes one level deeper; after it a heading replaces the last
    one.  So a later path is the headings before the first plain stub, the last
    of them replaced by the latest heading.
    """
    heading = F.when(
        F.contains(F.col(stub), F.lit(":")), F.replace(F.col(stub), F.lit(":"), F.lit(""))
    )
    rows = df.withColumns({"_order": order, "_heading": heading})
    twins = [F.col(g).alias(f"{g}_other") for g in group]
    dropped = [f"{g}_other" for g in group]
    first_leaf = rows.groupBy(*group).agg(
        F.min(F.when(F.col("_heading").isNull(), F.col("_order"))).alias("_leaf")
    )
    rows = rows.join(first_leaf.select(*twins, "_leaf"), same_group(group)).drop(*dropped)
    opening = F.col("_leaf").isNull() | (F.col("_order") < F.col("_leaf"))
    prefix = W.partitionBy(*group).orderBy("_order").rowsBetween(W.unboundedPreceding, 0)
    # Only the few headings above the first plain stub take part here.
    early = (
        rows.filter(opening)
        .withColumn("_path", F.collect_list("_heading").over(prefix))
        .drop("_leaf", "_heading", "_order")
    )
    base = (
        rows.filter(opening)
        .groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct("_order", "_heading"))).alias("_pairs"))
        .select(*twins, F.transform("_pairs", lambda p: p["_heading"]).alias("_base"))
    )
    later = carry_forward(
        rows.filter(~opening).drop("_leaf"),
        group,
        chunk,
        [F.col("_order")],
        {"_latest": F.col("_heading")},
    ).join(base, same_group(group), "left").drop(*dropped)
    base_or_empty = F.coalesce("_base", F.array().cast("array<string>"))
    kept = F.slice(base_or_empty, 1, F.greatest(F.size(base_or_empty) - 1, F.lit(0)))
    later = later.withColumn(
        "_path",
        F.when(F.col("_latest").isNull(), base_or_empty).otherwise(
            F.concat(kept, F.array("_latest"))
        ),
    )
    path = F.array_join("_path", "|")
    name = F.when(F.contains(F.col(stub), F.lit(":")), path).otherwise(
        F.concat(path, F.lit("|"), F.col(stub))
    )
    both = early.unionByName(later.select(*early.columns))
    return both.withColumn("variable_extended_name", name).drop("_path")


def preferred(value: Column, name: Column, ranked: list, tie: Column) -> Column:
    """Aggregate: the value whose name comes first in ``ranked``.

    Names not listed never win; equal names are settled by the smallest ``tie``.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in ranked]), name)
    return F.min_by(value, F.when(rank > 0, F.struct(rank, tie)))


def require_value(value: Column, message: str, shown: Column, data_type: str = "string") -> Column:
    """The value, or an error naming the row when it is null."""
    return F.coalesce(
        value, F.raise_error(F.concat(F.lit(message), shown.cast("string"))).cast(data_type)
    )


def latest_record(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key, by an aggregate that folds on the map side."""
    others = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    )
    return packed.select(*keys, "_row.*")


def first_record(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key."""
    others = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.struct(*order)).alias("_row")
    )
    return packed.select(*keys, "_row.*")


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a stated order; each task keeps only that many."""
    return df.orderBy(*order).limit(rows)


def drop_last_rows(df: DataFrame, group: list[str], order: str, n: int) -> DataFrame:
    """All but the last ``n`` rows per group (file footers); ``order`` must be unique.

    Rows without a group are a group of their own, and ``n = 0`` drops nothing.

    Spark limits a rank filter before the shuffle, so each task sends at most
    ``n`` rows per group; the rest of the table is compared with the cut only.
    """
    if n <= 0:
        return df
    tail = W.partitionBy(*group).orderBy(F.col(order).desc())
    cut = (
        df.select(*group, order)
        .withColumn("_rank", F.row_number().over(tail))
        .filter(F.col("_rank") <= n)
        .groupBy(*group)
        .agg(F.min(order).alias("_cut"))
        .select(*[F.col(g).alias(f"{g}_other") for g in group], "_cut")
    )
    return df.join(cut, same_group(group)).filter(F.col(order) < F.col("_cut")).select(*df.columns)


def zip_to_map(names: Column, joined_values: Column, separator: str) -> Column:
    """Map of names to the pieces of a joined key; both must have the same length."""
    pieces = F.split(joined_values, separator)
    return F.when(F.size(names) == F.size(pieces), F.map_from_arrays(names, pieces)).otherwise(
        F.raise_error(F.concat(F.lit("names do not fit "), joined_values)).cast(
            "map<string,string>"
        )
    )
