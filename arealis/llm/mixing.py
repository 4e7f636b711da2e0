"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget by its weight.  A source whose share is above the most that
its documents may be repeated is clamped there, and what it cannot take is shared again by weight
among the others, until no source is above its cap.  A target then becomes whole repetitions of every
document plus one more of documents drawn in a seeded order until the rest is reached.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
BUDGET = Fraction(3, 2)
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, identity: str = "doc_id") -> Column:
    """A seeded position of a document as hexadecimal text; equal for equal ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(identity).cast("string"), F.lit("?"))))


def source_targets(
    totals: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: Fraction = BUDGET,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """source, source_size, target from one row per source.

    Weights repeat over the sources in code-point order, null last.  Every round clamps all sources
    above their cap at once, so there are no more rounds than sources.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    totals = stored(
        totals.withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs),
        "mix-sources",
    )
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    rest, level = Fraction(whole) * budget, None
    capped = F.lit(False)
    while True:
        free = totals.agg(
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)),
            F.count(F.when(capped, 1)),
        ).first()
        if not free[1]:
            break
        new = (rest - free[0]) / free[1]
        if level is not None and new == level:
            break
        level = new
        over = F.col("weight") * F.lit(level.numerator).cast("decimal(38,0)") > F.col("cap") * F.lit(
            level.denominator
        ).cast("decimal(38,0)")
        capped = capped | over
    share = F.col("weight") * F.lit(float(level or 0))
    return totals.select(
        "source",
        "source_size",
        F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget: Fraction = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, repeats, taken.

    Null text and text without words have size 0 and are taken as often as the whole repetitions
    of their source.  The documents of the last repetition are those with the smallest draws; the
    one that the rest ends in is taken if at least half of it fits, so a source misses its target by
    half a document at most.  The draw depends on seed and doc_id alone: reruns agree, and repeated
    rows of one doc_id stand together.  Only doc_id, text and source are read.
    """
    rows = stored(
        docs.select("doc_id", "source", word_count().alias("size"), draw(seed).alias("draw")),
        "mix-rows",
    )
    targets = stored(
        source_targets(
            rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, budget, max_epochs
        )
        .withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .cast("long"),
        )
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-targets",
    )
    # The first hexadecimal digits deal every source over cells, so that only the cell in which
    # its rest ends has to be looked at in order.
    cell = F.substring("draw", 1, 4)
    cells = rows.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("cell_size"))
    before = F.sum("cell_size").over(
        Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = cells.withColumn("before", F.coalesce(before, F.lit(0))).withColumnRenamed("source", "of")
    cells = cells.join(targets, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    cells = stored(cells, "mix-cells")
    edge = F.col("before") + F.col("cell_size") > F.col("rest")
    inside = Window.partitionBy("of", "at").orderBy("draw", "doc_id", "size")
    placed = (
        rows.withColumn("at", cell)
        .withColumnRenamed("source", "of")
        .join(cells, F.col("of").eqNullSafe(F.col("source")) & (F.col("at") == F.col("cell")))
    )
    full = placed.where(~edge).withColumn("more", F.lit(1))
    ordered = (
        placed.where(edge)
        .withColumn(
            "behind",
            F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .withColumn(
            "more",
            (F.col("before") + F.col("behind") + F.col("size") / 2 <= F.col("rest")).cast("int"),
        )
        .drop("behind")
    )
    return (
        full.unionByName(ordered)
        .withColumn("repeats", F.col("whole") + F.when(F.col("rest") > 0, F.col("more")).otherwise(0))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "repeats",
            (F.col("size") * F.col("repeats")).alias("taken"),
        )
    )
