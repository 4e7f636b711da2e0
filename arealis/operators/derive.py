"""Derived metrics: filtered sums, row sums and dictionary-driven sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.codes import column_to_variable, column_to_variable_name
from arealis.operators.columns import sex_age_columns, quoted, survey_columns
from arealis.schemas import GEO_ID
from arealis.specs import DerivedMetric, DictionaryMetric, HeaderMetric


def derive_metric(
    df: DataFrame, spec: DerivedMetric, value: str, geo: str = GEO_ID
) -> DataFrame:
    """Sum ``value`` per area over the rows the predicate keeps; nulls add 0."""
    return (
        df.filter(F.col(geo).isNotNull())
        .filter(F.expr(spec.predicate))
        .groupBy(geo)
        .agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias(spec.name))
    )


def derive_metrics(
    df: DataFrame, specs: list[DerivedMetric], value: str, geo: str = GEO_ID
) -> DataFrame:
    """All metrics of :func:`derive_metric`, for areas that have every one of them.

    One conditional aggregation replaces one scan, shuffle and join per metric.
    """
    amount = F.coalesce(F.col(value), F.lit(0))
    sums = [F.sum(F.when(F.expr(s.predicate), amount)).alias(s.name) for s in specs]
    hits = [F.count_if(F.expr(s.predicate)).alias(f"_hits_{i}") for i, s in enumerate(specs)]
    complete = reduce(lambda a, b: a & b, [F.col(f"_hits_{i}") > 0 for i in range(len(specs))])
    return (
        df.filter(F.col(geo).isNotNull())
        .groupBy(geo)
        .agg(*sums, *hits)
        .filter(complete)
        .drop(*[f"_hits_{i}" for i in range(len(specs))])
    )


def row_sum(columns: list[str]) -> Column:
    """Sum across columns of one row, null counting as 0."""
    terms = [F.coalesce(F.col(quoted(c)), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, terms, F.lit(0))


def add_header_metrics(df: DataFrame, specs: list[HeaderMetric]) -> DataFrame:
    """Add metrics summed over the wide columns their headers select."""
    return df.withColumns(
        {s.name: row_sum(sex_age_columns(df.columns, s.sex, s.ages)) for s in specs}
    )


def dictionary_variables(
    dictionary: DataFrame, specs: list[DictionaryMetric]
) -> dict[str, list[str]]:
    """Variables behind each metric; each listed name must match exactly one.

    The result is bounded by the names the specs list.  A dictionary that
    matches more or fewer variables than names is an error.
    """
    names = [
        F.when(
            F.col("variable_extended_name").isin(list(s.variables))
            & (F.lower("universe") == s.universe)
            & F.col("table_id").startswith(s.table_prefix),
            F.lit(s.name),
        )
        for s in specs
    ]
    bound = sum(len(set(s.variables)) for s in specs)
    rows = (
        dictionary.select(
            F.explode(F.array_compact(F.array(*names))).alias("metric"),
            F.col("unique_id").alias("variable"),
        )
        .distinct()
        .limit(bound + 1)
        .collect()
    )
    found: dict[str, list[str]] = {s.name: [] for s in specs}
    for row in rows:
        found[row.metric].append(row.variable)
    for s in specs:
        if len(found[s.name]) != len(set(s.variables)):
            raise ValueError(
                f"{s.name}: {len(found[s.name])} variables match {len(set(s.variables))} names"
            )
    return {name: sorted(variables) for name, variables in found.items()}


def add_dictionary_metrics(
    df: DataFrame, dictionary: DataFrame, specs: list[DictionaryMetric]
) -> DataFrame:
    """Add metrics to a wide estimate table without a shuffle of that table."""
    by_variable = {column_to_variable_name(c): c for c in survey_columns(df, "E")}
    chosen = dictionary_variables(dictionary, specs)
    missing = sorted({v for vs in chosen.values() for v in vs} - by_variable.keys())
    if missing:
        raise ValueError(f"table lacks the columns of {missing}")
    return df.withColumns(
        {s.name: row_sum([by_variable[v] for v in chosen[s.name]]) for s in specs}
    )


def dictionary_sums(
    estimates: DataFrame, dictionary: DataFrame, specs: list[DictionaryMetric], geo: str = GEO_ID
) -> DataFrame:
    """The same sums from a long table ``(geo, column_name, value)``.

    The dictionary shrinks to the variables in use before it meets the data;
    that list is bounded by the specs, so it can be broadcast.
    """
    chosen = dictionary_variables(dictionary, specs)
    pairs = sorted((v, m) for m, vs in chosen.items() for v in vs)
    wanted = dictionary.sparkSession.createDataFrame(pairs, "variable string, metric string")
    return (
        estimates.withColumn("variable", column_to_variable(F.col("column_name")))
        .join(F.broadcast(wanted), "variable")
        .groupBy(geo, "metric")
        .agg(F.sum(F.coalesce("value", F.lit(0))).alias("value"))
    )
