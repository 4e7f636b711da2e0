"""Pivots and unpivots between long, wide and crosstab layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.text import join_key
from arealis.operators.columns import quoted
from arealis.schemas import GEO_ID
from arealis.specs import PivotSpec


def _present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(quoted(n)).isNotNull() for n in names]))


def pivot_names(df: DataFrame, keys: list[str], separator: str) -> list[str]:
    """Output column names, ordered by the typed key values.

    Column names are schema, so they have to be known before the plan is
    built.  ``spark.sql.pivotMaxValues`` bounds them; more keys, or two keys
    with one name, are an error.
    """
    bound = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    columns = [F.col(quoted(k)) for k in keys]
    rows = (
        _present(df, keys)
        .select(*columns, join_key(*columns, separator=separator).alias("_name"))
        .distinct()
        .limit(bound + 1)
        .collect()
    )
    if len(rows) > bound:
        raise ValueError(f"more than {bound} pivot columns; keep the table long")
    names = [r["_name"] for r in sorted(rows, key=lambda r: tuple(r)[:-1])]
    if len(set(names)) != len(names):
        raise ValueError("two key combinations share one column name; change the separator")
    return names


def pivot_metrics(
    df: DataFrame,
    geo: str,
    keys: list[str],
    value: str,
    how: str = "sum",
    separator: str = "_",
    names: list[str] | None = None,
) -> DataFrame:
    """One column per key combination, one row per area.

    Rows with a null area or key vanish.  ``sum``: a combination with only null
    values gives 0, an absent one null.  ``mean``: nulls do not count at all.
    Spark first aggregates by (area, key), so a hot area or key is folded on
    the map side.
    """
    if how not in ("sum", "mean"):
        raise ValueError(f"unknown pivot function {how}")
    rows = _present(df, [geo, *keys])
    if how == "mean":
        rows = _present(rows, [value])
    columns = [F.col(quoted(k)) for k in keys]
    rows = rows.select(
        F.col(quoted(geo)).alias(GEO_ID),
        join_key(*columns, separator=separator).alias("_name"),
        F.col(quoted(value)).alias("_value"),
    )
    if names is None:
        names = pivot_names(_present(df, [geo, value] if how == "mean" else [geo]), keys, separator)
    aggregate = F.avg("_value") if how == "mean" else F.sum(F.coalesce("_value", F.lit(0)))
    return rows.groupBy(GEO_ID).pivot("_name", names).agg(aggregate)


def unpivot_values(
    df: DataFrame, keep: list[str], values: list[str], name: str = "value_name", value: str = "value"
) -> DataFrame:
    """Wide to long over the given value columns."""
    return df.unpivot(
        [F.col(quoted(k)) for k in keep], [F.col(quoted(v)) for v in values], name, value
    )


def pivot_table(df: DataFrame, spec: PivotSpec, names: list[str] | None = None) -> DataFrame:
    """Pivot one or several value columns by 0..n keys.

    With named values a column is called ``value<sep>key1<sep>key2``.  Without
    keys every value column is summed per area.
    """
    keys, values = list(spec.key_columns), list(spec.value_columns)
    if not keys:
        return (
            _present(df, [spec.geo_column])
            .groupBy(F.col(quoted(spec.geo_column)).alias(GEO_ID))
            .agg(*[F.sum(F.coalesce(F.col(quoted(v)), F.lit(0))).alias(v) for v in values])
        )
    named = len(values) > 1 if spec.name_values is None else spec.name_values
    if not named:
        return pivot_metrics(
            df, spec.geo_column, keys, values[0], spec.how, spec.separator, names
        )
    long = unpivot_values(_present(df, keys), [spec.geo_column, *keys], values)
    return pivot_metrics(
        long, spec.geo_column, ["value_name", *keys], "value", spec.how, spec.separator, names
    )


def pivot_codes_and_labels(df: DataFrame, geo: str, value: str) -> DataFrame:
    """One pivot over the ``... Code`` columns and one over the ``... Label`` columns.

    Both key names of a row go into one array, so the table is read and
    aggregated once instead of twice plus a join.
    """
    df = df.filter(F.col(quoted(geo)).isNotNull())  # rows without an area make no columns either
    codes = [c for c in df.columns if c.endswith("Code") and c != geo]
    labels = [c for c in df.columns if c.endswith("Label")]
    code_names, label_names = pivot_names(df, codes, "_"), pivot_names(df, labels, "_")
    both = F.array(
        F.concat(F.lit("c:"), join_key(*[F.col(quoted(c)) for c in codes])),
        F.concat(F.lit("l:"), join_key(*[F.col(quoted(c)) for c in labels])),
    )
    wanted = [f"c:{n}" for n in code_names] + [f"l:{n}" for n in label_names]
    clash = set(code_names) & set(label_names)
    if clash:
        raise ValueError(f"code and label columns share the names {sorted(clash)}")
    long = (
        df.select(F.col(quoted(geo)).alias(GEO_ID), F.explode(both).alias("_name"),
                F.col(quoted(value)).alias("_value"))
        .filter(F.col("_name").isNotNull())
    )
    wide = long.groupBy(GEO_ID).pivot("_name", wanted).agg(F.sum(F.coalesce("_value", F.lit(0))))
    return wide.withColumnsRenamed({n: n[2:] for n in wanted})


def melt_crosstab(
    df: DataFrame, keep: list[str], values: dict[str, str], name: str, value: str
) -> DataFrame:
    """Crosstab to long, with the headers mapped to labels."""
    long = unpivot_values(df, keep, list(values), name, value)
    mapping = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return long.withColumn(name, F.element_at(mapping, F.col(name)))


def fold_to_long(df: DataFrame, geo: str = GEO_ID, value_type: str = "double") -> DataFrame:
    """A wide metric table as ``(GEO_ID, metric, value)``, absent values dropped."""
    values = [c for c in df.columns if c != geo]
    cast: list[Column] = [F.col(quoted(v)).cast(value_type).alias(v) for v in values]
    return (
        df.select(F.col(quoted(geo)), *cast)
        .unpivot([quoted(geo)], [F.col(quoted(v)) for v in values], "metric", "value")
        .filter(F.col("value").isNotNull())
    )
