"""Projection, selection and filter helpers on whole tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.schemas import GEO_ID


def with_geo_id(df: DataFrame, source: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename the id column to ``GEO_ID`` as text, and others as given.

    The cast comes before any join: ids such as ``01001`` lose their zeros as
    numbers.
    """
    out = df.withColumnsRenamed({source: GEO_ID, **(renames or {})})
    return out.withColumn(GEO_ID, F.col(GEO_ID).cast("string"))


def quoted(name: str) -> str:
    """Column reference for a header with dots, colons or blanks in it."""
    return "`" + name.replace("`", "``") + "`"


def blank_header_columns(df: DataFrame) -> DataFrame:
    """Name unnamed columns by position: the first is the area, others are keys.

    Spark calls a column without header ``_c<i>``.
    """
    renames, key = {}, 0
    for name in df.columns:
        if re.fullmatch(r"_c\d+", name):
            renames[name] = GEO_ID if not renames else f"key_{key}"
            key += 1 if renames[name] != GEO_ID else 0
    return df.withColumnsRenamed(renames)


def columns_ending(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def survey_columns(df: DataFrame, kind: str) -> list[str]:
    """Estimate (``E``) or margin (``M``) columns such as ``B01001_E001``."""
    return [c for c in df.columns if re.fullmatch(rf"B[^_]*_{kind}.*", c)]


# Words of the wide tables' headers, which read "Sex: …; Age: …; measures: Value".
SEXES = {"All persons": "total", "Female": "female", "Male": "male"}
ALL_AGES = "Total"
BOUND_AGES = {"Aged under 1 year": 0, "Aged 90 years and over": 90}


def header_parts(header: str) -> dict[str, str]:
    """The parts of a header by their names."""
    named = (part.partition(":") for part in header.split(";"))
    return {name.strip(): value.strip() for name, _, value in named}


def single_age(words: str) -> int | None:
    """Single year of age: infants are 0, the open band is 90, anything else but ``Aged n years`` is none."""
    if words in BOUND_AGES:
        return BOUND_AGES[words]
    match words.split():
        case ["Aged", number, "year" | "years"] if number.isdecimal():
            return int(number)
    return None


def sex_age_columns(columns: list[str], sex: str, ages: tuple[int, int] | None) -> list[str]:
    """Wide columns of one sex within an inclusive age range, or its all-ages column."""
    chosen = []
    for column in columns:
        parts = header_parts(column)
        if SEXES.get(parts.get("Sex", "")) != sex:
            continue
        words = parts.get("Age", "")
        age = single_age(words)
        if words == ALL_AGES if ages is None else age is not None and ages[0] <= age <= ages[1]:
            chosen.append(column)
    return chosen


def header_facts(header: Column) -> dict[str, Column]:
    """Sex and age out of a header held in a column (after an unpivot)."""
    parts = F.str_to_map(header, F.lit(r";\s*"), F.lit(r":\s*"))
    words = F.element_at(parts, F.lit("Age"))

    def looked_up(known: dict, key: Column) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), key)

    return {
        "sex": looked_up(SEXES, F.element_at(parts, F.lit("Sex"))),
        "age": F.coalesce(
            looked_up(BOUND_AGES, words), F.get(F.split(words, " "), F.lit(1)).try_cast("int")
        ),
        "all_ages": words == ALL_AGES,
    }


def not_blank(column: Column) -> Column:
    """Neither null nor only blanks."""
    return column.isNotNull() & (F.trim(column) != "")


def keep_differing(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two columns differ: a sub-heading repeats one text across the row."""
    return df.filter(F.col(left) != F.col(right))


def drop_areas(df: DataFrame, ids: list[str], geo: str = GEO_ID) -> DataFrame:
    """Remove whole-country rows and the like."""
    return df.filter(~F.col(geo).isin(ids))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns, order and types of ``schema``; absent columns are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
