"""Counts, age bands, code tables and survey variable codes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of coded census columns.
NATIONALITY = {"BEL": "Belgian", "ETR": "non-Belgian"}
MARITAL_STATUS = {1: "single", 2: "married", 3: "widowed", 4: "divorced"}
SEX_PLURAL = {"Males": "Male", "Females": "Female"}

# State codes run from 1 to 55, these were never given out.
UNUSED_STATE_CODES = [3, 7, 14, 43, 52]


def count_from_text(text: Column, strict: bool = True) -> Column:
    """``1,234`` -> 1234, a lone ``-`` -> 0, null -> 0.

    Other text is an error when ``strict``, else null so that the caller can
    set the row aside.
    """
    plain = F.trim(text)
    grouped = plain.rlike(r"^([0-9]+|[0-9]{1,3}(,[0-9]{3})+)$")
    digits = F.when(plain == "-", F.lit("0")).when(grouped, F.replace(plain, F.lit(","), F.lit("")))
    parsed = digits.try_cast("bigint")
    bad = text.isNotNull() & parsed.isNull()
    otherwise = (
        F.raise_error(F.concat(F.lit("not a count: "), text)).cast("bigint")
        if strict
        else F.lit(None).cast("bigint")
    )
    return F.when(text.isNull(), F.lit(0).cast("bigint")).when(bad, otherwise).otherwise(parsed)


def age_band(text: Column) -> Column:
    """``a - b`` -> (a, b), ``90 & Over`` -> (90, null), ``Total`` -> (0, null)."""
    low = F.when(text == "Total", F.lit(0)).otherwise(
        F.regexp_extract(text, r"^(\d+)(?: - \d+| & Over)$", 1).try_cast("int")
    )
    high = F.regexp_extract(text, r"^\d+ - (\d+)$", 1).try_cast("int")
    return F.struct(low.alias("age_min"), high.alias("age_max"))


def code_label(code: Column, labels: dict, strict: bool = True) -> Column:
    """Label of a code; an unknown code is an error when ``strict``, else null."""
    chosen = None
    for key, label in labels.items():
        hit = code == F.lit(key)
        chosen = F.when(hit, label) if chosen is None else chosen.when(hit, label)
    if strict:
        message = F.concat(F.lit("unknown code: "), F.coalesce(code.cast("string"), F.lit("null")))
        return chosen.otherwise(F.raise_error(message).cast("string"))
    return chosen


def column_to_variable(name: Column) -> Column:
    """``B01001_E001`` or ``B01001_M001`` -> ``B01001_001``."""
    return F.regexp_replace(name, r"^([^_]*)_.", "$1_")


def variable_to_column(variable: Column, kind: str = "M") -> Column:
    """``B01001_001`` -> ``B01001_M001``."""
    return F.regexp_replace(variable, r"^([^_]*)_", f"$1_{kind}")


def column_to_variable_name(name: str) -> str:
    """The same rule for a schema-level column name."""
    table, rest = name.split("_", 1)
    return f"{table}_{rest[1:]}"


def state_code(number: Column) -> Column:
    """Two-digit state code, null for numbers that are no state."""
    valid = number.between(1, 55) & ~number.isin(UNUSED_STATE_CODES)
    return F.when(valid, F.lpad(number.cast("string"), 2, "0"))


def state_codes() -> Column:
    """All state codes as one array, to be exploded where needed."""
    unused = F.array(*[F.lit(n) for n in UNUSED_STATE_CODES])
    numbers = F.filter(
        F.sequence(F.lit(1), F.lit(55)), lambda n: ~F.array_contains(unused, n)
    )
    return F.transform(numbers, lambda n: F.lpad(n.cast("string"), 2, "0"))


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def date_literal(value: date | None) -> Column:
    return F.lit(value).cast("date")


def period_is_valid(start: Column, end: Column) -> Column:
    """Start on or before end; null dates count as invalid."""
    return F.coalesce(start <= end, F.lit(False))


def add_int64(a: Column, b: Column) -> Column:
    return a.cast("bigint") + b.cast("bigint")


def subtract_int64(a: Column, b: Column) -> Column:
    return a.cast("bigint") - b.cast("bigint")


def multiply_int64(a: Column, b: Column) -> Column:
    return a.cast("bigint") * b.cast("bigint")


def pair_map(names: Column, values: Column) -> Column:
    """Map from two arrays that must have the same length."""
    same = F.size(names) == F.size(values)
    return F.when(same, F.map_from_arrays(names, values)).otherwise(
        F.raise_error(F.lit("names and values differ in length")).cast("map<string,string>")
    )
