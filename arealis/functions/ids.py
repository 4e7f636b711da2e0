"""Content-derived ids and file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealis.functions.text import keep_alphanumeric

# Control characters whose JSON escape holds a hex letter.
_ESCAPES_WITH_LETTERS = ["0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"]


def canonical_json(fields: dict[str, Column]) -> Column:
    """Canonical JSON of the fields: sorted names, nulls kept, ISO dates, no blanks.

    Spark writes control characters as ``\\u001F``; canonical JSON wants the
    hex digits in lower case.  The replacement only fires on an escape, i.e.
    after an even number of backslashes.
    """
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    plain = F.to_json(
        ordered, {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}
    )
    lowered = plain
    for code in _ESCAPES_WITH_LETTERS:
        lowered = F.regexp_replace(
            lowered,
            rf"(?<!\\)((?:\\\\)*)\\u00{code}",
            rf"$1\\u00{code.lower()}",
        )
    return F.when(plain.rlike(r"\\u00(0[BEF]|1[A-F])"), lowered).otherwise(plain)


def content_id(fields: dict[str, Column]) -> Column:
    """SHA-256 over the canonical JSON of the described fields."""
    return F.sha2(canonical_json(fields), 256)


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def country_id(iso3166_2: Column, iso3: Column) -> Column:
    """Subdivision code if there is one, else the ISO 3 code, as a folder name."""
    return F.replace(F.lower(F.coalesce(iso3166_2, iso3)), F.lit("-"), F.lit("_"))


def geometry_path_stem(country: Column, level: Column, start: Column) -> Column:
    """``<country>/geometries/<level>_<year>`` with blanks in the level as ``_``."""
    name = F.array_join(F.split(F.trim(F.lower(level)), r"\s+"), "_")
    return F.concat(
        country, F.lit("/geometries/"), name, F.lit("_"), F.year(start).cast("string")
    )


def metric_path(country: Column, partition: Column) -> Column:
    """``<country>/metrics/<letters and digits of the partition>.parquet``."""
    return F.concat(
        country, F.lit("/metrics/"), keep_alphanumeric(partition), F.lit(".parquet")
    )


def partition_key(*parts: Column) -> Column:
    return F.concat_ws("/", *[p.cast("string") for p in parts])


def release_key(*parts: Column) -> Column:
    """Level, or level and release, or year, period and level."""
    return F.concat_ws("_", *[p.cast("string") for p in parts])
