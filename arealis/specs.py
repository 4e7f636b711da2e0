"""Declarative descriptions of what a job derives.

A spec holds text (SQL predicates, patterns, names) and never a function over
rows, so every plan built from it stays a plain Catalyst plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date


@dataclass(frozen=True)
class DerivedMetric:
    """One metric summed over the rows that satisfy a SQL predicate."""

    name: str
    predicate: str
    hxl_tag: str
    label: str


@dataclass(frozen=True)
class HeaderMetric:
    """One metric summed over wide columns picked by sex and age in the header.

    ``ages`` is an inclusive range; ``None`` picks the all-ages column.
    """

    name: str
    sex: str
    ages: tuple[int, int] | None
    hxl_tag: str
    label: str


@dataclass(frozen=True)
class DictionaryMetric:
    """One metric summed over the variables a dictionary lists under these names."""

    name: str
    variables: tuple[str, ...]
    table_prefix: str
    universe: str
    hxl_tag: str
    label: str


@dataclass(frozen=True)
class PivotSpec:
    """How a long or crosstab table turns into one column per key combination.

    ``name_values`` puts the value column's name in front of the keys; by
    default only when there are several value columns.
    """

    geo_column: str
    value_columns: tuple[str, ...]
    key_columns: tuple[str, ...] = ()
    how: str = "sum"
    separator: str = "_"
    name_values: bool | None = None


@dataclass(frozen=True)
class GeometryLevel:
    """One boundary level and where its ids and names sit in the source layer."""

    level: str
    hxl_tag: str
    geo_id_column: str
    name_columns: dict[str, str] = field(default_factory=dict)
    left_on: str | None = None
    right_on: str | None = None


@dataclass(frozen=True)
class CountryRecord:
    name_short_en: str
    name_official: str
    iso3: str
    iso2: str
    iso3166_2: str | None = None

    @property
    def id(self) -> str:
        return (self.iso3166_2 or self.iso3).lower().replace("-", "_")


@dataclass(frozen=True)
class PublisherRecord:
    name: str
    url: str
    description: str
    countries_of_interest: tuple[str, ...]


@dataclass(frozen=True)
class ReleaseTemplate:
    """Everything about a release except the publisher and geometry it links to."""

    key: str
    name: str
    date_published: date
    reference_period_start: date
    reference_period_end: date
    collection_period_start: date
    collection_period_end: date
    expect_next_update: date
    url: str
    description: str


@dataclass(frozen=True)
class DelimitedFormat:
    """Separator, encoding and quoting of one landed text table."""

    separator: str = ","
    encoding: str = "UTF-8"
    quoted: bool = True
    header: bool = True
