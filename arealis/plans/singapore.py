"""Singapore: nested population table and subzones described in HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.sources import boundaries, nested

# Attributes in the description field of a subzone.
ATTRIBUTES = {"SUBZONE_N": "subzone", "PLN_AREA_N": "planning_area", "REGION_N": "region"}


def subzones(features: DataFrame) -> DataFrame:
    """Subzone, planning area and region with the boundary."""
    found = boundaries.described_attributes(F.col("properties")["Description"], list(ATTRIBUTES))
    return features.select(*[found[a].alias(n) for a, n in ATTRIBUTES.items()], "parts")


def population(spark: SparkSession, path: str) -> DataFrame:
    """Population per subzone, gender and age band from a landed table document."""
    documents = spark.read.text(path, wholetext=True)
    return nested.subzone_population(documents)


def total_population_areas(areas: DataFrame, people: DataFrame) -> DataFrame:
    """Boundaries joined with the population of both genders and all ages."""
    total = people.filter("gender = 'Total' and age_min = 0 and age_max is null")
    return areas.join(total, "subzone")
