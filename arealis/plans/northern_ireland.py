"""Northern Ireland: pages and metadata documents, long tables, code and label pivots."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.ids import metric_path
from arealis.operators import metadata as M
from arealis.operators.columns import columns_ending
from arealis.operators.derive import derive_metrics
from arealis.operators.joins import join_on_names
from arealis.operators.reshape import pivot_codes_and_labels
from arealis.operators.sets import stack
from arealis.plans.template import CountryPlan, MetricsOutput
from arealis.schemas import GEO_ID
from arealis.sources import boundaries, delimited, nested, pages
from arealis.specs import CountryRecord, DerivedMetric, GeometryLevel, PublisherRecord, ReleaseTemplate

SITE = "https://build.nisra.gov.uk"
CENSUS_DAY = date(2021, 3, 21)

# Levels, their id columns in the layer and in the census tables.
LEVELS = [
    GeometryLevel("DZ21", "TBD", "DZ2021_cd", {"eng": "DZ2021_nm"}),
    GeometryLevel("SDZ21", "TBD", "SDZ2021_cd", {"eng": "SDZ2021_nm"}),
    GeometryLevel("LGD14", "TBD", "LGD2014_cd", {"eng": "LGD2014_name"}, "DZ2021_cd", "DZ2021_code"),
]
TABLE_GEOGRAPHY = {
    "DZ21": "Census 2021 Data Zone",
    "SDZ21": "Census 2021 Super Data Zone",
    "LGD14": "Local Government District 2014",
}

# Derived metrics, their conditions, tags and names.
AGE_METRICS = [
    DerivedMetric("children_5_17", "`Age Code` >= 5 and `Age Code` < 18", "#population+children+age5_17", "Children aged 5 to 17"),
    DerivedMetric("infants_0_4", "`Age Code` >= 0 and `Age Code` < 5", "#population+infants+age0_4", "Infants aged 0 to 4"),
    DerivedMetric("children_0_17", "`Age Code` >= 0 and `Age Code` < 18", "#population+children+age0_17", "Children aged 0 to 17"),
    DerivedMetric("adults_f", "`Age Code` >= 18 and `Sex Label` = 'Female'", "#population+adults+f", "Female adults"),
    DerivedMetric("adults_m", "`Age Code` >= 18 and `Sex Label` = 'Male'", "#population+adults+m", "Male adults"),
    DerivedMetric("adults", "`Age Code` >= 18", "#population+adults", "Adults"),
    DerivedMetric("individuals", "true", "#population+ind", "Total individuals"),
]
DERIVED = {"DZ21/MS-A09": AGE_METRICS, "SDZ21/MS-A09": AGE_METRICS}


def standard_table_links(index_page: DataFrame) -> DataFrame:
    """Pages of ready-made tables linked from the index page."""
    found = pages.links(index_page).filter(F.col("href").startswith("/en/standard"))
    return found.select(F.concat(F.lit(SITE), "href").alias("url")).distinct()


def table_links(table_pages: DataFrame) -> DataFrame:
    """First data link and first metadata link of each page."""
    href = F.col("href")
    found = pages.first_link(
        pages.links(table_pages),
        {
            "table_url": href.contains("table.csv?"),
            "metadata_url": href.contains("table.csv-metadata"),
        },
    )
    return found.select(
        "url",
        F.concat(F.lit(SITE), "table_url").alias("table_url"),
        F.concat(F.lit(SITE), "metadata_url").alias("metadata_url"),
    )


def _type_of(name: str) -> T.DataType:
    return {"Age Code": T.IntegerType(), "Count": T.LongType()}.get(name, T.StringType())


class NorthernIreland(CountryPlan):
    """Landed: ``metadata`` (parquet ``url, value``), ``tables/<level>/<id>.csv``,
    ``zones_<level>.geojsonseq``, ``zone_lookup.csv``."""

    record = CountryRecord("Northern Ireland", "Northern Ireland", "GBR", "GB", "GB-NIR")
    publisher = PublisherRecord(
        "NISRA",
        "https://www.nisra.gov.uk/",
        "The Northern Ireland Statistics and Research Agency (NISRA), which incorporates the "
        "General Register Office (GRO), is an executive agency within the Department of Finance "
        "(NI) and was established on 1 April 1996.",
        ("gb_nir",),
    )
    levels = LEVELS
    templates = [
        ReleaseTemplate(
            "2021", "Census 2021", date(2023, 2, 21), CENSUS_DAY, CENSUS_DAY, CENSUS_DAY, CENSUS_DAY,
            date(2031, 1, 1),
            "https://www.nisra.gov.uk/publications/census-2021-outputs-prospectus", "TBC",
        )
    ]
    required: list[str] | None = None

    def build_catalogue(self) -> DataFrame:
        documents = self.spark.read.parquet(f"{self.landed}/metadata")
        found = nested.level_catalogue(documents, [lv.level for lv in self.levels])
        return found if self.required is None else found.filter(F.col("table_id").isin(self.required))

    def geometry_metadata(self) -> DataFrame:
        return M.geometry_table(self.spark, self.record.id, self.levels, CENSUS_DAY, CENSUS_DAY)

    def boundary_layer(self, level: GeometryLevel) -> DataFrame:
        features = self.features(f"zones_{level.level}")
        if level.left_on is None:
            return boundaries.with_properties(
                features, [level.geo_id_column, *level.name_columns.values()]
            )
        lookup = self.spark.read.option("header", True).csv(f"{self.landed}/zone_lookup.csv")
        layer = boundaries.with_properties(features, [level.left_on])
        return join_on_names(layer, lookup, level.left_on, level.right_on, "full_outer")

    def census_table(self, partition_key: str) -> DataFrame | None:
        level, table = partition_key.split("/")
        path = f"{self.landed}/tables/{level}/{table}.csv"
        found = delimited.read_named(self.spark, path, _type_of)
        return found if "Count" in found.columns else None

    def source_metric(self, partition_key: str) -> DataFrame:
        level = partition_key.split("/")[0]
        row = self.catalogue().filter(F.col("partition_key") == partition_key)
        return M.source_metric_rows(
            row.withColumn("geometry_level", F.lit(level)),
            self.source_data_releases(),
            ["geometry_level"],
            {
                "parquet_column_name": F.lit("Count"),
                "hxl_tag": F.lit("TBD"),
                "source_metric_id": F.lit("TBD"),
            },
        )

    def derived_metrics(self, partition_key: str) -> MetricsOutput | None:
        source = self.census_table(partition_key)
        if source is None or source.isEmpty():
            return None
        geography = TABLE_GEOGRAPHY[partition_key.split("/")[0]]
        table = source.withColumnRenamed(f"{geography} Code", GEO_ID).drop(f"{geography} Label")
        path = metric_path(F.lit(self.record.id), F.lit(partition_key))
        parent = F.lit("TBD")
        metrics = pivot_codes_and_labels(table, GEO_ID, "Count")
        rows = []
        specs = DERIVED.get(partition_key)
        if specs:
            # Areas lacking any derived metric fall out, as with an inner join.
            derived = derive_metrics(table, specs, "Count")
            metrics = derived.join(metrics, GEO_ID)
            path_text = f"{self.record.id}/metrics/{''.join(c for c in partition_key if c.isalnum())}.parquet"
            rows.append(M.metric_rows_from_specs(self.spark, specs, path_text, "TBD"))
        for ending in ("Code", "Label"):
            keys = [c for c in columns_ending(table, ending) if c != GEO_ID]
            names = [c.removesuffix(ending).strip() for c in keys]
            rows.append(M.metric_rows_from_keys(table, keys, path, parent, key_names=names))
        return MetricsOutput(
            metrics, M.complete_metric_rows(stack(rows), self.source_metric(partition_key))
        )


def population_table(spark, path: str) -> DataFrame:
    """The ready-made population table on its own."""
    return delimited.read_named(spark, path, _type_of)


def boundary_features(spark, path: str) -> DataFrame:
    """The zone layer on its own."""
    return boundaries.read_feature_collections(spark, path)
