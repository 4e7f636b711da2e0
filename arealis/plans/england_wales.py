"""England and Wales: bulk page, archives of wide tables, metrics picked by header."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.urls import archive_member_for_level, bulk_documentation_url, join_root
from arealis.operators import metadata as M
from arealis.operators.derive import add_header_metrics
from arealis.operators.joins import expand_dimension
from arealis.operators.quality import AssumptionsOutdated
from arealis.operators.sets import stack
from arealis.plans.template import CountryPlan, MetricsOutput
from arealis.schemas import GEO_ID
from arealis.sources import archives, boundaries, pages, zips
from arealis.specs import CountryRecord, GeometryLevel, HeaderMetric, PublisherRecord, ReleaseTemplate

ROOT_URL = "https://www.nomisweb.co.uk/"
BULK_PAGE = ROOT_URL + "sources/census_2021_bulk"
SECTION = "dataset-landing-information"
CENSUS_DAY = date(2021, 3, 21)

# Levels, id columns and name columns (English, Welsh).
LEVELS = [
    GeometryLevel(level, f"#geo+bounds+code+{level}", column, names)
    for level, column, names in (
        ("oa", "oa21cd", {"eng": "name"}),
        ("lsoa", "lsoa21cd", {"eng": "name"}),
        ("msoa", "msoa21cd", {"eng": "name"}),
        ("ltla", "ltla22cd", {"eng": "ltla22nm", "cym": "ltla22nmw"}),
        ("rgn", "rgn22cd", {"eng": "rgn22nm", "cym": "rgn22nmw"}),
        ("ctry", "ctry22cd", {"eng": "ctry22nm", "cym": "ctry22nmw"}),
    )
]

# Derived metrics, sex and ages they cover, tags and names.
AGE_METRICS = [
    HeaderMetric("children_5_17", "total", (5, 17), "#population+children+age5_17", "Children aged 5 to 17"),
    HeaderMetric("infants_0_4", "total", (0, 4), "#population+infants+age0_4", "Infants aged 0 to 4"),
    HeaderMetric("children_0_17", "total", (0, 17), "#population+children+age0_17", "Children aged 0 to 17"),
    HeaderMetric("adults_f", "female", (18, 90), "#population+adults+f", "Female adults"),
    HeaderMetric("adults_m", "male", (18, 90), "#population+adults+m", "Male adults"),
    HeaderMetric("adults", "total", (18, 90), "#population+adults", "Adults"),
    HeaderMetric("individuals", "total", None, "#population+ind", "Total individuals"),
]
DERIVED = {"ltla/TS009": AGE_METRICS}

_TEXT_COLUMNS = {"date", "geography", "geography code"}


def bulk_downloads(bulk_pages: DataFrame) -> DataFrame:
    """Rows of the one table on the bulk page, links made absolute."""
    rows = pages.table_rows(bulk_pages)
    found = rows.groupBy("url").agg(F.countDistinct("table_no").alias("tables"))
    counted = bulk_pages.select("url").distinct().join(found, "url", "left")
    if not counted.filter(F.coalesce("tables", F.lit(0)) != 1).isEmpty():
        raise AssumptionsOutdated("the bulk page no longer holds exactly one table")
    cells = pages.named_cells(
        rows, ["table_id", "description", "original_release", "extra_post_release"]
    )
    return cells.select(
        "row_no",
        F.col("table_id.text").alias("table_id"),
        F.col("description.text").alias("table_name"),
        F.col("original_release.text").alias("original_release_filename"),
        join_root(ROOT_URL, F.col("original_release.href")).alias("original_release_url"),
        F.col("extra_post_release.text").alias("extra_post_release_filename"),
        join_root(ROOT_URL, F.col("extra_post_release.href")).alias("extra_post_release_url"),
    )


def bulk_catalogue(downloads: DataFrame, descriptions: DataFrame, levels: list[str]) -> DataFrame:
    """Tables times levels; ``descriptions`` holds the page text per documentation url."""
    documented = downloads.withColumn(
        "source_documentation_url", bulk_documentation_url(F.col("table_id"))
    ).join(
        descriptions.select(F.col("url").alias("source_documentation_url"), F.col("text").alias("description")),
        "source_documentation_url",
        "left",
    )
    return expand_dimension(documented, "geo_level", levels).select(
        F.concat_ws("/", "geo_level", "table_id").alias("partition_key"),
        "table_id",
        "geo_level",
        F.col("table_name").alias("human_readable_name"),
        "description",
        F.col("original_release_url").alias("source_download_url"),
        archive_member_for_level(F.col("original_release_filename"), F.col("geo_level")).alias(
            "source_archive_file_path"
        ),
        "source_documentation_url",
    )


def wide_metrics(table: DataFrame, specs: list[HeaderMetric]) -> DataFrame:
    """All source columns keyed by ``GEO_ID``, then the derived ones."""
    keyed = table.withColumnRenamed("geography code", GEO_ID).drop("date", "geography")
    return add_header_metrics(keyed, specs) if specs else keyed


class EnglandAndWales(CountryPlan):
    """Landed: ``bulk`` and ``pages`` (parquet ``url, html``), ``archives/*.zip``, ``zones_<level>.geojsonseq``."""

    record = CountryRecord("England and Wales", "England and Wales", "GBR", "GB", "GB-EAW")
    publisher = PublisherRecord(
        "Office for National Statistics",
        BULK_PAGE,
        "We are the UK's largest independent producer of official statistics and its recognised "
        "national statistical institute. We are responsible for collecting and publishing "
        "statistics related to the economy, population and society at national, regional and "
        "local levels. We also conduct the census in England and Wales every 10 years.",
        ("gb_eaw",),
    )
    levels = LEVELS
    templates = [
        ReleaseTemplate(
            "2021", "Census 2021", date(2022, 6, 28), CENSUS_DAY, CENSUS_DAY, CENSUS_DAY, CENSUS_DAY,
            date(2031, 1, 1), "https://www.ons.gov.uk/census",
            "The census takes place every 10 years. It gives us a picture of all the people and "
            "households in England and Wales.",
        )
    ]
    required: list[str] | None = None

    def build_catalogue(self) -> DataFrame:
        downloads = bulk_downloads(self.spark.read.parquet(f"{self.landed}/bulk"))
        descriptions = pages.section_text(self.spark.read.parquet(f"{self.landed}/pages"), SECTION)
        found = bulk_catalogue(downloads, descriptions, [lv.level for lv in self.levels])
        return found if self.required is None else found.filter(F.col("table_id").isin(self.required))

    def geometry_metadata(self) -> DataFrame:
        return M.geometry_table(self.spark, self.record.id, self.levels, CENSUS_DAY, CENSUS_DAY)

    def boundary_layer(self, level: GeometryLevel) -> DataFrame:
        features = self.features(f"zones_{level.level}")
        return boundaries.with_properties(
            features, [level.geo_id_column, *level.name_columns.values()]
        )

    def picked_members(self) -> DataFrame:
        """Archive member and status per catalogue row; archives go by the file name their url ends with."""
        listed = self.archive_members(content=False).withColumn(
            "archive", F.regexp_extract("archive", r"([^/]*)$", 1)
        )
        wanted = self.catalogue().select(
            "partition_key",
            F.regexp_extract("source_download_url", r"([^/]*)$", 1).alias("archive"),
            F.col("source_archive_file_path").alias("wanted"),
        )
        picked = archives.pick_members_with_fallback(listed, wanted.select("archive", "wanted").distinct())
        return wanted.join(picked, ["archive", "wanted"])

    def records(self, archive: str, member: str) -> DataFrame:
        """CSV records of one member; nothing else is unpacked."""
        return zips.csv_records(self.archive_members(archive=archive, member=member))

    def census_table(self, partition_key: str) -> DataFrame | None:
        """``None`` when this table does not exist at this level, which is no failure."""
        row = self.kept("members", self.picked_members).filter(F.col("partition_key") == partition_key).first()
        if row is None or row["status"] != "ok":
            return None
        records = self.records(row["archive"], row["member"])
        header = records.filter("record_no = 0").first()
        if header is None:
            return None
        return zips.record_table(
            records,
            header["fields"],
            lambda n: T.StringType() if n in _TEXT_COLUMNS else T.LongType(),
        )

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
        table = self.census_table(partition_key)
        if table is None or table.isEmpty():
            return None
        specs = DERIVED.get(partition_key, [])
        metrics = wide_metrics(table, specs)
        path = f"{self.record.id}/metrics/{''.join(c for c in partition_key if c.isalnum())}.parquet"
        existing = metrics.drop(*[s.name for s in specs])
        rows = [M.metric_rows_from_columns(existing, path, "TBD")]
        if specs:
            rows.append(M.metric_rows_from_specs(self.spark, specs, path, "TBD"))
        return MetricsOutput(
            metrics, M.complete_metric_rows(stack(rows), self.source_metric(partition_key))
        )
