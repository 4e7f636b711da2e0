"""Belgium: catalogue of triples, long pipe tables, five levels out of one sector layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.functions.codes import MARITAL_STATUS, NATIONALITY
from arealis.functions.ids import metric_path
from arealis.functions.text import remove_prefix
from arealis.operators import metadata as M
from arealis.operators.quality import apply_known_lists
from arealis.operators.reshape import pivot_metrics
from arealis.plans.template import CountryPlan, MetricsOutput, case_sql
from arealis.schemas import GEO_ID
from arealis.sources import boundaries, delimited, triples
from arealis.specs import CountryRecord, DelimitedFormat, GeometryLevel, PublisherRecord, ReleaseTemplate

NODE_PREFIX = "https://statbel.fgov.be/node/"

# Datasets known to be unreadable (database dumps, broken
# archives, spreadsheets without a table).
FAILING = ["595", "2676", "2654", "3961", "4135", "4136"]


@dataclass(frozen=True)
class Dataset:
    """What is published from one dataset of the catalogue."""

    geography_level: str
    geo_column: str
    source_column: str
    schema: str
    key_columns: tuple[str, ...] = ()
    tag: str = ""
    name: str = ""


_NATIONALITY = case_sql("CD_NATLTY", NATIONALITY, "nationality")
_MARITAL = case_sql("CD_CIV_STS", MARITAL_STATUS, "marital status")

# Datasets, their columns, tags and names.
DATASETS = {
    "4796": Dataset(
        "statistical_sector",
        "CD_SECTOR",
        "TOTAL",
        "CD_SECTOR string, TOTAL bigint",
        tag="#population+adm5+total+2023",
        name="Population, total, 2023",
    ),
    "4689": Dataset(
        "municipality",
        "CD_REFNIS",
        "MS_POPULATION",
        "CD_REFNIS string, CD_NATLTY string, CD_CIV_STS int, CD_AGE int, CD_SEX string, "
        "MS_POPULATION bigint",
        ("CD_NATLTY", "CD_CIV_STS", "CD_AGE", "CD_SEX"),
        tag=f"concat('#population+adm4+', lower(CD_SEX), '+age', CD_AGE, '+', "
        f"lower({_NATIONALITY}), '+', lower({_MARITAL}))",
        name=f"concat('Population, ', {_NATIONALITY}, ', ', {_MARITAL}, ', ', "
        "if(CD_SEX = 'F', 'female', 'male'), ', and age ', CD_AGE)",
    ),
}
GEOMETRY_DATASET = "4726"

# Levels, id columns and name columns of the sector layer.
LEVELS = [
    GeometryLevel(
        level,
        tag,
        f"cd_{column}" if level == "statistical_sector" else f"cd_{column}_refnis",
        {
            "nld": f"tx_{names}_descr_nl",
            "fra": f"tx_{names}_descr_fr",
            "deu": f"tx_{names}_descr_de",
        },
    )
    for level, tag, column, names in (
        ("province", "adm1", "prov", "prov"),
        ("region", "adm2", "rgn", "rgn"),
        ("arrondisement", "adm3", "dstr", "adm_dstr"),
        ("municipality", "adm4", "munty", "munty"),
        ("statistical_sector", "adm5", "sector", "sector"),
    )
]

_START = date(2015, 10, 22)


class Belgium(CountryPlan):
    """Landed: ``catalogue.nt``, ``languages.nt``, ``tables/<node>``, ``sectors.geojsonseq``."""

    record = CountryRecord("Belgium", "Kingdom of Belgium", "BEL", "BE")
    publisher = PublisherRecord(
        "Statbel",
        "https://statbel.fgov.be/en",
        "Statbel is the Belgian statistical office. It is part of the Federal Public Service "
        "Economy, SMEs, Self-employed and Energy.",
        ("bel",),
    )
    levels = LEVELS
    templates = [
        ReleaseTemplate(
            "open_data", "StatBel Open Data", _START, _START, _START, _START, _START,
            date(2022, 1, 1), "https://statbel.fgov.be/en/open-data", "TBC",
        )
    ]
    required: list[str] | None = [GEOMETRY_DATASET, *DATASETS]

    def build_catalogue(self) -> DataFrame:
        graph = triples.read_triples(self.spark, f"{self.landed}/catalogue.nt")
        codes = triples.read_triples(self.spark, f"{self.landed}/languages.nt")
        datasets = triples.objects(graph, triples.DATASET).select(F.col("o").alias("s"))

        def text(predicate: str, name: str) -> DataFrame:
            return triples.text_by_language(graph, predicate).withColumnRenamed("text", name)

        described = (
            datasets.join(text(triples.TITLE, "human_readable_name"), "s")
            .join(text(triples.DESCRIPTION, "description"), "s")
            .join(
                triples.distributions(graph).withColumnsRenamed(
                    {"url": "source_download_url", "member": "source_archive_file_path",
                     "format": "source_format"}
                ),
                "s",
            )
            .join(
                triples.landing_pages(graph, codes).withColumnRenamed(
                    "page", "source_documentation_url"
                ),
                "s",
                "left",
            )
        )
        keyed = described.withColumn("partition_key", remove_prefix(F.col("s"), NODE_PREFIX))
        return apply_known_lists(keyed.drop("s"), "partition_key", FAILING, self.required)

    def geometry_metadata(self) -> DataFrame:
        return M.geometry_table(
            self.spark, self.record.id, self.levels, date(2023, 1, 1), date(2023, 12, 31)
        )

    def boundary_layer(self, level: GeometryLevel) -> DataFrame:
        # one layer for all levels, whose names are read from it as well: its text is parsed once
        wanted = {c for lv in self.levels for c in (lv.geo_id_column, *lv.name_columns.values())}
        return self.kept(
            "sectors", lambda: boundaries.with_properties(self.features("sectors"), sorted(wanted))
        )

    def census_table(self, partition_key: str) -> DataFrame | None:
        dataset = DATASETS.get(partition_key)
        if dataset is None:
            return None
        fmt = DelimitedFormat("|", quoted=False)
        return delimited.read_delimited(
            self.spark, f"{self.landed}/tables/{partition_key}", dataset.schema, fmt
        )

    def source_metric(self, partition_key: str) -> DataFrame:
        dataset = DATASETS[partition_key]
        releases = self.source_data_releases().filter(
            F.col("geometry_level") == dataset.geography_level
        )
        row = self.catalogue().filter(F.col("partition_key") == partition_key)
        return M.source_metric_rows(
            row.withColumn("geometry_level", F.lit(dataset.geography_level)),
            releases,
            ["geometry_level"],
            {
                "description": F.trim("description"),
                "source_metric_id": F.lit(dataset.source_column),
                "parent_metric_id": F.lit(None).cast("string"),
            },
        )

    def derived_metrics(self, partition_key: str) -> MetricsOutput | None:
        dataset = DATASETS.get(partition_key)
        source = self.census_table(partition_key)
        if dataset is None or source is None or dataset.source_column not in source.columns:
            return None
        if source.isEmpty():
            return None
        path = metric_path(F.lit(self.record.id), F.lit(partition_key))
        parent = F.lit(dataset.source_column)
        if dataset.key_columns:
            keys = list(dataset.key_columns)
            valued = source.filter(F.col(dataset.source_column).isNotNull())
            metrics = pivot_metrics(source, dataset.geo_column, keys, dataset.source_column, "mean")
            rows = M.metric_rows_from_templates(
                valued.filter(F.col(dataset.geo_column).isNotNull()),
                keys, dataset.name, dataset.tag, path, parent,
            )
        else:
            metrics = source.select(F.col(dataset.geo_column).alias(GEO_ID), dataset.source_column)
            rows = self.spark.range(1).select(
                F.lit(dataset.source_column).alias("parquet_column_name"),
                F.lit(dataset.tag).alias("hxl_tag"),
                F.lit(dataset.name).alias("human_readable_name"),
                path.alias("metric_parquet_path"),
                parent.alias("parent_metric_id"),
            )
        return MetricsOutput(
            metrics, M.complete_metric_rows(rows, self.source_metric(partition_key))
        )
