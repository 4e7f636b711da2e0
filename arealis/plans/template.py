"""The steps every country job goes through, each open to replacement."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.operators.columns import quoted
from arealis.operators.geometry import dissolve_layers, level_names
from arealis.operators.metadata import country_table, publisher_table, release_rows
from arealis.operators.reshape import fold_to_long
from arealis.operators.sets import stack
from arealis.schemas import published_schema
from arealis.session import scratch_path
from arealis.sinks import publish as sink
from arealis.sources import boundaries, zips
from arealis.specs import CountryRecord, GeometryLevel, PublisherRecord, ReleaseTemplate


@dataclass
class LevelOutput:
    """Boundaries and names of one geometry level."""

    level: GeometryLevel
    boundaries: DataFrame
    names: DataFrame
    stem: str | None = None


@dataclass
class MetricsOutput:
    """One metric table and one metadata row per column of it."""

    metrics: DataFrame
    metadata: DataFrame


class CountryPlan(ABC):
    """A country job over landed files.

    Subclasses say where things are and what to derive.  Steps take and return
    DataFrames; only the number of partitions (source tables) is looped over in
    the driver, because each becomes its own wide table.
    """

    record: CountryRecord
    publisher: PublisherRecord
    levels: list[GeometryLevel] = []
    templates: list[ReleaseTemplate] = []
    #: Landed boundary files: ``.geojsonseq`` (one feature per line, splits
    #: across tasks) or ``.geojson`` (one document per file).
    boundary_suffix = ".geojsonseq"

    def __init__(self, spark: SparkSession, landed: str, languages: DataFrame | None = None):
        self.spark = spark
        self.landed = landed.rstrip("/")
        self.languages = languages
        self._paths: dict[str, str] = {}

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table computed once per plan, into the shared folder."""
        if name not in self._paths:
            path = scratch_path(self.spark, name)
            build().write.parquet(path)
            self._paths[name] = path
        return self.spark.read.parquet(self._paths[name])

    # Metadata steps -----------------------------------------------------

    def country_metadata(self) -> DataFrame:
        return country_table(self.spark, self.record)

    def data_publisher(self) -> DataFrame:
        return publisher_table(self.spark, self.publisher)

    @abstractmethod
    def build_catalogue(self) -> DataFrame:
        """One row per source table, with ``partition_key``."""

    def catalogue(self) -> DataFrame:
        return self.kept("catalogue", self.build_catalogue)

    @abstractmethod
    def geometry_metadata(self) -> DataFrame:
        """Published geometry metadata."""

    def source_data_releases(self) -> DataFrame:
        return self.kept("releases", self.build_releases)

    def build_releases(self) -> DataFrame:
        """Releases with ``release_key`` and ``geometry_level``; the publisher id is one value."""
        publisher_id = self.data_publisher().first()["data_publisher_id"]
        return release_rows(self.geometry_metadata(), self.templates, publisher_id)

    # Data steps ---------------------------------------------------------

    def boundary_layer(self, level: GeometryLevel) -> DataFrame:
        """Source layer of a level, with its id and name columns and ``parts``."""
        raise NotImplementedError

    def features(self, name: str) -> DataFrame:
        """Landed features of a layer."""
        path = f"{self.landed}/{name}{self.boundary_suffix}"
        if self.boundary_suffix == ".geojson":
            return boundaries.read_feature_collections(self.spark, path)
        return boundaries.read_feature_lines(self.spark, path)

    def archive_members(
        self, content: bool = True, archive: str = "*.zip", member: str | None = None
    ) -> DataFrame:
        """Members of the landed zip files, in chunks, or their list without ``content``."""
        return zips.read_zip_members(self.spark, f"{self.landed}/archives/{archive}", content, member)

    def geometry(self) -> list[LevelOutput]:
        layers = {level.level: self.boundary_layer(level) for level in self.levels}
        shapes = dissolve_layers(
            {level.level: (layers[level.level], level.geo_id_column) for level in self.levels}
        )
        return [
            LevelOutput(level, shapes[level.level], level_names(layers[level.level], level))
            for level in self.levels
        ]

    @abstractmethod
    def census_table(self, partition_key: str) -> DataFrame | None:
        """Source table of a partition, ``None`` when there is none."""

    @abstractmethod
    def source_metric(self, partition_key: str) -> DataFrame:
        """The one template row metrics of a partition start from."""

    @abstractmethod
    def derived_metrics(self, partition_key: str) -> MetricsOutput | None:
        """Metrics of a partition, ``None`` when it is skipped."""

    # Fan-in and publication ---------------------------------------------

    def partition_keys(self) -> list[str]:
        """Names of the source tables; a catalogue lists hundreds of them."""
        rows = self.catalogue().select("partition_key").distinct().orderBy("partition_key")
        return [r["partition_key"] for r in rows.collect()]

    def metrics(self, partitions: list[str] | None = None) -> dict[str, MetricsOutput]:
        """Outputs of all partitions, or of chosen ones, without the skipped."""
        keys = self.partition_keys() if partitions is None else partitions
        outputs = {key: self.derived_metrics(key) for key in keys}
        return {key: output for key, output in outputs.items() if output is not None}

    def long_metrics(self, partitions: list[str] | None = None) -> DataFrame:
        """All metrics of all partitions as one long table."""
        frames = [
            fold_to_long(output.metrics).select(
                F.lit(self.record.id).alias("country_id"),
                F.lit(key).alias("partition_key"),
                "GEO_ID",
                "metric",
                "value",
            )
            for key, output in self.metrics(partitions).items()
        ]
        return stack(frames)

    def publish(self, base: str, partitions: list[str] | None = None) -> list[str]:
        """Write the whole country folder."""
        country = self.record.id
        outputs = list(self.metrics(partitions).values())
        written = [
            sink.write_metadata(self.country_metadata(), base, country),
            sink.write_metadata(self.data_publisher(), base, country),
            sink.write_metadata(
                self.source_data_releases().select(*published_schema("release").fieldNames()),
                base,
                country,
            ),
        ]
        if self.levels:
            if self.languages is None:
                raise ValueError("publishing geometry needs the table of language codes")
            stems = {
                r["geometry_level"]: r["geometry_filepath_stem"]
                for r in self.geometry_metadata()
                .select("geometry_level", "geometry_filepath_stem")
                .collect()
            }
            written += sink.write_geometry(
                [
                    (o.stem or stems[o.level.level], o.boundaries, o.names)
                    for o in self.geometry()
                ],
                self.geometry_metadata(),
                self.languages,
                base,
                country,
            )
        return written + self.write_outputs(outputs, base)

    def write_outputs(self, outputs: list[MetricsOutput], base: str) -> list[str]:
        """Metric tables and all their metadata."""
        return sink.write_metrics(
            [(o.metrics, o.metadata) for o in outputs], base, self.record.id
        )


def case_sql(column: str, labels: dict, kind: str = "value") -> str:
    """SQL that maps codes to labels and fails on an unknown code."""

    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    branches = " ".join(f"when {literal(k)} then {literal(v)}" for k, v in labels.items())
    return (
        f"case {quoted(column)} {branches} "
        f"else cast(raise_error(concat('unknown {kind}: ', {quoted(column)})) as string) end"
    )
