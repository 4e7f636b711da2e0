"""United States: batched survey tables, variable dictionary, level split."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.text import title_case
from arealis.operators import metadata as M
from arealis.operators.columns import not_blank, quoted, survey_columns
from arealis.operators.derive import add_dictionary_metrics
from arealis.operators.geometry import dissolve_layers
from arealis.operators.grouping import batches
from arealis.operators.joins import concat_columns
from arealis.operators.ordered import carry_forward, stub_paths
from arealis.operators.sets import stack, union_with_precedence
from arealis.plans.template import CountryPlan, LevelOutput, MetricsOutput
from arealis.schemas import GEO_ID
from arealis.session import scratch_path
from arealis.sinks import publish as sink
from arealis.sources import boundaries, delimited, pages
from arealis.specs import (
    CountryRecord,
    DelimitedFormat,
    DictionaryMetric,
    GeometryLevel,
    PublisherRecord,
    ReleaseTemplate,
)

# Summary level codes, periods and years.
SUMMARY_LEVELS = {"tract": 140, "block_group": 150, "county": 50}
PERIODS = ["oneYear", "fiveYear"]
YEARS = [2019, 2020, 2021]
BASE_URL = "https://www2.census.gov/programs-surveys/acs/summary_file/"
BATCH_SIZE = 10
MERGE_BATCH = 20

LEVELS = [GeometryLevel(level, level, GEO_ID, {"eng": "eng"}) for level in ("tract", "block_group", "county")]

# Age groups as the dictionary names them.
CHILD_AGES = ["5 to 9 years", "10 to 14 years", "15 to 17 years"]
ADULT_AGES = [
    "18 and 19 years", "20 years", "21 years", "22 to 24 years", "25 to 29 years",
    "30 to 34 years", "35 to 39 years", "40 to 44 years", "45 to 49 years", "50 to 54 years",
    "55 to 59 years", "60 and 61 years", "62 to 64 years", "65 and 66 years", "67 to 69 years",
    "70 to 74 years", "75 to 79 years", "80 to 84 years", "85 years and over",
]


def _names(sexes: list[str], ages: list[str]) -> tuple[str, ...]:
    return tuple(f"Total|{sex}|{age}" for sex in sexes for age in ages)


def _metric(name: str, variables: tuple[str, ...], tag: str, label: str) -> DictionaryMetric:
    return DictionaryMetric(name, variables, "B01001", "total population", tag, label)


_BOTH = ["Male", "Female"]
AGE_METRICS = [
    _metric("children_5_17", _names(_BOTH, CHILD_AGES), "#population+children+age5_17", "Children aged 5 to 17"),
    _metric("infants_0_4", _names(_BOTH, ["Under 5 years"]), "#population+infants+age0_4", "Infants aged 0 to 4"),
    _metric("children_0_17", _names(_BOTH, ["Under 5 years", *CHILD_AGES]), "#population+children+age0_17", "Children aged 0 to 17"),
    _metric("adults_f", _names(["Female"], ADULT_AGES), "#population+adults+f", "Female adults"),
    _metric("adults_m", _names(["Male"], ADULT_AGES), "#population+adults+m", "Male adults"),
    _metric("adults", _names(_BOTH, ADULT_AGES), "#population+adults", "Adults"),
    _metric("individuals", ("Total",), "#population+ind", "Total individuals"),
]


def has_tables(year: int, period: str, level: str) -> bool:
    """2020 has no one-year tables; one-year tables stop at counties."""
    return not (period == "oneYear" and (year == 2020 or level != "county"))


def table_format(year: int) -> DelimitedFormat:
    return DelimitedFormat("|") if year == 2021 else DelimitedFormat(",", "ISO-8859-1")


def id_column(year: int) -> str:
    return GEO_ID if year == 2021 else "DADSID"


def tables_url(year: int, period: str) -> str:
    folder = {"oneYear": "1YRData", "fiveYear": "5YRData"}[period]
    kind = "table-based-SF/data" if year == 2021 else "prototype"
    return f"{BASE_URL}{year}/{kind}/{folder}/"


def variable_dictionary(shells: DataFrame, year: int) -> DataFrame:
    """Variables of a table-shell file with table name, universe and extended name.

    ``shells`` has ``table_id, unique_id, stub, data_release, universe, title``
    and the source order columns.  Rows without a variable carry the table
    title or the universe for the rows after them; from 2021 both are columns.
    """
    rows = shells.filter(not_blank(F.col("table_id")))
    is_variable = F.col("unique_id").isNotNull()
    group, chunk = ["source_file"], F.col("file_offset")
    order = F.struct("file_offset", "row_index")
    if year == 2021:
        named = rows.withColumn("table_name", title_case(F.col("title")))
    else:
        is_title = ~is_variable & F.col("data_release").isNotNull()
        after = F.trim(F.regexp_extract("stub", "Universe:(.*)$", 1))
        universe = F.when(F.col("stub").contains("Universe:"), after).otherwise(F.col("stub"))
        named = carry_forward(
            rows.drop("universe", "title"),
            group,
            chunk,
            [F.col("file_offset"), F.col("row_index")],
            {
                "table_name": F.when(is_title, title_case(F.col("stub"))),
                "universe": F.when(~is_variable & ~is_title, universe),
            },
        )
    variables = named.filter(is_variable)
    pathed = stub_paths(variables, group, chunk, order, "stub")
    return pathed.select(
        "table_id",
        "unique_id",
        F.coalesce("universe", F.lit("")).alias("universe"),
        "table_name",
        F.col("stub").alias("variable_name"),
        "variable_extended_name",
    )


def at_level(table: DataFrame, geoids: DataFrame, level: str) -> DataFrame:
    """Rows of a survey table whose area is on one summary level."""
    listed = geoids.filter(F.col("SUMLEVEL") == SUMMARY_LEVELS[level]).select(GEO_ID)
    return table.join(listed, GEO_ID, "left_semi")


def widen_in_batches(
    spark, frames: list[DataFrame], key: str = GEO_ID, size: int = MERGE_BATCH, label: str = "wide"
) -> DataFrame:
    """Many tables side by side by key.

    Batches are joined and written to the shared folder before they meet, so no
    plan joins more than ``size`` tables and a lost executor repeats one batch.
    """
    level = frames
    while len(level) > size:
        joined = []
        for i in range(0, len(level), size):
            path = scratch_path(spark, label)
            concat_columns(level[i : i + size], [key]).write.parquet(path)
            joined.append(spark.read.parquet(path))
        level = joined
    return concat_columns(level, [key])


def select_kind(table: DataFrame, kind: str) -> DataFrame:
    """Id and the estimate or margin columns."""
    return table.select(GEO_ID, *[F.col(quoted(c)) for c in survey_columns(table, kind)])


def bulk_level_table(
    spark, tables: list[DataFrame], geoids: DataFrame, level: str
) -> DataFrame:
    """All estimates of a year and period for one level, one row per area."""
    return widen_in_batches(
        spark, [select_kind(at_level(t, geoids, level), "E") for t in tables]
    )


class UnitedStates(CountryPlan):
    """Landed per year and period: ``index/<year>_<period>`` (parquet ``url, html``),
    ``tables/<year>_<period>/<file>``, ``geoids/<year>_<period>``, ``shells/<year>_<period>``;
    ``areas/<year>_<level>.geojsonseq``."""

    record = CountryRecord("United States", "United States of America", "USA", "US")
    publisher = PublisherRecord(
        "United States Census Bureau",
        "https://www.census.gov/programs-surveys/acs",
        "The United States Census Bureau, officially the Bureau of the Census, is a principal "
        "agency of the U.S. Federal Statistical System, responsible for producing data about the "
        "American people and economy.",
        ("usa",),
    )
    levels = LEVELS
    years = YEARS
    batch_size = BATCH_SIZE

    def _periods(self, year: int) -> list[str]:
        return [p for p in PERIODS if any(has_tables(year, p, lv) for lv in SUMMARY_LEVELS)]

    def build_catalogue(self) -> DataFrame:
        listed = []
        for year in self.years:
            for period in self._periods(year):
                page = self.spark.read.parquet(f"{self.landed}/index/{year}_{period}")
                levels = [lv for lv in SUMMARY_LEVELS if has_tables(year, period, lv)]
                names = pages.index_files(page).select("name", "pos")
                listed.append(
                    batches(names.withColumn("year", F.lit(year)), ["year"], "name", ["pos"], self.batch_size)
                    .withColumn("summary_level", F.lit(period))
                    .withColumn("geo_level", F.explode(F.array(*[F.lit(lv) for lv in levels])))
                )
        return stack(listed).select(
            F.concat_ws(
                "/", F.col("year").cast("string"), "summary_level", "geo_level", F.col("batch").cast("string")
            ).alias("partition_key"),
            "year",
            "summary_level",
            "geo_level",
            "batch",
            F.col("items").alias("table_names"),
        )

    def geoids(self, year: int, period: str) -> DataFrame:
        found = delimited.read_named(
            self.spark,
            f"{self.landed}/geoids/{year}_{period}",
            lambda n: T.IntegerType() if n == "SUMLEVEL" else T.StringType(),
            table_format(year),
        )
        return found.withColumnRenamed(id_column(year), GEO_ID)

    def area_names(self, year: int) -> DataFrame:
        """Five-year areas, then the one-year areas they lack."""
        both = [self.geoids(year, p).select(GEO_ID, F.col("NAME").alias("eng")) for p in self._periods(year)[::-1]]
        return reduce(lambda a, b: union_with_precedence(a, b, GEO_ID), both)

    def geometry_metadata(self) -> DataFrame:
        return stack(
            [
                M.geometry_table(self.spark, self.record.id, LEVELS, date(y, 1, 1), date(y, 1, 1))
                for y in self.years
            ]
        )

    def geometry(self) -> list[LevelOutput]:
        layers = {
            f"{year}_{level.level}": (self.features(f"areas/{year}_{level.level}"), level, year)
            for year in self.years
            for level in LEVELS
        }
        shapes = dissolve_layers(
            {
                key: (boundaries.with_properties(features, ["AFFGEOID"]), "AFFGEOID")
                for key, (features, _, _) in layers.items()
            }
        )
        outputs = []
        for key, (_, level, year) in layers.items():
            names = self.kept(f"names_{year}", lambda y=year: self.area_names(y))
            known = shapes[key].join(names.select(GEO_ID), GEO_ID, "left_semi")
            kept = names.join(known.select(GEO_ID), GEO_ID, "left_semi").distinct()
            stem = f"{self.record.id}/geometries/{level.level}_{year}"
            outputs.append(LevelOutput(level, known, kept, stem))
        return outputs

    def build_releases(self) -> DataFrame:
        publisher_id = self.data_publisher().first()["data_publisher_id"]
        frames = []
        for year in self.years:
            day = date(year, 1, 1)
            templates = [
                ReleaseTemplate(
                    f"{year}_{period}", f"ACS {year} {number} year", day, day, day, day, day, day,
                    f"https://www2.census.gov/geo/tiger/GENZ{year}/shp/",
                    "The American Community Survey (ACS) helps local officials, community leaders, "
                    "and businesses understand the changes taking place in their communities. It is "
                    "the premier source for detailed population and housing information about our "
                    "nation.",
                )
                for period, number in (("oneYear", 1), ("fiveYear", 5))
            ]
            levels = M.geometry_table(self.spark, self.record.id, LEVELS, day, day)
            frames.append(M.release_rows(levels, templates, publisher_id))
        return stack(frames)

    def dictionary(self, year: int, period: str) -> DataFrame:
        names = {
            2019: ["Table ID", "UniqueID", "Stub", "Data Release"],
            2020: ["Table ID", "Unique ID", "Stub", "Data Release"],
            2021: ["Table ID", "Unique ID", "Label", "Universe", "Title"],
        }[year]
        found = delimited.read_named(
            self.spark, f"{self.landed}/shells/{year}_{period}", lambda _: T.StringType(), table_format(year)
        )
        missing = set(names) - set(found.columns)
        if missing:
            raise ValueError(f"table shells of {year} lack {sorted(missing)}")
        renames = {
            "Table ID": "table_id", "UniqueID": "unique_id", "Unique ID": "unique_id", "Stub": "stub",
            "Label": "stub", "Data Release": "data_release", "Universe": "universe", "Title": "title",
        }
        kept = delimited.with_source_order(found.select(*[F.col(quoted(n)) for n in names], "_metadata")).drop("_metadata")
        return variable_dictionary(kept.withColumnsRenamed(renames), year)

    def survey_table(self, year: int, period: str, name: str) -> DataFrame:
        path = f"{self.landed}/tables/{year}_{period}/{name}"
        return delimited.read_named(
            self.spark,
            path,
            lambda n: T.LongType() if re.fullmatch(r"B[^_]*_[EM].*", n) else T.StringType(),
            DelimitedFormat("|"),
        )

    def _row(self, partition_key: str):
        return self.catalogue().filter(F.col("partition_key") == partition_key).first()

    def census_table(self, partition_key: str) -> DataFrame | None:
        row = self._row(partition_key)
        if row is None:
            return None
        geoids = self.geoids(row["year"], row["summary_level"])
        tables = [
            at_level(self.survey_table(row["year"], row["summary_level"], n), geoids, row["geo_level"])
            for n in row["table_names"]
        ]
        return concat_columns(tables, [GEO_ID])

    def source_metric(self, partition_key: str) -> DataFrame:
        year, period, level, _ = partition_key.split("/")
        return self.source_data_releases().filter(
            (F.col("release_key") == f"{year}_{period}") & (F.col("geometry_level") == level)
        ).select("source_data_release_id")

    def table_urls(self, names: list[str], year: int, period: str) -> DataFrame:
        """Download url per table id in a file name such as ``acsdt1y2019-b01001.dat``."""
        rows = [(n.split("-")[1].split(".")[0].upper(), tables_url(year, period) + n) for n in names]
        return self.spark.createDataFrame(rows, "url_table string, source_download_url string")

    def derived_metrics(self, partition_key: str) -> MetricsOutput | None:
        row = self._row(partition_key)
        table = self.census_table(partition_key)
        if row is None or table is None or not survey_columns(table, "E") or table.isEmpty():
            return None
        year, period = row["year"], row["summary_level"]
        dictionary = self.kept(
            f"dictionary_{year}_{period}", lambda: self.dictionary(year, period)
        )
        path = f"{self.record.id}/metrics/{''.join(c for c in partition_key if c.isalnum())}.parquet"
        columns = self.spark.createDataFrame(
            [(c,) for c in survey_columns(table, "E")], "parquet_column_name string"
        )
        rows = [
            M.survey_metric_rows(
                columns, dictionary, self.table_urls(row["table_names"], year, period), str(year), period
            ).withColumns(
                {
                    "metric_parquet_path": F.lit(path),
                    "parquet_margin_of_error_file": F.lit(path),
                    "parent_metric_id": F.lit(None).cast("string"),
                }
            )
        ]
        if row["batch"] == 0 and any(c.startswith("B01001_") for c in table.columns):
            table = add_dictionary_metrics(table, dictionary, AGE_METRICS)
            first = next(n for n in row["table_names"] if "b01001." in n)
            derived = M.metric_rows_from_specs(self.spark, AGE_METRICS, path, None).withColumns(
                {
                    "description": F.col("human_readable_name"),
                    "source_metric_id": F.lit("TBD"),
                    "source_documentation_url": F.lit("TBD"),
                    "source_download_url": F.lit(tables_url(year, period) + first),
                }
            )
            rows.insert(0, derived)
        metadata = M.complete_metric_rows(stack(rows, allow_missing=True), self.source_metric(partition_key))
        return MetricsOutput(table, metadata)

    def write_outputs(self, outputs: list[MetricsOutput], base: str) -> list[str]:
        """Partition by partition: margin columns are written but not described."""
        written = [sink.write_partition(o.metrics, o.metadata, base) for o in outputs]
        metadata = stack([o.metadata for o in outputs])
        return [*written, sink.write_metadata(metadata, base, self.record.id)]


def merge_year(
    plan: UnitedStates, year: int, period: str, names: list[str], write: Callable[[DataFrame, str], None]
) -> None:
    """Merge all tables of a year and period into one wide table per level."""
    geoids = plan.geoids(year, period)
    tables = [plan.survey_table(year, period, n) for n in names]
    for level in SUMMARY_LEVELS:
        if has_tables(year, period, level):
            write(bulk_level_table(plan.spark, tables, geoids, level), f"{level}_{year}_{period}.parquet")
