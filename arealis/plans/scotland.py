"""Scotland: archives with an index, crosstabs with unnamed keys, a lookup chain."""

from __future__ import annotations

import itertools
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealis.functions.codes import SEX_PLURAL, count_from_text
from arealis.functions.ids import metric_path, partition_key as key_of, release_key
from arealis.functions.text import description_to_names
from arealis.operators import metadata as M
from arealis.operators.columns import drop_areas, quoted
from arealis.operators.derive import derive_metrics
from arealis.operators.grouping import first_by, ordered_concat
from arealis.operators.joins import chain_lookups, join_on_names
from arealis.operators.quality import apply_known_lists
from arealis.operators.reshape import melt_crosstab, pivot_table, unpivot_values
from arealis.operators.sets import stack
from arealis.plans.template import CountryPlan, MetricsOutput
from arealis.schemas import GEO_ID
from arealis.sources import archives, boundaries, delimited, zips
from arealis.specs import (
    CountryRecord,
    DelimitedFormat,
    DerivedMetric,
    GeometryLevel,
    PivotSpec,
    PublisherRecord,
    ReleaseTemplate,
)

CENSUS_DAY = date(2011, 3, 27)
NEXT_UPDATE = date(2022, 1, 1)
WHOLE_COUNTRY = "S92000003"
INDEX_URL = "https://www.scotlandscensus.gov.uk/media/kqcmo4ge/census-table-index-2011.xlsm"
_NEWS = "https://www.nrscotland.gov.uk/news/"

# Releases, their dates and pages.
RELEASES = [
    ("3A", date(2014, 2, 27), _NEWS + "2014/census-2011-release-3a"),
    ("3I", date(2014, 9, 24), _NEWS + "2014/census-2011-release-3i"),
    ("2A", date(2013, 9, 26), _NEWS + "2013/census-2011-release-2a"),
    ("3C", date(2014, 4, 9), _NEWS + "2014/census-2011-releases-2d-and-3c"),
    ("3D", date(2014, 5, 15), _NEWS + "2014/census-2011-release-3d"),
    ("3E", date(2014, 6, 4), _NEWS + "2014/census-2011-release-3e"),
    ("3F", date(2014, 6, 25), _NEWS + "2014/census-release-3f"),
    ("3L", date(2014, 11, 27), _NEWS + "2014/census-2011-release-3l"),
    ("3K", date(2014, 11, 6), _NEWS + "2014/census-2011-release-3k"),
    ("3N", date(2015, 1, 29), _NEWS + "2015/census-2011-release-3n"),
    (
        "3B",
        date(2014, 3, 19),
        _NEWS + "2014/census-2011-detailed-characteristics-on-ethnicity-identity-language-and-religion-in-scotland-%E2%80%93-release-3b",
    ),
    ("3J", date(2014, 10, 16), _NEWS + "2014/census-2011-release-3j"),
    ("3M", date(2014, 12, 18), _NEWS + "2014/census-2011-release-3m"),
    ("3G", date(2014, 7, 23), _NEWS + "2014/census-2011-release-3g"),
    ("3H", date(2014, 8, 13), _NEWS + "2014/census-2011-release-3h"),
    ("2C", date(2013, 12, 18), _NEWS + "2013/census-2011-release-2c"),
    ("2B", date(2013, 11, 14), _NEWS + "2013/census-2011-release-2b"),
    ("2D", date(2014, 4, 9), _NEWS + "2014/census-2011-releases-2d-and-3c"),
]

# Archives and the level of their tables.
SOURCES = {
    "Council Area blk": "CouncilArea2011",
    "SNS Data Zone 2011 blk": "DataZone2011",
    "Output Area blk": "OutputArea2011",
}

# Levels, id and name columns, keys to the area lookup.
LEVELS = [
    GeometryLevel("OutputArea2011", "TBD", "OA_CODE", {"eng": "OutputArea2011Name"}, "OA_CODE", "OutputArea2011Code"),
    GeometryLevel("DataZone2011", "TBD", "DataZone", {"eng": "Name"}, "DataZone", "DataZone2011Code"),
    GeometryLevel("CouncilArea2011", "TBD", "CouncilArea2011Code", {"eng": "CouncilArea2011Name"}, "DataZone", "DataZone2011Code"),
]

# Age bands of the crosstabs.
INFANTS = ["0 to 4"]
CHILDREN_5_TO_17 = ["5 to 9", "10 to 11", "12 to 14", "15", "16 to 17"]
ADULTS = [
    "18 to 19", "20 to 24", "25 to 29", "30 to 34", "35 to 39", "40 to 44", "45 to 49", "50 to 54", "55 to 59",
    "60 to 64", "65 to 69", "70 to 74", "75 to 79", "80 to 84", "85 to 89", "90 to 94", "95 and over",
]


def _in(bands: list[str], more: str = "") -> str:
    listed = ", ".join(f"'{b}'" for b in bands)
    return f"`Age Category` in ({listed}){more}"


# Derived metrics, their conditions, tags and names.
AGE_METRICS = [
    DerivedMetric("children_5_17", _in(CHILDREN_5_TO_17), "#population+children+age5_17", "Children aged 5 to 17"),
    DerivedMetric("infants_0_4", _in(INFANTS), "#population+infants+age0_4", "Infants aged 0 to 4"),
    DerivedMetric("children_0_17", _in(INFANTS + CHILDREN_5_TO_17), "#population+children+age0_17", "Children aged 0 to 17"),
    DerivedMetric("adults_f", _in(ADULTS, " and `Sex Label` = 'Female'"), "#population+adults+f", "Female adults"),
    DerivedMetric("adults_m", _in(ADULTS, " and `Sex Label` = 'Male'"), "#population+adults+m", "Male adults"),
    DerivedMetric("adults", _in(ADULTS), "#population+adults", "Adults"),
    DerivedMetric("individuals", _in(["All people"]), "#population+ind", "Total individuals"),
]
DERIVED = {f"2011/{level.level}/LC1117SC": AGE_METRICS for level in LEVELS}

# Descriptions whose pivot levels are not told apart by " by ".
DESCRIPTION_NAMES = {
    "Age by single year": ["Age by single year"],
    "National Statistics Socio-economic Classification (NS-SeC) by ethnic group by sex by age": [
        "Ethnic group",
        "Sex and Age",
        "National Statistics Socio-economic Classification (NS-SeC)",
    ],
    "Residence type by sex by age": ["Residence type and Sex", "Age"],
    "Schoolchildren and full-time students living away from home during term time by sex by age": [
        "Schoolchildren and full-time students living away from home during term time and Sex",
        "Age",
    ],
    "Dependent children by household type by sex by age": [
        "Dependent children by household type",
        "Sex",
        "Age",
    ],
}

# Reasons for which a partition has no metrics without anything being wrong.
NO_TABLE, EMPTY_TABLE = "not in the catalogue", "empty member"

INDEX_COLUMNS = [
    "census_release", "table_name", "description", "population_coverage", "variable",
    "catalog_resolution", "year", "additional_url", "population_coverage_and_variable",
]


def table_index(index: DataFrame, order: str) -> DataFrame:
    """One row per table out of the index sheet, variables listed in sheet order."""
    at = F.col(order)
    firsts = ["census_release", "description", "population_coverage", "catalog_resolution", "year"]
    return index.groupBy("table_name").agg(
        *[first_by(F.col(c), at).alias(c) for c in firsts],
        ordered_concat(F.col("variable"), at).alias("variables"),
    )


def area_lookup(
    oa_council: DataFrame, oa_zones: DataFrame, zone_names: DataFrame,
    intermediate_names: DataFrame, council_names: DataFrame,
) -> DataFrame:
    """Output area to council, data zone and intermediate zone, with names."""
    chained = chain_lookups(
        oa_council.select("OutputArea2011Code", "CouncilArea2011Code"),
        [
            (oa_zones, ["OutputArea2011Code"]),
            (zone_names, ["DataZone2011Code"]),
            (intermediate_names, ["IntermediateZone2011Code"]),
            (council_names.select("CouncilArea2011Code", "NRSCouncilAreaName"), ["CouncilArea2011Code"]),
        ],
    )
    return chained.withColumn("OutputArea2011Name", F.col("OutputArea2011Code")).withColumnRenamed(
        "NRSCouncilAreaName", "CouncilArea2011Name"
    )


def number_counts(table: DataFrame, values: list[str]) -> DataFrame:
    """Count texts as numbers, before any sum."""
    return table.withColumns({v: count_from_text(F.col(quoted(v))) for v in values})


class Scotland(CountryPlan):
    """Landed: ``archives/<source>.zip``, ``index.csv``, ``lookup/*.csv``, ``zones_<level>.geojsonseq``."""

    record = CountryRecord("Scotland", "Scotland", "GBR", "GB", "GB-SCT")
    publisher = PublisherRecord(
        "National Records of Scotland",
        "https://www.nrscotland.gov.uk/",
        "National Records of Scotland (NRS) is a Non-Ministerial Department of the Scottish "
        "Government. Our purpose is to collect, preserve and produce information about "
        "Scotland's people and history and make it available to inform current and future "
        "generations.",
        ("gb_sct",),
    )
    levels = LEVELS
    templates = [
        ReleaseTemplate(
            key, f"Census 2011: Release {key}", day, CENSUS_DAY, CENSUS_DAY, CENSUS_DAY, CENSUS_DAY,
            NEXT_UPDATE, url, "TBD",
        )
        for key, day, url in RELEASES
    ] + [
        ReleaseTemplate(
            "75+", "Census 2011: 75+", date(2014, 1, 1), CENSUS_DAY, CENSUS_DAY, CENSUS_DAY,
            CENSUS_DAY, NEXT_UPDATE, "TBD", "TBD",
        )
    ]
    required: list[str] | None = None
    allow_missing = True

    def __init__(self, *args, **kwargs) -> None:
        super().__init__(*args, **kwargs)
        self.skipped: dict[str, str] = {}

    def index(self) -> DataFrame:
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in INDEX_COLUMNS])
        sheet = delimited.read_delimited(
            self.spark, f"{self.landed}/index.csv", schema, DelimitedFormat(header=False)
        )
        ordered = delimited.with_source_order(sheet).withColumn(
            "_order", F.struct("file_offset", "row_index")
        )
        return table_index(ordered, "_order")

    def members(self) -> DataFrame:
        """Members of all archives with their level and table name."""
        found = self.archive_members(content=False)
        source = F.regexp_replace(
            F.regexp_extract(F.url_decode("archive"), r"([^/]*)\.zip$", 1), "_", " "
        )
        level = F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair])
        return archives.table_members(found, self.index()).withColumns(
            {"source": source, "resolution": F.element_at(level, source)}
        )

    def build_catalogue(self) -> DataFrame:
        described = self.members().join(self.index(), "table_name")
        keyed = described.select(
            key_of(F.col("year").cast("int"), F.col("resolution"), F.col("table_name")).alias(
                "partition_key"
            ),
            "resolution",
            "table_name",
            "archive",
            "member",
            "census_release",
            "catalog_resolution",
            "variables",
            "description",
            F.concat("description", F.lit(" ("), "population_coverage", F.lit(")")).alias(
                "human_readable_name"
            ),
            F.col("archive").alias("source_download_url"),
            F.lit(None).cast("string").alias("source_archive_file_path"),
            F.lit(INDEX_URL).alias("source_documentation_url"),
        )
        return apply_known_lists(
            keyed,
            "table_name",
            required=self.required,
            overrides={
                "census_release": {
                    "resolution = 'CouncilArea2011' and table_name = 'DC6102SC'": "3I"
                }
            },
        ).filter("not (table_name = 'QS421SC' and resolution = 'DataZone2011')")

    def geometry_metadata(self) -> DataFrame:
        return M.geometry_table(self.spark, self.record.id, self.levels, CENSUS_DAY, CENSUS_DAY)

    def lookup(self) -> DataFrame:
        def read(name: str) -> DataFrame:
            return self.spark.read.option("header", True).csv(f"{self.landed}/lookup/{name}.csv")

        return area_lookup(
            read("oa_council"), read("oa_zones"), read("zone_names"),
            read("intermediate_names"), read("council_names"),
        )

    def boundary_layer(self, level: GeometryLevel) -> DataFrame:
        features = self.features(f"zones_{level.level}")
        names = [level.left_on] + (["Name"] if level.level == "DataZone2011" else [])
        layer = boundaries.with_properties(features, names)
        return join_on_names(layer, self.lookup(), level.left_on, level.right_on)

    def census_table(self, partition_key: str) -> DataFrame | str:
        """The table of a partition, or why there is none."""
        row = self.catalogue().filter(F.col("partition_key") == partition_key).first()
        if row is None:
            return NO_TABLE
        archive = row["archive"].rpartition("/")[2]
        records = zips.csv_records(self.archive_members(archive=archive, member=row["member"]))
        header = records.filter("record_no = 0").first()
        if header is None or header["fields"] is None:
            return EMPTY_TABLE if header is None else header["problem"]
        # Blank headers become positional: the area first, then the keys.
        position = itertools.count()

        def named(cell: str) -> str:
            if cell.strip():
                return cell
            at = next(position)
            return GEO_ID if at == 0 else f"key_{at - 1}"

        return zips.record_table(records, [named(c) for c in header["fields"]])

    def source_metric(self, partition_key: str) -> DataFrame:
        level = partition_key.split("/")[1]
        row = self.catalogue().filter(F.col("partition_key") == partition_key)
        releases = self.source_data_releases().select(
            release_key(F.col("geometry_level"), F.col("release_key")).alias("level_and_release"),
            "source_data_release_id",
        )
        return M.source_metric_rows(
            row.withColumn(
                "level_and_release", release_key(F.lit(level), F.col("census_release"))
            ),
            releases,
            ["level_and_release"],
            {"hxl_tag": F.lit("TBD"), "source_metric_id": F.lit("TBD")},
        )

    def derived_metrics(self, partition_key: str) -> MetricsOutput | None:
        """The partition's metrics; a partition that has none is noted in ``skipped`` with the reason."""
        output = self._derive(partition_key)
        if isinstance(output, MetricsOutput):
            return output
        self.skipped[partition_key] = output
        if not self.allow_missing and output not in (NO_TABLE, EMPTY_TABLE):
            raise ValueError(output)
        return None

    def outcomes(self) -> DataFrame:
        """(partition_key, status, reason) of all partitions of the catalogue after publishing."""
        reasons = self.spark.createDataFrame(list(self.skipped.items()), "partition_key string, reason string")
        return self.catalogue().select("partition_key").join(reasons, "partition_key", "left").select(
            "partition_key",
            F.when(F.col("reason").isNull(), "ok").otherwise("skipped").alias("status"),
            "reason",
        )

    def _derive(self, partition_key: str) -> MetricsOutput | str:
        """The metrics, or why there are none."""
        table = self.census_table(partition_key)
        if isinstance(table, str):
            return table
        source = self.source_metric(partition_key)
        keys = [c for c in table.columns if c.startswith("key_")]
        values = [c for c in table.columns if c != GEO_ID and c not in keys]
        counted = number_counts(drop_areas(table, [WHOLE_COUNTRY]), values)
        path = metric_path(F.lit(self.record.id), F.lit(partition_key))
        described = source.select(
            description_to_names(F.col("description"), DESCRIPTION_NAMES).alias("n")
        ).first()
        if described is None:
            return "no release or catalogue row"
        names = described["n"]
        if len(names) != len(keys) + 1:
            return f"names {names} do not fit {len(keys)} keys and a value"
        spec = PivotSpec(GEO_ID, tuple(values), tuple(keys), "sum", "__", name_values=bool(keys))
        metrics = pivot_table(counted, spec)
        long = unpivot_values(counted, [GEO_ID, *keys], values)
        rows = [
            M.metric_rows_from_keys(
                long, ["value_name", *keys], path, F.lit("TBD"), "__", key_names=names
            )
        ]
        specs = DERIVED.get(partition_key)
        if specs:
            crosstab = counted.withColumnRenamed("key_0", "Age Category").drop("All people")
            melted = melt_crosstab(
                crosstab, [GEO_ID, "Age Category"], SEX_PLURAL, "Sex Label", "Count"
            )
            metrics = derive_metrics(melted, specs, "Count").join(metrics, GEO_ID)
            path_text = f"{self.record.id}/metrics/{''.join(c for c in partition_key if c.isalnum())}.parquet"
            rows.insert(0, M.metric_rows_from_specs(self.spark, specs, path_text, "TBD"))
        return MetricsOutput(metrics, M.complete_metric_rows(stack(rows), source))
