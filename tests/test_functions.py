from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arealis.functions import codes, ids, text, urls
from arealis.operators.metadata import from_records
from arealis.plans.open_boundaries import DATASETS, datasets


def values(spark, column, rows, schema="a string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_title_case_after_other_blanks(spark):
    samples = ["ab\ncd", "ab\tcd ef", "ab\u00a0cd", "o'neil-x\r\nyz", "a\n\nb"]
    assert values(spark, text.title_case(F.col("a")), [(s,) for s in samples]) == [s.title() for s in samples]


def test_title_case_matches_python(spark):
    samples = [
        "(HISPANIC-LATINO) 3RD o'neil", "", "élan ÉTÉ", "a_b c-d", "x1y2z", "ALL PEOPLE", "straße ßa", "  two  blanks ",
    ]
    got = values(spark, text.title_case(F.col("a")), [(s,) for s in samples])
    assert got == [s.title() for s in samples]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ éÖ019-_'()|:.", max_size=30), min_size=20, max_size=40))
def test_title_case_on_random_text(spark, samples):
    got = values(spark, text.title_case(F.col("a")), [(s,) for s in samples])
    assert got == [s.title() for s in samples]


def test_keep_alphanumeric(spark):
    samples = ["Age, 5 to 9", "été-2", "½ and ²", "日本 1", "a_b"]
    got = values(spark, text.keep_alphanumeric(F.col("a")), [(s,) for s in samples])
    assert got == ["".join(c for c in s if c.isalnum()) for s in samples]


def test_slugs(spark):
    got = {r["description"]: r["name"] for r in datasets(spark).collect()}
    assert got["Boundary-Line"] == "boundary_line"
    assert got["1:250 000 Scale Colour Raster"] == "1_250_000_scale_colour_raster"
    assert got["OS OpenMap - Local"] == "os_openmap_local"
    assert len(got) == len(DATASETS)
    assert values(spark, text.slug(F.col("a"), "-"), [("Éa 1,000/b",)]) == ["ea-1000-b"]


def test_counts(spark):
    rows = [("1,234",), ("-",), (None,), ("7",)]
    assert values(spark, codes.count_from_text(F.col("a")), rows) == [1234, 0, 0, 7]
    assert values(spark, codes.count_from_text(F.col("a"), strict=False), [("x",)]) == [None]
    with pytest.raises(Exception, match="not a count"):
        values(spark, codes.count_from_text(F.col("a")), [("12 people",)])


def test_age_bands(spark):
    got = values(spark, codes.age_band(F.col("a")), [("0 - 4",), ("90 & Over",), ("Total",), ("85 - 89",)])
    assert [tuple(r) for r in got] == [(0, 4), (90, None), (0, None), (85, 89)]


def test_codes(spark):
    assert values(spark, codes.code_label(F.col("a"), codes.NATIONALITY), [("BEL",), ("ETR",)]) == ["Belgian", "non-Belgian"]
    with pytest.raises(Exception, match="unknown code"):
        values(spark, codes.code_label(F.col("a"), codes.NATIONALITY), [("FRA",)])
    assert values(spark, codes.code_label(F.col("a"), codes.SEX_PLURAL, strict=False), [("All",)]) == [None]
    assert values(spark, codes.column_to_variable(F.col("a")), [("B01001_E001",), ("B01001A_M012",)]) == ["B01001_001", "B01001A_012"]
    assert values(spark, codes.variable_to_column(F.col("a"), "E"), [("B01001_001",)]) == ["B01001_E001"]
    fips = spark.range(1).select(codes.state_codes()).first()[0]
    assert fips == [f"{n:02d}" for n in range(1, 56) if n not in (3, 7, 14, 43, 52)]


def test_integer_arithmetic(spark):
    row = spark.range(1).select(
        codes.add_int64(F.lit(2), F.lit(3)), codes.subtract_int64(F.lit(4), F.lit(2)), codes.multiply_int64(F.lit(5), F.lit(7))
    ).first()
    assert tuple(row) == (5, 2, 35)


def test_urls(spark):
    level = urls.with_level_parameter(F.col("a"), F.lit("DZ21"))
    rows = [("https://x/t?d=PEOPLE&v=LGD14&v=SEX",), ("https://x/t?v=LGD14&v=SEX",), ("https://x/t?d=PEOPLE",)]
    assert values(spark, level, rows) == [
        "https://x/t?d=PEOPLE&v=DZ21&v=SEX", "https://x/t?v=DZ21&v=SEX", "https://x/t?d=PEOPLE&v=DZ21",
    ]
    assert values(spark, urls.quote(F.col("a")), [("SNS Data Zone 2011 blk",)]) == ["SNS%20Data%20Zone%202011%20blk"]
    member = urls.archive_member_for_level(F.col("a"), F.lit("ltla"))
    assert values(spark, member, [("census2021-ts009.zip",)]) == ["census2021-ts009-ltla.csv"]
    assert values(spark, urls.double_dot_variant(F.col("a")), [("x-oa.csv",)]) == ["x-oa..csv"]
    joined = urls.join_root("https://h.org/", F.col("a"))
    assert values(spark, joined, [("/o/x.zip",), ("o/x.zip",), ("https://b/x",), (None,)]) == [
        "https://h.org/o/x.zip", "https://h.org/o/x.zip", "https://b/x", None,
    ]


GOLDEN = [
    (
        "publisher",
        {"name": "Test Publisher", "url": "https://example.com", "description": "This is a test publisher", "countries_of_interest": ["GBR"]},
        "0238fa7ccdc4b5095e62d088a0377bb83e40f62895071f2cc2a75333a98895af",
    ),
    (
        "release",
        {
            "name": "Test Data Release", "date_published": date(2021, 1, 1), "reference_period_start": date(2020, 1, 1),
            "reference_period_end": date(2020, 12, 31), "collection_period_start": date(2020, 1, 1),
            "collection_period_end": date(2020, 12, 31), "expect_next_update": date(2022, 1, 1), "url": "https://example.com",
            "data_publisher_id": "test_publisher_id", "description": "This is a test data release", "geometry_metadata_id": "test_geom_id",
        },
        "9ec7e234d73664339e4c1f04bfa485dbb17e204dd72dc3ffbb9cab6870475597",
    ),
    (
        "geometry",
        {"country_id": "gbr", "validity_period_start": date(2021, 1, 1), "validity_period_end": date(2021, 1, 1), "level": "tract", "hxl_tag": "tract"},
        "082cfebd7348ca2d06353ff1d73e6096a60960f9795a26de54faeda777cd7f5d",
    ),
]


@pytest.mark.parametrize("kind, record, expected", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_golden_ids(spark, kind, record, expected):
    assert from_records(spark, kind, [record]).first()[0] == expected


@pytest.mark.parametrize("kind, record, expected", GOLDEN, ids=[g[0] for g in GOLDEN])
def test_every_field_changes_the_id(spark, kind, record, expected):
    changed = []
    for name, value in record.items():
        if name == "country_id":
            continue
        other = date(1999, 1, 1) if isinstance(value, date) else ["X"] if isinstance(value, list) else "other"
        changed.append({**record, name: other})
    found = [r[0] for r in from_records(spark, kind, changed).collect()]
    assert expected not in found and len(set(found)) == len(found)


def test_canonical_json_escapes(spark):
    import json

    raw = 'a\x1f"b\\u001F\x0b\\\x0e é\n'
    got = spark.createDataFrame([(raw, None)], "z string, b string").select(
        ids.canonical_json({"z": F.col("z"), "b": F.col("b")})
    ).first()[0]
    assert got == json.dumps({"b": None, "z": raw}, ensure_ascii=False, separators=(",", ":"))


def test_paths(spark):
    df = spark.createDataFrame([("GB-NIR", "GBR", "Output  Area", date(2021, 3, 21))], "sub string, iso3 string, level string, day date")
    country = ids.country_id(F.col("sub"), F.col("iso3"))
    row = df.select(country, ids.geometry_path_stem(country, F.col("level"), F.col("day")), ids.metric_path(country, F.lit("DZ21/MS-A09"))).first()
    assert tuple(row) == ("gb_nir", "gb_nir/geometries/output_area_2021", "gb_nir/metrics/DZ21MSA09.parquet")
