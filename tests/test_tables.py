"""Derived metrics, pivots, joins and sets against plain pandas or loops."""

import random

import pandas as pd
import pytest

from arealis.operators import columns as C
from arealis.operators import grouping as G
from arealis.operators import joins as J
from arealis.operators import sets as S
from arealis.operators.derive import add_dictionary_metrics, add_header_metrics, derive_metric, derive_metrics
from arealis.operators.reshape import pivot_codes_and_labels, pivot_metrics, pivot_table
from arealis.plans.england_wales import AGE_METRICS, wide_metrics
from arealis.plans.northern_ireland import AGE_METRICS as LONG_METRICS
from arealis.plans.usa import AGE_METRICS as SURVEY_METRICS
from arealis.specs import PivotSpec


def frame(df):
    return df.toPandas().sort_values("GEO_ID").set_index("GEO_ID").sort_index(axis=1)


def wide_rows():
    """Single-year cells that add up to published totals of one area, and a second area."""
    totals = {"All persons": (4981, 14847, 72519), "Female": (2400, 7200, 37971), "Male": (2581, 7647, 34548)}
    rows = []
    for code in ("E06000001", "E06000002"):
        row = {"date": "2021", "geography": "Name", "geography code": code}
        for sex, (infants, children, adults) in totals.items():
            row[f"Sex: {sex}; Age: Total; measures: Value"] = infants + children + adults
            for age in range(91):
                label = "Aged under 1 year" if age == 0 else "Aged 90 years and over" if age == 90 else f"Aged {age} year{'s' if age > 1 else ''}"
                group, first, size = (infants, 0, 5) if age < 5 else (children, 5, 13) if age < 18 else (adults, 18, 73)
                row[f"Sex: {sex}; Age: {label}; measures: Value"] = group // size + (group % size if age == first else 0)
        rows.append(row)
    return rows


def test_wide_goldens(spark):
    rows = wide_rows()
    names = list(rows[0])
    data = [tuple(r[n] for n in names) for r in rows]
    ddl = ", ".join(f"`{n}` {'string' if i < 3 else 'bigint'}" for i, n in enumerate(names))
    row = wide_metrics(spark.createDataFrame(data, ddl), AGE_METRICS).filter("GEO_ID = 'E06000001'").first()
    expected = {
        "children_5_17": 14847, "infants_0_4": 4981, "children_0_17": 19828, "adults_f": 37971, "adults_m": 34548,
        "adults": 72519, "individuals": 92347,
    }
    assert {n: row[n] for n in expected} == expected


def test_row_sum_counts_null_as_zero(spark):
    name = "Sex: Male; Age: Aged 20 years; measures: Value"
    df = spark.createDataFrame([("a", None), ("b", 3)], f"GEO_ID string, `{name}` bigint")
    got = {r.GEO_ID: r.adults_m for r in add_header_metrics(df, [m for m in AGE_METRICS if m.name == "adults_m"]).collect()}
    assert got == {"a": 0, "b": 3}


def random_long(n=4000, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        geo = rng.choice(["N00", "N00", "N00", "N01", "N02", None])
        rows.append((geo, rng.choice([0, 4, 5, 17, 18, 90, None]), rng.choice(["Female", "Male", None]), rng.choice([None, 1, 2, 3])))
    rows += [("N99", 3, "Male", 1)]
    return rows


SCHEMA = "GEO_ID string, `Age Code` int, `Sex Label` string, Count bigint"


def test_one_pass_equals_single_metrics_joined(spark):
    df = spark.createDataFrame(random_long(), SCHEMA)
    together = frame(derive_metrics(df, LONG_METRICS, "Count"))
    single = [derive_metric(df, m, "Count") for m in LONG_METRICS]
    joined = frame(J.join_all(single, ["GEO_ID"]))
    pd.testing.assert_frame_equal(together, joined)
    assert "N99" not in together.index


@pytest.mark.parametrize("how", ["sum", "mean"])
def test_pivot_matches_pandas(spark, how):
    rows = random_long()
    rows += [("N03", 5, "Male", None), ("N04", 0, "Female", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = frame(pivot_metrics(df, "GEO_ID", ["Age Code", "Sex Label"], "Count", how))
    table = pd.DataFrame(rows, columns=["GEO_ID", "Age Code", "Sex Label", "Count"])
    table["Age Code"] = table["Age Code"].astype("Int64")
    want = table.pivot_table(index="GEO_ID", columns=["Age Code", "Sex Label"], values="Count", aggfunc=how)
    want.columns = ["_".join(map(str, c)) for c in want.columns]
    want = want.sort_index(axis=1)
    pd.testing.assert_frame_equal(got.astype(float), want.astype(float), check_names=False)


def test_pivot_refuses_ambiguous_names(spark):
    df = spark.createDataFrame([("a", "x_y", "z", 1), ("a", "x", "y_z", 1)], "GEO_ID string, k string, l string, v int")
    with pytest.raises(ValueError, match="share one column name"):
        pivot_metrics(df, "GEO_ID", ["k", "l"], "v")


def test_multi_value_names(spark):
    df = spark.createDataFrame([("a", "0 to 4", 3, 4), ("a", "5 to 9", 5, 6)], "GEO_ID string, key_0 string, Males int, Females int")
    got = pivot_table(df, PivotSpec("GEO_ID", ("Males", "Females"), ("key_0",), "sum", "__")).first().asDict()
    assert got == {"GEO_ID": "a", "Males__0 to 4": 3, "Males__5 to 9": 5, "Females__0 to 4": 4, "Females__5 to 9": 6}
    one = pivot_table(df, PivotSpec("GEO_ID", ("Males",), ("key_0",), "sum", "__", name_values=True)).columns
    assert one == ["GEO_ID", "Males__0 to 4", "Males__5 to 9"]


def test_code_and_label_pivot(spark):
    rows = [("a", 1, "one", 5), ("a", 2, "two", 6), ("b", 1, "one", 7)]
    df = spark.createDataFrame(rows, "GEO_ID string, `Age Code` int, `Age Label` string, Count int")
    got = {r["GEO_ID"]: r.asDict() for r in pivot_codes_and_labels(df, "GEO_ID", "Count").collect()}
    assert got["a"] == {"GEO_ID": "a", "1": 5, "2": 6, "one": 5, "two": 6}
    assert got["b"]["two"] is None


def test_dictionary_metrics(spark):
    variables = sorted({v for m in SURVEY_METRICS for v in m.variables})
    rows = [("B01001", f"B01001_{i:03d}", "Total Population", v) for i, v in enumerate(variables, 1)]
    rows += [("B01001A", f"B01001A_{i:03d}", "White alone", v) for i, v in enumerate(variables, 1)]
    dictionary = spark.createDataFrame(rows, "table_id string, unique_id string, universe string, variable_extended_name string")
    names = [f"B01001_E{i:03d}" for i in range(1, len(variables) + 1)]
    wide = spark.createDataFrame([("g", *range(1, len(names) + 1))], ", ".join(["GEO_ID string", *[f"{n} bigint" for n in names]]))
    row = add_dictionary_metrics(wide, dictionary, SURVEY_METRICS).first()
    for m in SURVEY_METRICS:
        assert row[m.name] == sum(variables.index(v) + 1 for v in m.variables)
    with pytest.raises(ValueError, match="variables match"):
        add_dictionary_metrics(wide, dictionary.filter("unique_id <> 'B01001_003'"), SURVEY_METRICS)


def test_columns(spark):
    df = spark.createDataFrame([("a", "b", 1, 2)], "_c0 string, _c1 string, Males int, _c3 int")
    assert C.blank_header_columns(df).columns == ["GEO_ID", "key_0", "Males", "key_1"]
    assert C.survey_columns(spark.createDataFrame([(1, 1, 1)], "B01_E001 int, B01_M001 int, NAME int"), "M") == ["B01_M001"]
    rows = [("a", "a"), ("a", "b")]
    assert C.keep_differing(spark.createDataFrame(rows, "x string, y string"), "x", "y").count() == 1


def test_lookups(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    lookup = spark.createDataFrame([("a", "x")], "k string, v string")
    assert {tuple(r) for r in J.lookup_or_default(left, lookup, ["k"], "v").collect()} == {("a", "x"), ("b", "TBD")}
    with pytest.raises(Exception, match="no v for b"):
        J.lookup_or_fail(left, lookup, ["k"], "v").collect()
    big = J.lookup_join(left, lookup, "k", "left")
    assert {tuple(r) for r in big.collect()} == {("a", "x"), ("b", None)}


def test_one_to_one(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    once = spark.createDataFrame([("a", 3)], "k string, w int")
    assert J.one_to_one_join(once, once.withColumnRenamed("w", "x"), ["k"]).count() == 1
    with pytest.raises(ValueError, match="not one row per"):
        J.one_to_one_join(once, twice, ["k"])


def test_outer_join_of_many_matches_null_keys(spark):
    frames = [spark.createDataFrame(rows, f"k string, v{i} int") for i, rows in enumerate(([("a", 1), (None, 2)], [("b", 3), (None, 4)], [("a", 5)]))]
    got = {tuple(r) for r in J.outer_join_all(frames, ["k"]).collect()}
    assert got == {("a", 1, None, 5), ("b", None, 3, None), (None, 2, 4, None)}


def test_sets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "n string")
    b = spark.createDataFrame([("y",), ("z",)], "n string")
    assert {tuple(r) for r in S.differences(a, b, "n").collect()} == {("x", "missing"), ("z", "extra")}
    with pytest.raises(ValueError, match="missing: x"):
        S.require_equal_sets(a, b, "n")
    S.require_equal_sets(a, a.distinct(), "n")
    five = spark.createDataFrame([("1", "five")], "id string, eng string")
    one = spark.createDataFrame([("1", "one"), ("2", "one")], "id string, eng string")
    assert {tuple(r) for r in S.union_with_precedence(five, one, "id").collect()} == {("1", "five"), ("2", "one")}


def test_grouping(spark):
    df = spark.createDataFrame([("t", f"f{i:02d}", i) for i in range(23)], "g string, name string, pos int")
    got = {r.batch: r["items"] for r in G.batches(df, ["g"], "name", ["pos"], 10).collect()}
    assert got == {0: [f"f{i:02d}" for i in range(10)], 1: [f"f{i:02d}" for i in range(10, 20)], 2: ["f20", "f21", "f22"]}
    assert tuple(G.key_uniqueness(df, ["g"]).first()) == (23, 1, False)
    assert tuple(G.key_uniqueness(df.limit(0), ["g"]).first()) == (0, 0, True)
    assert G.split_levels(spark.createDataFrame([("a", 50), ("b", 10)], "GEO_ID string, SUMLEVEL int"), {"county": 50})["county"].collect()[0].asDict() == {"GEO_ID": "a"}
