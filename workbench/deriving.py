"""Derived metrics, pivots and row sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.codes import variable_to_column
from arealis.operators import columns as C
from arealis.operators.derive import (
    add_dictionary_metrics,
    add_header_metrics,
    derive_metric,
    derive_metrics,
    dictionary_sums,
)
from arealis.operators.reshape import (
    fold_to_long,
    melt_crosstab,
    pivot_codes_and_labels,
    pivot_metrics,
    pivot_table,
)
from arealis.specs import DerivedMetric, DictionaryMetric, HeaderMetric, PivotSpec
from workbench.base import (
    OBS,
    POP,
    PRIORITIES,
    SEGMENTS,
    STATUSES,
    observations,
    population,
    query,
    sql_text,
    table,
)

AGE_METRICS = [
    DerivedMetric("children_5_17", "age >= 5 and age < 18", "#population+children+age5_17", "Children aged 5 to 17"),
    DerivedMetric("infants_0_4", "age >= 0 and age < 5", "#population+infants+age0_4", "Infants aged 0 to 4"),
    DerivedMetric("children_0_17", "age >= 0 and age < 18", "#population+children+age0_17", "Children aged 0 to 17"),
    DerivedMetric("adults_f", "age >= 18 and sex = 'Female'", "#population+adults+f", "Female adults"),
    DerivedMetric("adults_m", "age >= 18 and sex = 'Male'", "#population+adults+m", "Male adults"),
    DerivedMetric("adults", "age >= 18", "#population+adults", "Adults"),
    DerivedMetric("individuals", "true", "#population+ind", "Total individuals"),
]


@query(
    "derived_metric_single",
    f'WITH {POP} SELECT "GEO_ID", CAST(sum(count) AS BIGINT) AS adults_f FROM pop '
    "WHERE age >= 18 AND sex = 'Female' GROUP BY 1",
)
def derived_metric_single(spark, sf):
    return derive_metric(population(spark, sf), AGE_METRICS[3], "count")


_LONG_SQL = ", ".join(
    f"CAST(coalesce(sum(count) FILTER (WHERE {m.predicate}), 0) AS BIGINT) AS {m.name}" for m in AGE_METRICS
)


@query(
    "derived_metrics_long",
    f'WITH {POP} SELECT "GEO_ID", {_LONG_SQL} FROM pop GROUP BY 1 HAVING '
    + " AND ".join(f"count(*) FILTER (WHERE {m.predicate}) > 0" for m in AGE_METRICS),
)
def derived_metrics_long(spark, sf):
    return derive_metrics(population(spark, sf), AGE_METRICS, "count")


@query(
    "pivot_sum",
    f'WITH {OBS} SELECT "GEO_ID", '
    + ", ".join(
        f"CAST(sum(cents) FILTER (WHERE segment = '{s}' AND status = '{t}') AS BIGINT) AS \"{s}_{t}\""
        for s in SEGMENTS for t in STATUSES
    )
    + " FROM obs GROUP BY 1",
)
def pivot_sum(spark, sf):
    return pivot_metrics(observations(spark, sf), "GEO_ID", ["segment", "status"], "cents")


@query(
    "pivot_mean",
    f'WITH {OBS} SELECT "GEO_ID", '
    + ", ".join(f"avg(cents) FILTER (WHERE priority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM obs GROUP BY 1",
)
def pivot_mean(spark, sf):
    return pivot_metrics(observations(spark, sf), "GEO_ID", ["priority"], "cents", how="mean")


@query(
    "pivot_multi_value",
    f'WITH {OBS} SELECT "GEO_ID", '
    + ", ".join(
        f"CAST(sum({v}) FILTER (WHERE status = '{t}' AND priority = '{p}') AS BIGINT) AS \"{v}__{t}__{p}\""
        for v in ("cents", "year") for t in STATUSES for p in PRIORITIES
    )
    + " FROM obs GROUP BY 1",
)
def pivot_multi_value(spark, sf):
    spec = PivotSpec("GEO_ID", ("cents", "year"), ("status", "priority"), "sum", "__")
    return pivot_table(observations(spark, sf), spec)


@query(
    "pivot_without_keys",
    f'WITH {OBS} SELECT "GEO_ID", CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(year) AS BIGINT) AS year '
    "FROM obs GROUP BY 1",
)
def pivot_without_keys(spark, sf):
    return pivot_table(observations(spark, sf), PivotSpec("GEO_ID", ("cents", "year")))


@query(
    "pivot_codes_and_labels",
    f'WITH {OBS} SELECT "GEO_ID", '
    + ", ".join(
        f"CAST(sum(cents) FILTER (WHERE priority = '{p}') AS BIGINT) AS \"{c}\""
        for p in PRIORITIES for c in (p[0], p[2:])
    )
    + " FROM obs GROUP BY 1",
)
def codes_and_labels(spark, sf):
    coded = observations(spark, sf).select(
        "GEO_ID",
        F.substring("priority", 1, 1).cast("int").alias("Priority Code"),
        F.expr("substring(priority, 3)").alias("Priority Label"),
        F.col("cents").alias("Count"),
    )
    return pivot_codes_and_labels(coded, "GEO_ID", "Count")


@query(
    "melt_then_derive",
    f"""WITH {POP} SELECT "GEO_ID",
        CAST(coalesce(sum(count) FILTER (WHERE age < 18 AND sex IS NOT NULL), 0) AS BIGINT) AS children,
        CAST(coalesce(sum(count) FILTER (WHERE age >= 18 AND sex = 'Male'), 0) AS BIGINT) AS adults_m
        FROM pop WHERE sex IS NOT NULL GROUP BY 1
        HAVING count(*) FILTER (WHERE age < 18) > 0 AND count(*) FILTER (WHERE age >= 18) > 0""",
)
def melt_then_derive(spark, sf):
    people = population(spark, sf).filter("sex is not null")
    crosstab = (
        people.groupBy("GEO_ID", "age").pivot("sex", ["Female", "Male"]).agg(F.sum("count"))
        .withColumnsRenamed({"Female": "Females", "Male": "Males"})
    )
    long = melt_crosstab(
        crosstab, ["GEO_ID", "age"], {"Males": "Male", "Females": "Female"}, "sex_label", "n"
    )
    specs = [
        DerivedMetric("children", "age < 18", "#population+children", "Children"),
        DerivedMetric("adults_m", "age >= 18 and sex_label = 'Male'", "#population+adults+m", "Male adults"),
    ]
    return derive_metrics(long, specs, "n")


def _age_header(age: int | None) -> str:
    if age is None:
        return "Age: Total; measures: Value"
    if age == 0:
        return "Age: Aged under 1 year; measures: Value"
    if age == 49:
        return "Age: Aged 90 years and over; measures: Value"
    return f"Age: Aged {age} year{'s' if age > 1 else ''}; measures: Value"


SEX_WORDS = {"All persons": None, "Female": "Female", "Male": "Male"}
HEADERS = [
    (f"Sex: {word}; {_age_header(age)}", sex, age)
    for word, sex in SEX_WORDS.items()
    for age in [None, *range(50)]
]

HEADER_METRICS = [
    HeaderMetric("children_5_17", "total", (5, 17), "#population+children+age5_17", "Children aged 5 to 17"),
    HeaderMetric("infants_0_4", "total", (0, 4), "#population+infants+age0_4", "Infants aged 0 to 4"),
    HeaderMetric("children_0_17", "total", (0, 17), "#population+children+age0_17", "Children aged 0 to 17"),
    HeaderMetric("adults_f", "female", (18, 90), "#population+adults+f", "Female adults"),
    HeaderMetric("adults_m", "male", (18, 90), "#population+adults+m", "Male adults"),
    HeaderMetric("adults", "total", (18, 90), "#population+adults", "Adults"),
    HeaderMetric("individuals", "total", None, "#population+ind", "Total individuals"),
]


def wide_by_header(spark, sf):
    """The population as a wide table whose headers spell out sex and age."""
    counted = population(spark, sf).groupBy("GEO_ID", "sex", "age").agg(F.sum("count").alias("n"))
    age = F.col("age")
    aged = F.concat(
        F.lit("Age: "),
        F.when(age == 0, "Aged under 1 year")
        .when(age == 49, "Aged 90 years and over")
        .when(age == 1, "Aged 1 year")
        .otherwise(F.concat(F.lit("Aged "), age.cast("string"), F.lit(" years"))),
        F.lit("; measures: Value"),
    )
    sexes = F.array_compact(F.array(F.lit("All persons"), F.col("sex")))
    ages = F.array(F.lit("Age: Total; measures: Value"), aged)
    long = (
        counted.select("GEO_ID", "n", F.explode(sexes).alias("s"), ages.alias("ages"))
        .select("GEO_ID", "n", "s", F.explode("ages").alias("a"))
        .select("GEO_ID", F.concat(F.lit("Sex: "), "s", F.lit("; "), "a").alias("header"), "n")
    )
    return long.groupBy("GEO_ID").pivot("header", [h for h, _, _ in HEADERS]).agg(F.sum("n"))


_HEADER_SQL = f"""WITH {POP} SELECT "GEO_ID",
  CAST(coalesce(sum(count) FILTER (WHERE age BETWEEN 5 AND 17), 0) AS BIGINT) AS children_5_17,
  CAST(coalesce(sum(count) FILTER (WHERE age BETWEEN 0 AND 4), 0) AS BIGINT) AS infants_0_4,
  CAST(coalesce(sum(count) FILTER (WHERE age BETWEEN 0 AND 17), 0) AS BIGINT) AS children_0_17,
  CAST(coalesce(sum(count) FILTER (WHERE age >= 18 AND sex = 'Female'), 0) AS BIGINT) AS adults_f,
  CAST(coalesce(sum(count) FILTER (WHERE age >= 18 AND sex = 'Male'), 0) AS BIGINT) AS adults_m,
  CAST(coalesce(sum(count) FILTER (WHERE age >= 18), 0) AS BIGINT) AS adults,
  CAST(sum(count) AS BIGINT) AS individuals FROM pop GROUP BY 1"""


@query("header_regex_rowsum", _HEADER_SQL)
def header_regex_rowsum(spark, sf):
    wide = wide_by_header(spark, sf)
    return add_header_metrics(wide, HEADER_METRICS).select(
        "GEO_ID", *[m.name for m in HEADER_METRICS]
    )


@query(
    "header_facts_long",
    f"""WITH {POP}, facts AS (
      SELECT "GEO_ID", lower(sex) AS sex, CASE WHEN age = 49 THEN 90 ELSE age END AS age, count AS n
      FROM pop WHERE sex IS NOT NULL
      UNION ALL SELECT "GEO_ID", 'total', CASE WHEN age = 49 THEN 90 ELSE age END, count FROM pop)
    SELECT sex, CAST(age AS BIGINT) AS age, CAST(sum(n) AS BIGINT) AS n FROM facts GROUP BY 1, 2""",
)
def header_facts_long(spark, sf):
    long = fold_to_long(wide_by_header(spark, sf), value_type="bigint")
    facts = C.header_facts(F.col("metric"))
    return (
        long.select(facts["sex"].alias("sex"), facts["age"].cast("bigint").alias("age"), "value")
        .filter("age is not null")
        .groupBy("sex", "age")
        .agg(F.sum("value").alias("n"))
    )


def survey_estimates(spark, sf):
    """The population as a survey table: ``B01001_E001`` ... one column per sex and age."""
    counted = (
        population(spark, sf)
        .filter("sex is not null")
        .withColumn("number", F.when(F.col("sex") == "Male", F.col("age")).otherwise(F.col("age") + 50) + 1)
        .withColumn("column", F.concat(F.lit("B01001_E"), F.lpad(F.col("number").cast("string"), 3, "0")))
    )
    names = [f"B01001_E{n:03d}" for n in range(1, 101)]
    return counted.groupBy("GEO_ID").pivot("column", names).agg(F.sum("count"))


def survey_dictionary(spark, sf):
    """Variable dictionary for the sexes and ages that occur, in two tables that differ by universe."""
    seen = population(spark, sf).filter("sex is not null").select("sex", "age").distinct()
    number = F.when(F.col("sex") == "Male", F.col("age")).otherwise(F.col("age") + 50) + 1
    shown = F.lpad(number.cast("string"), 3, "0")
    return seen.select(
        F.explode(F.array(
            F.struct(F.lit("B01001").alias("table_id"), F.lit("Total population").alias("universe")),
            F.struct(F.lit("B01001A").alias("table_id"), F.lit("People who are one race").alias("universe")),
        )).alias("t"),
        "sex", "age", shown.alias("shown"),
    ).select(
        "t.*",
        F.concat(F.col("t.table_id"), F.lit("_"), F.col("shown")).alias("unique_id"),
        F.lit("Sex By Age").alias("table_name"),
        F.concat(F.lit("Age "), F.col("age").cast("string")).alias("variable_name"),
        F.concat_ws("|", F.lit("Total"), "sex", F.concat(F.lit("Age "), F.col("age").cast("string"))).alias("variable_extended_name"),
    )


def _names(sexes, ages):
    return tuple(f"Total|{s}|Age {a}" for s in sexes for a in ages)


DICTIONARY_METRICS = [
    DictionaryMetric("children", _names(["Male", "Female"], range(18)), "B01001", "total population", "#population+children", "Children"),
    DictionaryMetric("adults_f", _names(["Female"], range(18, 50)), "B01001", "total population", "#population+adults+f", "Female adults"),
    DictionaryMetric("adults_m", _names(["Male"], range(18, 50)), "B01001", "total population", "#population+adults+m", "Male adults"),
]

_DICTIONARY_SQL = f"""WITH {POP} SELECT "GEO_ID",
  CAST(coalesce(sum(count) FILTER (WHERE age < 18), 0) AS BIGINT) AS children,
  CAST(coalesce(sum(count) FILTER (WHERE age >= 18 AND sex = 'Female'), 0) AS BIGINT) AS adults_f,
  CAST(coalesce(sum(count) FILTER (WHERE age >= 18 AND sex = 'Male'), 0) AS BIGINT) AS adults_m
  FROM pop WHERE sex IS NOT NULL GROUP BY 1"""


@query("dictionary_rowsum", _DICTIONARY_SQL)
def dictionary_rowsum(spark, sf):
    wide = add_dictionary_metrics(
        survey_estimates(spark, sf), survey_dictionary(spark, sf), DICTIONARY_METRICS
    )
    return wide.select("GEO_ID", *[m.name for m in DICTIONARY_METRICS])


@query(
    "dictionary_sums_long",
    f"""WITH s AS ({_DICTIONARY_SQL})
    SELECT "GEO_ID", 'children' AS metric, children AS value FROM s
    UNION ALL SELECT "GEO_ID", 'adults_f', adults_f FROM s
    UNION ALL SELECT "GEO_ID", 'adults_m', adults_m FROM s""",
)
def dictionary_sums_long(spark, sf):
    long = (
        population(spark, sf)
        .filter("sex is not null")
        .withColumn("number", F.when(F.col("sex") == "Male", F.col("age")).otherwise(F.col("age") + 50) + 1)
        .select(
            "GEO_ID",
            variable_to_column(F.concat(F.lit("B01001_"), F.lpad(F.col("number").cast("string"), 3, "0")), "E").alias("column_name"),
            F.col("count").alias("value"),
        )
    )
    return dictionary_sums(long, survey_dictionary(spark, sf), DICTIONARY_METRICS)


@query(
    "estimate_columns",
    f"""WITH {POP} SELECT "GEO_ID",
      CAST(sum(count) FILTER (WHERE sex = 'Male' AND age = 0) AS BIGINT) AS "B01001_E001",
      CAST(sum(count) FILTER (WHERE sex = 'Female' AND age = 0) AS BIGINT) AS "B01001_E051"
      FROM pop WHERE sex IS NOT NULL GROUP BY 1""",
)
def estimate_columns(spark, sf):
    people = population(spark, sf).filter("sex is not null")
    table_with_margins = people.groupBy("GEO_ID").agg(
        F.sum(F.when((F.col("sex") == "Male") & (F.col("age") == 0), F.col("count"))).alias("B01001_E001"),
        F.max("count").alias("B01001_M001"),
        F.sum(F.when((F.col("sex") == "Female") & (F.col("age") == 0), F.col("count"))).alias("B01001_E051"),
        F.max("count").alias("NAME_LENGTH"),
    )
    return table_with_margins.select("GEO_ID", *C.survey_columns(table_with_margins, "E"))


@query(
    "unpivot_metrics",
    f"""WITH {OBS} SELECT "GEO_ID", status AS metric, CAST(sum(cents) AS BIGINT) AS value
    FROM obs GROUP BY 1, 2""",
)
def unpivot_metrics(spark, sf):
    return fold_to_long(
        pivot_metrics(observations(spark, sf), "GEO_ID", ["status"], "cents"), value_type="bigint"
    )


@query(
    "predicates",
    """SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_type FROM part
    WHERE p_size BETWEEN 10 AND 20 AND p_type IN ('ECONOMY', 'STANDARD', 'PROMO')
      AND p_brand NOT IN ('Brand#1', 'Brand#2') AND p_name IS NOT NULL AND trim(p_name) <> ''
      AND (p_name LIKE 'small%' OR p_name LIKE '%ring' OR p_name LIKE '%ed wid%')
      AND regexp_matches(p_brand, '^Brand#[0-9]+$')""",
)
def predicates(spark, sf):
    part = table(spark, sf, "part")
    name = F.col("p_name")
    return part.filter(
        F.expr("p_size between 10 and 20")
        & F.col("p_type").isin("ECONOMY", "STANDARD", "PROMO")
        & ~F.col("p_brand").isin("Brand#1", "Brand#2")
        & C.not_blank(name)
        & (name.startswith("small") | name.endswith("ring") | name.contains("ed wid"))
        & F.col("p_brand").rlike("^Brand#[0-9]+$")
    ).select("p_partkey", "p_type")


@query(
    "select_rename_coerce",
    """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS "GEO_ID", n_name AS eng,
      CAST(n_regionkey AS BIGINT) AS parent, CAST(NULL AS VARCHAR) AS cym,
      CAST(count(c_custkey) AS BIGINT) AS customers
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2, 3""",
)
def select_rename_coerce(spark, sf):
    counted = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"))
    nation = table(spark, sf, "nation").withColumn("code", F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    joined = nation.join(counted, nation.n_nationkey == counted.c_nationkey).drop("n_nationkey", "c_nationkey")
    renamed = C.with_geo_id(joined, "code", {"n_name": "eng", "n_regionkey": "parent"})
    schema = "GEO_ID string, eng string, parent bigint, cym string, customers bigint"
    from pyspark.sql.types import _parse_datatype_string

    return C.conform(renamed, _parse_datatype_string(schema))


@query(
    "drop_whole_country_rows",
    f"""WITH {OBS}, stacked AS (
      SELECT "GEO_ID", sum(cents) AS cents FROM obs GROUP BY 1
      UNION ALL SELECT 'ALL', sum(cents) FROM obs)
    SELECT "GEO_ID", CAST(cents AS BIGINT) AS cents FROM stacked WHERE "GEO_ID" <> 'ALL'""",
)
def drop_whole_country_rows(spark, sf):
    per_area = observations(spark, sf).groupBy("GEO_ID").agg(F.sum("cents").alias("cents"))
    total = per_area.agg(F.sum("cents").alias("cents")).select(F.lit("ALL").alias("GEO_ID"), "cents")
    return C.drop_areas(per_area.unionByName(total), ["ALL"])


@query(
    "keep_differing_columns",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders
    JOIN customer ON o_custkey = c_custkey WHERE substr(c_mktsegment, 1, 1) <> o_orderstatus""",
)
def keep_differing_columns(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    both = orders.join(customer, orders.o_custkey == customer.c_custkey).withColumn(
        "initial", F.substring("c_mktsegment", 1, 1)
    )
    return C.keep_differing(both, "initial", "o_orderstatus").select("o_orderkey", "o_orderstatus")


@query(
    "computed_columns",
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS order_year,
      CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS whole, upper(o_orderpriority) AS priority
    FROM orders""",
)
def computed_columns(spark, sf):
    return (
        table(spark, sf, "orders")
        .withColumns(
            {
                "order_year": F.year("o_orderdate").cast("bigint"),
                "whole": F.expr("cast(round(o_totalprice * 100) as bigint) div 100"),
                "priority": F.upper("o_orderpriority"),
            }
        )
        .select("o_orderkey", "order_year", "whole", "priority")
    )


@query(
    "partition_key_lookup",
    f"""WITH {OBS} SELECT "GEO_ID", status, CAST(sum(cents) AS BIGINT) AS cents FROM obs
    WHERE CAST(year AS VARCHAR) || '/' || status = {sql_text('1997/O')} GROUP BY 1, 2""",
)
def partition_key_lookup(spark, sf):
    keyed = observations(spark, sf).withColumn(
        "partition_key", F.concat_ws("/", F.col("year").cast("string"), "status")
    )
    return (
        keyed.filter(F.col("partition_key") == "1997/O")
        .groupBy("GEO_ID", "status")
        .agg(F.sum("cents").alias("cents"))
    )
