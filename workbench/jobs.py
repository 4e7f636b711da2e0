"""Whole country jobs on landed files made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.functions.codes import column_to_variable
from arealis.operators import metadata as M
from arealis.operators.columns import quoted
from arealis.operators.derive import derive_metrics
from arealis.operators.geometry import geojson_feature, outline_measures, ring_edges
from arealis.operators.reshape import fold_to_long, pivot_metrics
from arealis.operators.sets import stack
from arealis.plans import belgium, england_wales, northern_ireland, open_boundaries, scotland, singapore, usa
from arealis.session import scratch_path
from arealis.sinks.publish import write_metrics
from arealis.sources import triples as R
from arealis.sources import zips
from workbench.base import OBS, POP, SEGMENTS, STATUSES, observations, population, query, table
from workbench.deriving import _HEADER_SQL, AGE_METRICS, HEADERS, wide_by_header
from workbench.landing import land_archive
from workbench.scanning import customer_grid


def flagship(spark, sf):
    """Long table -> derived metrics and pivot -> metadata with ids -> checks -> parquet -> read back."""
    people = population(spark, sf)
    derived = derive_metrics(people, AGE_METRICS, "count")
    pivoted = pivot_metrics(people, "GEO_ID", ["sex"], "count", names=["Female", "Male"])
    metrics = derived.join(pivoted, "GEO_ID")
    path = "be/metrics/2021population.parquet"
    rows = stack(
        [
            M.metric_rows_from_specs(spark, AGE_METRICS, path, "count"),
            M.metric_rows_from_keys(people, ["sex"], F.lit(path), F.lit("count")),
        ]
    )
    source = spark.createDataFrame([("r1",)], "source_data_release_id string")
    base = scratch_path(spark, "published")
    write_metrics([(metrics, M.complete_metric_rows(rows, source))], base, "be")
    return spark.read.parquet(f"{base}/{path}")


_FLAGSHIP = ", ".join(
    f"CAST(coalesce(sum(count) FILTER (WHERE {m.predicate}), 0) AS BIGINT) AS {m.name}" for m in AGE_METRICS
)


@query(
    "job_minimum",
    f"""WITH {POP} SELECT "GEO_ID", {_FLAGSHIP}, CAST(sum(count) FILTER (WHERE sex = 'Female') AS BIGINT) AS "Female",
      CAST(sum(count) FILTER (WHERE sex = 'Male') AS BIGINT) AS "Male" FROM pop GROUP BY 1 HAVING """
    + " AND ".join(f"count(*) FILTER (WHERE {m.predicate}) > 0" for m in AGE_METRICS),
)
def job_minimum(spark, sf):
    return flagship(spark, sf)


# C-1 ------------------------------------------------------------------------


def land_belgium(spark, sf):
    base = scratch_path(spark, "belgium")
    lineitem = table(spark, sf, "lineitem")
    part, supplier = table(spark, sf, "part"), table(spark, sf, "supplier")
    rows = (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .select(
            F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("CD_REFNIS"),
            F.when(F.col("l_linestatus") == "F", "BEL").otherwise("ETR").alias("CD_NATLTY"),
            (F.col("l_linenumber") % 4 + 1).alias("CD_CIV_STS"),
            F.floor(F.col("p_size") / 10).alias("CD_AGE"),
            F.when(F.col("l_returnflag") == "A", "F").otherwise("M").alias("CD_SEX"),
            F.col("l_quantity").cast("bigint").alias("MS_POPULATION"),
        )
    )
    rows.write.option("sep", "|").option("header", True).csv(f"{base}/tables/4689")
    sizes = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("CD_SECTOR"), F.col("c_nationkey").alias("TOTAL")
    )
    sizes.write.option("sep", "|").option("header", True).csv(f"{base}/tables/4796")
    root, node = "http://data.gov.be/catalog/statbelopen", belgium.NODE_PREFIX
    lines = []
    for key, fmt in (("4689", "TXT"), ("4796", "TXT"), ("4726", "GEOJSON"), ("595", "BIN")):
        s, d = f"<{node}{key}>", f"<https://example.com/files/{key}.zip>"
        lines += [
            f"<{root}> <{R.DATASET}> {s} .",
            f'{s} <{R.TITLE}> "Titel {key}"@nl .',
            f'{s} <{R.TITLE}> "Title {key}"@en .',
            f'{s} <{R.DESCRIPTION}> " About {key} "@en .',
            f"{s} <{R.DISTRIBUTION}> {d} .",
            f"{d} <{R.FORMAT}> <http://publications.europa.eu/resource/authority/file-type/{fmt}> .",
            f"{s} <{R.LANDING_PAGE}> <https://example.com/en/{key}> .",
            f"<https://example.com/en/{key}> <{R.LANGUAGE}> <http://example.com/ENG> .",
        ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{base}/catalogue.nt")
    code = f'<http://example.com/ENG> <{R.NOTATION}> "en"^^<{R.ISO_639_1}> .'
    spark.createDataFrame([(code,)], "value string").write.text(f"{base}/languages.nt")
    x, y = F.col("c_custkey") % 40, F.floor(F.col("c_custkey") / 40)
    levels = {
        "cd_sector": F.col("c_custkey").cast("string"),
        "cd_munty_refnis": F.concat_ws("-", F.floor(x / 5).cast("string"), F.floor(y / 5).cast("string")),
        "cd_dstr_refnis": F.concat_ws("-", F.floor(x / 10).cast("string"), F.floor(y / 10).cast("string")),
        "cd_rgn_refnis": F.floor(x / 20).cast("string"),
        "cd_prov_refnis": F.concat_ws("-", F.floor(x / 20).cast("string"), F.floor(y / 20).cast("string")),
    }
    names = {
        f"tx_{stem}_descr_{lang}": F.concat(F.lit(f"{lang} "), levels[column])
        for stem, column in (
            ("sector", "cd_sector"), ("munty", "cd_munty_refnis"), ("adm_dstr", "cd_dstr_refnis"),
            ("rgn", "cd_rgn_refnis"), ("prov", "cd_prov_refnis"),
        )
        for lang in ("nl", "fr", "de")
    }
    grid = customer_grid(spark, sf)
    grid.select(geojson_feature(F.col("parts"), {**levels, **names}).alias("value")).write.text(
        f"{base}/sectors.geojsonseq"
    )
    return base


@query(
    "job_long_mean",
    """SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS "GEO_ID",
      CASE WHEN l_linestatus = 'F' THEN 'BEL' ELSE 'ETR' END || '_' || CAST(l_linenumber % 4 + 1 AS VARCHAR) || '_' || CAST(p_size // 10 AS VARCHAR)
        || '_' || CASE WHEN l_returnflag = 'A' THEN 'F' ELSE 'M' END AS metric, avg(CAST(l_quantity AS BIGINT)) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def job_long_mean(spark, sf):
    plan = belgium.Belgium(spark, land_belgium(spark, sf))
    return fold_to_long(plan.derived_metrics("4689").metrics)


@query(
    "job_long_mean_metadata",
    """WITH k AS (SELECT DISTINCT CASE WHEN l_linestatus = 'F' THEN 'BEL' ELSE 'ETR' END AS n, l_linenumber % 4 + 1 AS m, p_size // 10 AS a,
        CASE WHEN l_returnflag = 'A' THEN 'F' ELSE 'M' END AS s FROM lineitem JOIN part ON l_partkey = p_partkey),
      l AS (SELECT *, CASE n WHEN 'BEL' THEN 'Belgian' ELSE 'non-Belgian' END AS nl, CASE m WHEN 1 THEN 'single' WHEN 2 THEN 'married' WHEN 3 THEN 'widowed' ELSE 'divorced' END AS ml FROM k)
    SELECT n || '_' || CAST(m AS VARCHAR) || '_' || CAST(a AS VARCHAR) || '_' || s AS metric_parquet_column_name,
      '#population+adm4+' || lower(s) || '+age' || CAST(a AS VARCHAR) || '+' || lower(nl) || '+' || ml AS metric_hxl_tag,
      'Population, ' || nl || ', ' || ml || ', ' || CASE s WHEN 'F' THEN 'female' ELSE 'male' END || ', and age ' || CAST(a AS VARCHAR) AS metric_human_readable_name,
      'About 4689' AS metric_description, 'bel/metrics/4689.parquet' AS metric_parquet_path FROM l""",
)
def job_long_mean_metadata(spark, sf):
    plan = belgium.Belgium(spark, land_belgium(spark, sf))
    return plan.derived_metrics("4689").metadata.select(
        "metric_parquet_column_name", "metric_hxl_tag", "metric_human_readable_name", "metric_description", "metric_parquet_path"
    )


@query(
    "job_five_levels",
    """WITH c AS (SELECT c_custkey % 40 AS x, c_custkey // 40 AS y, CAST(c_custkey AS VARCHAR) AS k FROM customer),
    a AS (SELECT 'statistical_sector' AS level, k AS "GEO_ID" FROM c UNION ALL
      SELECT 'municipality', CAST(x // 5 AS VARCHAR) || '-' || CAST(y // 5 AS VARCHAR) FROM c UNION ALL
      SELECT 'arrondisement', CAST(x // 10 AS VARCHAR) || '-' || CAST(y // 10 AS VARCHAR) FROM c UNION ALL
      SELECT 'region', CAST(x // 20 AS VARCHAR) FROM c UNION ALL
      SELECT 'province', CAST(x // 20 AS VARCHAR) || '-' || CAST(y // 20 AS VARCHAR) FROM c)
    SELECT level, "GEO_ID", count(*)::DOUBLE AS area, 'nl ' || "GEO_ID" AS nld FROM a GROUP BY 1, 2""",
)
def job_five_levels(spark, sf):
    plan = belgium.Belgium(spark, land_belgium(spark, sf))
    frames = []
    for output in plan.geometry():
        area = outline_measures(ring_edges(output.boundaries, ["GEO_ID"]), ["GEO_ID"]).select("GEO_ID", "area")
        frames.append(area.join(output.names.select("GEO_ID", "nld"), "GEO_ID").select(F.lit(output.level.level).alias("level"), "*"))
    return stack(frames)


# C-2 ------------------------------------------------------------------------


@query(
    "job_codes_and_labels",
    f"""WITH {POP}, p AS (SELECT "GEO_ID", age, sex, count FROM pop WHERE sex IS NOT NULL),
    d AS (SELECT "GEO_ID", {_FLAGSHIP} FROM p GROUP BY 1)
    SELECT "GEO_ID", metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT d ON {", ".join(m.name for m in AGE_METRICS)} INTO NAME metric VALUE value)
    UNION ALL SELECT "GEO_ID", CAST(age AS VARCHAR) || '_' || CASE sex WHEN 'Female' THEN '1' ELSE '2' END, CAST(sum(count) AS BIGINT) FROM p GROUP BY 1, 2
    UNION ALL SELECT "GEO_ID", 'Aged ' || CAST(age AS VARCHAR) || '_' || sex, CAST(sum(count) AS BIGINT) FROM p GROUP BY 1, 2""",
)
def job_codes_and_labels(spark, sf):
    base = scratch_path(spark, "zones")
    people = population(spark, sf).filter("sex is not null")
    geography = northern_ireland.TABLE_GEOGRAPHY["DZ21"]
    people.select(
        F.col("GEO_ID").alias(f"{geography} Code"),
        F.col("GEO_ID").alias(f"{geography} Label"),
        F.col("age").alias("Age Code"),
        F.concat(F.lit("Aged "), F.col("age").cast("string")).alias("Age Label"),
        F.when(F.col("sex") == "Female", "1").otherwise("2").alias("Sex Code"),
        F.col("sex").alias("Sex Label"),
        F.col("count").alias("Count"),
    ).write.option("header", True).csv(f"{base}/tables/DZ21/MS-A09.csv")
    document = (
        '{"dc:title": "MS-A09: Age", "dc:description": "Age by sex", "url": "https://x.org/t?d=PEOPLE&v=LGD14",'
        ' "tableSchema": {"columns": []}}'
    )
    spark.createDataFrame([("https://x.org/p", document)], "url string, value string").write.parquet(f"{base}/metadata")
    plan = northern_ireland.NorthernIreland(spark, base)
    return fold_to_long(plan.derived_metrics("DZ21/MS-A09").metrics, value_type="bigint")


# C-3 ------------------------------------------------------------------------


@query(
    "csv_quoted_records",
    """SELECT 'texts.csv' AS member, CAST(doc_id AS BIGINT) AS doc_id, nullif(text, '') AS text FROM documents""",
)
def csv_quoted_records(spark, sf):
    """Whole texts, line breaks and quotes included, through the quoted fields of an archived CSV member."""
    path = f"{scratch_path(spark, 'quoted')}/texts.zip"
    quoted_text = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    body = table(spark, sf, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("position"),
        F.concat_ws(",", F.col("doc_id").cast("string"), quoted_text).alias("line"),
    )
    header = spark.createDataFrame([("", "doc_id,text")], "position string, line string")
    land_archive(header.unionByName(body), path, "texts.csv")
    records = zips.csv_records(zips.read_zip_members(spark, path, member="texts.csv"))
    return zips.record_table(records, ["doc_id", "text"]).select(
        F.lit("texts.csv").alias("member"), F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )


_BAND = """CASE WHEN age < 5 THEN '0 to 4' WHEN age < 10 THEN '5 to 9' WHEN age < 12 THEN '10 to 11' WHEN age < 15 THEN '12 to 14'
  WHEN age < 16 THEN '15' WHEN age < 18 THEN '16 to 17' WHEN age < 20 THEN '18 to 19'
  ELSE CAST({five} AS VARCHAR) || ' to ' || CAST({five} + 4 AS VARCHAR) END"""
_BAND_SQL = _BAND.format(five="(age // 5 * 5)")


@query(
    "job_crosstab",
    f"""WITH {POP}, p AS (SELECT "GEO_ID", age, sex, count, {_BAND_SQL} AS band FROM pop WHERE sex IS NOT NULL),
    r AS (SELECT "GEO_ID", band, sum(count) FILTER (WHERE sex = 'Male') AS m, sum(count) FILTER (WHERE sex = 'Female') AS f FROM p GROUP BY 1, 2
      UNION ALL SELECT "GEO_ID", 'All people', sum(count) FILTER (WHERE sex = 'Male'), sum(count) FILTER (WHERE sex = 'Female') FROM p GROUP BY 1),
    t AS (SELECT "GEO_ID", 'All people__' || band AS metric, coalesce(m, 0) + coalesce(f, 0) AS value FROM r
      UNION ALL SELECT "GEO_ID", 'Males__' || band, coalesce(m, 0) FROM r UNION ALL SELECT "GEO_ID", 'Females__' || band, coalesce(f, 0) FROM r
      UNION ALL SELECT "GEO_ID", 'children_5_17', sum(count) FROM p WHERE age BETWEEN 5 AND 17 GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'infants_0_4', sum(count) FROM p WHERE age < 5 GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'children_0_17', sum(count) FROM p WHERE age < 18 GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'adults_f', sum(count) FROM p WHERE age >= 18 AND sex = 'Female' GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'adults_m', sum(count) FROM p WHERE age >= 18 AND sex = 'Male' GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'adults', sum(count) FROM p WHERE age >= 18 GROUP BY 1
      UNION ALL SELECT "GEO_ID", 'individuals', sum(count) FROM p GROUP BY 1)
    SELECT "GEO_ID", metric, CAST(value AS BIGINT) AS value FROM t""",
)
def job_crosstab(spark, sf):
    base = scratch_path(spark, "crosstab")
    people = population(spark, sf).filter("sex is not null")
    band = F.expr(_BAND.format(five="(age div 5 * 5)").replace("VARCHAR", "STRING"))
    counted = people.groupBy("GEO_ID", band.alias("band")).pivot("sex", ["Male", "Female"]).agg(F.sum("count"))
    whole = people.groupBy("GEO_ID", F.lit("All people").alias("band")).pivot("sex", ["Male", "Female"]).agg(F.sum("count"))
    country = people.groupBy(F.lit("S92000003").alias("GEO_ID"), F.lit("All people").alias("band")).pivot("sex", ["Male", "Female"]).agg(F.sum("count"))

    def shown(column):
        return F.coalesce(F.concat(F.lit('"'), F.format_number(column, 0), F.lit('"')), F.lit("-"))

    both = F.coalesce("Male", F.lit(0)) + F.coalesce("Female", F.lit(0))
    body = stack([counted, whole, country]).select(
        F.concat_ws("|", F.lit("1"), "GEO_ID", "band").alias("position"),
        F.concat_ws(",", "GEO_ID", "band", shown(both), shown(F.col("Male")), shown(F.col("Female"))).alias("line"),
    )
    header = spark.createDataFrame([("0", ",,All people,Males,Females")], "position string, line string")
    land_archive(header.unionByName(body), f"{base}/archives/Output_Area_blk.zip", "LC1117SC.csv")
    index = '3A,LC1117SC,Age by sex,All people,Age,OA,2011,,\n3A,LC1117SC,Age by sex,All people,Sex,OA,2011,,'
    spark.createDataFrame([(x,) for x in index.split("\n")], "value string").coalesce(1).write.text(f"{base}/index.csv")
    plan = scotland.Scotland(spark, base)
    plan.allow_missing = False
    return fold_to_long(plan.derived_metrics("2011/OutputArea2011/LC1117SC").metrics, value_type="bigint")


# C-4 ------------------------------------------------------------------------


@query(
    "job_wide_headers",
    f"""{_HEADER_SQL.replace('SELECT "GEO_ID",', ', d AS (SELECT "GEO_ID",', 1)}),
    f AS (SELECT "GEO_ID", age, count, unnest(list_filter(['All persons', sex], lambda x: x IS NOT NULL)) AS s FROM pop),
    w AS (SELECT "GEO_ID", count, s, unnest(['Age: Total', CASE age WHEN 0 THEN 'Age: Aged under 1 year'
      WHEN 49 THEN 'Age: Aged 90 years and over' WHEN 1 THEN 'Age: Aged 1 year' ELSE 'Age: Aged ' || age || ' years' END]) AS a FROM f)
    SELECT "GEO_ID", 'Sex: ' || s || '; ' || a || '; measures: Value' AS metric, CAST(sum(count) AS BIGINT) AS value FROM w GROUP BY ALL
    UNION ALL SELECT "GEO_ID", metric, value FROM (UNPIVOT d ON COLUMNS(* EXCLUDE "GEO_ID") INTO NAME metric VALUE value)""",
)
def job_wide_headers(spark, sf):
    base = scratch_path(spark, "wide")
    wide = wide_by_header(spark, sf)
    names = [h for h, _, _ in HEADERS]
    cells = [F.coalesce(F.col(quoted(n)).cast("string"), F.lit("")) for n in names]
    body = wide.select(
        F.concat(F.lit("1"), "GEO_ID").alias("position"),
        F.concat_ws(",", F.lit("2021"), F.concat(F.lit("Area "), "GEO_ID"), "GEO_ID", *cells).alias("line"),
    )
    header = spark.createDataFrame([("0", ",".join(["date", "geography", "geography code", *names]))], "position string, line string")
    land_archive(header.unionByName(body), f"{base}/archives/census2021-ts009.zip", "census2021-ts009-ltla..csv")
    bulk = (
        "<table><tr><th>a</th><th>b</th><th>c</th><th>d</th></tr><tr><td colspan='4'>Demography</td></tr>"
        "<tr><td>TS009</td><td>Sex by age</td><td><a href='/output/census/2021/census2021-ts009.zip'>census2021-ts009.zip</a></td><td></td></tr></table>"
    )
    spark.createDataFrame([("u", bulk)], "url string, html string").write.parquet(f"{base}/bulk")
    page = ("https://www.nomisweb.co.uk/datasets/c2021ts009", '<div id="dataset-landing-information"><p>Sex by single year</p></div>')
    spark.createDataFrame([page], "url string, html string").write.parquet(f"{base}/pages")
    output = england_wales.EnglandAndWales(spark, base).derived_metrics("ltla/TS009")
    return fold_to_long(output.metrics, value_type="bigint")


# C-5, C-8 ---------------------------------------------------------------------


# Ages of the survey table and the youngest age of the next group.
SURVEY_AGES = list(zip(["Under 5 years", *usa.CHILD_AGES, *usa.ADULT_AGES], [5, 10, 15, 18, 20, 21, 22, 25, 30, 35, 40, 45, 50, 55, 60, 62, 65, 67, 70, 75, 80, 85, 999]))


def _survey_columns():
    """Estimate column, sex and age range of ``B01001``; 001 is the total, 002 and 026 the sexes."""
    out, number = [("B01001_E001", None, 0, 999)], 2
    for sex in ("Male", "Female"):
        out.append((f"B01001_E{number:03d}", sex, 0, 999))
        number += 1
        low = 0
        for _, high in SURVEY_AGES:
            out.append((f"B01001_E{number:03d}", sex, low, high))
            low, number = high, number + 1
    return out


def land_survey(spark, sf):
    base = scratch_path(spark, "survey")
    people = population(spark, sf).filter("sex is not null")
    geo = F.concat(F.lit("0500000US"), "GEO_ID")
    sums = [
        F.coalesce(F.sum(F.when(
            (F.lit(True) if sex is None else F.col("sex") == sex) & (F.col("age") >= low) & (F.col("age") < high), F.col("count")
        )), F.lit(0)).alias(name)
        for name, sex, low, high in _survey_columns()
    ]
    ages = people.groupBy(geo.alias("GEO_ID")).agg(*sums, F.count("*").alias("B01001_M001"))
    whole = people.groupBy(F.lit("0100000US").alias("GEO_ID")).agg(*sums, F.count("*").alias("B01001_M001"))
    ages.unionByName(whole).write.option("sep", "|").option("header", True).csv(f"{base}/tables/2019_oneYear/acsdt1y2019-b01001.dat")
    orders = observations(spark, sf)
    orders.groupBy(geo.alias("GEO_ID")).agg(F.count("*").alias("B02001_E001"), F.sum("year").alias("B02001_M001")).write.option(
        "sep", "|").option("header", True).csv(f"{base}/tables/2019_oneYear/acsdt1y2019-b02001.dat")
    areas = ages.select(F.col("GEO_ID").alias("DADSID"), F.lit(50).alias("SUMLEVEL"), F.concat(F.lit("Area "), "GEO_ID").alias("NAME"))
    nation = whole.select(F.col("GEO_ID").alias("DADSID"), F.lit(10).alias("SUMLEVEL"), F.lit("Nation").alias("NAME"))
    areas.unionByName(nation).write.option("header", True).csv(f"{base}/geoids/2019_oneYear")
    page = "<table><tr><th>Name</th></tr>" + "".join(
        f'<tr><td><a href="{n}">{n}</a></td></tr>' for n in ("acsdt1y2019-b01001.dat", "acsdt1y2019-b02001.dat", "readme.txt")
    )
    spark.createDataFrame([("u", page)], "url string, html string").write.parquet(f"{base}/index/2019_oneYear")
    shells = ["Table ID,UniqueID,Stub,Data Release", "B01001,,SEX BY AGE,1", "B01001,,Universe:  Total population,", "B01001,B01001_001,Total:,"]
    number = 2
    for sex in ("Male", "Female"):
        shells.append(f"B01001,B01001_{number:03d},{sex}:,")
        number += 1
        for age, _ in SURVEY_AGES:
            shells.append(f"B01001,B01001_{number:03d},{age},")
            number += 1
    shells += [",,,", "B02001,,RACE,1", "B02001,,Universe:  Total population,", "B02001,B02001_001,Total:,"]
    spark.createDataFrame([(x,) for x in shells], "value string").coalesce(1).write.text(f"{base}/shells/2019_oneYear")
    return base


@query(
    "job_survey",
    f"""WITH {POP}, p AS (SELECT '0500000US' || "GEO_ID" AS "GEO_ID", age, sex, count FROM pop WHERE sex IS NOT NULL), {OBS},
    a AS (SELECT "GEO_ID", {_FLAGSHIP}, CAST(sum(count) FILTER (WHERE sex = 'Male' AND age BETWEEN 10 AND 14) AS BIGINT) AS "B01001_E005" FROM p GROUP BY 1),
    b AS (SELECT '0500000US' || "GEO_ID" AS "GEO_ID", CAST(count(*) AS BIGINT) AS "B02001_E001" FROM obs GROUP BY 1)
    SELECT a.*, b."B02001_E001" FROM a JOIN b USING ("GEO_ID")""",
)
def job_survey(spark, sf):
    plan = usa.UnitedStates(spark, land_survey(spark, sf))
    plan.years = [2019]
    plan._periods = lambda year: ["oneYear"]
    output = plan.derived_metrics("2019/oneYear/county/0")
    return output.metrics.select("GEO_ID", *[m.name for m in AGE_METRICS], "B01001_E005", "B02001_E001")


def _survey_variable_sql():
    """One row per variable of the survey tables, path and age range spelled out."""
    parts = []
    for name, sex, low, high in _survey_columns():
        steps = ["Total"] + ([sex] if sex else [])
        if sex and (low, high) != (0, 999):
            steps.append(next(label for label, end in SURVEY_AGES if end == high))
        where = f"age >= {low} AND age < {high}" + (f" AND sex = '{sex}'" if sex else "")
        parts.append(
            f"SELECT 'Sex By Age' AS table_name, 'Total population' AS universe, '{'|'.join(steps)}' AS variable_extended_name, "
            f"CAST(coalesce(sum(count) FILTER (WHERE {where}), 0) AS BIGINT) AS value FROM p"
        )
    parts.append("SELECT 'Race', 'Total population', 'Total|Total', CAST(count(*) AS BIGINT) FROM obs WHERE \"GEO_ID\" IN (SELECT \"GEO_ID\" FROM p)")
    return f"WITH {POP}, p AS (SELECT * FROM pop WHERE sex IS NOT NULL), {OBS} " + " UNION ALL ".join(parts)


@query("job_survey_dictionary", _survey_variable_sql())
def job_survey_dictionary(spark, sf):
    plan = usa.UnitedStates(spark, land_survey(spark, sf))
    plan.years = [2019]
    plan._periods = lambda year: ["oneYear"]
    estimates = fold_to_long(plan.census_table("2019/oneYear/county/0"), value_type="bigint")
    named = plan.kept("dictionary", lambda: plan.dictionary(2019, "oneYear"))
    return estimates.withColumn("unique_id", column_to_variable(F.col("metric"))).filter("metric not like '%\\_M%'").join(named, "unique_id").groupBy(
        "table_name", "universe", "variable_extended_name"
    ).agg(F.sum("value").alias("value"))


@query(
    "job_bulk_merge",
    f"""WITH {OBS} SELECT "GEO_ID", """
    + ", ".join(
        f"CAST(sum(cents) FILTER (WHERE status = '{t}' AND segment = '{s}') AS BIGINT) AS \"B{i}{j}_E001\""
        for i, t in enumerate(STATUSES) for j, s in enumerate(SEGMENTS)
    )
    + " FROM obs GROUP BY 1",
)
def job_bulk_merge(spark, sf):
    base = scratch_path(spark, "bulk")
    obs = observations(spark, sf)
    paths = []
    for i, status in enumerate(STATUSES):
        for j, segment in enumerate(SEGMENTS):
            name = f"B{i}{j}"
            one = obs.filter((F.col("status") == status) & (F.col("segment") == segment)).groupBy("GEO_ID").agg(
                F.sum("cents").alias(f"{name}_E001"), F.count("*").alias(f"{name}_M001"))
            total = one.agg(F.sum(f"{name}_E001").alias(f"{name}_E001"), F.sum(f"{name}_M001").alias(f"{name}_M001")).select(F.lit("ALL").alias("GEO_ID"), "*")
            one.unionByName(total).write.parquet(f"{base}/{name}")
            paths.append(f"{base}/{name}")
    tables = [spark.read.parquet(p) for p in paths]
    geoids = obs.select("GEO_ID", F.lit(50).alias("SUMLEVEL")).distinct()
    level = [usa.select_kind(usa.at_level(t, geoids, "county"), "E") for t in tables]
    return usa.widen_in_batches(spark, level, size=5)


# C-6, C-7, C-9 ------------------------------------------------------------------


@query(
    "job_boundary_layers",
    "SELECT c_mktsegment AS title, CAST(count(*) AS BIGINT) AS num_records FROM customer GROUP BY 1",
)
def job_boundary_layers(spark, sf):
    path = scratch_path(spark, "layers")
    customer_grid(spark, sf).select(
        F.col("c_mktsegment").alias("layer"),
        geojson_feature(F.col("parts"), {"id": F.col("c_custkey").cast("string")}).alias("value"),
    ).write.partitionBy("layer").text(path)
    layers = open_boundaries.read_layers(spark, path, SEGMENTS)
    return open_boundaries.layer_profiles(layers, SEGMENTS).select("title", "num_records")


@query(
    "job_subzones",
    """SELECT upper(c_name) AS subzone, c_mktsegment AS planning_area, CAST(c_nationkey * 1000 AS BIGINT) AS population, 1.0::DOUBLE AS area FROM customer""",
)
def job_subzones(spark, sf):
    base = scratch_path(spark, "subzones")
    grid = customer_grid(spark, sf).join(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey")
    html = F.concat(
        F.lit("<center><tr><th>SUBZONE_N</th> <td>"), F.upper("c_name"), F.lit("</td></tr><tr><th>PLN_AREA_N</th> <td>"),
        "c_mktsegment", F.lit("</td></tr><tr><th>REGION_N</th><td>R</td></tr></center>"))
    grid.select(geojson_feature(F.col("parts"), {"Description": html}).alias("value")).write.text(f"{base}/areas")
    band = F.array(F.struct(F.lit("Total").alias("key"), F.format_number(F.col("c_nationkey") * 1000, 0).alias("value")))
    groups = F.array(F.struct(F.lit("Total").alias("key"), band.alias("columns")))
    row = F.array(F.struct(F.lit("1.1").alias("rowNo"), F.col("c_name").alias("rowText"), groups.alias("columns")))
    documents = grid.select(F.to_json(F.struct(F.struct(row.alias("row")).alias("Data"))).alias("value"))
    from arealis.sources.boundaries import read_feature_lines
    from arealis.sources.nested import subzone_population

    areas = singapore.subzones(read_feature_lines(spark, f"{base}/areas"))
    joined = singapore.total_population_areas(areas, subzone_population(documents))
    area = outline_measures(ring_edges(joined, ["subzone"]), ["subzone"]).select("subzone", "area")
    return joined.select("subzone", "planning_area", "population").join(area, "subzone")


@query(
    "job_population_getter",
    f"""WITH {POP} SELECT "GEO_ID", CAST(sum(count) AS BIGINT) AS population FROM pop GROUP BY 1""",
)
def job_population_getter(spark, sf):
    base = scratch_path(spark, "getter")
    people = population(spark, sf)
    people.select(F.col("GEO_ID").alias("Zone Code"), F.col("count").alias("Count")).write.option("header", True).csv(base)
    return northern_ireland.population_table(spark, base).groupBy(F.col("Zone Code").alias("GEO_ID")).agg(F.sum("Count").alias("population"))
