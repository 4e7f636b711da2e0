"""Metadata tables, checks and profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from arealis.functions.ids import metric_path
from arealis.operators import metadata as M
from arealis.operators import quality as Q
from arealis.operators.reshape import pivot_metrics
from arealis.specs import ReleaseTemplate
from workbench.base import OBS, PRIORITIES, observations, query, sql_text, table


@query(
    "typed_records",
    """SELECT lower(r_name) AS country_id, r_name AS country_name_short_en, r_name AS country_name_official,
      r_name AS country_iso3, substr(r_name, 1, 2) AS country_iso2, CAST(NULL AS VARCHAR) AS country_iso3166_2,
      CAST(count(*) AS BIGINT) AS n FROM region JOIN nation ON n_regionkey = r_regionkey
      JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name""",
)
def typed_records(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    customer = table(spark, sf, "customer")
    counted = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .groupBy("r_name").agg(F.count("*").alias("n"))
    )
    name = F.col("r_name")
    records = M.publish_names("country", counted.select(
        name.alias("name_short_en"), name.alias("name_official"), name.alias("iso3"), F.substring(name, 1, 2).alias("iso2")))
    return records.join(counted, records.country_name_short_en == counted.r_name).drop("r_name")


def _releases(spark, sf, templates):
    day = F.lit(date(2021, 3, 21))
    geometries = M.publish_names("geometry", table(spark, sf, "nation").select(
        day.alias("validity_period_start"), day.alias("validity_period_end"), F.col("n_name").alias("level"),
        F.lit("adm1").alias("hxl_tag"), F.lit("be").alias("country_id")))
    return geometries, M.release_rows(geometries, templates, "pub")


def _template(key, start=date(2021, 3, 21), end=date(2021, 3, 21)):
    return ReleaseTemplate(key, f"Census {key}", date(2023, 2, 21), start, end, start, end, date(2031, 1, 1), "https://example.com", "TBC")


_GEOMETRY_ID = """sha256('{"hxl_tag":"adm1","level":"' || n_name || '","validity_period_end":"2021-03-21","validity_period_start":"2021-03-21"}')"""


def _release_id(key, end="2021-03-21"):
    return (
        """sha256('{"collection_period_end":"%s","collection_period_start":"2021-03-21","data_publisher_id":"pub",'
    || '"date_published":"2023-02-21","description":"TBC","expect_next_update":"2031-01-01","geometry_metadata_id":"' || gid
    || '","name":"Census ' || %s || '","reference_period_end":"%s","reference_period_start":"2021-03-21","url":"https://example.com"}')"""
        % (end, key, end)
    )


@query(
    "release_rows",
    f"""SELECT n_name AS geometry_level, gid AS geometry_id, {_release_id(sql_text('2021'))} AS source_data_release_id
    FROM (SELECT n_name, {_GEOMETRY_ID} AS gid FROM nation)""",
)
def release_rows(spark, sf):
    geometries, releases = _releases(spark, sf, [_template("2021")])
    return releases.select(
        "geometry_level", F.col("source_data_release_geometry_metadata_id").alias("geometry_id"), "source_data_release_id"
    )


@query(
    "release_rows_by_template",
    f"""SELECT n_name || '_' || k AS release_key, {_release_id('k')} AS source_data_release_id
    FROM (SELECT n_name, {_GEOMETRY_ID} AS gid FROM nation), (VALUES ('1A'), ('2B'), ('3I')) t(k)""",
)
def release_rows_by_template(spark, sf):
    _, releases = _releases(spark, sf, [_template(k) for k in ("1A", "2B", "3I")])
    return releases.select(
        F.concat_ws("_", "geometry_level", "release_key").alias("release_key"), "source_data_release_id"
    )


@query(
    "period_validity",
    """SELECT n_name AS geometry_level, k AS release_key, ok AS is_valid FROM nation,
      (VALUES ('good', true), ('bad', false)) t(k, ok)""",
)
def period_validity(spark, sf):
    _, releases = _releases(spark, sf, [_template("good"), _template("bad", end=date(2020, 1, 1))])
    return releases.select("geometry_level", "release_key", M.valid_periods(releases).alias("is_valid"))


@query(
    "metric_metadata_rows",
    f"""WITH {OBS}, k AS (SELECT DISTINCT segment, status FROM obs), m AS (
      SELECT segment || '_' || status AS metric_parquet_column_name,
      '#population+segment_' || segment || '+status_' || status AS metric_hxl_tag,
      'Variable: ''segment''; Value: ''' || segment || '''; Variable: ''status''; Value: ''' || status || '''' AS metric_human_readable_name
      FROM k)
    SELECT *, 'be/metrics/2021orders.parquet' AS metric_parquet_path, sha256('{{"description":"Orders","human_readable_name":"' || metric_human_readable_name
      || '","hxl_tag":"' || metric_hxl_tag || '","metric_parquet_path":"be/metrics/2021orders.parquet","parent_metric_id":"cents","parquet_column_name":"'
      || metric_parquet_column_name || '","parquet_margin_of_error_column":null,"parquet_margin_of_error_file":null,"potential_denominator_ids":null,'
      || '"source_archive_file_path":null,"source_data_release_id":"r1","source_documentation_url":"u","source_download_url":"u","source_metric_id":"cents"}}') AS metric_id
    FROM m""",
)
def metric_metadata_rows(spark, sf):
    path = metric_path(F.lit("be"), F.lit("2021/orders"))
    rows = M.metric_rows_from_keys(observations(spark, sf), ["segment", "status"], path, F.lit("cents"))
    source = spark.createDataFrame(
        [("Orders", "r1", "u", "u", "cents")],
        "description string, source_data_release_id string, source_download_url string, "
        "source_documentation_url string, source_metric_id string",
    )
    return M.complete_metric_rows(rows, source).select(
        "metric_parquet_column_name", "metric_hxl_tag", "metric_human_readable_name", "metric_parquet_path", "metric_id"
    )


@query(
    "templated_metric_rows",
    f"""WITH {OBS}, k AS (SELECT DISTINCT year, status FROM obs)
    SELECT CAST(year AS VARCHAR) || '_' || status AS parquet_column_name, '#population+adm4+' || lower(status) || '+age' || CAST(year AS VARCHAR) AS hxl_tag,
    'Population, ' || status || ', and age ' || CAST(year AS VARCHAR) AS human_readable_name FROM k""",
)
def templated_metric_rows(spark, sf):
    return M.metric_rows_from_templates(
        observations(spark, sf), ["year", "status"],
        "concat('Population, ', status, ', and age ', year)",
        "concat('#population+adm4+', lower(status), '+age', year)",
        F.lit("be/metrics/x.parquet"), F.lit("cents"),
    ).select("parquet_column_name", "hxl_tag", "human_readable_name")


@query(
    "column_metadata",
    f"""WITH {OBS}, k AS (SELECT DISTINCT priority FROM obs)
    SELECT priority AS parquet_column_name, '#population+details_unknown' AS hxl_tag, priority AS human_readable_name,
      'be/metrics/x.parquet' AS metric_parquet_path, 'TBD' AS parent_metric_id FROM k""",
)
def column_metadata(spark, sf):
    wide = pivot_metrics(observations(spark, sf), "GEO_ID", ["priority"], "cents")
    return M.metric_rows_from_columns(wide, "be/metrics/x.parquet", "TBD")


@query(
    "survey_metric_metadata",
    """WITH d AS (SELECT DISTINCT p_size, p_type FROM part),
    v AS (SELECT 'B' || lpad(CAST(p_size AS VARCHAR), 5, '0') AS t, lpad(CAST(ascii(p_type) AS VARCHAR), 3, '0') AS n, p_type FROM d WHERE p_type <> 'PROMO' AND p_type <> 'STANDARD'
      UNION ALL SELECT 'B' || lpad(CAST(p_size AS VARCHAR), 5, '0'), '00' || CAST(length(p_type) AS VARCHAR), p_type FROM d WHERE p_type IN ('PROMO', 'STANDARD'))
    SELECT t || '_E' || n AS parquet_column_name, 'Total population, Sizes, 2019, fiveYear, ' || p_type AS human_readable_name,
      '#TotalPopulation+Total+' || upper(p_type[1]) || lower(p_type[2:]) AS hxl_tag, t || '_M' || n AS parquet_margin_of_error_column,
      'Key: table_id, Value: ' || t || '; Key: unique_id, Value: ' || t || '_' || n || '; Key: universe, Value: Total population; Key: table_name, Value: Sizes; Key: variable_name, Value: ' || p_type || '; Key: variable_extended_name, Value: Total|' || p_type AS description,
      CASE WHEN t < 'B00030' THEN 'https://example.com/' || lower(t) || '.dat' ELSE 'TBD' END AS source_download_url
    FROM v""",
)
def survey_metric_metadata(spark, sf):
    kinds = table(spark, sf, "part").select("p_size", "p_type").distinct()
    table_id = F.concat(F.lit("B"), F.lpad(F.col("p_size").cast("string"), 5, "0"))
    number = F.when(
        F.col("p_type").isin("PROMO", "STANDARD"), F.concat(F.lit("00"), F.length("p_type").cast("string"))
    ).otherwise(F.lpad(F.ascii("p_type").cast("string"), 3, "0"))
    dictionary = kinds.select(
        table_id.alias("table_id"), F.concat(table_id, F.lit("_"), number).alias("unique_id"),
        F.lit("Total population").alias("universe"), F.lit("Sizes").alias("table_name"),
        F.col("p_type").alias("variable_name"), F.concat(F.lit("Total|"), "p_type").alias("variable_extended_name"))
    columns = kinds.select(F.concat(table_id, F.lit("_E"), number).alias("parquet_column_name"))
    urls = kinds.select(table_id.alias("url_table")).distinct().filter("url_table < 'B00030'").withColumn(
        "source_download_url", F.concat(F.lit("https://example.com/"), F.lower("url_table"), F.lit(".dat")))
    return M.survey_metric_rows(columns, dictionary, urls, "2019", "fiveYear").select(
        "parquet_column_name", "human_readable_name", "hxl_tag", "parquet_margin_of_error_column", "description", "source_download_url")


@query(
    "source_metric_template",
    f"""SELECT source || '/' || lang AS partition_key, 'Text in ' || lang AS human_readable_name,
      'unknown_at_this_stage' AS metric_parquet_path, 'Count' AS parquet_column_name, 'release ' || lang AS source_data_release_id
    FROM (SELECT DISTINCT source, lang FROM documents)""",
)
def source_metric_template(spark, sf):
    catalogue = table(spark, sf, "documents").select("source", F.col("lang").alias("geometry_level")).distinct().select(
        F.concat_ws("/", "source", "geometry_level").alias("partition_key"), "geometry_level",
        F.concat(F.lit("Text in "), "geometry_level").alias("human_readable_name"))
    releases = catalogue.select("geometry_level").distinct().withColumn(
        "source_data_release_id", F.concat(F.lit("release "), "geometry_level"))
    return M.source_metric_rows(catalogue, releases, ["geometry_level"], {"parquet_column_name": F.lit("Count")}).select(
        "partition_key", "human_readable_name", "metric_parquet_path", "parquet_column_name", "source_data_release_id")


@query(
    "column_match_check",
    f"""WITH {OBS} SELECT "GEO_ID", """
    + ", ".join(f"CAST(sum(cents) FILTER (WHERE priority = '{p}') AS BIGINT) AS \"{p}\"" for p in PRIORITIES)
    + " FROM obs GROUP BY 1",
)
def column_match_check(spark, sf):
    obs = observations(spark, sf)
    wide = pivot_metrics(obs, "GEO_ID", ["priority"], "cents")
    described = M.metric_rows_from_keys(obs, ["priority"], F.lit("be/metrics/x.parquet"), F.lit("cents"))
    Q.require_metric_columns(wide, M.publish_names("metric", described))
    return wide


@query(
    "required_columns_check",
    """SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS "GEO_ID", n_name AS eng, CAST(count(*) AS BIGINT) AS n
    FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2""",
)
def required_columns_check(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    joined = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).groupBy(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("GEO_ID"), F.col("n_name").alias("eng")
    ).agg(F.count("*").alias("n"))
    known = table(spark, sf, "documents").select("lang").distinct().select(
        F.explode(F.array(F.col("lang"), F.concat("lang", F.lit("g")))).alias("code"))
    Q.require_name_columns(joined.select("GEO_ID", "eng"), known)
    return joined


@query(
    "language_code_check",
    """SELECT DISTINCT lang AS code FROM documents WHERE lang NOT IN
      (SELECT lang FROM documents JOIN labels USING (doc_id) GROUP BY lang HAVING count(*) > 50)""",
)
def language_code_check(spark, sf):
    documents, labels = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("code")), table(spark, sf, "labels")
    known = documents.join(labels, "doc_id").groupBy("code").count().filter("count > 50")
    return Q.unknown_codes(documents, known)


@query(
    "path_uniqueness_check",
    """WITH p AS (SELECT DISTINCT p_brand AS output, p_type AS path FROM part WHERE p_size > 40)
    SELECT output AS subject, 'several paths in one output' AS problem FROM p GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT path, 'path used by several outputs' FROM p GROUP BY 1 HAVING count(*) > 1""",
)
def path_uniqueness_check(spark, sf):
    metadata = table(spark, sf, "part").filter("p_size > 40").select("p_brand", F.col("p_type").alias("metric_parquet_path"))
    return Q.path_problems(metadata, "p_brand")


@query(
    "known_lists_and_overrides",
    """SELECT p_partkey, p_brand, CASE WHEN p_type = 'PROMO' AND p_size > 25 THEN '3I' ELSE p_type END AS p_type FROM part
    WHERE p_brand NOT IN ('Brand#3', 'Brand#4') AND p_brand IN ('Brand#3', 'Brand#5', 'Brand#6', 'Brand#7')""",
)
def known_lists_and_overrides(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return Q.apply_known_lists(
        part, "p_brand", ["Brand#3", "Brand#4"], ["Brand#3", "Brand#5", "Brand#6", "Brand#7"],
        {"p_type": {"p_type = 'PROMO' and p_size > 25": "3I"}},
    ).drop("p_size")


@query(
    "skip_status",
    """SELECT d.source || '/' || d.lang AS partition_key, CASE WHEN d.lang IN ('de') THEN 'unknown partition'
        WHEN coalesce(n, 0) = 0 THEN 'empty table' WHEN q IS NULL THEN 'source column missing' ELSE 'ok' END AS status
    FROM (SELECT DISTINCT source, lang FROM documents) d LEFT JOIN
      (SELECT source, lang, count(*) AS n, max(CASE WHEN quality = 1 THEN 1 END) AS q FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2) l
      ON d.source = l.source AND d.lang = l.lang""",
)
def skip_status(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    per = documents.join(labels, "doc_id", "left").groupBy("source", "lang").agg(
        F.count("quality").alias("n"), F.max(F.when(F.col("quality") == 1, True)).alias("has"))
    status = Q.output_status(F.col("lang") != "de", F.col("n"), F.col("has"))
    return per.select(F.concat_ws("/", "source", "lang").alias("partition_key"), status.alias("status"))


@query(
    "table_profile",
    """SELECT 'Orders' AS title, CAST(count(*) AS BIGINT) AS num_records,
      '- ''`o_orderkey`''' || chr(10) || '- ''`o_custkey`''' || chr(10) || '- ''`o_orderstatus`''' AS columns FROM orders""",
)
def table_profile(spark, sf):
    return Q.profile(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "Orders")


@query(
    "column_profile",
    """SELECT 'o_orderstatus' AS "column", CAST(count(o_orderstatus) AS BIGINT) AS n_present, min(o_orderstatus) AS low, max(o_orderstatus) AS high FROM orders
    UNION ALL SELECT 'o_custkey', CAST(count(o_custkey) AS BIGINT), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders""",
)
def column_profile(spark, sf):
    return Q.column_profile(table(spark, sf, "orders"), ["o_orderstatus", "o_custkey"])


@query(
    "error_isolation",
    """WITH p AS (SELECT lang, source, text, regexp_matches(trim(text), '^[0-9]+$') AS numeric FROM documents),
    o AS (SELECT source, bool_and(length(text) < 40000) AS ok FROM documents GROUP BY 1)
    SELECT d.source AS source, CAST(count(*) AS BIGINT) AS n FROM documents d JOIN o ON d.source = o.source WHERE o.ok GROUP BY 1""",
)
def error_isolation(spark, sf):
    documents = table(spark, sf, "documents").select("source", "text")
    # A text of 40,000 characters or more does not parse and takes its source out of publication.
    parsed = F.when(F.length("text") < 40000, F.length("text"))
    outcomes = Q.partition_outcomes(documents, "source", parsed, F.col("text"))
    return Q.only_successful(documents, outcomes, "source").groupBy("source").agg(F.count("*").alias("n"))


@query(
    "partition_outcomes",
    """SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (WHERE length(text) >= 40000) AS BIGINT) AS n_bad,
      CASE WHEN count(*) FILTER (WHERE length(text) >= 40000) > 0 THEN 'failed' ELSE 'ok' END AS outcome FROM documents GROUP BY 1""",
)
def partition_outcomes(spark, sf):
    documents = table(spark, sf, "documents").select("source", "text")
    parsed = F.when(F.length("text") < 40000, F.length("text"))
    return Q.partition_outcomes(documents, "source", parsed, F.col("text"))


@query("assumption_check", "SELECT o_orderkey, o_orderpriority AS priority FROM orders")
def assumption_check(spark, sf):
    listed = F.col("o_orderpriority").isin(PRIORITIES)
    checked = Q.assumption(listed, F.col("o_orderpriority"), "unexpected priority", "string")
    return table(spark, sf, "orders").select("o_orderkey", checked.alias("priority"))
