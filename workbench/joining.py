"""Joins, set operations, grouping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from arealis.operators import grouping as G
from arealis.operators import joins as J
from arealis.operators import sets as S
from arealis.operators.metadata import complete_metric_rows, metric_rows_from_keys, publish_names, release_rows
from arealis.specs import ReleaseTemplate
from workbench.base import OBS, observations, query, table


@query(
    "lookup_chain",
    """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, n_name, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def lookup_chain(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nation = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    region = table(spark, sf, "region")
    return J.chain_lookups(
        customer, [(nation, ["n_nationkey"]), (region, ["r_regionkey"])]
    ).select("c_custkey", "n_name", "r_name")


@query(
    "inner_join_different_names",
    """SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, n_name FROM supplier
    JOIN nation ON s_nationkey = n_nationkey""",
)
def inner_join_different_names(spark, sf):
    return J.join_on_names(
        table(spark, sf, "supplier"), table(spark, sf, "nation"), "s_nationkey", "n_nationkey"
    ).select("s_suppkey", "n_name")


@query(
    "left_join_levels",
    """SELECT d.doc_id AS doc_id, CAST(l.quality AS BIGINT) AS quality FROM documents d
    LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def left_join_levels(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("quality"))
    return table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")


_BUILDERS = "SELECT c_custkey AS area FROM customer WHERE c_mktsegment = 'BUILDING'"
_URGENT = "SELECT DISTINCT o_custkey AS zone FROM orders WHERE o_orderpriority = '1-URGENT'"


def _builders(spark, sf):
    return table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("area"))


def _urgent(spark, sf):
    return table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("zone")).distinct()


@query("full_outer_lookup", f"SELECT area, zone FROM ({_BUILDERS}) FULL OUTER JOIN ({_URGENT}) ON area = zone")
def full_outer_lookup(spark, sf):
    return J.join_on_names(_builders(spark, sf), _urgent(spark, sf), "area", "zone", "full_outer")


_STATUS_SUMS = ", ".join(f"CAST(sum(cents) FILTER (WHERE status = '{s}') AS BIGINT) AS sum_{s}" for s in "FOP")


def _status_sums(spark, sf, key):
    obs = observations(spark, sf)
    return [
        obs.filter(F.col("status") == s).groupBy(*key).agg(F.sum("cents").alias(f"sum_{s}")) for s in "FOP"
    ]


_INNER_HAVING = " AND ".join(f"count(*) FILTER (WHERE status = '{s}') > 0" for s in "FOP")


@query(
    "inner_join_many",
    f'WITH {OBS} SELECT "GEO_ID", segment, priority, year, {_STATUS_SUMS} FROM obs GROUP BY 1, 2, 3, 4 HAVING {_INNER_HAVING}',
)
def inner_join_many(spark, sf):
    key = ["GEO_ID", "segment", "priority", "year"]
    return J.join_all(_status_sums(spark, sf, key), key)


@query(
    "outer_join_many",
    f'WITH {OBS} SELECT "GEO_ID", segment, priority, year, {_STATUS_SUMS} FROM obs GROUP BY 1, 2, 3, 4',
)
def outer_join_many(spark, sf):
    key = ["GEO_ID", "segment", "priority", "year"]
    return J.outer_join_all(_status_sums(spark, sf, key), key)


@query(
    "one_to_one_check",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
    CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def one_to_one_check(spark, sf):
    return J.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumn(
        "l_linenumber", F.col("l_linenumber").cast("bigint")
    )


@query(
    "one_to_one_join",
    """SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n_orders FROM customer
    JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def one_to_one_join(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n_orders"))
    return J.one_to_one_join(table(spark, sf, "customer").select("c_custkey"), counts, ["c_custkey"])


@query("semi_join", f"SELECT area FROM ({_BUILDERS}) WHERE area IN (SELECT zone FROM ({_URGENT}))")
def semi_join(spark, sf):
    listed = _urgent(spark, sf).withColumnRenamed("zone", "area")
    return J.keep_listed(_builders(spark, sf), listed, ["area"])


@query("anti_join", f"SELECT area FROM ({_BUILDERS}) WHERE area NOT IN (SELECT zone FROM ({_URGENT}))")
def anti_join(spark, sf):
    listed = _urgent(spark, sf).withColumnRenamed("zone", "area")
    return J.drop_listed(_builders(spark, sf), listed, ["area"])


@query(
    "index_concat",
    """SELECT coalesce(a.key, b.key) AS key, a.n AS builders, b.n AS urgent FROM
    (SELECT c_custkey AS key, CAST(count(*) AS BIGINT) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1) a
    FULL OUTER JOIN (SELECT o_custkey AS key, CAST(count(*) AS BIGINT) AS n FROM orders
      WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b ON a.key = b.key""",
)
def index_concat(spark, sf):
    builders = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").groupBy(F.col("c_custkey").alias("key")).agg(F.count("*").alias("builders"))
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("urgent"))
    return J.concat_columns([builders, urgent], ["key"])


@query(
    "null_matching_join",
    """WITH d AS (SELECT d.doc_id AS doc_id, l.quality AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    q AS (SELECT quality AS level, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY 1)
    SELECT d.doc_id AS doc_id, q.n AS n FROM d JOIN q ON d.quality IS NOT DISTINCT FROM q.level""",
)
def null_matching_join(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    documents = table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    sizes = documents.groupBy(F.col("quality").alias("level")).agg(F.count("*").alias("n"))
    return J.null_matching_join(documents, sizes, "quality", "level").select("doc_id", "n")


@query(
    "release_lookup",
    """SELECT o_orderkey, 'release ' || o_orderstatus || '_' || CAST(year(o_orderdate) AS VARCHAR) AS release
    FROM orders""",
)
def release_lookup(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    releases = orders.select("o_orderstatus", "year").distinct().withColumn(
        "release", F.concat(F.lit("release "), F.concat_ws("_", "o_orderstatus", F.col("year").cast("string")))
    )
    return J.lookup_or_fail(orders, releases, ["o_orderstatus", "year"], "release").select("o_orderkey", "release")


@query(
    "cross_dimensions",
    """SELECT n_name, level, CAST(year AS BIGINT) AS year,
      CAST(year AS VARCHAR) || '/' || level || '/' || n_name AS partition_key
    FROM nation, (VALUES ('tract'), ('county'), ('block_group')) l(level), (VALUES (2019), (2020), (2021)) y(year)
    WHERE NOT (year = 2020 AND level = 'tract')""",
)
def cross_dimensions(spark, sf):
    by_level = J.expand_dimension(table(spark, sf, "nation").select("n_name"), "level", ["tract", "county", "block_group"])
    every = J.expand_dimension(by_level, "year", [2019, 2020, 2021]).filter("not (year = 2020 and level = 'tract')")
    return every.select(
        "n_name", "level", F.col("year").cast("bigint").alias("year"),
        F.concat_ws("/", F.col("year").cast("string"), "level", "n_name").alias("partition_key"),
    )


@query(
    "fallback_lookup",
    """SELECT d.doc_id AS doc_id, coalesce('quality ' || CAST(l.quality AS VARCHAR), 'TBD') AS source_download_url
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def fallback_lookup(spark, sf):
    urls = table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("source_download_url")
    )
    return J.lookup_or_default(table(spark, sf, "documents").select("doc_id"), urls, ["doc_id"], "source_download_url")


def _census_release(key="census"):
    day = date(2021, 3, 21)
    return ReleaseTemplate(key, "Census", date(2023, 2, 21), day, day, day, day, date(2031, 1, 1), "https://example.com/census", "TBC")


def metadata_tables(spark, sf):
    """Five linked metadata tables out of the driver tables: regions are countries, nations levels."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    countries = publish_names("country", region.select(
        F.col("r_name").alias("name_short_en"), F.col("r_name").alias("name_official"),
        F.col("r_name").alias("iso3"), F.substring("r_name", 1, 2).alias("iso2")))
    publishers = publish_names("publisher", region.select(
        F.concat(F.lit("Office of "), "r_name").alias("name"), F.lit("https://example.com").alias("url"),
        F.lit("Office").alias("description"), F.array(F.replace(F.lower("r_name"), F.lit("-"), F.lit("_"))).alias("countries_of_interest")))
    day = F.lit(date(2021, 3, 21))
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey)
    geometries = publish_names("geometry", placed.select(
        day.alias("validity_period_start"), day.alias("validity_period_end"),
        F.col("n_name").alias("level"), F.lit("adm1").alias("hxl_tag"), F.lower("r_name").alias("country_id")))
    offices = publishers.select("data_publisher_id", F.col("data_publisher_countries_of_interest")[0].alias("country"))
    owned = geometries.withColumn("country", F.substring_index("geometry_filepath_stem", "/", 1)).join(offices, "country")
    releases = release_rows(owned, [_census_release()], F.col("data_publisher_id"))
    keys = observations(spark, sf).select("GEO_ID", "segment").distinct()
    named = keys.join(
        nation.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("GEO_ID"), "n_name"), "GEO_ID"
    )
    rows = named.select(
        F.col("segment").alias("parquet_column_name"), F.col("segment").alias("human_readable_name"),
        F.lit("d").alias("description"), F.lit("#population").alias("hxl_tag"), F.col("n_name").alias("geometry_level"),
        F.concat(F.lit("x/metrics/"), "GEO_ID", F.lit(".parquet")).alias("metric_parquet_path"))
    links = releases.select("geometry_level", "source_data_release_id")
    metrics = complete_metric_rows(rows, links, on=["geometry_level"])
    return metrics, releases.drop("release_key", "geometry_level"), publishers, geometries, countries


@query(
    "flat_catalogue",
    f"""WITH {OBS}, k AS (SELECT DISTINCT "GEO_ID", segment FROM obs)
    SELECT segment AS metric_parquet_column_name, n_name AS geometry_level, lower(r_name) AS country_id,
      'Office of ' || r_name AS data_publisher_name, 'Census' AS source_data_release_name,
      lower(r_name) || '/geometries/' || lower(n_name) || '_2021' AS geometry_filepath_stem
    FROM k JOIN nation ON "GEO_ID" = 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
    JOIN region ON n_regionkey = r_regionkey""",
)
def flat_catalogue(spark, sf):
    metrics, releases, publishers, geometries, countries = metadata_tables(spark, sf)
    flat = J.flat_catalogue(metrics, releases, publishers, geometries, countries)
    return flat.select(
        "metric_parquet_column_name", "geometry_level", "country_id", "data_publisher_name",
        "source_data_release_name", "geometry_filepath_stem",
    )


@query(
    "join_coverage_audit",
    """WITH m AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus = 'F'),
    g AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal > 0)
    SELECT coalesce(m.id, g.id) AS "GEO_ID",
      CASE WHEN g.id IS NULL THEN 'metric only' WHEN m.id IS NULL THEN 'geometry only' ELSE 'matched' END AS status
    FROM m FULL OUTER JOIN g ON m.id = g.id""",
)
def join_coverage_audit(spark, sf):
    metrics = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("GEO_ID"))
    boundaries = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("GEO_ID"))
    return J.coverage_audit(metrics, boundaries)


@query(
    "row_concat",
    """SELECT 'customer' AS kind, c_custkey AS id FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier""",
)
def row_concat(spark, sf):
    return S.stack(
        [
            table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id")),
            table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")),
        ]
    )


@query(
    "union_with_precedence",
    """SELECT s_suppkey AS id, s_name AS eng FROM supplier UNION ALL
    SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def union_with_precedence(spark, sf):
    preferred = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("eng"))
    other = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("eng"))
    return S.union_with_precedence(preferred, other, "id")


@query(
    "set_difference",
    f"""SELECT area AS id, 'missing' AS difference FROM ({_BUILDERS}) WHERE area NOT IN (SELECT zone FROM ({_URGENT}))
    UNION ALL SELECT zone, 'extra' FROM ({_URGENT}) WHERE zone NOT IN (SELECT area FROM ({_BUILDERS}))""",
)
def set_difference(spark, sf):
    expected = _builders(spark, sf).withColumnRenamed("area", "id")
    found = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    return S.differences(expected, found, "id")


@query(
    "nonempty_outputs",
    """SELECT source, CAST(count(*) AS BIGINT) AS n FROM documents JOIN labels USING (doc_id)
    GROUP BY 1 UNION SELECT source, CAST(count(*) AS BIGINT) FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
)
def nonempty_outputs(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    per_source = documents.join(labels, "doc_id", "left").groupBy("source").agg(F.count("quality").alias("n"))
    return S.stack([per_source, per_source]).filter("n > 0").distinct()


@query("distinct_names", 'SELECT DISTINCT p_brand AS "GEO_ID", p_type AS eng FROM part')
def distinct_names(spark, sf):
    return table(spark, sf, "part").select(F.col("p_brand").alias("GEO_ID"), F.col("p_type").alias("eng")).distinct()


@query(
    "output_counts",
    f"""WITH {OBS}, k AS (SELECT DISTINCT year, segment, status FROM obs)
    SELECT segment, CAST(count(*) AS BIGINT) AS num_metrics, CAST(count(DISTINCT year) AS BIGINT) AS num_parquets
    FROM k GROUP BY 1""",
)
def output_counts(spark, sf):
    obs = observations(spark, sf)
    path = F.concat(F.lit("x/metrics/"), F.col("year").cast("string"), F.lit(".parquet"))
    rows = metric_rows_from_keys(obs, ["year", "segment", "status"], F.lit(None).cast("string"), F.lit(None).cast("string"))
    keys = obs.select("year", "segment", "status").distinct().withColumn("metric_parquet_path", path)
    return G.output_counts(keys.join(rows.select("parquet_column_name"), F.concat_ws("_", "year", "segment", "status") == F.col("parquet_column_name")), ["segment"])


@query(
    "key_uniqueness",
    """SELECT 'lineitem' AS name, CAST(count(*) AS BIGINT) AS n_rows,
      CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS n_keys, false AS is_unique FROM lineitem
    UNION ALL SELECT 'orders', CAST(count(*) AS BIGINT), CAST(count(DISTINCT o_orderkey) AS BIGINT), true FROM orders""",
)
def key_uniqueness(spark, sf):
    lineitem = G.key_uniqueness(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = G.key_uniqueness(table(spark, sf, "orders"), ["o_orderkey"])
    return lineitem.select(F.lit("lineitem").alias("name"), "*").unionByName(orders.select(F.lit("orders").alias("name"), "*"))


@query(
    "flatten_outputs",
    """SELECT o_orderstatus AS asset, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS metric
    FROM orders GROUP BY 1, 2, 3""",
)
def flatten_outputs(spark, sf):
    # The nested lists hold distinct (year, priority) pairs, a handful per asset.
    nested = (
        table(spark, sf, "orders")
        .select("o_orderstatus", F.year("o_orderdate").cast("bigint").alias("year"), "o_orderpriority")
        .distinct()
        .groupBy(F.col("o_orderstatus").alias("asset"))
        .agg(F.collect_list(F.struct("year", F.col("o_orderpriority").alias("metric"))).alias("outputs"))
    )
    return G.flatten(nested, "outputs")


@query(
    "summary_level_split",
    """SELECT 'county' AS level, 'N' || CAST(c_nationkey AS VARCHAR) AS "GEO_ID", CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'tract', 'R' || CAST(n_regionkey AS VARCHAR), CAST(count(*) AS BIGINT)
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2""",
)
def summary_level_split(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    # Every customer counts for its nation, its region and the whole: three summary levels in one pass.
    stacked = joined.select(F.explode(F.array(
        F.struct(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("GEO_ID"), F.lit(50).alias("SUMLEVEL")),
        F.struct(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("GEO_ID"), F.lit(140).alias("SUMLEVEL")),
        F.struct(F.lit("ALL").alias("GEO_ID"), F.lit(10).alias("SUMLEVEL")),
    )).alias("g")).groupBy("g.GEO_ID", "g.SUMLEVEL").agg(F.count("*").alias("n"))
    split = G.split_levels(stacked, {"tract": 140, "block_group": 150, "county": 50})
    return S.stack([df.select(F.lit(name).alias("level"), "*") for name, df in split.items()])
