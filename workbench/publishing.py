"""Sinks and streams: publish into a fresh folder, then read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealis.operators import metadata as M
from arealis.operators.reshape import fold_to_long, pivot_metrics
from arealis.session import scratch_path
from arealis.sinks import publish as K
from arealis.sources import boundaries as B
from arealis.streaming import watch as T
from workbench.base import OBS, PRIORITIES, STATUSES, observations, query, table
from workbench.joining import metadata_tables
from workbench.scanning import customer_grid

_BY_PRIORITY = ", ".join(
    f"CAST(sum(cents) FILTER (WHERE priority = '{p}') AS BIGINT) AS \"{p}\"" for p in PRIORITIES
)


def _priority_output(spark, sf, path="be/metrics/priorities.parquet"):
    obs = observations(spark, sf)
    metrics = pivot_metrics(obs, "GEO_ID", ["priority"], "cents", names=PRIORITIES)
    rows = M.metric_rows_from_keys(obs, ["priority"], F.lit(path), F.lit("cents"))
    return metrics, M.publish_names("metric", rows)


def _status_output(spark, sf, path="be/metrics/statuses.parquet"):
    obs = observations(spark, sf)
    metrics = pivot_metrics(obs, "GEO_ID", ["status"], "cents", names=STATUSES)
    rows = M.metric_rows_from_keys(obs, ["status"], F.lit(path), F.lit("cents"))
    return metrics, M.publish_names("metric", rows)


@query("publish_metrics", f'WITH {OBS} SELECT "GEO_ID", {_BY_PRIORITY} FROM obs GROUP BY 1')
def publish_metrics(spark, sf):
    base = scratch_path(spark, "published")
    K.write_metrics([_priority_output(spark, sf), _status_output(spark, sf)], base, "be")
    return spark.read.parquet(f"{base}/be/metrics/priorities.parquet")


@query(
    "publish_metric_metadata",
    f"""WITH {OBS} SELECT DISTINCT 'be/metrics/priorities.parquet' AS metric_parquet_path, priority AS metric_parquet_column_name FROM obs
    UNION SELECT DISTINCT 'be/metrics/statuses.parquet', status FROM obs""",
)
def publish_metric_metadata(spark, sf):
    base = scratch_path(spark, "published")
    K.write_metrics([_priority_output(spark, sf), _status_output(spark, sf)], base, "be")
    return spark.read.parquet(f"{base}/be/metric_metadata.parquet").select(
        "metric_parquet_path", "metric_parquet_column_name"
    )


@query(
    "publish_metadata_tables",
    f"""WITH {OBS} SELECT 'country' AS kind, count(*)::BIGINT AS n FROM region UNION ALL SELECT 'publisher', count(*)::BIGINT FROM region
    UNION ALL SELECT 'release', count(*)::BIGINT FROM nation UNION ALL SELECT 'geometry', count(*)::BIGINT FROM nation
    UNION ALL SELECT 'metric', count(DISTINCT ("GEO_ID", segment))::BIGINT FROM obs""",
)
def publish_metadata_tables(spark, sf):
    base = scratch_path(spark, "published")
    tables = metadata_tables(spark, sf)
    counted = None
    for df in tables:
        kind = K.kind_of(df)
        path = K.write_metadata(df, base, "all")
        n = spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
        counted = n if counted is None else counted.unionByName(n)
    return counted


@query(
    "publish_names",
    """SELECT CAST(c_custkey AS VARCHAR) AS "GEO_ID", c_name AS eng, c_mktsegment AS fra FROM customer""",
)
def publish_names(spark, sf):
    base = scratch_path(spark, "published")
    names = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("GEO_ID"), F.col("c_name").alias("eng"), F.col("c_mktsegment").alias("fra")
    )
    boundaries = customer_grid(spark, sf).select(F.col("c_custkey").cast("string").alias("GEO_ID"), "parts")
    day = F.lit("2021-03-21").cast("date")
    geometry = M.publish_names("geometry", table(spark, sf, "region").select(
        day.alias("validity_period_start"), day.alias("validity_period_end"), F.col("r_name").alias("level"),
        F.lit("adm1").alias("hxl_tag"), F.lit("be").alias("country_id")))
    languages = spark.createDataFrame([("eng",), ("fra",)], "code string")
    K.write_geometry([("be/geometries/customers_2021", boundaries, names)], geometry, languages, base, "be")
    return spark.read.parquet(f"{base}/be/geometries/customers_2021.parquet")


@query(
    "publish_geojson_lines",
    """SELECT CAST(c_custkey AS VARCHAR) AS "GEO_ID", CAST(1 AS BIGINT) AS n_parts, CAST(5 AS BIGINT) AS n_points FROM customer""",
)
def publish_geojson_lines(spark, sf):
    path = scratch_path(spark, "geojsonseq")
    boundaries = customer_grid(spark, sf).select(F.col("c_custkey").cast("string").alias("GEO_ID"), "parts")
    K.write_boundaries(boundaries, "GeoJSONSeq", path)
    layer = B.with_properties(B.read_feature_lines(spark, path), ["GEO_ID"])
    return layer.select(
        "GEO_ID", F.size("parts").cast("bigint").alias("n_parts"), F.size(F.col("parts")[0][0]).cast("bigint").alias("n_points")
    )


@query(
    "publish_wkb",
    """SELECT CAST(c_custkey AS VARCHAR) AS "GEO_ID", CAST(102 AS BIGINT) AS n_bytes FROM customer""",
)
def publish_wkb(spark, sf):
    path = scratch_path(spark, "wkb")
    boundaries = customer_grid(spark, sf).select(F.col("c_custkey").cast("string").alias("GEO_ID"), "parts")
    K.write_boundaries(boundaries, "parquet", path)
    return spark.read.parquet(path).select("GEO_ID", F.octet_length("geometry").cast("bigint").alias("n_bytes"))


@query(
    "publish_partitions",
    f"""WITH {OBS} SELECT 'be' AS country_id, lpad(CAST(year AS VARCHAR), 6, '0') AS partition_key, "GEO_ID", status AS metric, CAST(sum(cents) AS BIGINT) AS value
    FROM obs GROUP BY 2, 3, 4""",
)
def publish_partitions(spark, sf):
    long = observations(spark, sf).groupBy(
        F.lit("be").alias("country_id"), F.lpad(F.col("year").cast("string"), 6, "0").alias("partition_key"), "GEO_ID", F.col("status").alias("metric")
    ).agg(F.sum("cents").alias("value"))
    path = K.write_long_metrics(long, scratch_path(spark, "published"))
    return K.read_long_metrics(spark, path)


@query(
    "publish_single_partition",
    f'WITH {OBS} SELECT "GEO_ID", status AS metric, CAST(sum(cents) AS BIGINT) AS value FROM obs GROUP BY 1, 2',
)
def publish_single_partition(spark, sf):
    metrics, metadata = _status_output(spark, sf)
    path = K.write_partition(metrics, metadata, scratch_path(spark, "published"))
    return fold_to_long(spark.read.parquet(path), value_type="bigint")


@query(
    "publish_country_list",
    "SELECT DISTINCT lower(r_name) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def publish_country_list(spark, sf):
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    used = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.lower("r_name").alias("country_id"))
    return spark.read.text(K.write_country_list(used, scratch_path(spark, "published")))


@query(
    "publish_layout",
    f"""WITH {OBS} SELECT DISTINCT lower(r_name) || '/metrics/' || CAST(year AS VARCHAR) || segment || '.parquet' AS metric_path,
      lower(r_name) || '/geometries/' || lower(n_name) || '_2021' AS stem FROM obs
      JOIN nation ON "GEO_ID" = 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') JOIN region ON n_regionkey = r_regionkey""",
)
def publish_layout(spark, sf):
    from arealis.functions.ids import geometry_path_stem, metric_path, partition_key

    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("GEO_ID"), "n_name", F.lower("r_name").alias("country")
    )
    keys = observations(spark, sf).select("GEO_ID", "year", "segment").distinct().join(placed, "GEO_ID")
    return keys.select(
        metric_path(F.col("country"), partition_key(F.col("year"), F.col("segment"))).alias("metric_path"),
        geometry_path_stem(F.col("country"), F.col("n_name"), F.lit("2021-03-21").cast("date")).alias("stem"),
    ).distinct()


# Kinds of output the event types stand for; 'error' is not monitored.
KINDS = {"signup": "metadata", "view": "geometry", "purchase": "metrics", "click": "metrics"}


def _log(spark, sf):
    """Events as a log of materialisations: the event type is the asset, the user is the run."""
    path = scratch_path(spark, "log")
    table(spark, sf, "events").select(
        F.col("event_type").alias("asset_key"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("Part "), (F.col("user_id") % 7).cast("string"))).alias("partition"),
        F.col("user_id").cast("string").alias("run_id"),
        "ts",
    ).write.parquet(path)
    return path


def _monitored(spark):
    return spark.createDataFrame(list(KINDS.items()), "asset_key string, kind string")


_LOG_SQL = """log AS (SELECT event_type AS asset_key, CASE WHEN event_type = 'click' THEN 'click-part-' || CAST(user_id % 7 AS VARCHAR) ELSE event_type END AS publish_key,
  CAST(user_id AS VARCHAR) AS run_id, ts, CASE event_type WHEN 'signup' THEN 'metadata' WHEN 'view' THEN 'geometry' WHEN 'purchase' THEN 'metrics' WHEN 'click' THEN 'metrics' END AS kind
  FROM events)"""


@query(
    "publish_once",
    f"""WITH {_LOG_SQL} SELECT kind, publish_key || '_' || run_id AS run_key, CAST(1 AS BIGINT) AS n FROM log
    WHERE kind IS NOT NULL GROUP BY 1, 2""",
)
def publish_once(spark, sf):
    log, base = _log(spark, sf), scratch_path(spark, "requests")
    checkpoint = scratch_path(spark, "stream")
    # The stream runs twice over the same log: the second run finds nothing new.
    for _ in range(2):
        events = T.read_materialisations(spark, log, max_files=1)
        requests = T.once_per_run(T.monitored_events(events, _monitored(spark)))
        kinds = sorted(set(KINDS.values()))
        writers = {k: T.batch_folder_writer(f"{base}/kind={k}") for k in kinds}
        T.publish_stream(requests, writers, checkpoint).awaitTermination()
    return spark.read.parquet(base).groupBy("kind", "run_key").agg(F.count("*").alias("n"))


@query(
    "publish_once_watermark",
    f"""WITH {_LOG_SQL} SELECT DISTINCT publish_key || '_' || run_id AS run_key FROM log WHERE kind IS NOT NULL""",
)
def publish_once_watermark(spark, sf):
    log, base = _log(spark, sf), scratch_path(spark, "requests")
    events = T.monitored_events(T.read_materialisations(spark, log), _monitored(spark))
    requests = T.once_per_run(events, watermark="400 days")
    writers = {k: T.batch_folder_writer(f"{base}/kind={k}") for k in sorted(set(KINDS.values()))}
    T.publish_stream(requests, writers, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(base).select("run_key")


@query(
    "publish_new_keys",
    f"WITH {_LOG_SQL} SELECT DISTINCT publish_key FROM log WHERE kind IS NOT NULL",
)
def publish_new_keys(spark, sf):
    log, base = _log(spark, sf), scratch_path(spark, "keys")
    events = T.monitored_events(T.read_materialisations(spark, log), _monitored(spark))
    keys = T.new_keys(events).withColumn("kind", F.lit("key"))
    T.publish_stream(keys, {"key": T.batch_folder_writer(base)}, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(base).select("publish_key")


@query(
    "latest_runs",
    f"""WITH {_LOG_SQL} SELECT publish_key, arg_max(run_id, struct_pack(t := ts, r := run_id)) AS run_id FROM log WHERE kind IS NOT NULL GROUP BY 1""",
)
def latest_runs(spark, sf):
    log = spark.read.parquet(_log(spark, sf))
    return T.latest_runs(T.monitored_events(log, _monitored(spark))).select("publish_key", "run_id")


@query(
    "monitor_report",
    """WITH m AS (SELECT DISTINCT source AS asset_key FROM documents UNION SELECT DISTINCT event_type FROM events)
    SELECT m.asset_key AS asset_key, CASE WHEN count(e.event_id) > 0 THEN 'materialised' ELSE 'not yet' END AS status,
      arg_max(CAST(user_id AS VARCHAR), struct_pack(t := ts, r := CAST(user_id AS VARCHAR))) AS last_run, CAST(count(e.event_id) AS BIGINT) AS n_events
    FROM m LEFT JOIN events e ON e.event_type = m.asset_key GROUP BY 1""",
)
def monitor_report(spark, sf):
    log = spark.read.parquet(_log(spark, sf))
    monitored = table(spark, sf, "documents").select(F.col("source").alias("asset_key")).union(
        table(spark, sf, "events").select("event_type")
    ).distinct()
    return T.monitor_report(monitored, log)


@query(
    "partition_fan_in",
    f"""WITH {OBS} SELECT year, status, CAST(sum(cents) AS BIGINT) AS cents FROM obs WHERE year IN (1996, 1998) GROUP BY 1, 2""",
)
def partition_fan_in(spark, sf):
    path = scratch_path(spark, "by_year")
    observations(spark, sf).groupBy("year", "status").agg(F.sum("cents").alias("cents")).write.partitionBy("year").parquet(path)
    chosen = T.fan_in(spark.read.parquet(path), "year", [1996, 1998])
    return chosen.withColumn("year", F.col("year").cast("bigint"))
