"""Metadata, checks, writers and streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from arealis import schemas
from arealis.operators import joins as J
from arealis.operators import metadata as M
from arealis.operators import quality as Q
from arealis.plans.usa import at_level, has_tables, variable_dictionary, widen_in_batches
from arealis.session import ensure_checkpoint_dir, scratch_path
from arealis.sinks import publish as K
from arealis.specs import CountryRecord, DerivedMetric, GeometryLevel, PublisherRecord, ReleaseTemplate
from arealis.streaming import watch as T

DAY = date(2021, 3, 21)


def test_published_names_are_unique():
    names = [n for kind in schemas.TABLES for n in schemas.published_schema(kind).fieldNames()]
    assert len(names) == len(set(names))


def template(key="2021", start=DAY, end=DAY):
    return ReleaseTemplate(key, "Census", DAY, start, end, DAY, DAY, DAY, "u", "TBC")


def tables(spark):
    country = M.country_table(spark, CountryRecord("Belgium", "Kingdom of Belgium", "BEL", "BE"))
    publisher = M.publisher_table(spark, PublisherRecord("P", "u", "d", ("bel",)))
    geometry = M.geometry_table(spark, "bel", [GeometryLevel("Output Area", "adm5", "x")], DAY, DAY)
    releases = M.release_rows(geometry, [template()], publisher.first()["data_publisher_id"])
    specs = [DerivedMetric("a", "true", "#a", "A"), DerivedMetric("b", "true", "#b", "B")]
    source = releases.select("source_data_release_id", F.lit("s").alias("source_metric_id"))
    metrics = M.complete_metric_rows(M.metric_rows_from_specs(spark, specs, "bel/metrics/t.parquet", "s"), source)
    return country, publisher, geometry, releases.select(*schemas.published_schema("release").fieldNames()), metrics


def test_chain_and_layout(spark, tmp_path):
    country, publisher, geometry, releases, metrics = tables(spark)
    assert country.first()["country_id"] == "bel"
    assert geometry.first()["geometry_filepath_stem"] == "bel/geometries/output_area_2021"
    flat = J.flat_catalogue(metrics, releases, publisher, geometry, country).collect()
    assert {(r.metric_parquet_column_name, r.country_name_short_en, r.geometry_level) for r in flat} == {
        ("a", "Belgium", "Output Area"), ("b", "Belgium", "Output Area"),
    }
    base = str(tmp_path)
    wide = spark.createDataFrame([(1, 2, 3)], "GEO_ID int, a int, b int")
    for df in (country, publisher, releases, geometry):
        K.write_metadata(df, base, "bel")
    assert K.write_metrics([(wide, metrics)], base, "bel") == [f"{base}/bel/metrics/t.parquet"]
    for name in schemas.FILE_NAMES.values():
        assert spark.read.parquet(f"{base}/bel/{name}").count() > 0
    assert spark.read.parquet(f"{base}/bel/metrics/t.parquet").first()["GEO_ID"] == "1"
    K.write_country_list(country, base)
    assert [r.value for r in spark.read.text(f"{base}/countries.txt").collect()] == ["bel"]


def test_geometry_ids_do_not_cover_the_country(spark):
    level = [GeometryLevel("ward", "adm4", "x")]
    one, two = (M.geometry_table(spark, c, level, DAY, DAY) for c in ("aaa", "bbb"))
    assert one.first()["geometry_id"] == two.first()["geometry_id"]


def test_all_null_columns_keep_their_type(spark, tmp_path):
    *_, metrics = tables(spark)
    path = K.write_table(metrics, str(tmp_path), "m.parquet")
    types = dict(spark.read.parquet(path).dtypes)
    assert types["metric_potential_denominator_ids"] == "array<string>"
    assert types["metric_parquet_margin_of_error_file"] == "string"


def test_metric_checks(spark, tmp_path):
    *_, metrics = tables(spark)
    good = spark.createDataFrame([("1", 2, 3)], "GEO_ID string, a int, b int")
    with pytest.raises(ValueError, match=r"columns without metadata: \['c'\]"):
        Q.require_metric_columns(good.withColumn("c", F.lit(1)), metrics)
    with pytest.raises(ValueError, match=r"metadata without column: \['b'\]"):
        Q.require_metric_columns(good.drop("b"), metrics)
    with pytest.raises(ValueError, match="need a GEO_ID"):
        Q.require_metric_columns(good.drop("GEO_ID"), metrics)
    with pytest.raises(ValueError, match="paths clash"):
        K.write_metrics([(good, metrics), (good, metrics)], str(tmp_path), "bel")
    assert not (tmp_path / "bel").exists()
    with pytest.raises(ValueError, match="empty"):
        K.write_metadata(metrics.limit(0), str(tmp_path), "bel")
    with pytest.raises(ValueError, match="not a metadata table"):
        K.kind_of(good)
    with pytest.raises(ValueError, match="no country records"):
        M.from_records(spark, "country", [])


def test_boundary_checks(spark, tmp_path):
    languages = spark.createDataFrame([("eng",), ("nld",)], "code string")
    names = spark.createDataFrame([("1", "x")], "GEO_ID string, eng string")
    Q.require_name_columns(names, languages)
    with pytest.raises(ValueError, match=r"not ISO 639-3 codes: \['en'\]"):
        Q.require_name_columns(names.withColumnRenamed("eng", "en"), languages)
    with pytest.raises(ValueError, match="name column"):
        Q.require_name_columns(names.select("GEO_ID"), languages)
    with pytest.raises(ValueError, match="GEO_ID and parts only"):
        Q.require_boundary_columns(names)
    with pytest.raises(ValueError, match="'shp' is not supported"):
        K.write_boundaries(names, "shp", str(tmp_path / "x"))


def test_period_validity(spark):
    geometry = M.geometry_table(spark, "bel", [GeometryLevel("w", "t", "x")], DAY, DAY)
    releases = M.release_rows(geometry, [template("a"), template("b", end=date(2020, 1, 1))], "p")
    assert {r.release_key: r.ok for r in releases.select("release_key", M.valid_periods(releases).alias("ok")).collect()} == {"a": True, "b": False}


def test_isolation_and_assumptions(spark):
    df = spark.createDataFrame([("p", "1"), ("p", "x"), ("q", "2")], "part string, n string")
    outcomes = Q.partition_outcomes(df, "part", F.col("n").try_cast("int"), F.col("n"))
    assert {r.part: r.outcome for r in outcomes.collect()} == {"p": "failed", "q": "ok"}
    assert [r.part for r in Q.only_successful(df, outcomes, "part").collect()] == ["q"]
    with pytest.raises(Exception, match="changed"):
        df.select(Q.assumption(F.col("part") == "p", F.col("n"), "changed", "string")).collect()
    with pytest.raises(Q.AssumptionsOutdated):
        Q.require_no_rows(df, "rows", Q.AssumptionsOutdated)


def test_partition_writer_skips_empty(spark, tmp_path):
    assert K.write_partition(spark.createDataFrame([], ""), None, str(tmp_path)) is None


def test_long_partitions_are_replaced_one_by_one(spark, tmp_path):
    schema = "country_id string, partition_key string, GEO_ID string, metric string, value double"
    both = spark.createDataFrame([("bel", "x", "1", "m", 1.0), ("bel", "y", "1", "m", 2.0)], schema)
    path = K.write_long_metrics(both, str(tmp_path))
    K.write_long_metrics(spark.createDataFrame([("bel", "y", "1", "m", 5.0)], schema), str(tmp_path))
    assert {(r.partition_key, r.value) for r in spark.read.parquet(path).collect()} == {("x", 1.0), ("y", 5.0)}


SHELLS = [
    ("B01001", None, "SEX BY AGE", "1"),
    ("B01001", None, "Universe:  Total population", None),
    ("B01001", "B01001_001", "Total:", None),
    ("B01001", "B01001_002", "Male:", None),
    ("B01001", "B01001_003", "Under 5 years", None),
    ("B01001", "B01001_004", "Female:", None),
    ("B01001", "B01001_005", "Under 5 years", None),
    ("  ", None, "note", None),
    ("B02001", None, "(HISPANIC-LATINO) RACE", "1"),
    ("B02001", None, "Households", None),
    ("B02001", "B02001_001", "Total:", None),
]


def test_variable_dictionary(spark):
    rows = [(*r, "f", 0, i) for i, r in enumerate(SHELLS)]
    df = spark.createDataFrame(
        rows, "table_id string, unique_id string, stub string, data_release string, source_file string, file_offset bigint, row_index bigint"
    ).withColumns({"universe": F.lit(None).cast("string"), "title": F.lit(None).cast("string")})
    got = {r.unique_id: (r.universe, r.table_name, r.variable_extended_name) for r in variable_dictionary(df, 2019).collect()}
    assert got["B01001_003"] == ("Total population", "Sex By Age", "Total|Male|Under 5 years")
    assert got["B01001_005"] == ("Total population", "Sex By Age", "Total|Female|Under 5 years")
    # The path goes on from one table to the next within a file.
    assert got["B02001_001"] == ("Households", "(Hispanic-Latino) Race", "Total|Total")
    columns = df.filter("unique_id is not null").withColumns({"universe": F.lit("Households"), "title": F.lit("SEX BY AGE")})
    assert {r.table_name for r in variable_dictionary(columns, 2021).collect()} == {"Sex By Age"}


def test_levels_and_batched_merge(spark):
    geoids = spark.createDataFrame([("a", 50), ("b", 140), ("c", 10)], "GEO_ID string, SUMLEVEL int")
    frames = [spark.createDataFrame([("a", i), ("b", i), ("c", i)], f"GEO_ID string, B{i:02d}_E001 int") for i in range(7)]
    wide = widen_in_batches(spark, [at_level(f, geoids, "county") for f in frames], size=3)
    assert [tuple(r) for r in wide.collect()] == [("a", *range(7))]
    assert not has_tables(2020, "oneYear", "county") and not has_tables(2019, "oneYear", "tract") and has_tables(2021, "fiveYear", "tract")


def log(spark, path, rows, mode="append"):
    spark.createDataFrame(rows, schemas.MATERIALISATION_SCHEMA).coalesce(1).write.mode(mode).parquet(path)


def test_publish_sequence(spark, tmp_path):
    """Nothing, unmonitored, monitored, same run again, monitored partition."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "check"))
    monitored = spark.createDataFrame([("be/geometry", "geometry"), ("be/metrics", "metrics")], "asset_key string, kind string")
    seen = []

    def run():
        requests = T.once_per_run(T.monitored_events(T.read_materialisations(spark, source), monitored))
        writers = {k: T.batch_folder_writer(f"{out}/kind={k}") for k in ("geometry", "metrics")}
        T.publish_stream(requests, writers, checkpoint).awaitTermination()
        try:
            found = spark.read.parquet(out)
            seen.append(found.count())
            return found
        except Exception:
            seen.append(0)

    now = datetime(2024, 1, 1)
    log(spark, source, [])
    run()
    log(spark, source, [("other", None, "r1", now)])
    run()
    log(spark, source, [("be/geometry", None, "r1", now)])
    run()
    log(spark, source, [("be/geometry", None, "r1", now)])
    run()
    log(spark, source, [("be/metrics", "A b/1", "r2", now)])
    found = run()
    assert seen == [0, 0, 1, 1, 2]
    assert {(r.kind, r.run_key) for r in found.collect()} == {("geometry", "be/geometry_r1"), ("metrics", "be-metrics-a-b-1_r2")}


def test_table_publisher(spark, tmp_path):
    batch = spark.createDataFrame([("k1",), ("k1",), ("k2",)], "publish_key string")
    T.table_publisher(lambda key: spark.createDataFrame([(key,)], "v string"), str(tmp_path))(batch, 0)
    assert {r.v for r in spark.read.parquet(str(tmp_path / "k1"), str(tmp_path / "k2")).collect()} == {"k1", "k2"}
    assert T.POLL_SECONDS["metadata"] == 20


def test_report_and_fan_in(spark):
    monitored = spark.createDataFrame([("a",), ("b",)], "asset_key string")
    events = spark.createDataFrame([("a", "r1", 1), ("a", "r2", 2)], "asset_key string, run_id string, ts int")
    got = {r.asset_key: (r.status, r.last_run, r.n_events) for r in T.monitor_report(monitored, events).collect()}
    assert got == {"a": ("materialised", "r2", 2), "b": ("not yet", None, 0)}
    assert T.fan_in(monitored, "asset_key", ["b"]).count() == 1 and T.fan_in(monitored, "asset_key").count() == 2


def test_shared_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(folder.rstrip("/"))
