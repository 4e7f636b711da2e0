"""Publication driven by a stream of materialisation events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arealis.functions.text import slug
from arealis.operators.ordered import latest_record
from arealis.schemas import MATERIALISATION_SCHEMA

# Seconds between polls per kind of output.
POLL_SECONDS = {
    "metadata": 20,
    "geometry": 60,
    "metrics": 60,
    "metrics_metadata": 60,
    "metrics_partitioned": 60,
}


def read_materialisations(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The event log as a stream of parquet files."""
    reader = spark.readStream.schema(MATERIALISATION_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def with_keys(events: DataFrame) -> DataFrame:
    """Add ``publish_key`` (asset and partition) and ``run_key`` (key and run)."""
    asset = F.when(
        F.col("partition").isNotNull(), slug(F.concat_ws("-", "asset_key", "partition"), "-")
    ).otherwise(F.col("asset_key"))
    return events.withColumn("publish_key", asset).withColumn(
        "run_key", F.concat_ws("_", "publish_key", "run_id")
    )


def monitored_events(events: DataFrame, monitored: DataFrame) -> DataFrame:
    """Events of monitored assets, with the kind of output they feed."""
    return with_keys(events).join(monitored.select("asset_key", "kind"), "asset_key")


def once_per_run(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Each run key once.

    Without a watermark all run keys stay in state.  With one, keys older than
    the watermark are forgotten, which bounds the state; it must exceed the
    longest time between two reports of one run.
    """
    if watermark is None:
        return events.dropDuplicates(["run_key"])
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["run_key"])


def latest_runs(events: DataFrame) -> DataFrame:
    """The newest run per publish key."""
    return latest_record(events, ["publish_key"], ["ts", "run_id"])


def publish_stream(
    requests: DataFrame,
    publishers: dict[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    poll_seconds: int | None = None,
) -> StreamingQuery:
    """Route requests by kind to a batch writer.

    A writer may be called again with the same batch number after a failure and
    has to overwrite what it wrote for it.  Without ``poll_seconds`` the stream
    works off what is there and stops; the next start goes on behind it.
    """

    def route(batch: DataFrame, number: int) -> None:
        for kind, publish in publishers.items():
            publish(batch.filter(F.col("kind") == kind), number)

    writer = requests.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def batch_folder_writer(base: str) -> Callable[[DataFrame, int], None]:
    """Writer that keeps one folder per batch; writing a batch again replaces it."""

    def publish(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base.rstrip('/')}/batch={number}")

    return publish


def table_publisher(
    load: Callable[[str], DataFrame], base: str
) -> Callable[[DataFrame, int], None]:
    """Writer that loads the latest value of each requested asset and overwrites its folder.

    A batch names each asset once however often it was materialised.
    """

    def publish(batch: DataFrame, number: int) -> None:
        for row in batch.select("publish_key").distinct().toLocalIterator():
            target = f"{base.rstrip('/')}/{row['publish_key']}"
            load(row["publish_key"]).write.mode("overwrite").parquet(target)

    return publish


def new_keys(events: DataFrame) -> DataFrame:
    """Publish keys never seen before, for a stream or a batch."""
    return events.select("publish_key").dropDuplicates(["publish_key"])


def monitor_report(monitored: DataFrame, events: DataFrame) -> DataFrame:
    """Monitored assets with ``materialised`` or ``not yet``, and their last run."""
    last = events.groupBy("asset_key").agg(
        F.max_by("run_id", F.struct("ts", "run_id")).alias("last_run"),
        F.count(F.lit(1)).alias("n_events"),
    )
    return monitored.join(last, "asset_key", "left").select(
        "asset_key",
        F.when(F.col("n_events").isNotNull(), "materialised").otherwise("not yet").alias("status"),
        "last_run",
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
    )


def fan_in(df: DataFrame, partition: str, wanted: list[str] | None = None) -> DataFrame:
    """All partitions, or a chosen list; the filter prunes partition folders."""
    return df if wanted is None else df.filter(F.col(partition).isin(wanted))
