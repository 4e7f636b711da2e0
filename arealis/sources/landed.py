"""Integrity of landed files and lists of known datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.ids import file_hash
from arealis.functions.text import slug


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size, modification time and SHA-256 of landed files."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            "path",
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
            file_hash(F.col("content")).alias("sha256"),
        )
    )


def integrity(files: DataFrame, manifest: DataFrame, now: Column | None = None) -> DataFrame:
    """Compare files with a manifest ``(path, expected_sha256, expected_size, refresh_days)``.

    ``status`` is ``missing``, ``corrupt``, ``wrong size``, ``stale`` or ``ok``;
    an expectation left null is not checked.
    """
    clock = F.current_timestamp() if now is None else now
    age_days = F.date_diff(clock.cast("date"), F.col("modified").cast("date"))
    status = (
        F.when(F.col("sha256").isNull(), "missing")
        .when(F.col("sha256") != F.col("expected_sha256"), "corrupt")
        .when(F.col("size") != F.col("expected_size"), "wrong size")
        .when(age_days > F.col("refresh_days"), "stale")
        .otherwise("ok")
    )
    return manifest.join(files, "path", "left").withColumn("status", status)


def with_dataset_name(datasets: DataFrame, description: str = "description") -> DataFrame:
    """Add the slug a dataset is picked by."""
    return datasets.withColumn("name", slug(F.col(description)))


def dataset_by_name(datasets: DataFrame, name: str) -> DataFrame:
    return with_dataset_name(datasets).filter(F.col("name") == name)
