"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators rely on.  None of them fixes a partition count:
#: adaptive execution sizes shuffles from what the map stage really wrote.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "arealis",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults above; ``master`` is left to spark-submit if unset."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting gets a temporary folder; anywhere else a missing
    setting is an error, because a machine-local folder does not survive the
    loss of the machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="arealis-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one written table or stream."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: its lineage ends there.

    Unlike ``checkpoint()`` this computes the table once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_packages(spark: SparkSession, folder: str | Path, packages: list[str]) -> None:
    """Send pure-Python packages to the executors, once per Spark context.

    Needed where they are not installed there, because the Arrow functions in
    tasks import them.  Spark distributes the archive itself.
    """
    context = spark.sparkContext
    if getattr(context, "_arealis_shipped", False):
        return
    staging = Path(tempfile.mkdtemp(prefix="arealis-code-"))
    for name in packages:
        shutil.copytree(
            Path(folder) / name, staging / "code" / name, ignore=shutil.ignore_patterns("__pycache__")
        )
    context.addPyFile(shutil.make_archive(str(staging / "arealis-code"), "zip", staging / "code"))
    context._arealis_shipped = True
