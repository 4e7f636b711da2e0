"""Zip archives: members, the one wanted, and fallbacks."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealis.functions.urls import double_dot_variant

MEMBER_SCHEMA = "archive string, member string, size bigint, content binary, problem string"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Landed zip files as ``(archive, content)``."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(F.col("path").alias("archive"), "content")
    )


_NAMES = ["archive", "member", "size", "content", "problem"]
_KINDS = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]

#: Bytes of rows handed on at once; a larger member is a batch of its own.
_CHUNK_BYTES = 4 * 1024 * 1024


def _members(with_content: bool):
    """Function for ``mapInArrow``: archives to members, one archive and few members at a time in memory."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES
        )

    def rows_of(archive: str | None, content: pa.Scalar) -> Iterator[tuple]:
        try:
            # the archive stays where Arrow has it
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer() or b"")) as z:
                for info in z.infolist():
                    if not info.is_dir():
                        data = z.read(info) if with_content else None
                        yield archive, info.filename, info.file_size, data, None
        except zipfile.BadZipFile:
            yield archive, None, None, None, "malformed"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for found in batches:
            for archive, content in zip(found.column(0), found.column(1), strict=True):
                for row in rows_of(archive.as_py(), content):
                    size = len(row[3] or b"") + 256
                    if rows and held + size > _CHUNK_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
                    rows.append(row)
                    held += size
        if rows:
            yield batch(rows)

    return read


def expand_archives(archives: DataFrame) -> DataFrame:
    """One row per member; a malformed archive gives one row with ``problem`` set.

    Each archive is opened once, whatever number of members is wanted from it.
    """
    return archives.select("archive", "content").mapInArrow(_members(True), MEMBER_SCHEMA)


def list_members(archives: DataFrame) -> DataFrame:
    """As :func:`expand_archives` from the directory of each archive only: nothing is unpacked."""
    return archives.select("archive", "content").mapInArrow(_members(False), MEMBER_SCHEMA).drop(
        "content"
    )


def pick_members(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """One member per ``(archive, wanted)`` row of ``wanted``.

    An archive with a single member gives that one; otherwise exactly one
    member has to end with ``wanted``, or be named so.  ``status`` is ``ok``,
    ``absent`` or ``malformed``.
    """
    listed = members.select("archive", "member", "problem")
    matched = wanted.select("archive", "wanted").distinct().join(listed, "archive", "left")
    ends = F.endswith(F.col("member"), F.col("wanted"))
    per = matched.groupBy("archive", "wanted").agg(
        F.count("member").alias("n_members"),
        F.count_if(ends).alias("n_ends"),
        F.min("member").alias("only"),
        F.min(F.when(ends, F.col("member"))).alias("ending"),
        F.max(F.when(F.col("member") == F.col("wanted"), F.col("member"))).alias("exact"),
        F.max("problem").alias("problem"),
    )
    member = (
        F.when(F.col("n_members") == 1, F.col("only"))
        .when(F.col("n_ends") == 1, F.col("ending"))
        .otherwise(F.col("exact"))
    )
    status = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(member.isNull(), "absent")
        .otherwise("ok")
    )
    return per.select("archive", "wanted", member.alias("member"), status.alias("status"))


def pick_members_with_fallback(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """As :func:`pick_members`, then the ``name..csv`` spelling, never an error.

    A zero-sized member counts as absent: the table is treated as empty.
    """
    listed = members.select("archive", "member", "size", "problem")
    matched = wanted.select("archive", "wanted").distinct().join(listed, "archive", "left")
    ends = F.endswith(F.col("member"), F.col("wanted"))
    slip = F.endswith(F.col("member"), double_dot_variant(F.col("wanted")))

    def one(flag: Column, what: str) -> list[Column]:
        return [
            F.count_if(flag).alias(f"n_{what}"),
            F.min(F.when(flag, F.struct("member", "size"))).alias(what),
        ]

    per = matched.groupBy("archive", "wanted").agg(
        F.count("member").alias("n_members"),
        F.min(F.when(F.col("member").isNotNull(), F.struct("member", "size"))).alias("only"),
        F.max("problem").alias("problem"),
        *one(ends, "ending"),
        *one(F.col("member") == F.col("wanted"), "exact"),
        *one(slip, "slip"),
    )
    chosen = (
        F.when(F.col("n_members") == 1, F.col("only"))
        .when(F.col("n_ending") == 1, F.col("ending"))
        .when(F.col("n_exact") > 0, F.col("exact"))
        .when(F.col("n_slip") == 1, F.col("slip"))
    )
    status = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.col("chosen").isNull(), "absent")
        .when(F.col("chosen.size") == 0, "empty")
        .otherwise("ok")
    )
    return per.withColumn("chosen", chosen).select(
        "archive", "wanted", F.col("chosen.member").alias("member"), status.alias("status")
    )


def table_members(members: DataFrame, index: DataFrame) -> DataFrame:
    """Members that are tables of the index; the table name is the file stem."""
    named = members.filter(~F.contains(F.lower("member"), F.lit("bulk_output"))).withColumn(
        "table_name", F.substring_index("member", ".csv", 1)
    )
    return named.join(index.select("table_name"), "table_name", "left_semi")


def member_lines(members: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Text lines of the members with their position, header line first."""
    text = F.decode("content", encoding)
    return members.select(
        "archive", "member", F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line")
    ).filter("line != ''")
