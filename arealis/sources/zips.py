"""Zip archives as a Spark data source: one partition per member, content in chunks, and CSV records of them.

The driver reads only the directory at the end of each archive.  A task seeks to its member and unpacks
that one, a chunk at a time, so neither an archive nor a member is ever one value.  Filters on ``archive``
and ``member`` are pushed down: members that do not match are not opened.
"""

from __future__ import annotations

import codecs
import csv
import fnmatch
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES = 4 << 20
#: Small members that share a task have no more than this together.
TASK_BYTES = 64 << 20

SCHEMA = (
    "archive string, member string, size bigint, problem string, chunk bigint, offset bigint, content binary"
)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a path without a scheme is local or mounted."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _archives(path: str) -> list[str]:
    """Files that a path with wildcards in its last part names."""
    system, inner = _file_system(path)
    folder, _, pattern = inner.rpartition("/")
    if not any(c in pattern for c in "*?["):
        return [path]
    start = path[: len(path) - len(inner)]
    found = system.get_file_info(fs.FileSelector(folder or "/", allow_not_found=True))
    return sorted(start + f.path for f in found if f.is_file and fnmatch.fnmatch(f.base_name, pattern))


@dataclass
class Members(InputPartition):
    """Members of one archive that a task reads: (name, size)."""

    archive: str
    members: list[tuple[str, int]] = field(default_factory=list)
    problem: str | None = None


class _Reader(DataSourceReader):
    def __init__(self, path: str, content: bool, member: str | None) -> None:
        self.path, self.content, self.member = path, content, member

    def partitions(self) -> list[Members]:
        out = []
        for archive in _archives(self.path):
            system, inner = _file_system(archive)
            try:
                with system.open_input_file(inner) as file, zipfile.ZipFile(file) as z:
                    listed = [(i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
            except (zipfile.BadZipFile, pa.ArrowInvalid):
                out.append(Members(archive, problem="malformed"))
                continue
            part, held = Members(archive), 0
            for name, size in listed:
                if self.member is not None and name != self.member:
                    continue
                if part.members and self.content and held + size > TASK_BYTES:
                    out.append(part)
                    part, held = Members(archive), 0
                part.members.append((name, size))
                held += size
            if part.members:
                out.append(part)
        return out

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        if partition.problem is not None:
            yield _batch(partition.archive, None, None, partition.problem, None, None, None)
            return
        if not self.content:
            for name, size in partition.members:
                yield _batch(partition.archive, name, size, None, None, None, None)
            return
        system, inner = _file_system(partition.archive)
        with system.open_input_file(inner) as file, zipfile.ZipFile(file) as z:
            for name, size in partition.members:
                with z.open(name) as member:
                    at = number = 0
                    # an empty member is one empty chunk
                    while (data := member.read(CHUNK_BYTES)) or not number:
                        yield _batch(partition.archive, name, size, None, number, at, data)
                        at, number = at + len(data), number + 1


def _batch(*values) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names
    )


class ZipMembers(DataSource):
    """Options: ``path`` (wildcards in the last part), ``content`` (false lists only), ``member`` (its name).

    Which member is wanted is an option and no filter that Spark pushes down: Spark keeps the
    partitions of the first query on a frame, so a second one with another filter would read them again.
    """

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(
            self.options["path"], self.options.get("content", "true") == "true", self.options.get("member")
        )


def read_zip_members(
    spark: SparkSession, path: str, content: bool = True, member: str | None = None
) -> DataFrame:
    """Chunks of the members of landed archives, or their list without ``content``.

    A malformed archive is one row with ``problem`` set.  Given ``member``, others are not unpacked.
    """
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("content", str(content).lower())
    return (reader if member is None else reader.option("member", member)).load(path)


def _lines(chunks: Iterator[tuple[str, bytes]], encoding: str) -> Iterator[str]:
    """Lines, with their ends, of text that comes in chunks."""
    decoder = codecs.getincrementaldecoder(encoding)()
    rest = ""
    for data in chunks:
        # line feeds only: other line separators may be part of a field
        *whole, rest = (rest + decoder.decode(data)).split("\n")
        yield from (line + "\n" for line in whole)
    rest += decoder.decode(b"", final=True)
    if rest:
        yield rest


def _members_in(batches: Iterator[pa.RecordBatch]):
    """(archive, member, iterator of chunks) in the order they come; each iterator is used up first."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    held = next(rows, None)

    def chunks(key):
        nonlocal held
        while held is not None and held[:2] == key:
            yield held[2]
            held = next(rows, None)

    while held is not None:
        key = held[:2]
        yield *key, chunks(key)


def csv_records(members: DataFrame, encoding: str = "utf-8-sig") -> DataFrame:
    """Records of CSV members: (archive, member, record_no, fields, problem).

    Quoted fields may hold separators and line breaks, over chunks too.  Blank lines are no records.
    Text that cannot be decoded, or a quote that does not close, gives a row with ``problem`` and no fields
    in place of the rest of the member.  ``members`` has the chunks of :func:`read_zip_members`, which
    come in order because a member is read by one task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["archive", "member", "record_no", "fields", "problem"],
            )

        for archive, member, chunks in _members_in(batches):
            number = 0
            records = csv.reader(_lines(chunks, encoding), strict=True)
            while True:
                try:
                    fields = next(records, None)
                    row = (archive, member, number, fields, None)
                except (csv.Error, UnicodeDecodeError) as error:
                    fields = None
                    row = (archive, member, number, None, str(error))
                if fields is None and row[4] is None:
                    break
                if row[4] is not None or fields:
                    held.append(row)
                    size += sum(map(len, fields or ())) + 64
                    number += 1
                if size >= CHUNK_BYTES:
                    yield batch()
                    held, size = [], 0
                if row[4] is not None:
                    break
            for _ in chunks:  # what a problem left unread
                pass
        if held:
            yield batch()

    return (
        members.filter(F.col("content").isNotNull())
        .select("archive", "member", "content")
        .mapInArrow(
            read, "archive string, member string, record_no bigint, fields array<string>, problem string"
        )
    )


def record_table(records: DataFrame, names: list[str], type_of=None) -> DataFrame:
    """Records after the header as columns; what does not fit its type is null, as in a CSV scan.

    ``type_of`` gives a column's type by its name; text without it.  Missing fields at the end are null.
    An empty field is null.  Records that :func:`record_problems` lists are left out.
    """

    def column(place: int, name: str) -> Column:
        text = F.nullif(F.get("fields", F.lit(place)), F.lit(""))
        return (text if type_of is None else text.try_cast(type_of(name))).alias(name)

    body = records.filter((F.col("record_no") > 0) & (F.size("fields") <= len(names)))
    return body.select(*(column(k, n) for k, n in enumerate(names)))


def record_problems(records: DataFrame) -> DataFrame:
    """(archive, member, n_records, n_malformed): records with more fields than the header, and unreadable ones."""
    header = records.filter("record_no = 0").select(
        "archive", "member", F.size("fields").alias("n_names")
    )
    wrong = F.col("problem").isNotNull() | (F.size("fields") > F.col("n_names"))
    return (
        records.filter("record_no > 0 or problem is not null")
        .join(header, ["archive", "member"], "left")
        .groupBy("archive", "member")
        .agg(F.count("*").alias("n_records"), F.count_if(wrong).alias("n_malformed"))
    )
