"""Landed archives made from the driver tables."""

from __future__ import annotations

import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from arealis.session import scratch_path
from arealis.sources import zips

_PACKED = "at bigint, path string, crc bigint, size bigint, packed_size bigint"


def crc32_joined(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, from both and the size of the second one."""

    def times(a: int, b: int) -> int:
        """Product of polynomials modulo that of CRC-32; the highest bit is the lowest power."""
        out = 0
        for k in range(31, -1, -1):
            if a >> k & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out

    shift, power, n = 1 << 31, 1 << 30, 8 * size
    while n:
        if n & 1:
            shift = times(shift, power)
        power = times(power, power)
        n >>= 1
    return times(shift, first) ^ second


def _packer(names: list[str], folder: str, base: str):
    """Deflates the files that rows number, each to a file that ends at a full byte and not the stream."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = zips._file_system(base)
        for at in (x for batch in batches for x in batch.column(0).to_pylist()):
            # a task that runs twice writes two files
            path = f"{folder}/{at}-{TaskContext.get().taskAttemptId()}"
            deflate = zlib.compressobj(wbits=-zlib.MAX_WBITS)
            crc = size = packed_size = 0
            with source.open_input_stream(names[at]) as part, source.open_output_stream(path) as out:
                while data := part.read(zips.CHUNK_BYTES):
                    crc, size = zlib.crc32(data, crc), size + len(data)
                    packed_size += out.write(deflate.compress(data))
                packed_size += out.write(deflate.flush(zlib.Z_SYNC_FLUSH))
            yield pa.RecordBatch.from_pylist(
                [{"at": at, "path": path, "crc": crc, "size": size, "packed_size": packed_size}]
            )

    return pack


def land_archive(lines: DataFrame, path: str, member: str) -> None:
    """Lines in the order of ``position`` as the member of a landed zip, next to one that is no table.

    Spark sorts, writes and deflates the lines, a task for each file; the driver streams the packed
    files one after another into the archive, which stands for the download.
    """
    spark = lines.sparkSession
    parts, folder = scratch_path(spark, "member"), scratch_path(spark, "packed")
    lines.orderBy("position").select("line").write.text(parts)
    system, inner = zips._file_system(path)
    source, listed = zips._file_system(parts)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    names = sorted(f.path for f in source.get_file_info(fs.FileSelector(listed)) if f.base_name.startswith("part-"))
    _, packed_folder = zips._file_system(folder)
    source.create_dir(packed_folder, recursive=True)
    numbers = spark.range(0, len(names), 1, max(len(names), 1))
    packed = sorted(numbers.mapInArrow(_packer(names, packed_folder, parts), _PACKED).collect())
    end = zlib.compressobj(wbits=-zlib.MAX_WBITS).flush()
    info = zipfile.ZipInfo(member)
    info.compress_type = zipfile.ZIP_DEFLATED
    info.compress_size = sum(p.packed_size for p in packed) + len(end)
    for p in packed:
        info.CRC = crc32_joined(getattr(info, "CRC", 0), p.crc, p.size)
        info.file_size += p.size
    with system.open_output_stream(inner) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        info.header_offset = z.fp.tell()
        z.fp.write(info.FileHeader())
        for p in packed:
            with source.open_input_stream(p.path) as part:
                while data := part.read(zips.CHUNK_BYTES):
                    z.fp.write(data)
        z.fp.write(end)
        z.filelist.append(info)
        z.NameToInfo[info.filename] = info
        z.writestr("bulk_output.txt", "all tables")
