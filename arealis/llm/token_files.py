"""Token ids in Arrow files with fixed-size lists.

Each file holds record batches of three columns, ``ids``, ``mask`` and ``last``, all fixed-size lists of
one length, so sequence i of a file is a slice of their buffers: with a memory-mapped file nothing is
copied.  Ids take two bytes where the vocabulary allows it, the other two are bits: ``mask`` is false in
the padding behind the last document, ``last`` is true at the token that ends a document.  The schema's
metadata holds the ids of the file's documents in order.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import stored, text_bytes
from arealis.llm.tokens import default_vocabulary, encoded, encoder
from arealis.session import scratch_path

SEQUENCE = 2048
END_ID = 0
#: Tokens after which a writer goes on with another file; a longer document is a file of its own.
FILE_TOKENS = 1 << 22
#: Sequences in a record batch.
BATCH_ROWS = 256
_NULL_ID = np.iinfo(np.int64).min


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pafs.LocalFileSystem(),
        path,
    )


def write_file(
    path: str, doc_ids: list[int | None], docs: list[np.ndarray], length: int, kind=np.uint32
) -> None:
    """One file from the ids of whole documents; visible under its name only when complete."""
    total = sum(map(len, docs))
    rows = -(-total // length)
    ids, mask, last = (np.zeros(rows * length, k) for k in (kind, bool, bool))
    ids[:total] = np.concatenate(docs)
    mask[:total] = True
    last[np.cumsum([len(d) for d in docs]) - 1] = True
    names = np.array([_NULL_ID if x is None else x for x in doc_ids], "<i8").tobytes()
    schema = pa.schema(
        [
            ("ids", pa.list_(pa.from_numpy_dtype(kind), length)),
            ("mask", pa.list_(pa.bool_(), length)),
            ("last", pa.list_(pa.bool_(), length)),
        ],
        metadata={"doc_ids": names},
    )
    columns = [
        pa.FixedSizeListArray.from_arrays(pa.array(values), length) for values in (ids, mask, last)
    ]
    system, name = opened(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    attempt = TaskContext.get()
    draft = f"{name}.{attempt.taskAttemptId() if attempt else 0}.tmp"
    with system.open_output_stream(draft) as sink, ipc.new_file(sink, schema) as writer:
        writer.write_table(pa.Table.from_arrays(columns, schema=schema), max_chunksize=BATCH_ROWS)
    system.move(draft, name)


def read_file(path: str) -> tuple[list[int | None], list[np.ndarray]]:
    """Document ids, and the token ids of every document."""
    system, name = opened(path)
    local = isinstance(system, pafs.LocalFileSystem)
    with pa.memory_map(name) if local else system.open_input_file(name) as source:
        reader = ipc.open_file(source)
        names = np.frombuffer(reader.schema.metadata[b"doc_ids"], "<i8").tolist()
        held = reader.read_all()
        ids, last = (
            np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in held.column(x).chunks])
            for x in ("ids", "last")
        )
    ends = np.flatnonzero(last) + 1
    return (
        [None if x == _NULL_ID else x for x in names],
        [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)],
    )


def read_sequence(path: str, index: int) -> tuple[pa.Array, pa.Array]:
    """One sequence and its mask, found by position alone, as views of the file."""
    system, name = opened(path)
    local = isinstance(system, pafs.LocalFileSystem)
    source = pa.memory_map(name) if local else system.open_input_file(name)
    batch = ipc.open_file(source).get_batch(index // BATCH_ROWS)
    at = index % BATCH_ROWS
    return tuple(batch.column(i)[at].values for i in (0, 1))


def _writer(folder: str, vocabulary: str, end_id: int, length: int, file_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, files, held, names, size = TaskContext.get().partitionId(), 0, [], [], 0
        done: list[tuple[str, int, int, int]] = []

        def close() -> None:
            nonlocal files, held, names, size
            if held:
                path = f"{folder}/part-{part:06d}-{files:06d}.arrow"
                write_file(path, names, held, length, kind)
                done.append((path, part, files, size))
            files, held, names, size = files + 1, [], [], 0

        end = np.array([end_id], np.uint32)
        kind = np.uint16 if max(end_id, len(encoder(vocabulary).widths) - 1) < 1 << 16 else np.uint32
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for name, ids in zip(batch.column(0).to_pylist(), encoded(vocabulary, texts), strict=True):
                if held and size + len(ids) + 1 > file_tokens:
                    close()
                held.append(np.concatenate([ids, end]))
                names.append(name)
                size += len(ids) + 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*done, strict=True)], names=["path", "part", "file", "tokens"]
            )

    return write


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    length: int = SEQUENCE,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode all texts in ascending doc_id order into files of ``folder``; returns their list.

    Columns: path, part, file, tokens and start, the number of ids in all files before it.  Null
    text counts as empty and gives the end id alone; null doc_ids come first; rows of one doc_id stand
    in the order of their texts.  A file's name depends on its range of documents only, so a task that
    runs again replaces it by the same bytes.  Without rows there are no files.
    """
    files = stored(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(
            _writer(folder, vocabulary or default_vocabulary(), end_id, length, file_tokens),
            "path string, part long, file long, tokens long",
        ),
        "token-files",
    )
    # A few numbers for each file of millions of tokens.
    spark, start, rows = docs.sparkSession, 0, []
    for x in files.orderBy("part", "file").toLocalIterator():
        rows.append((x.path, x.part, x.file, x.tokens, start))
        start += x.tokens
    return spark.createDataFrame(rows, "path string, part long, file long, tokens long, start long")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
            names, docs = read_file(path)
            sizes = np.array([len(x) for x in docs], np.int64)
            sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in docs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array(np.cumsum(sizes) - sizes + start, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the listed files."""
    return (
        files.select("path", "start")
        .repartition("path")
        .mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_documents(docs: DataFrame, **options) -> DataFrame:
    """Write token files to the shared folder and describe the documents read back from them."""
    folder = scratch_path(docs.sparkSession, "token-arrow")
    return read_documents(write_token_files(docs, folder, **options))
