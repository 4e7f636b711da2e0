"""Secrets: fixed patterns, and character Markov models of random strings and ordinary identifiers.

The patterns label strings as random, all shorter strings of the same characters are ordinary; seeded draws
over the usual alphabets of keys are random as well, since the patterns see only some of them.  Both kinds
train a second-order Markov model over all documents: counts of (two characters, next character), each
order smoothed towards the one below it.  A long string outside the patterns' spans is a secret if its
log-likelihood ratio, random against ordinary, is high enough.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import BLOCK_BYTES, blocks, stored

# The patterns, and the least size of what counts (group 2 of the first, else the match).
PATTERNS = (
    (
        "assign",
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        8,
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = tuple(name for name, *_ in PATTERNS)
#: Kind of the spans that the models add.
RANDOM = "random"
#: Characters that the models know, and those that join parts of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
JOINTS = "+/_-"
#: Fewest characters of a string that the models may call a secret, and fewest different ones.
LEAST = 16
DIFFERENT = 8
#: Alphabets of drawn random strings, characters drawn from each, and the seed.
DRAWN_FROM = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    ALPHABET,
    ALPHABET + "+/",
    ALPHABET + "_-",
)
DRAWN = 200_000
SEED = 7
#: Natural logarithm of the likelihood ratio from which on a string is a secret.
RATIO = 24.0
#: Weight, in counts, of the lower order in a context.
BACKOFF = 8.0

_N = len(ALPHABET) + 1
CELLS = _N**3
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(ALPHABET.encode())] = np.arange(1, _N)
_IN_RUN = _SYMBOL > 0
_IN_RUN[list(JOINTS.encode())] = True
_UPPER, _LOWER = _SYMBOL[[ord("Z"), ord("z")]]
# A shorter run cannot pass, and longest runs start where any match would: the outcome is the same.
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")


def pattern_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, place of the kind, value) of what the patterns find, in code points, in order."""
    found = []
    for place, (name, pattern, group, least) in enumerate(PATTERNS):
        pattern = _LONG_HEX if name == "hex" else pattern
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), m.end(), place, m.group(group)))
    return sorted(found)


def transitions(data: bytes) -> np.ndarray:
    """Cell of (two characters before, character) for each character of the alphabet.

    A part of a string begins after any other byte, and where a capital follows a small letter; what
    lies before its beginning is not seen.
    """
    symbol = np.zeros(len(data) + 2, np.int64)
    symbol[2:] = _SYMBOL[np.frombuffer(data, np.uint8)] if data else 0
    small = (symbol > _UPPER) & (symbol <= _LOWER)
    begins = np.ones(len(symbol), bool)
    begins[1:] = (symbol[:-1] == 0) | (small[:-1] & (symbol[1:] > 0) & (symbol[1:] <= _UPPER))
    at = np.flatnonzero(symbol)
    one = np.where(begins[at], 0, symbol[at - 1])
    two = np.where(begins[at] | begins[at - 1], 0, symbol[at - 2])
    return (two * _N + one) * _N + symbol[at]


def log_ratio(random: np.ndarray, ordinary: np.ndarray, backoff: float = BACKOFF) -> np.ndarray:
    """Per cell the log of the chance under the model of random strings over that of ordinary ones."""

    def chances(counts: np.ndarray) -> np.ndarray:
        second = counts.reshape(_N, _N, _N).astype(float)
        first = second.sum(axis=0)
        single = first.sum(axis=0)
        lowest = (single + 1) / (single.sum() + _N - 1)
        lower = (first + backoff * lowest) / (first.sum(axis=1, keepdims=True) + backoff)
        return (second + backoff * lower) / (second.sum(axis=2, keepdims=True) + backoff)

    return np.log(chances(random) / chances(ordinary)).ravel()


def drawn_counts(size: int = DRAWN, seed: int = SEED) -> np.ndarray:
    """Counts of seeded even draws over the alphabets of keys."""
    draw = np.random.default_rng(seed)
    out = np.zeros(CELLS, np.int64)
    for letters in DRAWN_FROM:
        picked = np.frombuffer(letters.encode(), np.uint8)[draw.integers(0, len(letters), size)]
        out += np.bincount(transitions(picked.tobytes()), minlength=CELLS)
    return out


def _long_runs(data: bytes, least: int) -> Iterator[tuple[int, int]]:
    if not data:
        return iter(())
    held = np.concatenate([[0], _IN_RUN[np.frombuffer(data, np.uint8)], [0]]).astype(np.int8)
    step = np.diff(held)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = ends - starts >= least
    return zip(starts[long].tolist(), ends[long].tolist(), strict=True)


def _strings(text: str, spans: list[tuple[int, int, int, str]], least: int) -> list[dict]:
    """Long strings with letters that touch no span, with their place in code points."""
    data = text.encode()
    out, seen, points = [], 0, 0
    for a, b in _long_runs(data, least):
        points += len(data[seen:a].decode())
        seen = a
        held = set(data[a:b])
        if len(held) >= DIFFERENT and any(c >= ord("A") and c != ord("_") for c in held):
            out.append({"start": points, "text": data[a:b].decode()})
    if not spans:
        return out
    return [
        s for s in out if not any(a < s["start"] + len(s["text"]) and s["start"] < b for a, b, *_ in spans)
    ]


def _ordinary(text: str, spans: list[tuple[int, int, int, str]], least: int) -> bytes:
    """The text with blanks for spans and long strings: no candidate teaches what it is judged by."""
    pieces, end = [], 0
    for a, b, *_ in spans:
        pieces.append(text[end : max(a, end)])
        end = max(end, b)
    data = bytearray(" ".join([*pieces, text[end:]]).encode())
    for a, b in _long_runs(bytes(data), least):
        data[a:b] = b" " * (b - a)
    return bytes(data)


_SPAN = pa.struct([("place", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_STRING = pa.struct([("start", pa.int64()), ("text", pa.string())])
_COUNT = pa.struct([("cell", pa.int64()), ("random", pa.int64()), ("ordinary", pa.int64())])


class _Counts:
    def __init__(self) -> None:
        self.held = np.zeros((2, CELLS), np.int64)

    def add(self, random: bool, data: bytes) -> None:
        cells = transitions(data)
        if len(cells) > CELLS // 8:
            self.held[int(random)] += np.bincount(cells, minlength=CELLS)
        else:
            np.add.at(self.held[int(random)], cells, 1)

    def rows(self) -> list[dict]:
        cells = np.flatnonzero(self.held.any(axis=0))
        return [
            {"cell": c, "random": r, "ordinary": o}
            for c, r, o in zip(cells.tolist(), self.held[1, cells].tolist(), self.held[0, cells].tolist(), strict=True)
        ]


def _scanner(least: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in blocks([len(t) for t in texts], BLOCK_BYTES):
                spans = [pattern_spans(t) for t in texts[a:b]]
                strings = [_strings(t, s, least) for t, s in zip(texts[a:b], spans, strict=True)]
                rest = (_ordinary(t, s, least) for t, s in zip(texts[a:b], spans, strict=True))
                counts.add(False, b" ".join(rest))
                counts.add(True, " ".join(s[3] for found in spans for s in found).encode())
                found = [[{"place": p, "start": i, "end": j} for i, j, p, _ in s] for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(b - a, np.int32)),
                        batch.column(0).slice(a, b - a),
                        pa.array(found, pa.list_(_SPAN)),
                        pa.array(strings, pa.list_(_STRING)),
                        pa.nulls(b - a, pa.list_(_COUNT)),
                    ],
                    names=["part", "doc_id", "spans", "strings", "counts"],
                )
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([1], pa.int32()),
                    pa.nulls(1, kind),
                    pa.nulls(1, pa.list_(_SPAN)),
                    pa.nulls(1, pa.list_(_STRING)),
                    pa.array([counts.rows()], pa.list_(_COUNT)),
                ],
                names=["part", "doc_id", "spans", "strings", "counts"],
            )

    return scan


def _sample_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for text, random in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if text is not None and random is not None:
                counts.add(random, text.encode())
    rows = counts.rows()
    yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_COUNT)))


def found_secrets(
    docs: DataFrame, samples: DataFrame | None = None, least: int = LEAST, ratio: float = RATIO
) -> DataFrame:
    """doc_id and its spans (kind, start, end, score) by start, then kind, of every row of ``docs``.

    Places are code points, the end is exclusive, the score is the log-likelihood ratio and null for the
    patterns' spans.  Null counts as empty and has no spans.  The models learn from all texts:
    what the patterns found is random, other strings too short to be candidates are ordinary; ``samples`` (text, random boolean)
    adds labelled strings.  Strings that touch a pattern's span, have
    fewer than DIFFERENT characters or no letter are no candidates.  Rows may repeat; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = stored(
        docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
            _scanner(least),
            f"part int, doc_id {kind}, spans array<struct<place:int,start:bigint,end:bigint>>, "
            "strings array<struct<start:bigint,text:string>>, "
            "counts array<struct<cell:bigint,random:bigint,ordinary:bigint>>",
        ),
        "secrets",
        ["part"],
    )
    counts = scanned.where("part = 1").select(F.inline("counts"))
    if samples is not None:
        counts = counts.unionByName(
            samples.select("text", "random").mapInArrow(_sample_counter, "cell long, random long, ordinary long")
        )
    random, ordinary = drawn_counts(), np.zeros(CELLS, np.int64)
    # at most one row per cell, however many documents
    for r in counts.groupBy("cell").agg(F.sum("random").alias("r"), F.sum("ordinary").alias("o")).collect():
        random[r.cell] += r.r
        ordinary[r.cell] = r.o
    model = docs.sparkSession.sparkContext.broadcast(log_ratio(random, ordinary))  # CELLS numbers
    names = (*KINDS, RANDOM)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans, strings in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows = [(s["start"], s["place"], s["end"], None) for s in spans]
                for s in strings:
                    cells = transitions(s["text"].encode())
                    value = float(model.value[cells].sum())
                    if value >= ratio:
                        rows.append((s["start"], len(KINDS), s["start"] + len(s["text"]), value))
                rows.sort(key=lambda r: r[:2])
                out.append([{"kind": names[p], "start": a, "end": b, "score": v} for a, p, b, v in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(
                        out,
                        pa.list_(
                            pa.struct(
                                [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
                            )
                        ),
                    ),
                ],
                names=["doc_id", "spans"],
            )

    return (
        scanned.where("part = 0")
        .select("doc_id", "spans", "strings")
        .mapInArrow(
            score, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
        )
    )


def secret_digests(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: numbers of the patterns' spans, their digest, and all spans as text."""

    def written(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def number(kind):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = F.col("spans")
    base = F.filter(found, lambda s: s["kind"] != RANDOM)
    return found_secrets(docs).select(
        "doc_id",
        *map(number, KINDS),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(found).alias("spans"),
    )
