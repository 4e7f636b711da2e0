"""Token ids of whole texts with a given byte-level vocabulary file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from arealis.llm.common import BLOCK_BYTES, blocks, span_hashes

#: Bytes of pieces, hashes and ids that a worker remembers before it starts anew.
REMEMBERED = 64 << 20
#: Pieces that are encoded in one call.
CALL = 64

_encoders: dict[str, Encoder] = {}


def default_vocabulary() -> str:
    """The byte-level BPE file of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ends_in_print(data: np.ndarray) -> np.ndarray:
    """Whether the character that ends at a byte is surely no white space."""
    out = (data > 0x20) & (data != 0x7F)
    high = np.flatnonzero(data >= 0x80)
    before = data[np.maximum(high - 1, 0)]
    first = data[np.maximum(high - 2, 0)]
    # The lead bytes of all white space beyond ASCII.
    out[high] = (before != 0xC2) & ~np.isin(first, (0xE1, 0xE2, 0xE3))
    return out


def _equal(
    data: np.ndarray, start: np.ndarray, size: np.ndarray,
    other: np.ndarray, begin: np.ndarray, length: np.ndarray,
) -> np.ndarray:
    """Whether ranges of two arrays of bytes, none of them empty, are the same."""
    out = size == length
    rows = np.flatnonzero(out)
    if len(rows):
        n = size[rows].astype(np.int64)
        first = np.cumsum(n) - n
        step = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        same = data[np.repeat(start[rows], n) + step] == other[np.repeat(begin[rows], n) + step]
        out[rows] = np.logical_and.reduceat(same, first)
    return out


class Encoder:
    """Byte-level BPE, one distinct piece at a time.

    The vocabulary's pattern never joins text across a space that follows a character other than
    white space.  Between such spaces lie the pieces; those that a worker has met are looked up, the others
    are encoded by the tokenizers library.  A 64-bit hash brings equal pieces together, and bytes are
    compared before a piece stands for another one; what only shares the hash is encoded by itself.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.widths = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.widths[i] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        #: where a piece's ids begin and how many there are, where its bytes begin and how many
        self.places = np.empty((0, 4), np.int32)
        self.ids = np.empty(0, np.uint32)
        self.bytes = np.empty(0, np.uint8)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], joinable: np.ndarray) -> None:
        """Add pieces; joinable ones are encoded many in a call and parted by their byte counts."""
        order = np.argsort(~joinable, kind="stable")
        n = int(joinable.sum())
        groups = [order[a : min(a + CALL, n)] for a in range(0, n, CALL)]
        groups += [order[a : a + 1] for a in range(n, len(order))]
        found = self._encode([b"".join(pieces[i] for i in g).decode() for g in groups])
        counts = np.empty(len(pieces), np.int64)
        for g, ids in zip(groups, found, strict=True):
            ends = np.searchsorted(
                np.cumsum(self.widths[ids]), np.cumsum([len(pieces[i]) for i in g]), side="right"
            )
            counts[g] = np.diff(np.concatenate([[0], ends])) if len(g) > 1 else len(ids)
        starts = np.empty(len(pieces), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order] + len(self.ids)
        sizes = np.array([len(p) for p in pieces])
        places = np.stack([starts, counts, np.cumsum(sizes) - sizes + len(self.bytes), sizes], 1)
        self.ids = np.concatenate([self.ids, *found])
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(pieces), np.uint8)])
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.places = np.insert(self.places, at, places.astype(np.int32), axis=0)

    def _full(self) -> bool:
        held = (self.hashes, self.places, self.ids, self.bytes)
        return sum(x.nbytes for x in held) > REMEMBERED

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return [np.empty(0, np.uint32) for _ in texts]
        offsets = np.cumsum([0, *map(len, texts)])
        closing = _ends_in_print(data)
        begins = data == 0x20
        begins[0] = True
        begins[1:] &= closing[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        size = ends - starts
        found, first, which = np.unique(
            span_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        # pieces that differ from the first one with their hash
        odd = np.flatnonzero(~_equal(data, starts, size, data, starts[first][which], size[first][which]))
        if self._full():
            self._forget()
        at = np.minimum(np.searchsorted(self.hashes, found), max(0, len(self.hashes) - 1))
        seen = self.hashes[at] == found if len(self.hashes) else np.zeros(len(found), bool)
        new = np.flatnonzero(~seen)
        old = np.flatnonzero(seen)
        _, _, begin, length = self.places[at[old]].T
        other = old[~_equal(data, starts[first[old]], size[first[old]], self.bytes, begin, length)]
        if len(other):
            odd = np.union1d(odd, np.flatnonzero(np.isin(which, other)))
        raw = data.tobytes()
        if len(new):
            a, b = starts[first[new]], ends[first[new]]
            pieces = [raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
            self._learn(found[new], pieces, (data[a] == 0x20) & closing[b - 1])
        places = self.places[np.searchsorted(self.hashes, found)][which].astype(np.int64)
        begin, counts, known = places[:, 0], places[:, 1], self.ids
        if len(odd):
            apart = [self._encode([raw[starts[i] : ends[i]].decode()])[0] for i in odd.tolist()]
            counts[odd] = [len(x) for x in apart]
            begin[odd] = len(known) + np.cumsum(counts[odd]) - counts[odd]
            known = np.concatenate([known, *apart])
        last = np.cumsum(counts)
        ids = known[np.repeat(begin - last + counts, counts) + np.arange(last[-1])]
        cuts = np.append(0, last)[np.searchsorted(starts, offsets)]
        return [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(path: str, texts: list[bytes]) -> Iterator[np.ndarray]:
    """Ids of UTF-8 texts, in turn."""
    found = encoder(path)
    for a, b in blocks([len(x) for x in texts], BLOCK_BYTES):
        yield from found.encode(texts[a:b])
