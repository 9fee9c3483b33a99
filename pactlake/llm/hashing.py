"""Words and their hashes for whole Arrow batches of texts, in numpy, without a Python loop over words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (9, 10, 11, 12, 13, 32)
U64 = np.uint64
#: Bytes up to which a span is hashed in numpy, eight at a time; longer ones are few and go through BLAKE2.
_SHORT = 64
#: Bytes of text that a step of an operator takes at a time.
PART_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x.astype(U64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array end to end, and the offset of each text; a null is an empty text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(batch: pa.RecordBatch, column: int, rows: int, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `rows` rows and, where there is more than one row, `size` bytes of that text column.
    What a step holds is a multiple of the bytes, so long texts come in slices of few."""
    upto = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        before = upto[begin - 1] if begin else 0
        end = int(np.searchsorted(upto, before + size, side="right"))
        end = min(max(end, begin + 1), begin + rows, batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; no byte of a longer UTF-8 character is one of them."""
    return _LOWER[data]


def blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes are one of `SPACES`."""
    return _SPACE[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of bytes outside `SPACES`, and for each text the index of its first word
    (one entry more than texts). A word never crosses the end of its text."""
    blank = _SPACE[data]
    first = ~blank
    first[1:] &= blank[:-1]
    last = ~blank
    last[:-1] &= blank[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = ~blank[inner]
    last[inner - 1] = ~blank[inner - 1]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal spans, equal hash. Eight bytes at a time go through `mix`, one step
    after the other, so spans of one length up to eight never share a hash and others by chance alone."""
    sizes = ends - begins
    out = mix(sizes.astype(U64) + U64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    rest = np.flatnonzero((sizes > 0) & (sizes <= _SHORT))
    at, left = begins[rest], sizes[rest]
    while len(rest):
        block = eight[at]
        ragged = left < 8
        block[ragged] &= (U64(1) << (U64(8) * left[ragged].astype(U64))) - U64(1)
        out[rest] = mix(out[rest] ^ block)
        more = left > 8
        rest, at, left = rest[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > _SHORT).tolist():
        long = hashlib.blake2b(data[begins[i] : ends[i]], digest_size=8, salt=seed.to_bytes(8, "little")).digest()
        out[i] = int.from_bytes(long, "little")
    return out


def shingles(hashes: np.ndarray, firsts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """For all texts end to end the hash of each window of `size` words, the whole text where it has fewer words
    and none where it has no word; and the offsets of each text's windows."""
    lengths = np.diff(firsts)
    counts = np.where(lengths >= size, lengths - size + 1, (lengths > 0).astype(np.int64))
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=starts[1:])
    where = np.repeat(firsts[:-1] - starts[:-1], counts) + np.arange(starts[-1])
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    width = np.repeat(np.minimum(lengths, size), counts)
    out = np.zeros(len(where), U64)
    for i in range(size):
        out = np.where(i < width, mix(out + padded[where + i] + U64(i + 1)), out)
    return out, starts


def distinct(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each text sorted and without repeats, and their offsets."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    out = np.zeros(len(starts), np.int64)
    np.cumsum(np.bincount(owner[keep], minlength=len(starts) - 1), out=out[1:])
    return values[keep], out


def shingle_sets(texts: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The set of word shingles of each text, A-Z in lower case, as sorted hashes, and their offsets."""
    data, offsets = utf8(texts)
    data = lower(data)
    begins, ends, firsts = words(data, offsets)
    return distinct(*shingles(span_hashes(data, begins, ends), firsts, size))
