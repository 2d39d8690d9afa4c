"""Words of whole Arrow columns as numpy arrays, without a Python object per word.

A 256-entry byte table says what every byte is: the byte it stands for inside a
word, ``SPACE`` between words, or ``BREAK`` (a space that also ends a piece).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SPACE, BREAK = -1, -2
#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 4 << 20
_WHITE = (0x20, *range(0x09, 0x0E))


def byte_table(spaces: Iterable[int] = _WHITE, breaks: Iterable[int] = (),
               lower: bool = True) -> np.ndarray:
    """A-Z lower-cased if asked for; every other byte stands for itself."""
    table = np.arange(256, dtype=np.int16)
    if lower:
        table[0x41:0x5B] += 32
    table[list(spaces)] = SPACE
    table[list(breaks)] = BREAK
    return table


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8)
    return body, at - at[0]


def slices(batch: pa.RecordBatch, column: int = 0, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths.astype(np.int64)) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


class Words(NamedTuple):
    ids: np.ndarray       # per word, its place in ``distinct``
    text: np.ndarray      # per word, the text it stands in
    piece: np.ndarray     # per word, a number shared by the words of one piece
    sizes: np.ndarray     # words per text
    distinct: pa.Array    # the distinct words, binary


class Bounds(NamedTuple):
    kinds: np.ndarray     # per byte, what it stands for
    starts: np.ndarray    # per word, its first byte
    ends: np.ndarray      # per word, past its last byte
    sizes: np.ndarray     # words per text
    text: np.ndarray      # per word, the text it stands in


def bounds_of(texts: pa.Array, table: np.ndarray) -> Bounds:
    data, offsets = utf8(texts)
    kinds = table[data]
    inside = kinds >= 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]  # a text's ends also end its words
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[firsts], stops[lasts] = inside[firsts], inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sizes = np.diff(np.searchsorted(starts, offsets))
    return Bounds(kinds, starts, ends, sizes, np.repeat(np.arange(len(sizes)), sizes))


def words_of(texts: pa.Array, table: np.ndarray) -> Words:
    kinds, starts, ends, sizes, text = bounds_of(texts, table)
    kept = kinds[kinds >= 0].astype(np.uint8)
    ends = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    coded = found.dictionary_encode()
    piece = np.cumsum(kinds == BREAK)[starts] + text if len(starts) else text
    return Words(coded.indices.to_numpy().astype(np.int64), text, piece, sizes,
                 coded.dictionary)


_MULTIPLY = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_LONG_WORD = 256  # bytes; longer words are hashed one by one
_HEADS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    for m in _MULTIPLY:
        h = (h ^ (h >> np.uint64(33))) * m
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash of every word, its text, words per text), eight bytes of all words at once."""
    kinds, starts, ends, sizes, text = bounds_of(texts, table)
    raw = np.append(kinds, np.zeros(8, kinds.dtype)).astype(np.uint8)
    length = ends - starts
    hashes = _mixed(length.astype(np.uint64) + np.uint64(1))
    for at in range(0, min(_LONG_WORD, int(length.max(initial=0))), 8):
        more = np.flatnonzero((length > at) & (length <= _LONG_WORD)) if at else np.flatnonzero(length <= _LONG_WORD)
        some = raw[(starts[more] + at)[:, None] + np.arange(8)].view("<u8").ravel()
        some &= _HEADS[np.minimum(length[more] - at, 8)]
        hashes[more] = _mixed(hashes[more] ^ some)
    for i in np.flatnonzero(length > _LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]].tobytes())
    return hashes, text, sizes
