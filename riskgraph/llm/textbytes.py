"""Words and shingles of Arrow string batches, vectorised over UTF-8 bytes.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 never
uses those bytes inside a longer character, so byte runs and character runs
agree.  Hashes are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from riskgraph.llm.common import ship

ship(__name__)

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CHUNK = 1 << 19  # bytes hashed at once; bounds the work arrays


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising permutation of 64-bit values (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    n, first = len(column), column.offset
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[first:first + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    if column.null_count:
        starts, ends = offsets[:-1], np.where(np.asarray(column.is_null()), offsets[:-1], offsets[1:])
        if (ends != offsets[1:]).any():  # a null slot that still holds bytes
            parts = [data[a:b] for a, b in zip(starts, ends, strict=True)]
            data = np.concatenate(parts) if parts else data[:0]
            offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    return data, offsets


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_bounds(sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of non-separators."""
    inside = np.concatenate([[False], ~sep, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE, np.uint64))])


def _inverse(b: np.uint64) -> np.uint64:
    return np.uint64(pow(int(b), -1, 1 << 64))


def _inverse_powers(n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _inverse(BASE), np.uint64))])


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, n) + 1
    if size not in _TABLES:
        made = _powers(size), _inverse_powers(size)
        if size > CHUNK + 1:
            return made  # an outsized word; not kept
        _TABLES[size] = made
    return _TABLES[size]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run [start, end): a polynomial over the bytes,
    read off prefix sums, then mixed."""
    powers, inverse = _tables(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=prefix[1:])
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts])


def word_hashes(data: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hashes of one text's words, in order, in bounded chunks; ``fold``
    lower-cases A-Z."""
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK)
        if end < len(data):  # move the cut to a separator
            part = spaces(data[at:end])
            last = np.flatnonzero(part)
            if len(last):
                end = at + int(last[-1]) + 1
            else:
                rest = np.flatnonzero(spaces(data[end:]))
                end = end + int(rest[0]) if len(rest) else len(data)
        piece = lowered(data[at:end]) if fold else data[at:end]
        s, e = word_bounds(spaces(piece))
        out.append(run_hashes(piece, s, e))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def doc_words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) for every row; short rows are hashed together."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1
        if to <= at:  # one text longer than a chunk
            yield at, word_hashes(data[offsets[at]:offsets[at + 1]], fold)
            at += 1
            continue
        lo, hi = offsets[at], offsets[to]
        piece = lowered(data[lo:hi]) if fold else data[lo:hi]
        cut = offsets[at:to + 1] - lo
        sep = spaces(piece)
        inside = np.concatenate([[False], ~sep, [False]])
        begin = ~inside[:-1] & inside[1:]
        finish = inside[1:] & ~np.concatenate([inside[2:], [False]])
        edges = cut[(cut > 0) & (cut < len(piece))]  # a text's end always ends a word
        begin[edges[inside[edges + 1]]] = True
        finish[(edges - 1)[inside[edges]]] = True
        s, e = np.flatnonzero(begin[:len(piece)]), np.flatnonzero(finish[:len(piece)]) + 1
        hashes = run_hashes(piece, s, e)
        bounds = np.searchsorted(s, cut)
        for k in range(to - at):
            yield at + k, hashes[bounds[k]:bounds[k + 1]]
        at = to


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; a text of fewer
    words, but not none, is one shingle of its whole sequence."""
    if not len(words):
        return words
    k = min(width, len(words))
    m = len(words) - k + 1
    h = np.zeros(m, np.uint64)
    for i in range(k):  # each position has its own odd factor
        h += words[i:i + m] * np.uint64(BASE + np.uint64(2 * i))
    h = mix64(h + np.uint64(k))
    h.sort()
    first = np.ones(m, bool)
    np.not_equal(h[1:], h[:-1], out=first[1:])
    return h[first]
