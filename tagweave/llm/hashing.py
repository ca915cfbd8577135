"""Vectorised byte and word hashing shared by the numpy-backed operators.

Everything works on a :class:`Chunk`: the UTF-8 bytes of several texts laid
end to end, with the offset of each text. Hashes are polynomial in a 64-bit
ring (wrapping arithmetic), finished with a multiply-xorshift mixer, so the
hash of any byte range comes from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Texts are processed in runs of about this many bytes (bounds memory).
CHUNK_BYTES = 1 << 21

_MULT = 0x9E3779B97F4A7C15 | 1
_U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240115))
#: One random 64-bit value per byte value.
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U64(2) + _U64(1)
#: Odd multipliers that make a shingle depend on word order.
ORDER_VALUES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U64(2) + _U64(1)

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on every input bit."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


_POWERS: tuple[np.ndarray, np.ndarray] | None = None


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """M^i and M^-i for i up to n, kept between calls."""
    global _POWERS
    if _POWERS is None or len(_POWERS[0]) <= n:
        size = max(n + 1, CHUNK_BYTES + 65536)
        inverse = pow(_MULT, -1, 1 << 64)
        up = np.full(size, _MULT, dtype=np.uint64)
        down = np.full(size, inverse, dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS = (np.cumprod(up), np.cumprod(down))
    return _POWERS


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n + 1 prefix sums of byte value times power; feed to :func:`range_hash`."""
    up, _ = _powers(len(data))
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Raw (unmixed) hash of the bytes [start, end), independent of position."""
    _, down = _powers(len(prefix) - 1)
    return (prefix[end] - prefix[start]) * down[start]


@dataclass
class Chunk:
    """Rows of one or more texts, laid end to end."""

    rows: np.ndarray  # row numbers in the batch, one per text
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, len(rows) + 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a string column into chunks of about ``limit`` bytes (null: empty).

    A text longer than the limit is a chunk of its own, whole.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, dtype=np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(n, max(end, begin + 1))
        yield Chunk(
            rows=np.arange(begin, end),
            data=data[offsets[begin] : offsets[end]],
            offsets=offsets[begin : end + 1] - offsets[begin],
        )
        begin = end


@dataclass
class Words:
    """Lower-cased words of a chunk: byte ranges, hashes, and word offsets per text."""

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray  # uint64, mixed
    offsets: np.ndarray  # len(texts) + 1, into the arrays above


def words(chunk: Chunk) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the A-Z lower-cased texts; none crosses texts."""
    data, offsets = chunk.data, chunk.offsets
    n = len(data)
    solid = ~SPACE[data]
    first = np.empty(n + 1, dtype=bool)  # a text starts here
    first[:] = False
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:n]
    ends = solid
    ends[:-1] &= SPACE[data[1:]] | first[1:n]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    prefix = prefix_hash(LOWER[data])
    hashes = mix(range_hash(prefix, start, end) + (end - start).astype(np.uint64))
    return Words(start, end, hashes, np.searchsorted(start, offsets))


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words: (hashes, offsets per text).

    A text with fewer words (but at least one) has its whole sequence as one.
    """
    n = len(w.hashes)
    count = np.diff(w.offsets)
    per_text = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(per_text)])
    out = np.empty(offsets[-1], dtype=np.uint64)
    if n >= width:
        total = w.hashes[: n - width + 1] * ORDER_VALUES[0]
        for j in range(1, width):
            total += w.hashes[j : n - width + 1 + j] * ORDER_VALUES[j]
        text_of = np.repeat(np.arange(len(count)), np.where(count >= width, per_text, 0))
        long_first = w.offsets[:-1] - offsets[:-1]
        rank = np.flatnonzero(np.repeat(count >= width, per_text))
        out[rank] = total[rank + long_first[text_of]]
    for i in np.flatnonzero((count < width) & (count > 0)):
        a, b = w.offsets[i], w.offsets[i + 1]
        out[offsets[i]] = (w.hashes[a:b] * ORDER_VALUES[: b - a]).sum() ^ ORDER_VALUES[32 + b - a]
    return mix(out), offsets
