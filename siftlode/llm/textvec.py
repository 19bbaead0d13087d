"""Vectorised text helpers for Arrow batches: bytes of many documents in one numpy array.

Word boundaries and hashes are found with whole-array operations, a mebibyte or so at a time, so that
memory stays bounded whatever the length of a batch or a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_U = np.uint64


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about ``limit`` bytes; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"") if len(texts) else texts.cast(pa.large_binary())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield lo, hi, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def pieces(batches, column: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches with about ``limit`` bytes of text each, so that what is made of one stays small."""
    for b in batches:
        for lo, hi, *_ in chunks(b.column(column), limit):
            yield b.slice(lo, hi - lo)


def table(members: bytes | range | list[int]) -> np.ndarray:
    """Boolean lookup by byte value."""
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: Bytes that separate words: space and 09-0D.
WHITE = table([0x20, *range(0x09, 0x0E)])
NOT_WHITE = ~WHITE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalising permutation (multiply, xor-shift)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def mix1(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], _U))[0])


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_ODD = 0x2545F4914F6CDD1D
_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the odd base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) <= n:
        for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            p = np.full(max(n, 2 * CHUNK) + 1, base, _U)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes with ``inside[byte]``, none across two texts."""
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    w = inside[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = w.copy()
    first[1:] &= ~w[:-1] | cut[1:n]
    last = w.copy()
    last[:-1] &= ~w[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def owners(offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text of each position."""
    return np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, all from one prefix sum."""
    if not len(starts):
        return np.empty(0, _U)
    up, down = _power(len(data))
    total = np.empty(len(data) + 1, _U)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0x9E3779B97F4A7C15))


def counts_by_text(owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """(first index, number) of the spans of each text; owners ascend."""
    number = np.bincount(owner, minlength=texts)
    return np.concatenate([[0], np.cumsum(number)[:-1]]), number


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_array(values: np.ndarray, lengths, kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
