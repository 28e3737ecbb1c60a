"""Vectorised work on the UTF-8 bytes of a column of texts.

Texts are taken as they lie in an Arrow string array (one buffer, offsets), in groups of
about ``GROUP_BYTES``, so numpy's temporary arrays stay small; a longer
text is a group of its own and is cut at white space into pieces.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
_MULTIPLIER, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply), in place."""
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


#: One pseudo-random odd 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 4 * GROUP_BYTES:
            _powers[base] = have
    return have[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(len(texts) + 1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), off


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``limit`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _spans(kind: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of one non-zero kind; a run ends at each cut."""
    edge = np.empty(len(kind) + 1, dtype=bool)
    edge[0] = edge[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
    edge[cuts] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] > 0
    return starts[keep], ends[keep]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the given byte ranges, whatever their place."""
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(BYTE_VALUES[data] * _power(_MULTIPLIER, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power(_INVERSE, len(data))[starts])


def tokens(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, token hashes, tokens of each text) by group.

    ``kinds`` maps a byte to 0 (white space) or to a token class; a token is a
    maximal run of bytes of one class within a text."""
    for i, j in groups(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        found, counts = [], np.zeros(j - i, dtype=np.int64)
        while lo < hi:
            end = hi
            if j - i == 1 and hi - lo > 2 * GROUP_BYTES:  # one long text: pieces that end at white space
                end = lo + GROUP_BYTES
                while end < hi and kinds[data[end]]:
                    blank = np.flatnonzero(kinds[data[end:end + GROUP_BYTES]] == 0)
                    end = end + int(blank[0]) if len(blank) else min(hi, end + GROUP_BYTES)
            part = data[lo:end]
            cuts = offsets[i:j + 1]
            cuts = cuts[(cuts >= lo) & (cuts <= end)] - lo
            starts, ends = _spans(kinds[part], cuts)
            if len(starts):
                found.append(_hashes(part, starts, ends))
                where = np.searchsorted(offsets[i:j + 1], starts + lo, side="right") - 1
                counts += np.bincount(where, minlength=j - i)
            lo = end
        yield i, j, np.concatenate(found) if found else np.zeros(0, np.uint64), counts


def ngrams(tok: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of the runs of ``order`` tokens within each text."""
    text = np.repeat(np.arange(len(counts)), counts)
    if order == 1:
        return mix(tok + np.uint64(1)), text
    n = len(tok) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = tok[:n].copy()
    for k in range(1, order):
        h *= np.uint64(_MULTIPLIER)
        h += tok[k:n + k]
    inside = text[:n] == text[order - 1:]
    return mix(h[inside] + np.uint64(order)), text[:n][inside]
