"""Words and word shingles as 64-bit hashes, vectorised per document.

A word is a maximal run of bytes other than space and 0x09..0x0D, with A-Z taken as a-z. Its hash is
a polynomial over a fixed random value for each byte, summed for all words of a text at once, so no
word becomes a Python object. Equal words have equal hashes wherever they stand; words longer than
``BLOCK`` bytes are hashed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Texts are hashed in blocks of about so many bytes, cut at white space; bounds the power tables.
BLOCK = 1 << 16

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
#: For ``words(..., plain=True)``: of ASCII, only letters and digits are part of a word.
_OTHER = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_PLAIN_BYTE = np.where(_OTHER, np.uint64(0), _BYTE)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def _powers(p: int, n: int) -> np.ndarray:
    out = np.full(n, p, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P, 2 * BLOCK + 2), _powers(_P_INV, 2 * BLOCK + 2)
#: Odd multipliers, one for each word of a gram (any odd constants would do).
_ODD = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def _block(b: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = _OTHER[b] if plain else _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    longest = int((ends - starts).max())
    if len(b) > len(_POW) or longest > BLOCK:
        out = np.empty(len(starts), dtype=np.uint64)
        for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            if e - s > BLOCK:
                out[i] = xxhash.xxh3_64_intdigest(bytes(b[s:e]).lower())
            else:
                out[i] = _block(b[s:e], plain)[2][0]
        return starts, ends, out
    v = _PLAIN_BYTE[b] if plain else _BYTE[b]
    v *= _POW[: len(b)]
    return starts, ends, mixed(np.add.reduceat(v, starts) * _INV[starts])


def words(b: np.ndarray, plain: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offsets of the start and end of each word of a UTF-8 text, and the words' hashes."""
    if len(b) <= 2 * BLOCK:
        return _block(b, plain)
    out, at = [], 0
    while at < len(b):
        to = min(at + BLOCK, len(b))
        while to < len(b) and not _SPACE[b[to]]:  # at most one word beyond the block
            gap = np.flatnonzero(_SPACE[b[to : to + BLOCK]])
            to = to + int(gap[0]) if len(gap) else min(to + BLOCK, len(b))
        s, e, h = _block(b[at:to], plain)
        out.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def gram_hashes(wh: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that start at each position (len(wh) - n + 1 of them)."""
    m = len(wh) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.full(m, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        h += wh[i : i + m] * _ODD[i % 16]
        if i % 16 == 15:
            h = mixed(h)
    return mixed(h)


def shingle_set(wh: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; the whole sequence as one if it is shorter; empty without words."""
    if 0 < len(wh) < n:
        return gram_hashes(wh, len(wh))
    g = gram_hashes(wh, n)
    g.sort()
    return g[np.concatenate(([True], g[1:] != g[:-1]))] if len(g) else g


def texts(column: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each value of a string column, without copies; null as no bytes."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    b = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else None
    for i in range(len(column)):
        yield b[:0] if null is not None and null[i] else b[at[i] : at[i + 1]]


def prefixes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size, a hash of the first so many characters of each word of ``b`` (found with plain=True);
    of a shorter word, of all of it."""
    if not len(starts):
        return [np.empty(0, dtype=np.uint64) for _ in sizes]
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(starts, starts[at] + BLOCK)), at + 1)
        first, last = int(starts[at]), min(int(starts[to - 1]) + 4 * max(sizes), len(b))
        x, s = b[first:last], starts[at:to] - first
        e = np.minimum(ends[at:to] - first, len(x))
        char = np.flatnonzero((x & 0xC0) != 0x80)
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_PLAIN_BYTE[x] * _POW[: len(x)], dtype=np.uint64)))
        nth = np.searchsorted(char, s)
        for k, size in enumerate(sizes):
            end = np.append(char, len(x))[np.minimum(nth + size, len(char))]
            out[k].append(mixed((sums[np.minimum(end, e)] - sums[s]) * _INV[s]))
        at = to
    return [np.concatenate(o) for o in out]


def slices(column: pa.Array, size: int = 1 << 19) -> Iterator[list[np.ndarray]]:
    """The UTF-8 bytes of a string column's values, in lists of about ``size`` bytes."""
    part, held = [], 0
    for b in texts(column):
        part.append(b)
        held += len(b) + 1
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part
