"""Whole texts to token ids by units that no token crosses, vectorised.

A unit ends before every space or line feed that stands between two characters which aren't white
space: there, a byte-level pre-tokenizer always ends a piece. Units tile the text; each distinct one
is encoded once and found again by a 64-bit hash of its bytes, so a text's ids are one gather.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import xxhash

from .words import mixed

#: Distinct units a worker remembers (the first it meets; others are encoded again), the longest of
#: them in bytes, and bytes handled together.
CACHE_UNITS, CACHE_BYTES, BLOCK = 500_000, 64, 1 << 19

_BYTE = np.random.default_rng(41).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
#: Lead bytes of the white space beyond ASCII (U+0085, U+00A0, U+1680, U+2000..U+205F, U+3000).
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _powers(p: int) -> np.ndarray:
    out = np.full(BLOCK, p, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _INV = _powers(_P), _powers(pow(_P, -1, 1 << 64))


def white_space(b: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space."""
    white = _WHITE[b]
    at = np.flatnonzero(_LEAD[b[:-1]])
    if len(at):
        x, y, z = b[at], b[at + 1], b[np.minimum(at + 2, len(b) - 1)]
        two = (x == 0xC2) & ((y == 0x85) | (y == 0xA0))
        general = (x == 0xE2) & (((y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF))) | ((y == 0x81) & (z == 0x9F)))
        three = general | ((x == 0xE1) & (y == 0x9A) & (z == 0x80)) | ((x == 0xE3) & (y == 0x80) & (z == 0x80))
        for i, some in ((0, two | three), (1, two | three), (2, three)):
            white[at[some] + i] = True
    return white


def unit_starts(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """First byte of each unit of texts that stand one after the other in ``b``, from ``starts``."""
    cut = np.zeros(len(b), dtype=bool)
    if len(b) > 2:
        white = white_space(b)
        cut[1:-1] = ((b[1:-1] == 32) | (b[1:-1] == 10)) & ~white[:-2] & ~white[2:]
    ends = starts[1:] - 1
    cut[ends[ends >= 0]] = False  # at a text's end no character follows
    cut[starts[starts < len(b)]] = True
    return np.flatnonzero(cut)


def hashes(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each unit."""
    ends = np.append(starts[1:], len(b))
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + BLOCK, "right"))
        if to == at:  # a unit longer than a block
            out[at] = xxhash.xxh3_64_intdigest(bytes(b[starts[at] : ends[at]]))
            at += 1
            continue
        first, here = int(starts[at]), starts[at:to] - starts[at]
        v = _BYTE[b[first : ends[to - 1]]]
        v *= _POW[: len(v)]
        out[at:to] = mixed(np.add.reduceat(v, here) * _INV[here])
        at = to
    return out


def gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` with these starts and lengths, one after the other."""
    upto = np.cumsum(count)
    return flat[np.repeat(start - upto + count, count) + np.arange(upto[-1] if len(upto) else 0)]


class Units:
    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        """encode: texts of units to their ids, one after the other, and how many each has."""
        self.encode = encode
        self.keys = np.empty(0, dtype=np.uint64)
        self.start, self.count = np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.uint8)
        self.flat, self.used = np.empty(1 << 16, dtype=np.uint32), 0

    def _remember(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.used : self.used + len(ids)] = ids
        start = (self.used + np.cumsum(count) - count).astype(np.uint32)
        self.used += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.count = np.insert(self.keys, at, keys), np.insert(self.start, at, start), np.insert(self.count, at, count.astype(np.uint8))

    def ids(self, texts: Sequence[np.ndarray], block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8 bytes), one after the other, and how many each has."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        b = np.concatenate(texts) if len(texts) else np.empty(0, dtype=np.uint8)
        begin = np.cumsum(sizes) - sizes
        starts = unit_starts(b, begin[sizes > 0])
        key = hashes(b, starts)
        out, counts = [], np.empty(len(starts), dtype=np.int64)
        at = 0
        while at < len(starts):
            to = max(int(np.searchsorted(starts, starts[at] + block)), at + 1)
            got, counts[at:to] = self._block(b, starts[at:to], starts[to] if to < len(starts) else len(b), key[at:to])
            out.append(got)
            at = to
        before = np.concatenate(([0], np.cumsum(counts)))
        edges = before[np.searchsorted(starts, np.append(begin, len(b)))]
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint32), np.diff(edges)

    def _block(self, b: np.ndarray, starts: np.ndarray, end: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, first, which = np.unique(key, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        count, start = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        count[known] = self.count[at[known]]
        old = gather(self.flat, self.start[at[known]].astype(np.int64), count[known])
        new = np.flatnonzero(~known)
        fresh = old[:0]
        if len(new):
            s = starts[first[new]]
            e = np.append(starts[1:], end)[first[new]]
            fresh, n = self.encode([bytes(b[x:y]).decode() for x, y in zip(s.tolist(), e.tolist(), strict=True)])
            count[new] = n
            keep = np.flatnonzero(e - s <= CACHE_BYTES)[: max(CACHE_UNITS - len(self.keys), 0)]
            if len(keep):
                self._remember(keys[new[keep]], gather(fresh, (np.cumsum(n) - n)[keep], n[keep]), n[keep])
            start[new] = len(old) + np.cumsum(n) - n
        start[known] = np.cumsum(count[known]) - count[known]
        counts = count[which]
        return gather(np.concatenate((old, fresh)), start[which], counts), counts
