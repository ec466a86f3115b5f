"""Sampled suffixes of byte strings, chosen by content.

Of every window of ``length`` bytes, the position whose ``gram`` bytes have the
smallest hash is its anchor. Equal windows have equal anchors, so a repeat of
``length`` bytes or more always shares a sampled suffix, while only about one
position in ``(length - gram) / 2`` is sampled. Windows with the same anchor
follow each other; such a run is a segment.
"""

from __future__ import annotations

import numpy as np

LENGTH = 100
GRAM = 32
#: Window starts handled at a time.
CHUNK = 1 << 18

#: Odd bases of the two families of hashes, so that neither tells of the other.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(base, -1, 2**64) for base in _BASES)
_CODES = np.random.default_rng(7).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[tuple[int, str], np.ndarray] = {}


def _powers(n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get((family, "up"), ())) < n:
        size = -(-n // 65536) * 65536
        for name, base in (("up", _BASES[family]), ("down", _INVERSES[family])):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[family, name] = np.multiply.accumulate(row)
    return _POWERS[family, "up"], _POWERS[family, "down"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """Hashes of any substring of a byte string, from one running sum.

    ``family`` (0 or 1) picks one of two independent hashes.
    """

    def __init__(self, raw: np.ndarray, family: int = 0):
        self.up, down = _powers(len(raw) + 1, family)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_CODES[family][raw] * down[: len(raw)], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed 64-bit hashes of the bytes from ``start`` to ``end``."""
        return mixed((self.sums[end] - self.sums[start]) * self.up[start])

    def rolling(self, n: int) -> np.ndarray:
        """Mixed hashes of all runs of ``n`` bytes."""
        return mixed((self.sums[n:] - self.sums[:-n]) * self.up[: len(self.sums) - n])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, 1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``gram hash, segment hash, first window, windows, suffix offset`` of every segment of a byte string."""
    out = []
    for begin in range(0, max(0, len(raw) - length + 1), CHUNK):
        part = raw[begin : begin + CHUNK + length - 1]
        hashed = Hashed(part)
        grams = hashed.rolling(gram)
        keyed = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
        anchor = (smallest(keyed, length - gram + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        windows = np.diff(np.append(first, len(anchor)))
        whole = hashed.slices(first, first + windows + length - 1) ^ mixed((anchor[first] - first).astype(np.uint64))
        out.append((grams[anchor[first]].view(np.int64), whole.view(np.int64), first + begin, windows, anchor[first] - first))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))
