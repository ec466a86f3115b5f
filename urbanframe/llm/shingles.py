"""Sets of hashed word n-grams, made for many texts at a time.

Words are runs of bytes other than white space, ASCII letters lower-cased. A
word's hash comes from a running sum over the joined bytes of many texts, a
gram's from the hashes of its words; only the sort of each set runs text by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from urbanframe.llm.anchors import Hashed, mixed

#: Bytes of joined texts hashed at a time.
PIECE = 1 << 19
SPACES = b" \t\n\x0b\x0c\r"

_IN_WORD = np.ones(256, bool)
_IN_WORD[list(SPACES)] = False
_STEP = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def _word_hashes(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word."""
    raw = np.frombuffer(joined, np.uint8)
    inside = np.concatenate([[False], _IN_WORD[raw], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    if len(raw) <= 2 * PIECE:
        return Hashed(raw).slices(start, end), start
    out, at = [], 0  # a long text, in pieces that end with a word
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + PIECE)))
        first, last = int(start[at]), int(end[stop - 1])
        out.append(Hashed(raw[first:last]).slices(start[at:stop] - first, end[at:stop] - first))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64), start


def gram_sets(texts: list[str | None], words: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct gram hashes (int64) of every whole text, in order.

    A text of fewer words has its whole sequence as the one gram, one without
    words none.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if held and size + len(data) > PIECE:
            yield from _sets_of(held, words)
            held, size = [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield from _sets_of(held, words)


def _sets_of(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    word, start = _word_hashes(b" ".join(texts))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes + 1) - sizes - 1
    first = np.append(np.searchsorted(start, begin), len(word))
    grams = _combined(word, words) if len(word) >= words else np.zeros(0, np.int64)
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= words:
            own = np.sort(grams[a : b - words + 1])
            fresh = own[1:] != own[:-1]
            yield own if fresh.all() else own[np.concatenate([[True], fresh])]
        else:
            yield _combined(word[a:b], b - a) if b > a else np.zeros(0, np.int64)


def _combined(word: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    total = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        total += word[i : len(word) - n + 1 + i] * _STEP[i]
    return mixed(total).view(np.int64)
