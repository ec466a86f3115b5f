"""Words of many texts at a time, as numpy arrays over their joined bytes.

A ``Block`` holds the lower-cased bytes of some texts, one separator between
neighbouring words and one between texts, so equal runs of words are equal
bytes wherever they stand and however they were spaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from urbanframe.llm.anchors import Hashed, mixed

#: Bytes of joined texts handled at a time; a longer text is one block of its own.
PIECE = 1 << 19
#: Separator between the words of a block and between its texts.
GAP = ord(" ")

_STEP = np.random.default_rng(23).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes in the closed ``ranges``."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


class Block:
    """Words of ``texts``: ``start, end`` in ``raw``, the ``text`` they stand in, the ``piece`` between breaks.

    ``separators`` and ``breaks`` are byte tables; a break separates words, too.
    ``source_start`` and ``source_end`` are places in the text's own bytes.
    """

    def __init__(self, texts: list[bytes], separators: np.ndarray, breaks: np.ndarray | None = None):
        joined = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begin = np.cumsum(sizes) - sizes
        out = separators if breaks is None else separators | breaks
        inside = ~out[joined]
        inside[begin[1:] - 1] = False  # between texts
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        start, end = edge[::2], edge[1::2]
        self.texts = len(texts)
        self.text = np.searchsorted(begin, start, "right") - 1
        self.source_start, self.source_end = start - begin[self.text], end - begin[self.text]
        if breaks is None:
            self.piece = self.text
        else:
            cut = breaks[joined]
            cut[begin[1:] - 1] = True
            self.piece = np.cumsum(cut, dtype=np.int32)[start] if len(start) else start
        size = end - start
        self.start = np.cumsum(size + 1) - size - 1
        self.end = self.start + size
        kept = inside
        kept[end[end < len(joined)]] = True
        self.raw = joined[kept]
        if len(self.raw) < (self.end[-1] if len(start) else 0) + 1:
            self.raw = np.append(self.raw, np.uint8(GAP))
        self.raw[self.end] = GAP

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, family: int = 0) -> np.ndarray:
        """A hash of every word (uint64)."""
        out, at = np.zeros(len(self), np.uint64), 0
        while at < len(self):  # long texts in parts that end with a word
            stop = max(at + 1, int(np.searchsorted(self.end, self.start[at] + 2 * PIECE)))
            first = int(self.start[at])
            part = Hashed(self.raw[first : int(self.end[stop - 1])], family)
            out[at:stop] = part.slices(self.start[at:stop] - first, self.end[at:stop] - first)
            at = stop
        return out

    def same_piece(self, n: int) -> np.ndarray:
        """First words of all runs of ``n`` words within one piece."""
        return np.flatnonzero(self.piece[: len(self) - n + 1] == self.piece[n - 1 :]) if len(self) >= n else np.zeros(0, np.int64)


def blocks(texts: list[str | None], separators: np.ndarray, breaks: np.ndarray | None = None) -> Iterator[tuple[int, Block]]:
    """Blocks of whole texts of about ``PIECE`` bytes, with the number of their first text."""
    held: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(data) > PIECE:
            yield first, Block(held, separators, breaks)
            held, size, first = [], 0, i
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, Block(held, separators, breaks)


def run_hashes(word: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words from the words' hashes (uint64)."""
    if len(word) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        total += word[i : len(word) - n + 1 + i] * _STEP[i % len(_STEP)]
    return mixed(total)
