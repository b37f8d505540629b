"""Hashes of words and of runs of words, computed from bytes with numpy inside tasks."""

from __future__ import annotations

import numpy as np

SHINGLE = 5
BLOCK = 1 << 16
_ROOT = 0x9E3779B97F4A7C15 | 1
_FOLD = np.uint64(0xFF51AFD7ED558CCD)


class SpanHasher:
    """64-bit hashes of byte spans by differences of running sums, so a span costs a few steps.

    A span's hash is the sum of a random number per byte times a power of an odd root, divided by
    the power at its start.  Equal spans have equal hashes; others collide by chance only.
    """

    def __init__(self, seed: int = 17):
        self.bytes = np.random.default_rng(seed).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, length: int) -> None:
        if len(self.powers) > length:
            return
        size = 1 << (length + 1).bit_length()
        self.powers, self.inverse = (
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, root, np.uint64))])
            for root in (_ROOT, pow(_ROOT, -1, 1 << 64))
        )

    def __call__(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        return self.runs(self.bytes[raw], starts, ends)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of runs of random numbers."""
        self._grow(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=sums[1:])
        mixed = (sums[ends] - sums[starts]) * self.inverse[starts]
        mixed ^= mixed >> np.uint64(33)
        mixed *= _FOLD
        return mixed ^ (mixed >> np.uint64(33))


def space_words(text: str | None) -> list[bytes]:
    """Words between white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes whose words are parted by single spaces."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return np.append(0, breaks + 1), np.append(breaks, len(data))


def run_hashes(hasher: SpanHasher, words: list[bytes], width: int = SHINGLE) -> np.ndarray:
    """Hash of every ``width`` words in a row, in order; a shorter text is one run.

    Long texts go block by block, so that memory stays near eight bytes a word.
    """
    if not words:
        return np.zeros(0, np.uint64)
    width = min(width, len(words))
    parts = []
    for at in range(0, len(words) - width + 1, BLOCK):
        data = b" ".join(words[at : at + BLOCK + width - 1])
        starts, ends = word_spans(data)
        parts.append(hasher(data, starts[: len(starts) - width + 1], ends[width - 1 :]))
    return np.concatenate(parts)
