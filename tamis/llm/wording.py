"""Words and word shingles of texts, as several operators see them.

A-Z are lower-cased; a word is a run of ASCII digits, a-z and non-ASCII characters.
"""

from __future__ import annotations

import numpy as np

_WORD = frozenset((*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)))
#: UTF-8 bytes to lower-case words and blanks.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words of texts.

    A text of fewer words, but not none, is one run. Runs are hashed as polynomials over
    their bytes, all texts of a portion at once.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, width: int, portion: int = 1 << 20):
        self.width, self.portion = width, portion
        self.values = mixed(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            for name, base in (("powers", self.BASE), ("inverses", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(2 * n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for text in texts:
            held.append(b" ".join((text or b"").translate(FOLD).split()))
            size += len(held[-1]) + 1
            if size >= self.portion:
                out += self._portion(held)
                held, size = [], 0
        return out + self._portion(held) if held else out

    def _portion(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = np.frombuffer(b" ".join(t for t in texts if t) + b" ", np.uint8)
        counts = np.array([t.count(b" ") + 1 if t else 0 for t in texts])
        runs = np.where(counts >= self.width, counts - self.width + 1, np.minimum(counts, 1))
        total = int(runs.sum())
        if not total:
            return [np.zeros(0, np.uint64) for _ in texts]
        ends = np.flatnonzero(raw == 0x20)
        starts = np.concatenate(([0], ends[:-1] + 1))
        self._reach(len(raw) + 1)
        prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.values[raw] * self.powers[: len(raw)], out=prefix[1:])
        first = np.repeat(np.cumsum(counts) - counts - (np.cumsum(runs) - runs), runs) + np.arange(total)
        last = first + np.repeat(np.minimum(counts, self.width), runs) - 1
        a, b = starts[first], ends[last]
        hashes = mixed((prefix[b] - prefix[a]) * self.inverses[a])
        return [np.unique(part) for part in np.split(hashes, np.cumsum(runs)[:-1])]
