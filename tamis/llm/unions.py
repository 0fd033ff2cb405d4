"""Small helpers inside tasks: links between rows as labels instead of pairs."""

from __future__ import annotations

import numpy as np


class Labels:
    """Disjoint sets of the numbers 0 .. n-1, merged a whole neighbourhood at a time."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.members: dict[int, list[int]] = {}

    def merge(self, rows: np.ndarray) -> None:
        """Put all ``rows`` into one set."""
        labels = np.unique(self.of[rows])
        if len(labels) < 2:
            return
        groups = {int(x): self.members.pop(int(x), [int(x)]) for x in labels}
        root = max(groups, key=lambda x: len(groups[x]))  # the smaller sets are relabelled
        whole = groups.pop(root)
        for group in groups.values():
            self.of[group] = root
            whole += group
        self.members[root] = whole

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each member with its set's label: as many edges as a spanning forest has."""
        rows = np.flatnonzero(self.of != np.arange(len(self.of)))
        return rows, self.of[rows]
