"""A run-length index of a set of byte windows: which of their positions start a string that starts elsewhere too.

The windows are concatenated, a unique separator after each, and sorted into a
suffix array, of which only the Burrows-Wheeler transform's runs are kept with the
text positions at their first and last rows. At a run's first row the match
with the row before is measured, at its last row the match with the row after.
Everywhere else the match of a position is that of the position before it, less
one: rows inside a run keep their neighbour when both step back in the text. So
one walk along the text turns the samples into matching statistics, the length of
the longest match that each position has anywhere else. Repetitive windows have
few runs, and few matches are measured.
"""

from __future__ import annotations

import numpy as np

from railpulse.llm.common import prefix_hashes, span_hashes


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` (small non-negative numbers, its last one unique) in order, by prefix doubling.

    Each round sorts only suffixes that are not yet told apart.
    """
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    # A suffix's rank is the place of the first of its group.
    sorted_rank = rank[order]
    opens = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    first = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    rank[order] = first
    while True:
        closes = np.concatenate([opens[1:], [True]])
        tied = np.flatnonzero(~(opens & closes))  # places in groups of more than one
        if not len(tied):
            return order
        members = order[tied]
        ahead = np.where(members + step < n, rank[np.minimum(members + step, n - 1)] + 1, 0)
        key = rank[members] * (n + 1) + ahead
        by = np.argsort(key, kind="stable")
        key, members = key[by], members[by]
        order[tied] = members
        new = np.concatenate([[True], key[1:] != key[:-1]])
        opens[tied] = new
        rank[members] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        step *= 2


class RunLengthIndex:
    """Runs of the transform with the text positions of their first and last rows."""

    def __init__(self, windows: list[bytes]):
        sizes = np.array([len(w) + 1 for w in windows])
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        count = len(windows)
        self.text = np.empty(int(self.first[-1]), np.int64)
        raw = np.frombuffer(b"\0".join(windows) + b"\0", np.uint8)
        self.text[:] = raw.astype(np.int64) + count
        self.text[self.first[1:] - 1] = np.arange(count)
        order = suffix_array(self.text)
        transform = self.text[order - 1]  # before the first position comes the last, a separator
        change = transform[1:] != transform[:-1]
        self.runs = int(change.sum()) + 1
        # Samples: (position at a run's first row, at the row before), (at its last row, at the row after).
        self.starts = order[1:][change], order[:-1][change]
        self.ends = order[:-1][change], order[1:][change]
        self.first_row, self.last_row = order[0], order[-1]
        self.sums = prefix_hashes((self.text + 1).astype(np.uint64))

    def _match(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, up to ``most``."""
        n = len(self.text)
        low = np.zeros(len(a), np.int64)
        high = np.minimum(most, n - np.maximum(a, b))
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = span_hashes(self.sums, a, a + middle) == span_hashes(self.sums, b, b + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def _walk(self, at: np.ndarray, match: np.ndarray) -> np.ndarray:
        """The samples carried along the text, one less per position."""
        n = len(self.text)
        value = np.zeros(n, np.int64)
        sampled = np.zeros(n, bool)
        value[at], sampled[at] = match, True
        last = np.maximum.accumulate(np.where(sampled, np.arange(n), -1))
        carried = value[np.maximum(last, 0)] - (np.arange(n) - last)
        return np.where(last < 0, 0, np.maximum(carried, 0))

    def matching_statistics(self) -> list[np.ndarray]:
        """For every window, how long each of its positions matches elsewhere."""
        length = self.first[1:] - self.first[:-1] - 1
        # Measured in full, as positions after a sample live on what is left of it.
        reach = int(length.max(initial=0)) + 1
        none = np.zeros(1, np.int64)
        before = self._walk(
            np.append(self.starts[0], self.first_row), np.append(self._match(*self.starts, reach), none)
        )
        after = self._walk(
            np.append(self.ends[0], self.last_row), np.append(self._match(*self.ends, reach), none)
        )
        best = np.maximum(before, after)
        return [best[a:b - 1] for a, b in zip(self.first[:-1], self.first[1:])]
