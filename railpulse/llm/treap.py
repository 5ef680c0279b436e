"""A K2-treap: a grid of rows and columns with a weight in some cells, as a compressed quadtree.

The grid is a square with a side of a power of two. A node stands for a square of it and has up to four children, for its
quarters. Nodes without a weight below them do not exist. Per level there is a bitmap with four bits for
each node of the level (which quarters exist) and, for every node, by how much its largest weight falls
short of its parent's, in as many byte planes as the largest difference takes. A child's place is the number of bits set
before its own.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

_HEAD = struct.Struct("<BQ")
_LEVEL = struct.Struct("<QB")


def _spread(values: np.ndarray) -> np.ndarray:
    """Bits of 32-bit numbers at every other place."""
    x = values.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def compressed(rows: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> bytes:
    """The treap of cells that are all different; weights are above 0."""
    side = int(max(rows.max(initial=0), columns.max(initial=0)))
    levels = side.bit_length()
    path = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(path)
    path, largest = path[order], weights[order].astype(np.int64)
    parts: list[bytes] = []
    for _ in range(levels):
        parent = path >> np.uint64(2)
        opens = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(path) else np.zeros(0, np.int64)
        node = np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(path))))
        above = np.maximum.reduceat(largest, opens) if len(opens) else largest
        bits = np.zeros(4 * len(opens), bool)
        bits[4 * node + (path & np.uint64(3)).astype(np.int64)] = True
        short = above[node] - largest
        width = max(1, -(-int(short.max(initial=0)).bit_length() // 8))
        planes = short.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        parts.append(_LEVEL.pack(len(opens), width) + np.packbits(bits).tobytes() + planes.T.tobytes())
        path, largest = parent[opens], above
    return _HEAD.pack(levels, int(largest[0]) if len(largest) else 0) + b"".join(reversed(parts))


@dataclass
class Level:
    """Children of the nodes of a level: ``child[4 * node + quarter]``, or -1, and the largest weight of each child."""

    child: np.ndarray
    largest: np.ndarray


class Treap:
    """A treap read back, ready to be descended."""

    def __init__(self, data: bytes | memoryview):
        self.height, top = _HEAD.unpack_from(data)
        self.largest = np.array([top], np.int64)
        self.levels: list[Level] = []
        at, above = _HEAD.size, self.largest
        for _ in range(self.height):
            nodes, width = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            packed = np.frombuffer(data, np.uint8, -(-4 * nodes // 8), at)
            at += len(packed)
            bits = np.unpackbits(packed, count=4 * nodes)
            child = np.where(bits, np.cumsum(bits, dtype=np.int32) - 1, np.int32(-1))
            parent = np.flatnonzero(bits) // 4
            planes = np.frombuffer(data, np.uint8, width * len(parent), at).reshape(width, len(parent))
            at += width * len(parent)
            above = above[parent]
            for place, plane in enumerate(planes):
                above -= plane.astype(np.int64) << (8 * place)
            self.levels.append(Level(child, above))

    def best_columns(
        self, rows: np.ndarray, times: np.ndarray, count: int, beam: int = 256
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``count`` columns with the largest sums of weights over ``rows``, each ``times`` over, and their sums.

        Of equal sums the smaller column comes first. Ranges of columns are opened best first, ``beam`` of them at a
        time; the bound of a range is the sum of the largest weights that the paths of all rows have in it. Paths
        descend together, and those that have ended weigh nothing. A range goes when its bound cannot displace one
        of the ``count`` found.
        """
        none = np.zeros(0, np.int64)
        within = rows < 1 << self.height
        rows, times = rows[within], times[within]
        if not len(rows) or not len(self.largest) or self.largest[0] <= 0:
            return none, none
        # Ranges waiting, by depth: starts, bounds, and the node of every row's path (-1 where it has ended).
        waiting = [(none, none, np.zeros((0, len(rows)), np.int32)) for _ in range(self.height + 1)]
        waiting[0] = (np.zeros(1, np.int64), np.array([self.largest[0] * times.sum()]), np.zeros((1, len(rows)), np.int32))
        columns, sums = none, none
        while True:
            if self.height == 0 or len(waiting[-1][0]):
                start, bound, _ = waiting[-1]
                columns, sums = np.concatenate([columns, start]), np.concatenate([sums, bound])
                order = np.lexsort((columns, -sums))[:count]
                columns, sums = columns[order], sums[order]
                waiting[-1] = (none, none, np.zeros((0, len(rows)), np.int32))
                if self.height == 0:
                    return columns, sums
            if len(sums) == count:
                for depth, (start, bound, nodes) in enumerate(waiting):
                    able = (bound > sums[-1]) | ((bound == sums[-1]) & (start < columns[-1]))
                    if not able.all():
                        waiting[depth] = (start[able], bound[able], nodes[able])
            # The deepest of the best: ties go to ranges that are nearer to a column.
            best = [int(b.max(initial=-1)) for _, b, _ in waiting]
            depth = max(range(self.height), key=lambda d: (best[d], d))
            if best[depth] < 0:
                return columns, sums
            start, bound, nodes = waiting[depth]
            if len(start) > beam:
                chosen = np.zeros(len(start), bool)
                chosen[np.argpartition(-bound, beam)[:beam]] = True
                waiting[depth] = (start[~chosen], bound[~chosen], nodes[~chosen])
                start, nodes = start[chosen], nodes[chosen]
            else:
                waiting[depth] = (none, none, np.zeros((0, len(rows)), np.int32))
            self._open(waiting, depth, start, nodes, rows, times)

    def _open(self, waiting: list, depth: int, start: np.ndarray, nodes: np.ndarray, rows: np.ndarray, times: np.ndarray) -> None:
        """Put both halves of ranges among those waiting at the next depth."""
        level = self.levels[depth]
        shift = self.height - 1 - depth
        quarter = 4 * nodes.astype(np.int64) + 2 * ((rows >> shift) & 1)
        for half in (0, 1):
            below = np.where(nodes >= 0, level.child[np.where(nodes >= 0, quarter + half, 0)], np.int32(-1))
            largest = np.where(below >= 0, level.largest[below], 0)
            bound = largest @ times
            some = bound > 0
            was = waiting[depth + 1]
            waiting[depth + 1] = (
                np.concatenate([was[0], start[some] + (half << shift)]),
                np.concatenate([was[1], bound[some]]),
                np.concatenate([was[2], below[some]]),
            )
