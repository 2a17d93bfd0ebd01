"""Run-length grammar of a sequence by recompression, and exact common extensions by it.

Levels alternate. On a block level each maximal run of one symbol becomes one symbol of (symbol, length). On a pair level the symbols are parted in two
halves by a hash, and each left symbol followed by a right one becomes one symbol of both. Equal symbols of a level stand for equal stretches of the
sequence, and equal stretches are parsed alike but for a symbol or two at their edges, on every level.

A common extension of two places climbs while both stand at the start of equal symbols of the next level, steps over equal symbols (over the shorter rest of
two runs of one symbol), and goes down a level where symbols differ; on the lowest level that is the end. Each level costs a few steps, so an extension costs
steps in the order of the number of levels, which is logarithmic. Many extensions are answered together as arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from sunledger.llm.common import GOLD, mix64


@dataclass
class Level:
    """Symbols of one level as seen from one side.

    ``start`` is the place in the sequence at which each symbol begins (and the length of the sequence at the end); ``up`` the number of the symbol of the next
    level that each belongs to; ``first`` the number of its first symbol here; ``rest`` how many equal symbols follow from each on, itself included.
    """

    symbol: np.ndarray
    start: np.ndarray
    rest: np.ndarray
    up: np.ndarray | None = None
    first: np.ndarray | None = None


def named(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 for distinct rows of whole numbers below 2**31."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = (key << np.int64(32)) | c.astype(np.int64)
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def run_rests(symbol: np.ndarray) -> np.ndarray:
    """For each place how many equal symbols stand from it on, itself included."""
    n = len(symbol)
    ends = np.flatnonzero(np.r_[symbol[1:] != symbol[:-1], True]) + 1
    return (np.repeat(ends, np.diff(np.r_[0, ends])) - np.arange(n)).astype(np.int32)


class Grammar:
    """All levels of a sequence of symbols >= 0, in which negative numbers are separators that equal nothing, not even each other."""

    def __init__(self, sequence: np.ndarray):
        n = len(sequence)
        alone = sequence < 0
        symbol = named(np.where(alone, 0, sequence + 1), np.where(alone, np.arange(n), 0)) if n else np.zeros(0, np.int32)
        start = np.arange(n + 1, dtype=np.int32)
        self.length = n
        self.levels: list[Level] = []
        blocks, still = True, 0
        while True:
            if not still:
                level = Level(symbol, start, run_rests(symbol) if n else symbol)
                self.levels.append(level)
            if len(symbol) < 2 or still >= 8:
                break
            heads = self._block_heads(level) if blocks else self._pair_heads(symbol, alone, len(self.levels) + 100 * still)
            blocks = not blocks
            if len(heads) == len(symbol):  # nothing to join: try the other kind, or other halves
                still += 1
                continue
            still = 0
            sizes = np.diff(np.r_[heads, len(symbol)])
            level.first = heads.astype(np.int32)
            level.up = np.repeat(np.arange(len(heads), dtype=np.int32), sizes)
            if blocks:  # the level just made was of pairs
                second = np.where(sizes == 2, symbol[np.minimum(heads + 1, len(symbol) - 1)] + 1, 0)
                symbol, alone = named(symbol[heads], second), alone[heads]
            else:
                symbol, alone = named(symbol[heads], sizes), alone[heads]
            start = np.r_[start[heads], start[-1]]

    @staticmethod
    def _block_heads(level: Level) -> np.ndarray:
        return np.flatnonzero(np.r_[True, level.rest[:-1] == 1])

    @staticmethod
    def _pair_heads(symbol: np.ndarray, alone: np.ndarray, salt: int) -> np.ndarray:
        """Starts of the symbols of a pair level, for the one of a few partings that joins most pairs."""
        best = None
        for seed in range(3):
            with np.errstate(over="ignore"):
                side = (mix64(symbol.astype(np.uint64) + GOLD * np.uint64(3 * salt + seed + 1)) & np.uint64(1)).astype(bool)
            for left in (side, ~side):
                joined = left[:-1] & ~left[1:] & ~alone[:-1] & ~alone[1:]
                if best is None or np.count_nonzero(joined) > np.count_nonzero(best):
                    best = joined
        return np.flatnonzero(np.r_[True, ~best])

    def mirrored(self) -> Grammar:
        """The same grammar seen from the end of the sequence."""
        out = Grammar.__new__(Grammar)
        out.length, out.levels = self.length, []
        for level in self.levels:
            n = len(level.symbol)
            symbol = level.symbol[::-1]
            turned = Level(symbol, (self.length - level.start)[::-1], level.rest[::-1])
            # The rest of a run seen from its other end.
            head = np.flatnonzero(np.r_[True, level.rest[:-1] == 1]) if n else np.zeros(0, np.int64)
            size = np.diff(np.r_[head, n])
            turned.rest = (np.repeat(size, size) - level.rest + 1).astype(np.int32)[::-1] if n else level.rest
            if level.up is not None:
                m = len(level.first)
                turned.up = (m - 1 - level.up)[::-1]
                turned.first = (n - np.r_[level.first[1:], n])[::-1].astype(np.int32)
            out.levels.append(turned)
        return out

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the longest stretch that starts at both places, for many pairs of different places; the end of the sequence ends it."""
        x, y = np.asarray(x, np.int64), np.asarray(y, np.int64)
        found = np.zeros(len(x), np.int64)
        lv = np.zeros(len(x), np.int32)
        i, j = x.copy(), y.copy()  # symbol numbers on each query's own level
        climbing = np.ones(len(x), bool)
        open_ = np.flatnonzero((x < self.length) & (y < self.length))
        while len(open_):
            gone = []
            levels = lv[open_]
            for level_no in np.unique(levels).tolist():
                q = open_[levels == level_no]
                level = self.levels[level_no]
                a, b = i[q], j[q]
                inside = (a < len(level.symbol)) & (b < len(level.symbol))
                if not inside.all():  # one of them has come to the end of the sequence
                    gone.append(q[~inside])
                    q, a, b = q[inside], a[inside], b[inside]
                equal = level.symbol[a] == level.symbol[b]
                if level.up is not None:
                    up_a, up_b = level.up[a], level.up[b]
                    above = self.levels[level_no + 1].symbol
                    rise = equal & climbing[q] & (level.first[up_a] == a) & (level.first[up_b] == b)
                    rise &= above[up_a] == above[up_b]
                else:
                    rise = np.zeros(len(q), bool)
                    up_a = up_b = a
                lift = q[rise]
                lv[lift] += 1
                i[lift], j[lift] = up_a[rise], up_b[rise]
                step = equal & ~rise
                go, sa, sb = q[step], a[step], b[step]
                ahead = np.minimum(level.rest[sa], level.rest[sb])
                found[go] += level.start[sa + ahead] - level.start[sa]
                i[go], j[go] = sa + ahead, sb + ahead
                drop = q[~equal]
                if level_no == 0:
                    gone.append(drop)
                elif len(drop):
                    below = self.levels[level_no - 1]
                    i[drop], j[drop] = below.first[i[drop]], below.first[j[drop]]
                    lv[drop] -= 1
                    climbing[drop] = False  # whatever lies above begins with symbols that differ
            if gone:
                ended = np.zeros(len(found), bool)
                for g in gone:
                    ended[g] = True
                open_ = open_[~ended[open_]]
        return found
