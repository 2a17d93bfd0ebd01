"""Suffix sorting by external induced sorting, with common-prefix values carried along.

Positions are split into L- and S-type; the leftmost S positions (S*) are sorted by their substrings, named, and, if names
repeat, sorted by recursion on the string of names. Both the substrings and in the end all suffixes are induced: suffixes
leave a priority queue in ascending order and put the one that begins a place earlier back in (and once more in descending order).

The queue lies on disk. Its key is (first symbol, order of arrival), so its order is known beforehand: each symbol has a run of
slots, filled from one end. It is popped in blocks: as many tuples at once as none of them pushes into. All arrays longer than
``MEMORY`` bytes are files of the scratch folder and are read and written in blocks, so a text may be far larger than memory; only
arrays over the symbols of the text itself (not of its strings of names) stay in memory. Prefixes of neighbouring S* suffixes are
compared in the text, up to the cap, after the recursion has sorted them.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np

MEMORY = 1 << 22
LEAST_BLOCK, MOST_BLOCK = 512, 1 << 17
SHORT = 1024  # strings of names up to this length are sorted directly
FAR = np.int16(32767)


class Scratch:
    """Arrays on the task's own disk; private to the task and gone with it, like Spark's own spill files."""

    def __enter__(self):
        self.folder, self.number = tempfile.TemporaryDirectory(prefix="suffix-"), 0
        return self

    def __exit__(self, *_):
        self.folder.cleanup()

    def array(self, n: int, kind, fill=None) -> np.ndarray:
        if n * np.dtype(kind).itemsize <= MEMORY:
            out = np.empty(n, kind)
        else:
            self.number += 1
            path = os.path.join(self.folder.name, str(self.number))
            out = np.memmap(path, kind, "w+", shape=(n,))
            os.unlink(path)  # the space is free as soon as the array is
        if fill is not None:
            out[:] = fill
        return out


def blocks(n: int, backwards: bool = False) -> Iterator[tuple[int, int]]:
    """Ranges of ``MOST_BLOCK`` places that cover ``n``."""
    starts = range(0, n, MOST_BLOCK)
    for a in reversed(starts) if backwards else starts:
        yield a, min(a + MOST_BLOCK, n)


def s_types(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last is, by definition."""
    n = len(text)
    out = scratch.array(n, bool)
    out[n - 1] = True
    later = 1  # the sign of the next change behind the block
    for a, b in blocks(n - 1, backwards=True):
        change = np.sign(np.diff(text[a : b + 1].astype(np.int64)))
        places = np.where(change != 0, np.arange(b - a), b - a)
        change = np.r_[change, later][np.minimum.accumulate(places[::-1])[::-1]]
        out[a:b] = change > 0
        later = change[0]
    return out


def place_kind(n: int) -> type:
    return np.int32 if n < 2**31 else np.int64


def counts_of(text: np.ndarray, symbols: int, scratch: Scratch, is_s: np.ndarray | None = None) -> np.ndarray:
    """How often each symbol stands in the text, or begins an L-type suffix."""
    out = scratch.array(symbols, place_kind(len(text)), 0)
    for a, b in blocks(len(text)):
        some = text[a:b] if is_s is None else text[a:b][~is_s[a:b]]
        found, times = np.unique(some, return_counts=True)
        out[found] += times
    return out


def added_up(counts: np.ndarray, scratch: Scratch) -> np.ndarray:
    out, total = scratch.array(len(counts) + 1, counts.dtype), 0
    out[0] = 0
    for a, b in blocks(len(counts)):
        out[a + 1 : b + 1] = np.cumsum(counts[a:b], dtype=np.int64) + total
        total = int(out[b])
    return out


def ranks_in_groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by key, first index of each key's group in it, and the place within the group."""
    n = len(keys)
    order = keys.argsort(kind="stable")
    ordered = keys[order]
    new = np.empty(n, bool)
    new[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    first = new.nonzero()[0]
    rank = np.arange(n)
    if len(first) < n:
        rank -= first[new.cumsum() - 1]
    else:
        rank[:] = 0
    return order, first, rank


class RangeMinimum:
    """Minima of ranges of a short array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of values[a:b]; FAR where empty."""
        out = np.full(len(a), FAR)
        size = b - a
        for level in range(len(self.levels)):
            here = (size >= 1 << level) & ((size < 2 << level) | (level == len(self.levels) - 1))
            if here.any():
                v = self.levels[level]
                out[here] = np.minimum(v[a[here]], v[b[here] - (1 << level)])
        return out


class Gathered:
    """values[places], a block at a time."""

    def __init__(self, values: np.ndarray, places: np.ndarray):
        self.values, self.places = values, places

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, some: slice) -> np.ndarray:
        return self.values[self.places[some]]


def chosen(which: Callable[[int, int], np.ndarray], n: int, scratch: Scratch) -> np.ndarray:
    """Places below ``n`` for which ``which(a, b)`` holds."""
    out, at = scratch.array(sum(int(np.count_nonzero(which(a, b))) for a, b in blocks(n)), place_kind(n)), 0
    for a, b in blocks(n):
        found = np.flatnonzero(which(a, b)) + a
        out[at : at + len(found)] = found
        at += len(found)
    return out


class InducedQueue:
    """The disk-backed queue of one string: its slots in the order of the suffixes, and the common prefix of each slot with the one before."""

    def __init__(self, text: np.ndarray, is_s: np.ndarray, symbols: int, scratch: Scratch, cap: int | None):
        self.text, self.is_s, self.cap, self.scratch = text, is_s, cap, scratch
        self.starts = added_up(counts_of(text, symbols, scratch), scratch)
        self.smaller = counts_of(text, symbols, scratch, is_s)  # L-type suffixes of a symbol stand first
        self.slots = scratch.array(len(text), place_kind(len(text)), -1)
        self.prefix = None
        if cap is not None:
            self.prefix = scratch.array(len(text), np.int16, FAR)

    def seed(self, suffixes: np.ndarray, prefix: np.ndarray | None = None) -> None:
        """Place S* suffixes at the ends of their symbols, those of a symbol in the given order; ``prefix`` is what each shares with the one before."""
        left = counts_of(Gathered(self.text, suffixes), len(self.smaller), self.scratch)
        if self.prefix is not None:
            held = chosen(lambda a, b: left[a:b] > 0, len(left), self.scratch)
            firsts, befores = (self.scratch.array(len(held), np.int64) for _ in range(2))
            for a, b in blocks(len(held)):
                h = held[a:b]
                firsts[a:b] = self.starts[h + 1] - left[h]
                # The first of a symbol stands after an L-type suffix of that symbol, or after another symbol.
                befores[a:b] = self.starts[h] + self.smaller[h] - 1
            self.seams = firsts, befores
        for a, b in blocks(len(suffixes)):
            some = suffixes[a:b]
            symbols = self.text[some].astype(np.int64)
            order, first, rank = ranks_in_groups(symbols)
            symbols = symbols[order]
            slot = self.starts[symbols + 1] - left[symbols] + rank
            self.slots[slot] = some[order]
            if prefix is not None:
                self.prefix[slot] = prefix[a:b][order]
            left[symbols[first]] -= np.diff(np.r_[first, len(symbols)])
        if self.prefix is not None:
            for a, b in blocks(len(firsts)):
                self.prefix[firsts[a:b]] = 0

    def _run(self, places: np.ndarray) -> np.ndarray:
        """How often the first symbol of the suffixes repeats, at most ``cap``."""
        places = places.astype(np.int64)
        out, active = np.full(len(places), self.cap, np.int16), np.arange(len(places))
        for offset in range(1, self.cap):
            x = places[active] + offset
            equal = x < len(self.text)
            equal[equal] = self.text[x[equal]] == self.text[places[active[equal]]]
            out[active[~equal]] = offset
            active = active[equal]
            if not len(active):
                break
        return out

    def _seam(self, low: int, high: int) -> None:
        """Both sides of a seam begin with a run of its symbol, and go on with a smaller or a larger one."""
        slot, before = self.seams
        a, b = np.searchsorted(slot, (low, high))
        if a < b:
            s, p = slot[a:b], before[a:b]
            some = (p >= 0) & (p >= self.starts[self.text[self.slots[s]].astype(np.int64)])
            s, p = s[some], p[some]
            self.prefix[s] = np.minimum(self._run(self.slots[s]), self._run(self.slots[p]))

    def induce(self, ascending: bool) -> None:
        """One pass: L-type suffixes in ascending order, or S-type in descending order."""
        n, sign = len(self.slots), 1 if ascending else -1
        edge = self.scratch.array(len(self.starts) - 1, self.starts.dtype)
        for a, b in blocks(len(edge)):
            edge[a:b] = self.starts[a:b] if ascending else self.starts[a + 1 : b + 1] - 1
        if not ascending:
            self._clear()
        if self.prefix is not None:
            # Only the text itself has prefixes, and its symbols are few.
            waiting = np.full(len(edge), FAR)  # per symbol, the least prefix met since its last push
            last_slot = np.full(len(edge), -1)
        at, size = (0 if ascending else n - 1), LEAST_BLOCK
        while 0 <= at < n:
            to = min(at + size, n) if ascending else max(at - size, -1)
            low, high = (at, to) if ascending else (to + 1, at + 1)
            if self.prefix is not None:
                self._seam(low, high)
            block = self.slots[low:high][::sign]
            k = (block > 0).nonzero()[0]
            before = block[k].astype(np.int64) - 1
            wanted = self.is_s[before]
            if ascending:
                wanted = ~wanted
            k, before = k[wanted], before[wanted]
            symbols = self.text[before].astype(np.int64)
            end, slot = to, k
            if len(k):
                order, _, rank = ranks_in_groups(symbols)
                slot = np.empty(len(k), np.int64)
                slot[order] = edge[symbols[order]] + sign * rank
                # A tuple leaves with this block only if none before it in the block was put in at or before its place.
                nearest = np.minimum.accumulate(sign * slot)
                held = (sign * at + k[1:] >= nearest[:-1]).nonzero()[0]
                m = int(held[0]) + 1 if len(held) else len(k)
                stop = sign * int(nearest[m - 1])
                end = min(to, stop) if ascending else max(to, stop)
                k, before, symbols, slot = k[:m], before[:m], symbols[:m], slot[:m]
            if self.prefix is not None:
                self._carry(at, end, sign, k, symbols, slot, waiting, last_slot)
            if len(k):
                self.slots[slot] = before
                edge[symbols] = slot + sign  # the last of a symbol stays
            size = min(2 * size, MOST_BLOCK) if end == to else max(LEAST_BLOCK, 2 * abs(end - at))
            at = end

    def _carry(self, at, end, sign, k, symbols, slot, waiting, last_slot) -> None:
        """Common prefixes of pushed tuples: one more than the least value between their sources."""
        low, high = (at, end) if sign > 0 else (end + 1, at + 1)
        met = self.prefix[low:high][::sign]
        if sign < 0:
            # Going down, the value between a slot and the one below it is met only after the slot itself.
            met = np.r_[self.prefix[high] if high < len(self.prefix) else FAR, met[:-1]]
        minima = RangeMinimum(met)
        if len(k):
            order, first, _ = ranks_in_groups(symbols)
            place, group = k[order], symbols[order]
            start = np.r_[0, place[:-1] + 1]
            start[first] = 0
            least = minima(start, place + 1)
            least[first] = np.minimum(least[first], waiting[group[first]])
            value = np.minimum(least.astype(np.int32) + 1, self.cap).astype(np.int16)
            if sign > 0:
                value[first] = np.where(last_slot[group[first]] < 0, 0, value[first])
                self.prefix[slot[order]] = value
            else:
                upper = np.r_[-1, slot[order][:-1]]
                upper[first] = last_slot[group[first]]
                there = upper >= 0
                self.prefix[slot] = 0  # until the next smaller of the symbol comes, or the seam
                self.prefix[upper[there]] = value[there]
            last = np.r_[first[1:], len(k)] - 1
            hit = group[first]
            last_slot[hit] = slot[order][last]
            rest = minima(place[last] + 1, np.full(len(last), len(met)))
        np.minimum(waiting, met.min() if len(met) else FAR, out=waiting)
        if len(k):
            waiting[hit] = rest

    def _clear(self) -> None:
        """Forget the seeds before the descending pass finds all S-type suffixes anew."""
        last = self.slots[0]
        for a, b in blocks(len(self.slots)):
            places = np.arange(a, b)
            symbol = np.searchsorted(self.starts, places, "right") - 1
            drop = places >= self.starts[symbol] + self.smaller[symbol]
            self.slots[a:b][drop] = -1
            if self.prefix is not None:
                self.prefix[a:b][drop] = 0
        self.slots[0] = last
        if self.prefix is not None:
            held = np.flatnonzero((np.diff(self.starts) > self.smaller) & (self.smaller > 0))
            self.seams = self.starts[held] + self.smaller[held], self.starts[held] + self.smaller[held] - 1


def names_of(text: np.ndarray, ordered: np.ndarray, end_of: Callable[[np.ndarray], np.ndarray], scratch: Scratch) -> np.ndarray:
    """Rank of each of the ordered substrings text[p : end_of(p)]; equal ones share it."""
    names, last = scratch.array(len(ordered), np.int32), 0
    for a, b in blocks(len(ordered)):
        some = ordered[max(a - 1, 0) : b].astype(np.int64)  # with the one before the block
        length = end_of(some) - some
        same = np.r_[False, length[1:] == length[:-1]]
        pairs = np.flatnonzero(same)
        offset = 0
        while len(pairs):
            equal = text[some[pairs] + offset] == text[some[pairs - 1] + offset]
            same[pairs[~equal]] = False
            offset += 1
            pairs = pairs[equal & (offset < length[pairs])]
        found = np.cumsum(~same) - 1 + last
        names[a:b] = found[min(a, 1) :]
        last = int(found[-1])
    return names


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Symbols that the suffixes at a and b share, at most ``cap``."""
    out = np.full(len(a), cap, np.int16)
    active, n = np.arange(len(a)), len(text)
    for offset in range(cap):
        x, y = a[active] + offset, b[active] + offset
        equal = (x < n) & (y < n)
        equal[equal] = text[x[equal]] == text[y[equal]]
        out[active[~equal]] = offset
        active = active[equal]
        if not len(active):
            break
    return out


def suffix_array(text: np.ndarray, symbols: int, scratch: Scratch, cap: int | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Sorted suffixes of a text that ends in its only 0, and what each shares with the one before (up to ``cap``)."""
    n = len(text)
    if cap is None and n <= SHORT:
        data = text.astype(">u4").tobytes()
        return np.array(sorted(range(n), key=lambda i: data[4 * i :])), None
    is_s = s_types(text, scratch)
    starred = chosen(lambda a, b: is_s[a:b] & ~np.r_[is_s[a - 1] if a else True, is_s[a : b - 1]], n, scratch)
    queue = InducedQueue(text, is_s, symbols, scratch, None)
    if n == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int16)
    queue.seed(starred)
    queue.induce(True)
    queue.induce(False)
    ordered, at = scratch.array(len(starred), place_kind(n)), 0
    for a, b in blocks(n):
        block = queue.slots[a:b]
        found = block[(block > 0) & is_s[block] & ~is_s[block - 1]]
        ordered[at : at + len(found)] = found
        at += len(found)
    del queue
    if len(starred) > 1:

        def end_of(places: np.ndarray) -> np.ndarray:
            following = np.searchsorted(starred, places.astype(starred.dtype)) + 1
            return np.where(following < len(starred), starred[np.minimum(following, len(starred) - 1)].astype(np.int64) + 1, n)

        names = names_of(text, ordered, end_of, scratch)
        if names[-1] + 1 < len(names):
            reduced = scratch.array(len(names), np.int32)
            for a, b in blocks(len(names)):
                reduced[np.searchsorted(starred, ordered[a:b])] = names[a:b]
            most = int(names[-1]) + 1
            del names, ordered
            order, _ = suffix_array(reduced, most, scratch)
            del reduced
            ordered = scratch.array(len(order), place_kind(n))
            for a, b in blocks(len(order)):
                ordered[a:b] = starred[order[a:b]]
            del order
        else:
            del names
    del starred
    queue = InducedQueue(text, is_s, symbols, scratch, cap)
    shared = None
    if cap is not None:
        shared = scratch.array(len(ordered), np.int16)
        for a, b in blocks(len(ordered)):
            some = ordered[a:b].astype(np.int64)
            shared[a:b] = common_prefix(text, some, np.r_[ordered[a - 1] if a else 0, some[:-1]].astype(np.int64), cap)
    queue.seed(ordered, shared)
    queue.induce(True)
    queue.induce(False)
    return queue.slots, queue.prefix
