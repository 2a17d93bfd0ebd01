"""Periodic runs of words, found on a harmonic grid and extended exactly by common extensions in a run-length grammar.

A run of period p holds a stretch in which each word equals the one p words on. The stretch is so long that for every p one of few grid places lies in
it; for all p together these are in the order of n log n candidates. A candidate whose first few words do not match is no run. The others ask the grammar
(``recompression``) how far the match goes to both sides, which is the run. Multiples of a period find the same stretch and fold into the smallest.

The work of a text does not meet that of another: no shuffle, one pass, and each step holds about ``TEXT_BATCH_BYTES`` characters (a longer text is a step of its own).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sunledger.llm.common import map_arrow, text_steps
from sunledger.llm.recompression import Grammar

CANDIDATES = 1 << 20  # candidates of one numpy step
GLANCE = 4  # words of a candidate that are compared before the grammar is asked

RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def interned(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, all words as numbers in one row with a separator (-1) behind each text, and the first place of each text."""
    known: dict[bytes, int] = defaultdict(count().__next__)
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at the six ASCII blanks
    numbers: list[int] = []
    first = np.zeros(len(texts) + 1, np.int64)
    for k, w in enumerate(words):
        numbers.extend(map(known.__getitem__, w))
        numbers.append(-1)
        first[k + 1] = len(numbers)
    return words, np.array(numbers, np.int32), first


def grid(sizes: np.ndarray, least: int, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place in it, period, words that must match from there on) of all candidates, in steps; periods of a text ascend."""
    periods = np.where(sizes >= least, sizes // repeats, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    p = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    stretch = np.maximum(least, repeats * p) - p  # words that each equal the one p words on, in the shortest run
    stride = np.maximum(1, stretch // 2)
    need = stretch - stride + 1  # the first grid place of a stretch is that far from its end
    places = np.maximum(0, (sizes[text] - p - need) // stride + 1)
    through = np.cumsum(places)
    at = 0
    while at < len(text):
        done = through[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(through, done + CANDIDATES, "right")))
        n = places[at:to]
        k = np.arange(through[to - 1] - done) - np.repeat(np.cumsum(n) - n, n)
        yield tuple(np.repeat(c[at:to], n) * (k if c is stride else 1) for c in (text, stride, p, need))
        at = to


def glanced(sequence: np.ndarray, first: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the sequence, period) of the candidates whose first words match."""
    out = [(np.zeros(0, np.int64),) * 3]
    for text, place, p, need in grid(np.diff(first) - 1, least, repeats):
        place = first[text] + place
        for t in range(GLANCE):
            same = (sequence[place + np.minimum(t, need - 1)] == sequence[place + p + np.minimum(t, need - 1)]).nonzero()[0]
            text, place, p, need = text[same], place[same], p[same], need[same]
        out.append((text, place, p))
    return tuple(np.concatenate(c) for c in zip(*out))


def runs_of(sequence: np.ndarray, first: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start in it, length, period) of all runs of a row of texts, by text, start and period."""
    text, place, p = glanced(sequence, first, least, repeats)
    if not len(text):
        return text, place, place, p
    # The grammar holds the texts that have a candidate.
    asked = np.unique(text)
    sizes = first[asked + 1] - first[asked]
    begin = np.cumsum(sizes) - sizes
    own = np.concatenate([sequence[first[t] : first[t + 1]] for t in asked.tolist()])
    shift = np.zeros(len(first), np.int64)
    shift[asked] = begin - first[asked]
    grammar = Grammar(own)
    mirrored = grammar.mirrored()
    found = []
    for at in range(0, len(text), CANDIDATES):
        t, x, q = text[at : at + CANDIDATES], place[at : at + CANDIDATES] + shift[text[at : at + CANDIDATES]], p[at : at + CANDIDATES]
        ahead = grammar.common(x, x + q)
        back = mirrored.common(len(own) - x, len(own) - x - q)
        start, length = x - back - shift[t] - first[t], back + q + ahead
        keep = length >= np.maximum(least, repeats * q)
        rows = np.stack([t[keep], start[keep], length[keep], q[keep]], axis=1)
        found.append(np.unique(rows, axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    # The smallest period of a stretch divides all others that it is long enough for.
    smallest = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)] if len(rows) else np.zeros(0, bool)
    rows = rows[smallest]
    order = np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))
    return tuple(rows[order].T)


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> str:
    """The words of a text that no run holds after its first period, joined by one space."""
    if len(start):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def find_runs(docs: DataFrame, text: str = "text", least: int = 24, repeats: int = 3, runs: str = "runs", rest: str = "collapsed") -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) by start, then period, and ``rest``, the text without what runs repeat.

    Words are stretches of characters other than the six ASCII blanks, numbered from 0. A run is a stretch of words with smallest period p and
    at least ``least`` and ``repeats`` * p words (``repeats`` >= 2) that no word beside it extends with that period. ``rest`` keeps the words that no run
    holds after its first p words, joined by one space.

    A NULL, empty or blank text has no run and an empty rest; rows may repeat; a table without rows gives none. All other columns pass
    through unread; the new names must not be among them. Work and memory of a text grow with n log n of its words.
    """
    clash = {runs, rest} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    if least < 2 or repeats < 2:
        raise ValueError("a run has two words and repeats its period at least")
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            arrays, rests = [], []
            for _, texts in text_steps(batch.column(at)):
                words, sequence, first = interned(texts)
                t, start, length, period = runs_of(sequence, first, least, repeats)
                bounds = np.searchsorted(t, np.arange(len(texts) + 1))
                for k, w in enumerate(words):
                    own = slice(bounds[k], bounds[k + 1])
                    rests.append(collapsed(w, start[own], length[own], period[own]))
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays([pa.array(np.asarray(c, np.int64)) for c in (start, length, period)], names=RUN.names)))
            found = pa.concat_arrays(arrays) if arrays else pa.array([], pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names])))
            yield pa.RecordBatch.from_arrays([*batch.columns, found, pa.array(rests, pa.string())], names=[*batch.schema.names, runs, rest])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(runs, ArrayType(RUN)), StructField(rest, StringType())]), rows=500)
