"""Helpers shared by the corpus operators: batches, ids, hashing of text as numpy arrays, written tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_BATCH_BYTES = 400_000  # characters of one numpy step; a longer text is a step of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column has it (Spark does not tell case apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_steps(texts: pa.Array | pa.ChunkedArray, limit: int = TEXT_BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in steps of about ``limit`` characters; NULL becomes ''."""
    start, size, step = 0, 0, []
    for i, scalar in enumerate(texts):
        text = scalar.as_py() or ""
        if step and size + len(text) > limit:
            yield start, step
            start, size, step = i, 0, []
        step.append(text)
        size += len(text)
    if step:
        yield start, step


def arrow_rows(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches on their way to a worker hold at most ``BATCH_BYTES`` (or one row), in the JVM and in the worker; a session with a lower bound keeps it."""
    now = spark.conf.get(BATCH_BYTES_KEY, None)
    if now is None or now == f"{64 << 20}b":  # Spark's default
        spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))


_HELD: dict[str, dict] = {}  # of this worker process: what is made once for many tasks, by kind


def held(kind: str, key: str, make: Callable):
    """What ``make`` gives, made once in a worker process and kept until a task of an operator without that ``kind`` begins in it."""
    own = _HELD.setdefault(kind, {})
    if key not in own:
        own[key] = make()
    return own[key]


def let_go(kept: str | None) -> None:
    """Drop what the tasks of other operators left in this process; workers live on to later stages and jobs."""
    others = [kind for kind in _HELD if kind != kept]
    for kind in others:
        del _HELD[kind]
    if others:
        give_back()


def give_back() -> None:
    """Memory that nothing holds goes back to the system (with glibc also what its allocator keeps)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn: Callable, schema: str, rows: int = 2000, holds: str | None = None) -> DataFrame:
    """``mapInArrow`` with batches of bounded rows and bytes. ``holds`` is the kind of what its tasks keep in their processes (``held``)."""
    bound_batches(df.sparkSession)

    def run(batches):
        let_go(holds)
        yield from fn(arrow_rows(batches, rows))
        give_back()

    return df.mapInArrow(run, schema)


MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
S33 = np.uint64(33)
GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads the bits of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> S33
        x *= MIX_A
        x ^= x >> S33
        x *= MIX_B
        x ^= x >> S33
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _grown(key: str, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        have = powers(base, max(n, 1 << 16))
        if n <= 8_000_000:
            _POWERS[key] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[start:end] for many spans, by prefix sums of a polynomial modulo 2**64."""
    n = len(values)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(values.astype(np.uint64) + np.uint64(1)) * _grown("up", BASE, n), out=sums[1:])
        flat = (sums[ends] - sums[starts]) * _grown("down", INVERSE, n + 1)[starts]
        return mix64(flat + (ends - starts).astype(np.uint64) * MIX_A)


SPACES = np.zeros(0x110000, bool)
SPACES[[c for c in range(0x3001) if chr(c).isspace()]] = True


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters of the texts as numbers, each text followed by one line feed, and the first place of each text (one more at the end)."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    firsts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
    return codes, firsts


def words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of characters that are no white space."""
    solid = np.zeros(len(codes) + 2, np.int8)
    solid[1:-1] = ~SPACES[codes]
    edges = np.diff(solid)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def distinct_sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each run of equal keys, and the run lengths."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return first, np.diff(np.r_[first, len(keys)])
