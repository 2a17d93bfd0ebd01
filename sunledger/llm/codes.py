"""Product codes of vectors: each part of a vector becomes the number of its nearest codebook entry, found by a GNAT.

A vector is cut into equal parts. The codebook of a part position starts as that part of the first vectors and is refined in rounds: every
part goes to its nearest entry, then each entry becomes the floored mean of its parts. All components are whole numbers, so the result is the same
on any cluster.

Nearest entries are searched in a geometric near-neighbour access tree over the entries of a codebook: a node holds split points, each other
entry lies below its nearest split point, and for each pair (split point, subtree) the node stores the range of distances. A distance from the query
to a split point rules out all subtrees whose range lies strictly beyond the best distance so far. Ranges and distances are square roots, rounded
outwards, so nothing that could be as near is ruled out; what is compared in the end are squared distances as whole numbers, ties to the lower entry.

Rows are read once per round in place. What leaves a task are sums per (part, entry), what reaches the driver are the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sunledger.llm.common import map_arrow
from sunledger.llm.vectors import finite

SPLITS = 4  # split points of a node
LEAF = 3  # entries that are not worth a node
OUTWARDS = 2.0**-48  # relative: more than double precision loses in a square root of a whole number
SMALL = 1 << 24  # components below stay 64-bit numbers through all sums; others are Python's own whole numbers
BATCH_ROWS = 4000
STEP_NUMBERS = 1 << 21  # components of one numpy step
LIMB = 10**30  # sums cross the shuffle as two decimals, sum = high * LIMB + low


def whole(column: pa.Array, rows: int, factor: float) -> np.ndarray:
    """floor(factor * x) of equally long vectors, as rows of whole numbers; factor is a power of two, so nothing is rounded before."""
    x = np.floor(np.asarray(column.flatten(), np.float64).reshape(rows, -1) * factor)
    if x.size and (np.abs(x).max() >= SMALL or x.shape[1] >= 1 << 12):
        return np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    return x.astype(np.int64)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one point."""
    d = x - y
    return (d * d).sum(axis=1)


def roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above the square roots."""
    r = np.sqrt(squares.astype(np.float64))
    return r * (1 - OUTWARDS), r * (1 + OUTWARDS)


@dataclass
class Node:
    """Split points by entry number, their subtrees, and ``low``/``high`` [i][j]: distances of split point i to all entries of subtree j, its split point included."""

    splits: list[int]
    below: list[Node | list[int]]
    low: np.ndarray
    high: np.ndarray


def spread(entries: np.ndarray, members: list[int], n: int) -> list[int]:
    """``n`` members far from each other: each next one has the greatest distance to the nearest one taken; ties to the lower number."""
    taken = [members[0]]
    points = entries[members]
    nearest = squared(points, entries[taken[0]])
    while len(taken) < n:
        taken.append(members[int(np.argmax(nearest))])
        nearest = np.minimum(nearest, squared(points, entries[taken[-1]]))
    return taken


def gnat(entries: np.ndarray, members: list[int] | None = None, splits: int = SPLITS) -> Node | list[int]:
    """The tree over entries[members]; a short or undivided list stays a list. Equal entries may lie anywhere."""
    members = list(range(len(entries))) if members is None else members
    if len(members) <= max(LEAF, splits):
        return members
    chosen = spread(entries, members, splits)
    rest = [m for m in members if m not in set(chosen)]
    to_splits = np.stack([squared(entries[rest], entries[s]) for s in chosen])
    home = np.argmin(to_splits, axis=0)
    groups = [[m for m, h in zip(rest, home) if h == j] for j in range(splits)]
    low, high = np.zeros((splits, splits)), np.zeros((splits, splits))
    for i, s in enumerate(chosen):
        for j, group in enumerate(groups):
            lower, upper = roots(squared(entries[[chosen[j], *group]], entries[s]))
            low[i, j], high[i, j] = lower.min(), upper.max()
    return Node(chosen, [gnat(entries, g, splits) for g in groups], low, high)


def nearest(tree: Node | list[int], entries: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each point the number of its nearest entry, ties to the lower one, the squared distance, and how many distances were worked out."""
    n = len(points)
    best, which = np.zeros(n, points.dtype), np.full(n, -1)
    counted = 0

    def meet(rows: np.ndarray, entry: int) -> np.ndarray:
        nonlocal counted
        counted += len(rows)
        d = squared(points[rows], entries[entry])
        better = (which[rows] < 0) | (d < best[rows]) | ((d == best[rows]) & (entry < which[rows]))
        best[rows[better]], which[rows[better]] = d[better], entry
        return d

    def search(node: Node | list[int], rows: np.ndarray) -> None:
        if not len(rows):
            return
        if not isinstance(node, Node):
            for entry in node:
                meet(rows, entry)
            return
        alive = np.ones((len(node.splits), len(rows)), bool)
        met = np.zeros_like(alive)
        for i, entry in enumerate(node.splits):
            here = np.flatnonzero(alive[i])
            if not len(here):
                continue
            met[i, here] = True
            near, far = roots(meet(rows[here], entry))
            reach = roots(best[rows[here]])[1]
            for j in range(len(node.splits)):
                # The subtree's entries are at least this far from the point; its own split point may have been met already.
                gap = np.maximum(near - node.high[i, j], node.low[i, j] - far)
                alive[j, here[gap > reach]] = False
        for i, child in enumerate(node.below):
            search(child, rows[alive[i] & met[i]])

    search(tree, np.arange(n))
    return which, best, counted


def cut(column: pa.Array, rows: int, factor: float, parts: int) -> np.ndarray:
    """(row, part, component); a length that is no multiple of ``parts`` is filled up with zeros."""
    x = whole(column, rows, factor)
    width = -(-x.shape[1] // parts) if rows else 0
    filled = np.zeros((rows, width * parts), x.dtype)
    filled[:, : x.shape[1]] = x
    return filled.reshape(rows, parts, width)


Codebooks = dict[int, list[np.ndarray]]  # by vector length: for each part its entries


def compact(x: np.ndarray) -> np.ndarray:
    """64-bit numbers where they are small enough."""
    if x.dtype == object and not (np.abs(x) >= SMALL).any() and x.shape[-1] < 1 << 12:
        return x.astype(np.int64)
    return x


class Coder:
    """Codebooks with their trees, for one task."""

    def __init__(self, books: Codebooks, factor: float, parts: int):
        self.books, self.factor, self.parts = books, factor, parts
        self.trees = {dim: [gnat(entries) for entries in of] for dim, of in books.items()}

    def assign(self, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, row numbers, cut vectors, entry numbers (part, row), squared distances (part, row)), in steps of equally long vectors."""
        dims = vectors.value_lengths().to_numpy()
        for dim in np.unique(dims).tolist():
            every = np.flatnonzero(dims == dim)
            for at in range(0, len(every), step := max(1, STEP_NUMBERS // max(1, dim))):
                rows = every[at : at + step]
                x = cut(vectors.take(pa.array(rows)), len(rows), self.factor, self.parts)
                which, far = [], []
                for p, (tree, entries) in enumerate(zip(self.trees[dim], self.books[dim])):
                    points = x[:, p]
                    if points.dtype != entries.dtype:
                        points, entries = points.astype(object), entries.astype(object)
                    w, d, _ = nearest(tree, entries, points)
                    which.append(w)
                    far.append(d)
                yield dim, rows, x, np.array(which), np.array(far)


SUMS = "dim int, part int, entry int, place int, n bigint, high decimal(38,0), low decimal(38,0)"


def part_sums(batches: Iterator[pa.RecordBatch], coder: Coder) -> Iterator[pa.RecordBatch]:
    """Count and component sums of the parts at each entry that the task has seen."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for dim, _, x, which, _ in coder.assign(batch.column("vector")):
            if dim not in held:
                shape = (coder.parts, max(map(len, coder.books[dim])))
                held[dim] = np.zeros(shape, np.int64), np.zeros((*shape, x.shape[2]), object)
            n, sums = held[dim]
            for p in range(coder.parts):
                n[p] += np.bincount(which[p], minlength=n.shape[1])
                for e in np.unique(which[p]).tolist():
                    sums[p, e] += x[which[p] == e, p].sum(axis=0).astype(object)
    for dim, (n, sums) in held.items():
        p, e, c = np.nonzero(np.broadcast_to(n[:, :, None] > 0, sums.shape))
        values = [int(v) for v in sums[p, e, c]]
        exact = pa.decimal128(38, 0)
        columns = [np.full(len(p), dim, np.int32), p.astype(np.int32), e.astype(np.int32), c.astype(np.int32), n[p, e]]
        limbs = [pa.array([Decimal(v // LIMB) for v in values], exact), pa.array([Decimal(v % LIMB) for v in values], exact)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *limbs], names=["dim", "part", "entry", "place", "n", "high", "low"])


def prepared(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.where(finite(F.col(vector))).withColumn("vector", F.col(vector).cast("array<double>"))


@dataclass(frozen=True)
class ProductCode:
    """Fitted codebooks by vector length."""

    books: Codebooks
    factor: float
    parts: int

    def digest(self, dim: int) -> str:
        """SHA-256 of all entries as decimal numbers, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for of in self.books[dim] for v in of.reshape(-1)).encode()).hexdigest()

    def digests(self, vector: Column) -> Column:
        """The digest of the codebooks that a vector is coded with."""
        none = F.lit(None).cast("string")
        return F.coalesce(none, *[F.when(F.size(vector) == dim, F.lit(self.digest(dim))) for dim in sorted(self.books)])

    def encode(self, vectors: DataFrame, vector: str = "embedding", code: str = "code", error: str = "error") -> DataFrame:
        """The rows of ``vectors`` that can be coded, with two more columns: the code (two hexadecimal digits per part) and the squared distance
        between the vector and its entries, all parts together (NULL where it exceeds 64 bits).

        Rows whose vector is NULL or holds a NULL or non-finite component are left out, all other rows stay, repeated ones too. Other columns pass
        through unread; the new names must not be among them. A vector of a length that was not fitted is an error.
        """
        clash = {code, error} & set(vectors.columns)
        if clash:
            raise ValueError(f"columns {sorted(clash)} exist already")
        coder, at = Coder(self.books, self.factor, self.parts), vectors.columns.index(vector)
        rows = vectors.where(finite(F.col(vector)))

        def run(batches):
            for batch in batches:
                codes, errors = np.empty(batch.num_rows, object), np.empty(batch.num_rows, object)
                doubles = batch.column(at).cast(pa.list_(pa.float64()))
                for _, held, _, which, far in coder.assign(doubles):
                    codes[held] = [bytes(w).hex() for w in which.T.tolist()]
                    errors[held] = [v if v < 1 << 63 else None for v in map(int, far.sum(axis=0))]
                made = [pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, code, error])

        return map_arrow(rows, run, StructType([*vectors.schema.fields, StructField(code, StringType()), StructField(error, LongType())]), rows=BATCH_ROWS)

    def decode(self, code: str, dim: int) -> list[float]:
        """The vector that a code stands for: the middle of each floored component's step."""
        entries = [self.books[dim][p][e] for p, e in enumerate(bytes.fromhex(code))]
        return ((np.concatenate(entries)[:dim].astype(np.float64) + 0.5) / self.factor).tolist()


def fit(vectors: DataFrame, vector_id: str = "vec_id", vector: str = "embedding", factor: float = 4096.0, parts: int = 8, entries: int = 16, rounds: int = 6) -> ProductCode:
    """Codebooks of ``entries`` for each of ``parts`` positions, after ``rounds`` of assigning all vectors and taking floored means.

    Components are floor(factor * x). The codebooks start as the parts of the first vectors by id (NULL ids last, equal ids by vector); an entry
    that nothing is nearest to stays. Vectors that are NULL or hold NULL or non-finite components take no part. Vectors of different lengths have
    codebooks of their own, so a table should have few lengths; a length that ``parts`` does not divide is filled up with zeros. A table without
    usable rows gives no codebooks. ``factor`` must be a power of two and ``entries`` at most 256.

    The rows are read once per round where they lie; hand in a table, not a costly plan.
    """
    if not 1 <= entries <= 256 or np.frexp(factor)[0] != 0.5:
        raise ValueError("entries must be 1 to 256, and factor a power of two")
    rows = prepared(vectors.select(F.col(vector_id).alias("id"), F.col(vector).alias("given")), "given").select("id", "vector")
    books: Codebooks = {}
    for (dim,) in sorted(rows.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1))).select("dim").collect()):
        first = rows.where(F.size("vector") == dim).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
        x = cut(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), len(first), factor, parts)
        books[dim] = [x[:, p] for p in range(parts)]
    for _ in range(rounds if books else 0):
        coder = Coder(books, factor, parts)
        sums = map_arrow(rows.select("vector"), lambda batches: part_sums(batches, coder), SUMS, rows=BATCH_ROWS)
        whole_sums = sums.groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
        # At most parts * entries * width rows: the size of the codebooks.
        new = {dim: [of.astype(object) for of in books[dim]] for dim in books}
        for r in whole_sums.collect():
            new[r["dim"]][r["part"]][r["entry"], r["place"]] = (int(r["high"]) * LIMB + int(r["low"])) // r["n"]
        new = {dim: [compact(of) for of in new[dim]] for dim in new}
        same = all((a == b).all() for dim in books for a, b in zip(books[dim], new[dim]))
        books = new
        if same:  # every later round would give the same codebooks
            break
    return ProductCode(books, factor, parts)


def compressed_sql(factor: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The query as SQL over ``embeddings`` (one vector length): every part is compared with every entry."""
    steps = []
    for t in range(1, rounds + 2):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, part, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM
          (SELECT p.r, part, c.e, sum((p.c - c.c) * (p.c - c.c)) AS d FROM p JOIN c{t - 1} AS c USING (part, place) GROUP BY ALL) GROUP BY ALL)""")
        if t <= rounds:
            steps.append(f"""c{t} AS MATERIALIZED (SELECT part, c.e, place, coalesce(m.c, c.c) AS c FROM c{t - 1} AS c LEFT JOIN
              (SELECT part, e, place, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c FROM
                (SELECT part, a.e, place, sum(c) AS s, count(*) AS n FROM p JOIN a{t} AS a USING (r, part) GROUP BY ALL)) AS m USING (part, e, place))""")
    return f"""WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, embedding FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      p AS MATERIALIZED (SELECT r, i // (d // {parts}) AS part, i % (d // {parts}) AS place, c FROM
          (SELECT r, len(embedding) AS d, unnest(range(len(embedding))) AS i, unnest(list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT))) AS c FROM k)),
      c0 AS MATERIALIZED (SELECT part, r - 1 AS e, place, c FROM p WHERE r <= {entries}),
      {", ".join(steps)},
      o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM k JOIN a{rounds + 1} USING (r) GROUP BY r, vec_id, label)
      SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, e, place)) FROM c{rounds}) AS codebooks_sha256 FROM o"""
