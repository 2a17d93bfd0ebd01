"""Near-duplicate embeddings by int8 tiles with rigorous error bounds, and exact top-k search by histogram selection.

Both cut the vectors into blocks of bounded size and let each task meet one pair of blocks (a tile).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.graph import components, forest
from sunledger.session import materialize

BLOCK_ROWS = 2048


def finite(v: Column) -> Column:
    """Not NULL, and without a NULL or non-finite component."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """A column of equally long vectors as rows of doubles."""
    return np.asarray(column.combine_chunks().flatten(), np.float64).reshape(rows, -1) if rows else np.zeros((0, 0))


# ------------------------------------------------------------------ near-duplicates


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scale of each row, and an upper bound of the length of what rounding took from the row."""
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None]).astype(np.int8)
    error = np.sqrt(((u - codes * scale[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9) + 1e-12
    return codes, scale, error


def int_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes: single precision holds sums of up to 1,024 of them without rounding."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        out += a[:, at : at + 1024].astype(np.float32) @ b[:, at : at + 1024].astype(np.float32).T
    return out


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float, chunk: int = 100_000) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs with cosine >= threshold. With unit rows u = s p + e and v = t q + f, u.v differs from the tile product
    s t (p.q) by e.v + (s p).f, which is at most |e| + (1 + |e|) |f|. Only pairs that may reach the threshold are computed in double."""
    nx, ny = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1))
    p, s, e = quantise(x / nx[:, None])
    q, t, f = quantise(y / ny[:, None])
    upper = int_products(p, q) * s[:, None] * t + (e[:, None] + (1 + e[:, None]) * f)
    i, j = np.nonzero(upper >= threshold - 1e-9)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), chunk):
        a, b = i[at : at + chunk], j[at : at + chunk]
        keep[at : at + chunk] = np.einsum("ij,ij->i", x[a], y[b]) / (nx[a] * ny[b]) >= threshold
    return i[keep], j[keep]


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links (other rows with the same label and cosine >= threshold),
    component_id (smallest vec_id reachable by links), kept (vec_id = component_id).

    Equal vectors of a label fold into one that carries their number, so thousands of copies cost one row. A tile gives back
    one row per linked vector: how many links it saw, and the root of its component within the tile, never the pairs.
    A NULL label, a NULL, empty or zero vector, NULL or non-finite components and vectors of other lengths link with nothing.
    A NULL vec_id takes no part: 0 links, component_id NULL, kept. Repeated rows are other rows with the same id.
    Other columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.col("label"))
    usable = finite(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    folded = rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    folded = materialize(folded.withColumn("dim", F.size("embedding")), "folded-vectors")
    sizes = folded.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    placed = folded.join(sizes, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "dim", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"), (F.col("own") > F.col("other")).alias("right"), "rep", "copies", "embedding"
    )

    def tile(t: pa.Table) -> pa.Table:
        reps, copies = t["rep"].to_numpy(), t["copies"].to_numpy()
        x, right = matrix(t["embedding"], len(reps)), np.asarray(t["right"])
        diagonal = t["ti"][0].as_py() == t["tj"][0].as_py()
        a = np.flatnonzero(~right)
        b = a if diagonal else np.flatnonzero(right)
        i, j = linked_pairs(x[a], x[b], threshold) if len(a) and len(b) else (a[:0], a[:0])
        i, j = a[i], b[j]
        if diagonal:
            i, j = i[i != j], j[i != j]
        n = np.bincount(i, copies[j], len(reps))
        if not diagonal:
            n = n + np.bincount(j, copies[i], len(reps))
        held = np.flatnonzero(n)
        return pa.table({"rep": reps[held], "n": n[held].astype(np.int64), "root": reps[forest(len(reps), i, j)[held]]})

    found = materialize(tiles.groupBy("label", "dim", "ti", "tj").applyInArrow(tile, "rep bigint, n bigint, root bigint"), "tile-links")
    # A vec_id may stand at two labels in repeated rows, so links go by id and counts by (label, vector).
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    folded_out = folded.join(counts, "rep", "left").join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    folded_out = folded_out.select("label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = rows.where("usable").join(folded_out, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


# ------------------------------------------------------------------ top-k


BINS = 512


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 256.0, query_rows: int = 1024, block_rows: int = 4096) -> DataFrame:
    """The k rows with the highest integer inner product for each query: query_id, rank, vec_id, score.

    Vectors of (vec_id, embedding) become floor(factor * x). Every pass scores all queries against all rows, block by
    block. The first passes count scores in ``BINS`` bins of the range that still holds each query's k-th value, until a bin is
    one score wide; a tile leaves out the bins that lie below its own k-th score, which cannot matter. The last pass keeps what
    is above the k-th value and, of those equal to it, the k smallest ids of each tile; ties go to the smaller vec_id.

    Vectors that are NULL or hold NULL or non-finite components take no part, as do NULL ids; vectors meet only vectors of
    their length; a query has fewer than k rows if there are fewer. A query id that repeats is asked once, with its smallest
    vector; rows with the query's id are its own. Scores must fit 64-bit integers.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    rows = rows.withColumn("dim", F.size("embedding"))
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * factor).cast("double"), 2))
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    total, longest = rows.agg(F.count(F.lit(1)), F.max(F.sqrt(square))).first()
    n_queries = asked.count()
    c_blocks, q_blocks = max(1, -(-total // block_rows)), max(1, -(-n_queries // query_rows))
    longest = longest or 0.0
    reach = (F.ceil(F.sqrt(square) * F.lit(longest) * (1 + 1e-9)) + 1).cast("bigint")
    state = asked.select("vec_id", "embedding", "dim", (-reach).alias("low"), (F.floor(2 * reach / BINS) + 1).cast("bigint").alias("width"), F.lit(k).cast("bigint").alias("wanted"))
    state = materialize(state.withColumn("span", F.col("width") * BINS), "queries")
    own_block = F.pmod(F.xxhash64("vec_id"), F.lit(c_blocks)).cast("int")
    candidates = rows.withColumn("cb", own_block).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).groupBy("dim", "qb", "cb")

    def tiles(state: DataFrame):
        own = F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int")
        return state.withColumn("qb", own).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))).groupBy("dim", "qb", "cb").cogroup(candidates)

    def scores(q: pa.Table, c: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Scores, and where a row is not the query's own."""
        a = np.floor(factor * matrix(q["embedding"], q.num_rows))
        b = np.floor(factor * matrix(c["embedding"], c.num_rows))
        if a.size and b.size and np.abs(a).max() * np.abs(b).max() * a.shape[1] >= 2**53:
            product = a.astype(np.int64) @ b.astype(np.int64).T
        else:
            product = (a @ b.T).astype(np.int64)
        return product, q["vec_id"].to_numpy()[:, None] != c["vec_id"].to_numpy()

    def histogram(q: pa.Table, c: pa.Table) -> pa.Table:
        empty = pa.table({"vec_id": pa.array([], pa.int64()), "bin": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
        if not q.num_rows or not c.num_rows:
            return empty
        score, other = scores(q, c)
        above_low = score - q["low"].to_numpy()[:, None]
        bins = above_low // q["width"].to_numpy()[:, None]
        i, j = np.nonzero((above_low >= 0) & (above_low < q["span"].to_numpy()[:, None]) & other)
        counts = np.bincount(i * BINS + bins[i, j], minlength=len(score) * BINS).reshape(-1, BINS)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        i, j = np.nonzero((counts > 0) & (above < q["wanted"].to_numpy()[:, None]))
        return pa.table({"vec_id": q["vec_id"].to_numpy()[i], "bin": j.astype(np.int32), "n": counts[i, j]})

    while not state.where("width > 0").isEmpty():
        # The range is [low, low + span); ``wanted`` counts from its top down; width 0 marks a k-th value that is found (low).
        open_, done = state.where("width > 0"), state.where("width = 0")
        counted = tiles(open_).applyInArrow(histogram, "vec_id bigint, bin int, n bigint").groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        upper = Window.partitionBy("vec_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        reached = counted.withColumn("through", F.sum("n").over(upper))
        placed = reached.join(open_.select("vec_id", "wanted"), "vec_id").where("through >= wanted").groupBy("vec_id").agg(F.max_by(F.struct("bin", "n", "through"), "bin").alias("at"))
        step = open_.join(placed, "vec_id", "left")
        fewer = F.col("at").isNull()  # fewer than k rows in all: everything from the lowest score on counts
        step = step.select(
            "vec_id", "embedding", "dim",
            F.when(fewer, F.col("low")).otherwise(F.col("low") + F.col("at.bin") * F.col("width")).alias("low"),
            F.when(fewer | (F.col("width") == 1), F.lit(0)).otherwise(F.floor((F.col("width") - 1) / BINS) + 1).cast("bigint").alias("width"),
            F.col("width").alias("span"),
            F.when(fewer, F.col("wanted")).otherwise(F.col("wanted") - (F.col("at.through") - F.col("at.n"))).cast("bigint").alias("wanted"),
        )
        state = materialize(step.unionByName(done), "queries")

    def final(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in ("query_id", "vec_id", "score")})
        order = np.argsort(c["vec_id"].to_numpy(), kind="stable")
        c = c.take(pa.array(order))
        score, other = scores(q, c)
        low = q["low"].to_numpy()[:, None]
        tie = (score == low) & other
        i, j = np.nonzero(((score > low) & other) | (tie & (tie.cumsum(axis=1) <= k)))
        return pa.table({"query_id": q["vec_id"].to_numpy()[i], "vec_id": c["vec_id"].to_numpy()[j], "score": score[i, j]})

    best = tiles(state).applyInArrow(final, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
