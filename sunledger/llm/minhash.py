"""Near-duplicate texts by ProbMinHash over weighted word shingles, banding and exact verification.

The weight of a shingle (five words, lower case; a shorter text is one shingle) is how often the text says it. Each shingle of
weight w sends arrivals of a Poisson process of rate w, every one to a random register; a register keeps the shingle that
came first. A process stops as soon as its next arrival is later than the latest register. Two texts agree in a register with
the probability Jaccard of their weights,

    sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i),

so bands of registers propose pairs, and the exact value decides. Texts with equal weights fold into one first. In a
bucket, members meet a pivot, not each other: what a pivot links needs no further pair. Where members of a bucket are still in
different classes, they are compared in tiles that give back links only. No pairs within a group become rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import GOLD, MIX_A, MIX_B, code_points, map_arrow, mix64, span_hashes, text_steps, words
from sunledger.llm.graph import components, forest
from sunledger.session import materialize

SHINGLE = 5
BANDS, ROWS = 24, 4
STEP_CHARS = 400_000
TILE = 384  # texts on each side of a tile
COLUMNS = 4096  # shingles of a tile that are multiplied at a time
ROUNDING = 1e-12


def shingles(texts: list[str], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted distinct shingle hashes and their counts, per text."""
    codes, firsts = code_points([t.lower() for t in texts])
    starts, ends = words(codes)
    word = span_hashes(codes, starts, ends)
    first_word = np.searchsorted(starts, firsts)
    with np.errstate(over="ignore"):
        joined = np.zeros(max(0, len(word) - size + 1), np.uint64)
        for k in range(size):
            joined = joined * MIX_A + word[k : len(word) - size + 1 + k] if len(joined) else joined
        joined = mix64(joined)
        out = []
        for a, b in zip(first_word[:-1].tolist(), first_word[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(joined[a : b - size + 1], return_counts=True))
            else:
                short = np.uint64(b - a)
                for w in word[a:b]:
                    short = short * MIX_B + w
                out.append((mix64(np.array([short] if b > a else [], np.uint64)), np.ones(int(b > a), np.int64)))
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """(texts, registers) winners of the arrival processes; rows of texts without a shingle are 0."""
    sizes = [len(s[0]) for s in sets]
    shingle = np.concatenate([s[0] for s in sets]) if sets else np.zeros(0, np.uint64)
    weight = np.concatenate([s[1] for s in sets]) if sets else np.zeros(0)
    text = np.repeat(np.arange(len(sets)), sizes)
    first = np.full(len(sets) * registers, np.inf)
    winner = np.zeros(len(sets) * registers, np.uint64)
    time, arrival = np.zeros(len(shingle)), np.uint64(0)
    with np.errstate(over="ignore"):
        while len(shingle):
            arrival += np.uint64(1)
            random = mix64(shingle + arrival * GOLD)
            time = time - np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight
            place = text * registers + (mix64(random ^ MIX_B) % np.uint64(registers)).astype(np.int64)
            better = np.flatnonzero(time < first[place])
            np.minimum.at(first, place[better], time[better])
            won = better[first[place[better]] == time[better]]
            winner[place[won]] = shingle[won]
            latest = first.reshape(-1, registers).max(axis=1)
            going = time < latest[text]
            shingle, weight, text, time = shingle[going], weight[going], text[going], time[going]
    return winner.reshape(-1, registers)


def probability_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact, from sorted distinct hashes and weights; 0 if either is empty."""
    both, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    xs, ys = x[1].astype(float), y[1].astype(float)
    only_x = xs.sum() - xs[i].sum()  # these count in every denominator
    only_y = ys.sum() - ys[j].sum()
    a, b = xs[i], ys[j]
    ratio = a / b
    order = np.argsort(ratio, kind="stable")
    below = np.r_[0, np.cumsum(b[order])]
    above = np.r_[0, np.cumsum(a[order])]
    at = np.searchsorted(ratio[order], ratio, "left")
    least = only_x + (above[-1] - above[at]) + ratio * (only_y + below[at])
    return float((a / least).sum())


def sketch(rows: DataFrame) -> DataFrame:
    """(id, d1, d2, keys): a digest of the weighted shingles and the bucket of each band, for texts with a word."""

    def run(batches):
        for batch in batches:
            for at, texts in text_steps(batch.column("text"), STEP_CHARS):
                sets = shingles(texts)
                held = np.array([i for i, s in enumerate(sets) if len(s[0])], np.int64)
                sets = [sets[i] for i in held]
                with np.errstate(over="ignore"):
                    digests = [[mix64(s[0] * m + s[1].astype(np.uint64)).sum(dtype=np.uint64) for s in sets] for m in (MIX_A, MIX_B)]
                    won = signatures(sets, BANDS * ROWS).reshape(-1, BANDS, ROWS)
                    keys = np.zeros(won.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
                    for k in range(ROWS):
                        keys = mix64(keys * MIX_A + won[:, :, k])
                ids = batch.column("id").take(pa.array(at + held))
                columns = [ids, *(pa.array(np.array(d, np.uint64).view(np.int64)) for d in digests)]
                lists = pa.ListArray.from_arrays(np.arange(0, len(held) * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*columns, lists], names=["id", "d1", "d2", "keys"])

    return map_arrow(rows, run, "id bigint, d1 bigint, d2 bigint, keys array<bigint>")


def weighted_sets(rows: DataFrame) -> DataFrame:
    """(id, hashes, counts) as little-endian bytes."""

    def run(batches):
        for batch in batches:
            for at, texts in text_steps(batch.column("text"), STEP_CHARS):
                sets = shingles(texts)
                columns = [[s[0].astype("<u8").tobytes() for s in sets], [s[1].astype("<u4").tobytes() for s in sets]]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(texts)), *(pa.array(c, pa.binary()) for c in columns)], names=["id", "hashes", "counts"])

    return map_arrow(rows, run, "id bigint, hashes binary, counts binary")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose probability Jaccard reaches the threshold."""
    both = pairs.join(sets.toDF("a", "ha", "ca"), "a").join(sets.toDF("b", "hb", "cb"), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for ha, ca, hb, cb in zip(*(batch.column(n) for n in ("ha", "ca", "hb", "cb"))):
                x = np.frombuffer(ha.as_buffer(), "<u8"), np.frombuffer(ca.as_buffer(), "<u4")
                y = np.frombuffer(hb.as_buffer(), "<u8"), np.frombuffer(cb.as_buffer(), "<u4")
                keep.append(probability_jaccard(x, y) >= threshold - ROUNDING)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_arrow(both, run, "a bigint, b bigint", rows=200)


def similar_pairs(x: list[tuple], y: list[tuple], apart: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two short lists of weighted sets that reach the threshold, where ``apart`` holds.

    Products of incidence matrices give the shared shingles of all pairs. For sets without weights that is the similarity. Else a pair
    can only reach the threshold if both have that share of their weight on shared shingles; those are computed one by one.
    """
    sets = [*x, *y]
    sizes = np.array([len(h) for h, _ in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    weight = np.concatenate([c / c.sum() for _, c in sets])
    _, column, times = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column, weight = owner[keep], number[column[keep]], weight[keep]
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[order], column[order], weight[order]
    flat = np.array([bool((c == c[0]).all()) for _, c in sets])
    n, weighted = len(x), not flat.all()
    both, mass_x, mass_y = (np.zeros((n, len(y))) for _ in range(3))
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        there = np.zeros((len(sets), COLUMNS), np.float32)
        there[owner[a:b], column[a:b] - first] = 1
        both += there[:n] @ there[n:].T
        if weighted:
            heavy = np.zeros((len(sets), COLUMNS))
            heavy[owner[a:b], column[a:b] - first] = weight[a:b]
            mass_x += heavy[:n] @ there[n:].T
            mass_y += there[:n] @ heavy[n:].T
    plain = flat[:n, None] & flat[n:]
    hit = apart & plain & (both / (sizes[:n, None] + sizes[n:] - both) >= threshold - ROUNDING)
    for i, j in zip(*np.nonzero(apart & ~plain & (np.minimum(mass_x, mass_y) >= threshold - 1e-6))):
        hit[i, j] = probability_jaccard(x[i], y[j]) >= threshold - ROUNDING
    return np.nonzero(hit)


def links_in_families(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join different classes among ``members`` (family, rep, class).

    A family's largest class needs no comparison within itself. Its other members meet each other and that class in tiles of
    ``TILE`` by ``TILE`` texts; a tile gives back a forest of its links, at most a row per text.
    """
    sizes = members.groupBy("family", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("family").agg(F.max_by("class", F.struct("n", -F.col("class"))).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_all"))
    placed = members.join(largest, "family").withColumn("in_main", F.col("class") == F.col("main"))
    few, many = F.ceil((F.col("n_all") - F.col("n_main")) / TILE).cast("int"), F.ceil(F.col("n_main") / TILE).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("in_main"), many).otherwise(few)).cast("int")
    # Blocks of the other members are 0, 1, ...; those of the main class are -1, -2, ...
    block = F.when(F.col("in_main"), -1 - own).otherwise(own)
    others = F.sequence(F.lit(0), few - 1)
    meets = F.when(F.col("in_main"), others).otherwise(F.concat(others, F.sequence(-many, F.lit(-1))))
    dealt = placed.where(few > 0).select("family", "rep", "class", block.alias("own"), F.explode(meets).alias("other"))
    tiles = dealt.select("family", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"), (F.col("own") > F.col("other")).alias("right"), "rep", "class")

    def tile(t: pa.Table) -> pa.Table:
        rep, kind, right = t["rep"].to_numpy(), t["class"].to_numpy(), np.asarray(t["right"])
        one = t["ti"][0].as_py() == t["tj"][0].as_py()
        a = np.flatnonzero(~right)
        b = a if one else np.flatnonzero(right)
        if not len(a) or not len(b):
            return pa.table({"a": rep[:0], "b": rep[:0]})
        found = [(np.frombuffer(h.as_buffer(), "<u8"), np.frombuffer(c.as_buffer(), "<u4")) for h, c in zip(t["hashes"], t["counts"])]
        apart = kind[a][:, None] != kind[b]
        i, j = similar_pairs([found[k] for k in a], [found[k] for k in b], apart, threshold)
        root = forest(len(rep), a[i], b[j])
        held = np.flatnonzero(root != np.arange(len(rep)))
        return pa.table({"a": rep[held], "b": rep[root[held]]})

    with_sets = tiles.join(sets.withColumnRenamed("id", "rep"), "rep")
    return with_sets.groupBy("family", "ti", "tj").applyInArrow(tile, "a bigint, b bigint")


def classes(rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(id, class_id) for the rows of (id, text): the smallest id reachable over pairs with probability Jaccard >= ``threshold``.

    A text without a word (NULL, empty, white space) is a class of its own; so is a row with a NULL id, whose class is NULL.
    Rows with equal ids count as one. Each pair that a bucket proposes is compared or already in one class, whatever the bucket's size.
    """
    sketches = materialize(sketch(rows.where("id IS NOT NULL")), "sketches")
    folded = sketches.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.min("keys").alias("keys"))
    # Only buckets that hold two texts or more matter.
    buckets = folded.select("rep", F.explode("keys").alias("key"))
    full = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot")).where("n > 1").select("key", "pivot")
    members = materialize(buckets.join(full, "key"), "buckets")
    ids = members.select(F.col("rep").alias("id")).distinct()
    sets = materialize(weighted_sets(rows.join(ids, "id", "left_semi").dropDuplicates(["id"])), "sets")
    # First every member meets the pivot of its buckets, which settles most: copies of one text share a pivot.
    meet = members.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    links = materialize(verified(meet, sets, threshold), "near-links")
    classed = components(links).toDF("rep", "class")
    # Buckets that still hold several classes hang together in families; there everything is compared that is not in one class.
    placed = members.join(classed, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    several = placed.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    open_ = materialize(placed.join(several, "key", "left_semi").select("rep", "pivot", "class"), "open-members")
    families = components(open_.select(F.col("rep").alias("a"), F.col("pivot").alias("b"))).toDF("rep", "family")
    apart = open_.select("rep", "class").distinct().join(families, "rep")
    more = materialize(links_in_families(apart, sets, threshold), "near-links")
    final = components(links.unionByName(more)).toDF("rep", "class")
    reps = sketches.join(folded.select("d1", "d2", "rep"), ["d1", "d2"]).select("id", "rep").join(final, "rep", "left").select("id", F.coalesce("class", "rep").alias("class_id"))
    once = reps.groupBy("id").agg(F.min("class_id").alias("class_id"))
    return rows.select("id").join(once, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
