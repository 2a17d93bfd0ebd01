"""Removal of long byte strings that stand anywhere else too, by sorting suffixes of the places where that can be.

1. Every window of ``size`` bytes has an anchor, the least hash among its strings of 96 bytes or a quarter of ``size`` (leftmost on ties), so equal windows
   have the same anchor at the same offset. Neighbouring windows with one anchor form a run.
2. Anchors that stand once are done. Runs of the others fold by their text: a run whose whole text stands twice is a repeat.
3. Different runs of one anchor are the edges of repeats. If an anchor has more than ``CROWD``, they are cut into ``PARTS`` parts by the
   anchor's offset, and the parts fold by their text as the runs do; parts that still have as many texts are cut to single windows and fold again.
4. One piece of each text that is left is dealt to a shard by anchor, part and common middle, at most ``CROWD`` to a group. Within a shard, windows
   go whose common middle stands only once; the suffixes of the rest are sorted by external induced sorting (``suffixes``). A suffix
   that shares ``size`` bytes with a neighbour is a repeat.

Hashes, run edges and their text are shuffled, and the documents where Spark joins them to their cuts by sorting. A text in a third of all rows is one folded run, and so are its edges, however the rows go on.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from sunledger.llm.common import BASE, GOLD, INVERSE, _grown, distinct_sorted, fresh, map_arrow, mix64, span_hashes
from sunledger.llm.suffixes import Scratch, blocks, suffix_array
from sunledger.session import Scratch as Tables
from sunledger.session import materialize

ANCHOR = 96  # at most; a quarter of the window if that is less
STEP_BYTES = 1 << 18
SHARD_BYTES = 8 << 20
CELL = 16  # windows with neighbouring offsets that are judged by their common middle
CROWD = 512  # different runs of one anchor, or texts of one part of it, that share a shard; more are split by offset and folded
PARTS = 16  # of a crowd, whatever its size, so that pieces grow with its rows
RUNS = "anchor bigint, h1 bigint, h2 bigint, rid bigint, first bigint, n int, offset int"
PIECE = ["anchor", "low", "middle", "rid", "first", "n", "offset"]
PIECES = "anchor bigint, low int, middle bigint, rid bigint, first bigint, n int, offset int"

_RANDOM = np.random.default_rng(2024).integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
PLACE = np.uint64((1 << 24) - 1)


def anchor_bytes(size: int) -> int:
    return max(1, min(ANCHOR, size // 4))


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and where each row begins (one more at the end); NULL is empty."""
    column = column.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from minima towards both sides of every ``width``-th place."""
    n = len(keys)
    grid = np.full((-(-n // width), width), np.iinfo(np.uint64).max, np.uint64)
    grid.reshape(-1)[:n] = keys
    before = np.minimum.accumulate(grid, axis=1).reshape(-1)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def runs_of(data: np.ndarray, bounds: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """Runs of the rows data[bounds[i]:bounds[i+1]]: row, first window, windows, offset of the anchor, hashes."""
    n = len(data)
    empty = {k: np.zeros(0, np.int64) for k in ("row", "first", "n", "offset", "anchor", "h1", "h2")}
    if n < size:
        return empty
    anchor_size = anchor_bytes(size)
    width = size - anchor_size + 1
    with np.errstate(over="ignore"):
        up, down = _grown("up", BASE, n), _grown("down", INVERSE, n + 1)
        sums = np.zeros((2, n + 1), np.uint64)
        for s, random in zip(sums, _RANDOM):
            np.cumsum(random[data] * up, out=s[1:])
        grams = mix64((sums[0][anchor_size:] - sums[0][:-anchor_size]) * down[: n - anchor_size + 1])
        least = least_in_windows((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), width)
        anchor = (least & PLACE).astype(np.int64)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
        inside = np.arange(len(anchor)) + size <= bounds[1:][row]
        edge = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])])
        last = np.r_[edge[1:], len(anchor)] - 1
        first, last = edge[inside[edge]], last[inside[edge]]
        end, length = last + size, (last - first).astype(np.uint64)
        h1, h2 = (mix64((s[end] - s[first]) * down[first] + length) for s in sums)
    return {"row": row[first], "first": first - bounds[row[first]], "n": last - first + 1, "offset": anchor[first] - first, "anchor": grams[anchor[first]].view(np.int64), "h1": h1.view(np.int64), "h2": h2.view(np.int64)}


def steps(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, bounds, row numbers, first byte of each within its row): rows together up to ``STEP_BYTES``, a longer row in overlapping parts."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP_BYTES, "right")) - 1)
        to = min(to, rows)
        length = offsets[at + 1] - offsets[at]
        if length > STEP_BYTES:
            for part in range(0, int(length) - size + 1, STEP_BYTES):
                piece = data[offsets[at] + part : min(offsets[at] + part + STEP_BYTES + size - 1, offsets[at + 1])]
                yield piece, np.array([0, len(piece)]), np.array([at]), np.array([part])
            at += 1
            continue
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], np.arange(at, to), np.zeros(to - at, np.int64)
        at = to


def find_runs(rows: DataFrame, size: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = byte_column(batch.column("bytes"))
            rid = batch.column("rid").to_numpy()
            for piece, bounds, which, begin in steps(data, offsets, size):
                r = runs_of(piece, bounds, size)
                columns = [r["anchor"], r["h1"], r["h2"], rid[which[r["row"]]], r["first"] + begin[r["row"]], r["n"].astype(np.int32), r["offset"].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "h1", "h2", "rid", "first", "n", "offset"])

    return map_arrow(rows, run, RUNS)


def promising(texts: np.ndarray, begin: np.ndarray, anchor: np.ndarray, n: np.ndarray, offset: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first window, windows) of the parts of pieces that may stand elsewhere.

    The windows of a piece whose anchor lies ``CELL`` * j to ``CELL`` * (j + 1) - 1 bytes behind their start all hold the same
    size - CELL + 1 bytes around it. Two windows can only be equal if these are; they are compared by hash, a group of the shard's text at a time.
    """
    low, high = (offset - n + 1) // CELL, offset // CELL
    cells = (high - low + 1).astype(np.int64)
    piece = np.repeat(np.arange(len(n)), cells)
    cell = low[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(cells) - cells, cells)
    start = begin[piece] + offset[piece] - cell * CELL
    hashes = np.zeros(len(piece), np.uint64)
    ends, at = np.r_[begin[1:], len(texts)], 0
    while at < len(n):  # pieces of about STEP_BYTES together
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + STEP_BYTES)))
        a, b = np.searchsorted(piece, (at, to))
        some = np.asarray(texts[begin[at] : ends[to - 1]])
        inner = start[a:b] - begin[at]
        hashes[a:b] = span_hashes(some, inner, inner + size - CELL + 1)
        at = to
    key = mix64(hashes ^ mix64(anchor[piece].view(np.uint64) + cell.astype(np.uint64) * GOLD))
    order = np.argsort(key, kind="stable")
    first, runs = distinct_sorted(key[order])
    again = np.zeros(len(piece), bool)
    again[order[np.repeat(runs > 1, runs)]] = True
    held = np.flatnonzero(again)
    if not len(held):
        return held, held, held
    new = np.flatnonzero(np.r_[True, (np.diff(held) != 1) | (np.diff(piece[held]) != 0)])
    last = np.r_[new[1:], len(held)] - 1
    p = piece[held[new]]
    # Windows with larger offsets of the anchor begin earlier.
    from_, to_ = offset[p] - (cell[held[last]] + 1) * CELL + 1, offset[p] - cell[held[new]] * CELL
    from_, to_ = np.maximum(from_, 0), np.minimum(to_, n[p] - 1)
    return p, from_, to_ - from_ + 1


def repeated_in_shard(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Windows of the pieces of one shard that stand in another piece, or elsewhere in the same."""
    with Scratch() as scratch:
        columns: dict[str, list] = {c: [] for c in ("anchor", "rid", "first", "n", "offset")}
        sizes, raw, path = [], os.path.join(scratch.folder.name, "raw"), os.path.join(scratch.folder.name, "text")
        with open(raw, "wb") as out:
            for batch in batches:
                data, offsets = byte_column(batch.column("bytes"))
                out.write(data[offsets[0] : offsets[-1]])
                sizes.append(np.diff(offsets))
                for c, held in columns.items():
                    held.append(batch.column(c).to_numpy().astype(np.int64))
        if not sizes or not sum(s.sum() for s in sizes):
            return
        whole = {c: np.concatenate(held) for c, held in columns.items()}
        begin = np.r_[0, np.cumsum(np.concatenate(sizes))[:-1]]
        texts = np.memmap(raw, np.uint8, "r")
        os.unlink(raw)  # the space is free as soon as the array is
        piece, from_, n = promising(texts, begin, whole["anchor"], whole["n"], whole["offset"], size)
        if not len(piece):
            return
        with open(path, "wb") as out:
            for a, b in zip((begin[piece] + from_).tolist(), (begin[piece] + from_ + n + size - 1).tolist()):
                out.write((texts[a:b].astype(np.uint16) + 2).tobytes())
                out.write(b"\x01\x00")  # a separator, smaller than every byte
            out.write(b"\x00\x00")
        del texts
        rid, first = whole["rid"][piece], whole["first"][piece] + from_
        begin = np.r_[0, np.cumsum(n + size)[:-1]]
        text = np.memmap(path, np.uint16, "r")
        order, prefix = suffix_array(text, 258, scratch, cap=size)
        marked = scratch.array(len(text) + 1, bool, False)
        for a, b in blocks(len(text) - 1):
            hit = np.flatnonzero(prefix[a + 1 : b + 1] >= size) + a + 1
            marked[order[hit]] = True
            marked[order[hit - 1]] = True
        del order, prefix
        # Two rows of pieces may be equal beyond a separator; only whole windows of one piece count.
        last, edges = False, []
        for a, b in blocks(len(marked)):
            places = np.arange(a, b)
            own = np.searchsorted(begin, places, "right") - 1
            held = marked[a:b] & (places - begin[own] < n[own])
            edges.append(np.flatnonzero(np.diff(np.r_[last, held])) + a)
            last = bool(held[-1])
        edges = np.concatenate(edges)
        a, b = edges[::2], edges[1::2]
        piece = np.searchsorted(begin, a, "right") - 1
        start, end = a - begin[piece], b - begin[piece]  # windows [start, end) of the piece
        yield pa.RecordBatch.from_arrays([pa.array(rid[piece]), pa.array(first[piece] + start), pa.array(first[piece] + end + size - 1)], names=["rid", "start", "end"])


def windows_between(pieces: DataFrame) -> DataFrame:
    """The windows of the pieces whose anchor lies ``low`` to ``high`` bytes behind their start."""
    begin, end = F.greatest(F.lit(0), F.col("offset") - F.col("high")).cast("int"), F.least(F.col("n") - 1, F.col("offset") - F.col("low")).cast("int")
    return pieces.select(
        "anchor", "low", "high", "rid", (F.col("first") + begin).alias("first"), (end - begin + 1).alias("n"), (F.col("offset") - begin).alias("offset")
    ).where("n > 0")


def cuts_of(pieces: DataFrame, size: int) -> DataFrame:
    """Pieces by document, which has at most as many as it has windows."""
    names = [c for c in pieces.columns if c != "rid"]
    return pieces.groupBy("rid").agg(F.collect_list(F.struct(*names)).alias("cuts"), F.sum(F.col("n") + size - 1).alias("size"))


def piece_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, inner: np.ndarray, inner_end: np.ndarray) -> np.ndarray:
    """Two hashes of data[start:end] and one of data[inner:inner_end] within it, for many pieces."""
    out = np.zeros((3, len(start)), np.int64)
    order, at = np.argsort(start, kind="stable"), 0
    begins = start[order]
    while at < len(order):  # pieces that begin within STEP_BYTES
        to = int(np.searchsorted(begins, begins[at] + STEP_BYTES, "right"))
        here, base = order[at:to], begins[at]
        some = data[base : end[here].max()]
        with np.errstate(over="ignore"):
            up, down = _grown("up", BASE, len(some)), _grown("down", INVERSE, len(some) + 1)
            sums = np.zeros((2, len(some) + 1), np.uint64)
            for s, random in zip(sums, _RANDOM):
                np.cumsum(random[some] * up, out=s[1:])
            for row, s, a, b in ((0, sums[0], start, end), (1, sums[1], start, end), (2, sums[0], inner, inner_end)):
                x, y = a[here] - base, b[here] - base
                out[row, here] = mix64((s[y] - s[x]) * down[x] + (y - x).astype(np.uint64)).view(np.int64)
        at = to
    return out


def folded(rows: DataFrame, pieces: DataFrame, size: int, scratch: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(spans of pieces whose whole text stands twice, pieces to be sorted, pieces of parts with more than CROWD texts), with one piece for each text.

    All windows of a part (anchor, ``low`` to ``high``) hold the same ``middle`` around the anchor. A text whose middle no other text of its part
    holds is decided by its copies. Pieces are shuffled as hashes; the documents themselves are, if Spark joins them to their cuts by sorting.
    """

    def run(batches):
        for batch in batches:
            data, offsets = byte_column(batch.column("bytes"))
            cuts = batch.column("cuts")
            one = cuts.flatten()
            c = {f: one.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i, f in enumerate(("anchor", "low", "high", "first", "n", "offset"))}
            which = np.repeat(np.arange(batch.num_rows), cuts.value_lengths().to_numpy())
            start = offsets[which] + c["first"]
            anchor = start + c["offset"]
            h = piece_hashes(data, start, start + c["n"] + size - 1, anchor - c["low"], anchor - c["high"] + size)
            columns = [c["anchor"], c["low"].astype(np.int32), h[2], batch.column("rid").to_numpy()[which], c["first"], c["n"].astype(np.int32), c["offset"].astype(np.int32), c["high"].astype(np.int32), h[0], h[1]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[*PIECE, "high", "h1", "h2"])

    cuts = materialize(cuts_of(pieces, size).select("rid", "cuts"), "piece-cuts", scratch)
    if cuts.isEmpty():  # without a crowd the texts are not read again
        none = rows.sparkSession.createDataFrame([], PIECES + ", high int")
        return none.selectExpr("rid", "first as start", "first as end"), none, none
    hashed = map_arrow(rows.join(cuts, "rid").select("rid", "bytes", "cuts"), run, PIECES + ", high int, h1 bigint, h2 bigint", rows=200)
    hashed = materialize(hashed, "piece-hashes", scratch)
    part, text = ["anchor", "low", "middle"], ["anchor", "low", "middle", "n", "offset", "h1", "h2"]
    texts = hashed.groupBy(*text, "high").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "first")).alias("one"))
    texts = materialize(texts, "piece-texts", scratch)
    again = hashed.join(texts.where("copies > 1").select(*text), text, "left_semi")
    spans = again.select("rid", F.col("first").alias("start"), (F.col("first") + F.col("n") - 1 + size).alias("end"))
    several = texts.groupBy(*part).agg(F.count(F.lit(1)).alias("v")).where("v > 1")
    open_ = texts.join(several, part).select(*part, "one.*", "n", "offset", "high", "v")
    more = (F.col("v") > CROWD) & (F.col("low") < F.col("high"))
    return spans, open_.where(~more & (F.col("low") < F.col("high"))), open_.where(more)


def repeated_spans(rows: DataFrame, size: int) -> DataFrame:
    """(rid, start, end): byte ranges of (rid, bytes) covered by windows that start anywhere else too; they may overlap.

    The result is a written table; the tables on the way to it are deleted.
    """
    with Tables(rows.sparkSession) as scratch:
        return _repeated_spans(rows, size, scratch)


def _repeated_spans(rows: DataFrame, size: int, scratch: Tables) -> DataFrame:
    runs = materialize(find_runs(rows, size), "runs", scratch)
    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    runs = materialize(runs.join(shared, "anchor", "left_semi"), "shared-runs", scratch)
    texts = runs.groupBy("anchor", "h1", "h2").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "first", "n", "offset")).alias("one"))
    texts = materialize(texts, "run-texts", scratch)
    whole = runs.join(texts.where("copies > 1").select("anchor", "h1", "h2"), ["anchor", "h1", "h2"], "left_semi")
    whole = whole.select("rid", F.col("first").alias("start"), (F.col("first") + F.col("n") - 1 + size).alias("end"))

    # Edges: anchors with several different runs. Equal windows have the anchor at one offset, so a crowd is cut by offset.
    width = size - anchor_bytes(size) + 1
    several = texts.groupBy("anchor").agg(F.count(F.lit(1)).alias("v")).where("v > 1")
    parts = F.when(F.col("v") > CROWD, min(width, PARTS)).otherwise(1)
    pieces = texts.join(several, "anchor").select("anchor", "one.*", parts.alias("parts"))
    few = pieces.where("parts = 1").select("anchor", F.lit(0).alias("low"), F.lit(0).cast("bigint").alias("middle"), "rid", "first", "n", "offset")
    # A piece meets the parts of its own offsets only.
    of = lambda place: F.floor(place * F.col("parts") / width).cast("int")
    crowd = pieces.where("parts > 1").withColumn("part", F.explode(F.sequence(of(F.col("offset") - F.col("n") + 1), of(F.col("offset")))))
    low, high = F.ceil(F.col("part") * width / F.col("parts")), F.ceil((F.col("part") + 1) * width / F.col("parts")) - 1
    crowd = windows_between(crowd.withColumns({"low": low.cast("int"), "high": high.cast("int")}))
    crowd_spans, still, thronged = folded(rows, crowd, size, scratch)
    # Parts with many different texts, as where a passage ends: single windows, which their hashes decide.
    single = thronged.withColumn("low", F.explode(F.sequence(F.col("offset") - F.col("n") + 1, F.col("offset")))).withColumn("high", F.col("low"))
    single_spans, _, _ = folded(rows, windows_between(single), size, scratch)

    cuts = materialize(cuts_of(few.unionByName(still.select(*few.columns)), size), "cuts", scratch)
    total = cuts.agg(F.sum("size")).first()[0] or 0

    def cut(batches):
        for batch in batches:
            data, offsets = byte_column(batch.column("bytes"))
            out: list[list] = [[] for _ in range(8)]
            for i, (rid, found) in enumerate(zip(batch.column("rid").to_pylist(), batch.column("cuts").to_pylist())):
                for c in found:
                    a = offsets[i] + c["first"]
                    for column, value in zip(out, (c["anchor"], c["low"], c["middle"], rid, c["first"], c["n"], c["offset"], data[a : a + c["n"] + size - 1].tobytes())):
                        column.append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            names = ["anchor", "low", "middle", "rid", "first", "n", "offset", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    cut_rows = map_arrow(rows.join(cuts.select("rid", "cuts"), "rid").select("rid", "bytes", "cuts"), cut, PIECES + ", bytes binary", rows=200)
    dealt = cut_rows.repartition(max(1, -(-total // SHARD_BYTES)), "anchor", "low", "middle")
    edges = dealt.mapInArrow(lambda b: repeated_in_shard(b, size), "rid bigint, start bigint, end bigint")
    return materialize(whole.unionByName(crowd_spans).unionByName(single_spans).unionByName(edges), "spans")


def merged(spans: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal ranges covered by overlapping or touching ones."""
    if not spans:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.array(sorted((x["start"], x["end"]) for x in spans), np.int64)
    reach = np.maximum.accumulate(s[:, 1])
    new = np.r_[True, s[1:, 0] > reach[:-1]]
    first = np.flatnonzero(new)
    return s[first, 0], reach[np.r_[first[1:], len(s)] - 1]


RESULT = [StructField("__n_bytes", LongType()), StructField("__n_removed", LongType()), StructField("__n_spans", LongType()), StructField("__kept", BinaryType())]


def remove_repeats(docs: DataFrame, size: int = 400, as_text: bool = False) -> DataFrame:
    """``docs`` with ``__n_bytes``, ``__n_removed``, ``__n_spans`` (maximal removed ranges) and ``__kept`` (remaining bytes).

    With ``as_text`` the remaining bytes come as ``__text`` instead: a cut may split a character, whose other bytes are then left out.

    A byte of the column text, as UTF-8, goes if a string of ``size`` bytes that covers it also starts anywhere else, in
    another row or in the same text, judged on the input. Repeated rows are rows of their own, so their texts repeat each other. A
    NULL or empty text, or one shorter than ``size``, keeps all it has. All other columns pass through unread; the new names must not be among them.

    Rows are numbered once and written with their numbers, as another job may read ``docs`` in other splits.
    """
    result = [*RESULT[:3], StructField("__text", StringType())] if as_text else RESULT
    made = [f.name for f in result]
    clash = {m for m in made if fresh(docs.columns, m) != m}
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")
    row, ranges, raw = (fresh(docs.columns, n) for n in ("__rid", "__spans", "__bytes"))
    numbered = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    rows = numbered.select(F.col(row).alias("rid"), F.col("text").cast("string").cast("binary").alias("bytes"))
    spans = repeated_spans(rows, size).groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias(ranges))
    joined = numbered.join(spans.withColumnRenamed("rid", row), row, "left").withColumn(raw, F.col("text").cast("string").cast("binary"))
    names = docs.columns

    def run(batches):
        for batch in batches:
            data, offsets = byte_column(batch.column(raw))
            out: list[list] = [[] for _ in RESULT]
            for i, spans in enumerate(batch.column(ranges).to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                a, b = merged(spans)
                keep = np.ones(len(own), bool)
                for s, e in zip(a.tolist(), b.tolist()):
                    keep[s:e] = False
                rest = own[keep].tobytes() if len(a) else own.tobytes()
                for column, value in zip(out, (len(own), int((b - a).sum()), len(a), rest.decode("utf-8", "ignore") if as_text else rest)):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.string() if as_text else pa.binary()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *(pa.array(c, k) for c, k in zip(out, kinds))], names=[*names, *made])

    return map_arrow(joined.select(*names, ranges, raw), run, StructType([*docs.schema.fields, *result]), rows=500)
