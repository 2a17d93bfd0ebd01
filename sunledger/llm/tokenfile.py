"""Token-id files in patched frame-of-reference blocks.

A file set is a Parquet table written by Spark, one row per segment of whole documents in ascending doc_id order:
``part`` and ``segment`` (their place), ``first`` (ids of the part before the segment), ``doc_ids`` and ``doc_lengths`` (the
directory), ``payload`` (blocks of 4,096 ids) and ``block_index`` (byte start of each block). A block holds its
minimum, the packing width that covers the chosen percentile of the differences, the packed low bits, and for the
outliers their places and high bits. ``read_ids`` decodes whole documents, ``decode_blocks`` any range of blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.llm.common import map_arrow, text_steps
from sunledger.llm.tokens import library_encoder
from sunledger.session import shared_dir

BLOCK = 4096
PERCENTILE = 90
SEGMENT_IDS = 65_536
HEAD = struct.Struct("<IHBH")  # minimum, ids, width, outliers
SEGMENTS = "part int, segment int, first bigint, doc_ids array<bigint>, doc_lengths array<bigint>, n_ids bigint, payload binary, block_index binary"


def encode_block(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block of at most 65,535 unsigned 32-bit ids, not empty."""
    low = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(low)
    rank = min(len(rest) - 1, len(rest) * percentile // 100)
    width = int(np.partition(rest, rank)[rank]).bit_length()
    kind = "<u2" if width <= 16 else "<u4"
    bits = np.unpackbits(rest.astype(kind).view(np.uint8).reshape(len(rest), -1), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits.reshape(-1), bitorder="little").tobytes()
    high = rest >> np.uint32(width) if width < 32 else np.zeros_like(rest)
    odd = np.flatnonzero(high)
    return HEAD.pack(low, len(ids), width, len(odd)) + packed + odd.astype("<u2").tobytes() + high[odd].astype("<u4").tobytes()


def decode_block(data: memoryview) -> np.ndarray:
    low, n, width, odd = HEAD.unpack_from(data)
    at = HEAD.size
    size = (n * width + 7) // 8
    kind = "<u2" if width <= 16 else "<u4"
    bits = np.zeros((n, 8 * np.dtype(kind).itemsize), np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    values = np.packbits(bits, axis=1, bitorder="little").view(kind)[:, 0].astype(np.uint32)
    at += size
    if odd:
        places = np.frombuffer(data, "<u2", odd, at)
        values[places] |= np.frombuffer(data, "<u4", odd, at + 2 * odd) << np.uint32(width)
    return values + np.uint32(low)


def encode_ids(ids: np.ndarray, block: int = BLOCK, percentile: int = PERCENTILE) -> tuple[bytes, bytes]:
    """Payload and block index."""
    blocks = [encode_block(ids[i : i + block], percentile) for i in range(0, len(ids), block)]
    starts = np.zeros(len(blocks), "<u8")
    np.cumsum([len(b) for b in blocks[:-1]], out=starts[1:])
    return b"".join(blocks), starts.tobytes()


def decode_blocks(payload: bytes, block_index: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks first..last-1, found by the index."""
    starts, view = np.frombuffer(block_index, "<u8"), memoryview(payload)
    found = [decode_block(view[int(s) :]) for s in starts[first:last]]
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def write_ids(docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int = 2) -> str:
    """Encode the texts, append ``end_id`` to each, write the file set, return its folder.

    Documents are range-partitioned by doc_id (equal ids by their text), so each part is an interval of the order and
    a frequent id can be split. A NULL or empty text is the end id alone; NULL ids come first; repeated rows are
    written each; other columns are not read; no rows give no segments. A segment is closed after the document that
    fills it, so one very long document is one long segment.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark, "token-ids")
    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = own.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), library_encoder(tokenizer_path, "word")
        end = np.asarray([end_id], "<u4").tobytes()
        segment, first = 0, 0
        keys, lengths, held, n = [], [], [], 0

        def close():
            payload, index = encode_ids(np.frombuffer(b"".join(held), "<u4"))
            row = [[part], [segment], [first], [keys[:]], [lengths[:]], [n], [payload], [index]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
            names = ["part", "segment", "first", "doc_ids", "doc_lengths", "n_ids", "payload", "block_index"]
            return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at, texts in text_steps(batch.column("text")):
                for i, encoded in enumerate(encoder.encode(texts)):
                    keys.append(ids[at + i])
                    lengths.append(len(encoded) // 4 + 1)
                    held += [encoded, end]
                    n += lengths[-1]
                    if n >= SEGMENT_IDS:
                        yield close()
                        segment, first, n = segment + 1, first + n, 0
                        keys, lengths, held = [], [], []
        if keys:
            yield close()

    map_arrow(ranged, run, SEGMENTS, holds="word").write.parquet(path)
    return path


def read_ids(spark, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row per part, as many as the writing job had partitions.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("__n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("part_start"))
    placed = segments.join(starts, "part").select((F.col("part_start") + F.col("first")).alias("start"), "doc_ids", "doc_lengths", "payload", "block_index")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                data = decode_blocks(row["payload"], row["block_index"]).astype("<u4").tobytes()
                ends = np.cumsum(row["doc_lengths"])
                begins = ends - row["doc_lengths"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(begins + row["start"], pa.int64()),
                        pa.array(row["doc_lengths"], pa.int64()),
                        pa.array([data[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return map_arrow(placed, run, "doc_id bigint, start bigint, n_tokens bigint, ids binary", rows=8)
