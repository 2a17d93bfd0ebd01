"""Sum-of-squares online packing of tokenised documents into windows of a fixed length.

Every document is cut into full windows and one rest. A rest goes to the fill level for which the sum of the squared
counts of partially filled windows becomes smallest: with N[l] open windows at level l, putting a rest of r into a
window at level l changes the sum by 2 * (N[l + r] - N[l] + 1) (without the term of a level that is empty or full).
The level array holds all counts; windows at the same level stand in a stack. When a partition ends, its open windows
are laid end to end and cut again at the window length, and the very last window into powers of two, so no
sequence needs padding.

Each Spark partition packs its own rows, so there is no shuffle and no state that grows with the table: at most
one open window per level. Hot sources or long documents only mean more full windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sunledger.llm.common import map_arrow, text_steps
from sunledger.llm.tokens import library_encoder

PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, piece_ids binary"
Piece = tuple[int, int, int]  # document (place in the stream), first id, number of ids


class SumOfSquares:
    """Online packer. ``put`` takes a piece and yields closed windows as lists of pieces; ``finish`` the rest."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)  # level 0 and the full level stay 0: they cost nothing
        self.stacks: list[list[list[Piece]]] = [[] for _ in range(capacity)]

    def level_for(self, length: int) -> int:
        """The level to place ``length`` on; 0 opens a new window. Ties go to the fullest level."""
        top = self.capacity - length
        before, after = self.counts[: top + 1], self.counts[length:]
        change = 2 * (after - before) + 2
        change[0] = 2 * after[0] + 1  # nothing leaves level 0
        change[top] = 1 - 2 * before[top]  # a full window is no longer open
        if top == 0:
            return 0
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return int(top - np.argmin(change[::-1]))

    def put(self, piece: Piece) -> list[Piece] | None:
        length = piece[2]
        if length == self.capacity:
            return [piece]
        level = self.level_for(length)
        window = self.stacks[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        window.append(piece)
        if level + length == self.capacity:
            return window
        self.stacks[level + length].append(window)
        self.counts[level + length] += 1
        return None

    def finish(self) -> Iterator[list[Piece]]:
        """Close the open windows without padding: joined, cut at the capacity, the last rest at powers of two."""
        pieces = [p for stack in self.stacks for window in stack for p in window]
        left = sum(p[2] for p in pieces)
        window, room = [], 0
        for doc, start, length in pieces:
            while length:
                if not room:
                    room = self.capacity if left >= self.capacity else 1 << (left.bit_length() - 1)
                took = min(room, length)
                window.append((doc, start, took))
                start, length, room, left = start + took, length - took, room - took, left - took
                if not room:
                    yield window
                    window = []
        self.__init__(self.capacity)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of all documents, each id in exactly one.

    Columns: doc_id, start (ids of its document before the piece), length, doc_tokens (with the end id),
    sequence_id, offset in the sequence, piece_ids (little-endian unsigned 32-bit). A NULL or empty text is the end id
    alone; a NULL doc_id stays NULL; repeated rows are packed each; other columns are not read. No rows give no pieces.
    The memory of a task is bounded by the windows that are open, one per level at the most times the rests in them.
    """
    if capacity < 2:
        raise ValueError("capacity must be at least 2")

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33  # room for 2**33 sequences in each partition
        encoder, packer = library_encoder(tokenizer_path, "byte"), SumOfSquares(capacity)
        held: dict[int, list] = {}  # document -> [doc_id, ids, ids not written yet]
        out: list[list] = [[] for _ in range(7)]
        sequence, doc = 0, 0
        end = np.asarray([end_id], "<u4").tobytes()

        def write(window):
            nonlocal sequence
            offset = 0
            for d, start, length in window:
                entry = held[d]
                ids = entry[1][4 * start : 4 * (start + length)]
                for column, value in zip(out, (entry[0], start, length, len(entry[1]) // 4, base + sequence, offset, ids)):
                    column.append(value)
                offset += length
                entry[2] -= length
                if not entry[2]:
                    del held[d]
            sequence += 1

        def flush():
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "piece_ids"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds)], names=names)
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for first, texts in text_steps(batch.column("text")):
                for i, ids in enumerate(encoder.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    held[doc] = [keys[first + i], ids, n]
                    rest = n % capacity
                    for start in range(0, n - rest, capacity):
                        write([(doc, start, capacity)])
                    if rest:
                        if n > rest:  # the written windows are no longer needed
                            held[doc] = [keys[first + i], Tail(ids, n - rest), rest]
                        if window := packer.put((doc, n - rest, rest)):
                            write(window)
                    doc += 1
                if len(out[0]) >= 2000:
                    yield flush()
        for window in packer.finish():
            write(window)
        yield flush()

    return map_arrow(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")), run, PIECES, holds="byte")


class Tail:
    """The last ids of a document, addressed as if all of them were still held."""

    def __init__(self, ids: bytes, first: int):
        self.kept, self.first, self.size = ids[4 * first :], 4 * first, len(ids)

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, part: slice) -> bytes:
        return self.kept[part.start - self.first : part.stop - self.first]
