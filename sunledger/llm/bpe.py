"""Byte-pair encoding as a streaming transducer with bounded lookahead, and an incremental decoder.

The merge list itself bounds how far to the right a token's end can depend. Let the text before a place q be encoded
on its own and end in token t. A merge can only cross q if it takes a token s from the right edge of t's merge tree
before s itself is merged away (at rank m), with some right part y that forms after q and still stands then. So

    reach(s, m)   = max over merges r = (s, y) with r < m of  len(y) + depends(r)
    depends(r)    = max over s on the right edge of y, merged away at m (r for y itself), of  reach(s, m)
    settle(t)     = max over s on the right edge of t, merged away at m (never for t itself), of  reach(s, m)

and once settle(t) bytes after the end of t are known, the end is final. Ranks only fall along ``depends``, so one
pass over the merge list in rank order computes it. The encoder holds an input window of a fixed size, emits the tokens whose
ends are settled, and carries the rest over; each step looks at no more than window + largest ``settle`` bytes.
"""

from __future__ import annotations

import codecs
import heapq
import json
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sunledger.llm.common import held, map_arrow, text_steps
from sunledger.llm.tokens import PieceEncoder, byte_units

# Fixed value: the published splitting pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WINDOW = 1024


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if visible in Latin-1, else the next free one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """Vocabulary and ranked merges of a byte-level tokenizer file."""

    def __init__(self, path: str, lookahead: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]  # byte -> id
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # rank -> id
        self.parts: list[tuple[int, int]] = []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((vocab[a], vocab[b]), len(self.made))
            self.made.append(vocab[a + b])
            self.parts.append((vocab[a], vocab[b]))
        self.origin = {i: r for r, i in reversed(list(enumerate(self.made)))}  # id -> rank of the merge that makes it
        self.settle = self._settle() if lookahead else {}
        self.lookahead = max(self.settle.values(), default=0)

    def _right_edge(self, token: int, until: int) -> Iterator[tuple[int, int]]:
        """Tokens at the right edge of a token's merge tree, each with the rank at which it is merged away."""
        yield token, until
        while (r := self.origin.get(token)) is not None:
            token = self.parts[r][1]
            yield token, r

    def _settle(self) -> dict[int, int]:
        ranks: dict[int, list[int]] = {}  # left part -> ranks so far
        most: dict[int, list[int]] = {}  # and the largest reach up to each

        def reach(s: int, before: int) -> int:
            k = bisect_left(ranks.get(s, ()), before)
            return most[s][k - 1] if k else 0

        for r, (a, b) in enumerate(self.parts):
            far = len(self.bytes_of[b]) + max(reach(s, m) for s, m in self._right_edge(b, r))
            ranks.setdefault(a, []).append(r)
            so_far = most.setdefault(a, [])
            so_far.append(max(far, so_far[-1]) if so_far else far)
        never = len(self.parts)
        return {t: max(reach(s, m) for s, m in self._right_edge(t, never)) for t in {*self.first, *self.made}}

    def encode_window(self, data: bytes) -> list[int]:
        """Merge by rank, ties from the left, until nothing merges."""
        ids = [self.first[b] for b in data]
        rank = self.rank
        if len(ids) <= 48:
            while len(ids) > 1:
                ranks = [rank.get(p, 1 << 60) for p in zip(ids, ids[1:])]
                low = min(ranks)
                if low == 1 << 60:
                    break
                k = ranks.index(low)
                ids[k : k + 2] = [self.made[low]]
            return ids
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap = [(rank[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        n, gone = len(ids), -1
        while heap:
            r, i, p = heapq.heappop(heap)
            j = after[i]
            if j >= n or (ids[i], ids[j]) != p:
                continue
            ids[i], ids[j] = self.made[r], gone
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := rank.get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (q, x, (ids[x], ids[y])))
        return [t for t in ids if t != gone]


class Transducer:
    """Bytes in, final ids out: ``feed`` emits what no further input can change, ``finish`` the rest."""

    def __init__(self, merges: MergeList, window: int = WINDOW):
        self.merges, self.window, self.held = merges, window + merges.lookahead, b""

    def feed(self, data: bytes) -> Iterator[int]:
        at = 0
        while at < len(data):
            took = max(1, self.window - len(self.held))
            self.held += data[at : at + took]
            at += took
            if len(self.held) >= self.window:
                yield from self._emit()

    def _emit(self) -> Iterator[int]:
        end, final = 0, 0
        for token in self.merges.encode_window(self.held):
            end += len(self.merges.bytes_of[token])
            if end + self.merges.settle[token] > len(self.held):
                break
            final = end
            yield token
        self.held = self.held[final:]

    def finish(self) -> Iterator[int]:
        if self.held:
            yield from self.merges.encode_window(self.held)
        self.held = b""


class TextDecoder:
    """Ids in, text out. The state is the unfinished UTF-8 character, at most three bytes; broken ones become U+FFFD."""

    def __init__(self, merges: MergeList):
        self.bytes_of, self.utf8 = merges.bytes_of, codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.utf8.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


class StreamEncoder:
    """Pieces of text to ids: special strings first, then the splitting pattern, then the transducer for each match."""

    def __init__(self, merges: MergeList, remembered: int = 200_000):
        import regex

        self.merges, self.split = merges, regex.compile(PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True))) + ")") if merges.special else None
        self.words: dict[str, list[int]] = {}
        self.remembered = remembered

    def word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            data = word.encode()
            if len(data) <= WINDOW:
                ids = self.merges.encode_window(data)
            else:
                machine = Transducer(self.merges)
                ids = [*machine.feed(data), *machine.finish()]
            if len(word) <= 32:
                if len(self.words) >= self.remembered:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def piece(self, piece: str) -> list[int]:
        ids: list[int] = []
        for k, part in enumerate(self.specials.split(piece) if self.specials else [piece]):
            if k % 2:
                ids.append(self.merges.special[part])
            else:
                for word in self.split.findall(part):
                    ids += self.word(word)
        return ids


def stream_encoder(path: str) -> tuple[MergeList, PieceEncoder]:
    """One per worker process, ``held`` as ``stream``."""

    def make():
        merges = MergeList(path)
        return merges, PieceEncoder(byte_units, StreamEncoder(merges).piece)

    return held("stream", path, make)


DECODE_STEP = 65_536


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded (their text).

    A NULL or empty text has no ids and decodes to ''. Rows are independent: repeated rows and NULL ids pass through,
    other columns are not read, no rows give no rows. No shuffle.
    """

    def run(batches):
        merges, encoder = stream_encoder(tokenizer_path)
        for batch in batches:
            keys = batch.column("doc_id")
            for at, texts in text_steps(batch.column("text")):
                ids = encoder.encode(texts)
                decoded = []
                for data in ids:
                    machine, numbers = TextDecoder(merges), np.frombuffer(data, "<u4").tolist()
                    parts = [machine.feed(numbers[i : i + DECODE_STEP]) for i in range(0, len(numbers), DECODE_STEP)]
                    decoded.append("".join([*parts, machine.finish()]))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(texts)).cast(pa.int64()), pa.array([len(d) // 4 for d in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    own = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_arrow(own, run, "doc_id bigint, n_tokens bigint, ids binary, decoded string", rows=1000, holds="stream")
