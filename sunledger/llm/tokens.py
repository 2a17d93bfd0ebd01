"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memory of short pieces.

A text is cut at single spaces, where neither of the two vocabularies can ever form a token across the cut, and each
distinct piece is encoded once per memory life. Corpora repeat their words, so most pieces come from the memory.
"""

from __future__ import annotations

import json
import re
from array import array

from sunledger.llm.common import held

SPACE_BEFORE_WHITE = re.compile(r" (?=\s|$)")
CUT = re.compile(r"(?= \S)")
LONGEST_KEPT = 64  # longer pieces are encoded anew each time
STOPS = ".,!?;:"


def byte_units(text: str) -> list[str]:
    """Pieces of a text for a byte-level vocabulary: each begins with the space before its word.

    A cut stands before a space that a character other than white space follows. There the splitting pattern always
    ends a match, since a run of white space leaves its last space to the next word.
    """
    if SPACE_BEFORE_WHITE.search(text):
        return CUT.split(text)
    if "\0" in text:
        first, *rest = text.split(" ")
        return [first, *(" " + r for r in rest)]
    return text.replace(" ", "\0 ").split("\0")


def without_stops(piece: str) -> str:
    """The piece without stops at its end if a plain letter stands before them. Both vocabularies end a token there, since their
    patterns never match letters and stops together. Letters beyond Latin, and the one that lower case splits, are left alone."""
    core = piece.rstrip(STOPS)
    return core if core and core[-1].isalpha() and core[-1] < "\u0250" and core[-1] != "\u0130" else piece


def word_units(text: str) -> list[str]:
    """Pieces for a vocabulary that lowers the case, drops white space and never joins across it.

    Lowering a whole text is the same as the vocabulary's own lowering, character by character, but for two letters.
    """
    if "\u03a3" not in text and "\u0130" not in text:
        text = text.lower()
    return text.split(" ")


class Memory(dict):
    """Pieces met at least twice and their ids as bytes; the rest is worked out on each look.

    ``once`` are pieces met a single time lately: most pieces of a corpus never come again and should not push out those that
    do. ``older`` is the generation before.
    """

    def __init__(self, encode_piece, size: int, older: dict):
        self.encode_piece, self.size, self.once, self.older = encode_piece, size, {}, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.once.pop(piece, None)
        if ids is None:
            ids = self.older.get(piece)
        if ids is not None:
            self[piece] = ids
            return ids
        core = without_stops(piece)  # a word before a stop is often known without it
        ids = self.encode_piece(piece) if len(core) == len(piece) else self[core] + self[piece[len(core) :]]
        if len(piece) <= LONGEST_KEPT:
            if len(self.once) >= self.size:
                self.once.clear()
            self.once[piece] = ids
        return ids


class PieceEncoder:
    """Texts to little-endian unsigned 32-bit ids. ``encode_piece`` maps a string to a list of ids.

    Of pieces met once and of two generations of others about ``size`` each are remembered.
    """

    def __init__(self, units, encode_piece, size: int = 250_000):
        self.units, self.size = units, size
        self.memory = Memory(lambda piece: array("I", encode_piece(piece)).tobytes(), size, {})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes."""
        out = []
        for text in texts:
            out.append(b"".join(map(self.memory.__getitem__, self.units(text))))
            if len(self.memory) >= self.size:
                young = self.memory
                young.older = {}
                self.memory = Memory(young.encode_piece, self.size, young)
                self.memory.once, young.once = young.once, {}
        return out


def latin_first(path: str, encode_piece):
    """For pieces of Latin characters the same merges by ``tiktoken``, which is twice as fast on short strings.

    It merges whatever two neighbours make a known token, by the token's rank. Each token of the file, taken alone, is
    made by its own merge, so until a merge crosses its ends no other two parts of it can stand there, and the results
    are equal (a test tries all tokens). Other characters stay with ``tokenizers``: the two libraries might sort rare ones differently.
    """
    import tiktoken

    from sunledger.llm.bpe import PATTERN, MergeList

    merges = MergeList(path, lookahead=False)
    ranks = {b: i for i, b in merges.bytes_of.items() if i not in merges.special.values()}
    fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    special = tuple(merges.special)

    def encode(piece: str) -> list[int]:
        if piece.isascii() or max(piece) < "\u0250":
            if not any(s in piece for s in special):
                return fast(piece)
        return encode_piece(piece)

    return encode


def words_first(path: str, encode_piece):
    """The same for words of small Latin letters and a vocabulary that marks word ends.

    A stop stands for the mark, as no such word holds one; joining it to the last byte has the first ranks, as the file
    takes both for one symbol. All other pieces go to ``tokenizers``.
    """
    import tiktoken

    from sunledger.llm.bpe import byte_letters

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters, vocab, mark = byte_letters(), model["vocab"], model["end_of_word_suffix"]

    def bytes_of(token: str) -> bytes:
        ends = token.endswith(mark)
        return bytes(letters[c] for c in (token[: -len(mark)] if ends else token)) + b"." * ends

    ranks = {bytes([b]): b for b in range(256)}
    ids = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
    merged = (a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]))
    for token in [*(c + mark for c in letters), *merged]:
        data = bytes_of(token)
        if b"." not in data[:-1] and data not in ranks:
            ranks[data] = len(ids)
            ids.append(vocab[token])
    fast = tiktoken.Encoding("marked", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(piece: str) -> list[int]:
        if piece.isalpha() and piece.islower() and max(piece) < "\u0250":
            return [ids[r] for r in fast(piece + ".")]
        return encode_piece(piece)

    return encode


def library_encoder(path: str, kind: str) -> PieceEncoder:
    """One encoder per worker process, ``held`` by its ``kind``: ``byte`` (cut before spaces) or ``word`` (white space is dropped)."""

    def make():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        def encode_piece(piece):
            return tokenizer.encode(piece, add_special_tokens=False).ids

        encode_piece = {"byte": latin_first, "word": words_first}[kind](path, encode_piece)
        return PieceEncoder({"byte": byte_units, "word": word_units}[kind], encode_piece)

    return held(kind, path, make)
