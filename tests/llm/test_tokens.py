"""Packing, streaming BPE and token files against the tokenizers library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sunledger.llm import bpe, packing, tokenfile, tokens
from sunledger.llm.common import map_arrow

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "the", " ", "  ", "\n", "\t", "é", "ß", "<|endoftext|>", "'s", "12", "!", "...", ".", ", ", "日本", "\x1c", "\x85", "　", "👍", "ing", "́", "Σ", "İ", "יִ", "K", "Word. "]


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


@pytest.fixture(scope="module")
def merges():
    return bpe.MergeList(BYTE)


def test_each_token_is_made_by_its_own_merge(merges):
    assert all(merges.encode_window(b) == [i] for i, b in merges.bytes_of.items() if i not in merges.special.values())


def test_words_with_marked_ends_equal_the_library():
    library, encode = Tokenizer.from_file(WORD), tokens.words_first(WORD, None)
    random_ = random.Random(11)
    words = ["".join(random_.choice("abcdefghijklmnopqrstuvwxyzéèêçüßñóíäöå") for _ in range(random_.randrange(1, 14))) for _ in range(3000)]
    words += [t[:-4] for t in library.get_vocab() if t.endswith("</w>") and t[:-4].isascii() and t[:-4].isalpha() and t[:-4].islower()]
    assert all(encode(w) == library.encode(w, add_special_tokens=False).ids for w in words)


def ids_of(tokenizer, text):
    return np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoders_equal_the_library(byte_library):
    random_, word_library = random.Random(1), Tokenizer.from_file(WORD)
    own = bpe.stream_encoder(BYTE)[1]
    for _ in range(1500):
        text = "".join(random_.choice(PARTS) for _ in range(random_.randrange(30)))
        want = ids_of(byte_library, text)
        assert own.encode([text])[0] == want, repr(text)
        assert tokens.library_encoder(BYTE, "byte").encode([text])[0] == want, repr(text)
        assert tokens.library_encoder(WORD, "word").encode([text])[0] == ids_of(word_library, text), repr(text)


def test_memory_stays_bounded(byte_library):
    encoder = tokens.PieceEncoder(tokens.byte_units, lambda p: byte_library.encode(p, add_special_tokens=False).ids, size=10)
    for i in range(40):
        text = f"alpha{i} beta{i % 3}. gamma"
        assert encoder.encode([text])[0] == ids_of(byte_library, text)
        assert len(encoder.memory) <= 20 and len(encoder.memory.older) <= 20


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["a", "an", "the", "ing", "tion", "zz", "aaaa", "e", "é", "\n"]), max_size=800), st.integers(1, 90), st.randoms(use_true_random=False))
def test_transducer_emits_what_the_whole_word_gives(parts, window, random_):
    merges_ = bpe.stream_encoder(BYTE)[0]
    data = "".join(parts).encode()
    machine, got, at = bpe.Transducer(merges_, window), [], 0
    while at < len(data):
        n = random_.randrange(1, 200)
        got += machine.feed(data[at : at + n])
        assert len(machine.held) <= window + merges_.lookahead
        at += n
    assert [*got, *machine.finish()] == merges_.encode_window(data)


def test_lookahead_of_a_small_merge_list(merges):
    # Every settled end really holds: no continuation changes a token whose end is that far back.
    random_ = random.Random(4)
    for _ in range(300):
        head = "".join(random_.choice(["th", "e", "re", "ing", "a", "s"]) for _ in range(40)).encode()
        end, kept = 0, []
        for t in merges.encode_window(head):
            end += len(merges.bytes_of[t])
            if end + merges.settle[t] > len(head):
                break
            kept.append(t)
        tail = "".join(random_.choice(["ing", "ed", "x", "tion"]) for _ in range(6)).encode()
        assert merges.encode_window(head + tail)[: len(kept)] == kept


def test_decoder_is_incremental_and_replaces_broken_bytes(byte_library, merges):
    random_ = random.Random(2)
    for _ in range(300):
        ids = [random_.randrange(50257) for _ in range(random_.randrange(12))]
        machine = bpe.TextDecoder(merges)
        assert "".join(machine.feed([i]) for i in ids) + machine.finish() == byte_library.decode(ids, skip_special_tokens=False)


def test_encode_decode_rows(nasty, empty, byte_library):
    got = bpe.encode_decode(nasty, BYTE).collect()
    assert len(got) == nasty.count()
    text_of = {r["doc_id"]: r["text"] for r in nasty.collect() if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is not None:
            text = text_of[r["doc_id"]] or ""
            assert r["decoded"] == text and bytes(r["ids"]) == ids_of(byte_library, text) and r["n_tokens"] == len(r["ids"]) // 4
    assert bpe.encode_decode(empty, BYTE).count() == 0


def squares(counts, capacity):
    return sum(counts[level] ** 2 for level in range(1, capacity))


def test_sum_of_squares_takes_the_best_level():
    random_, capacity = random.Random(3), 24
    packer = packing.SumOfSquares(capacity)
    for i in range(600):
        length = random_.randrange(1, capacity)
        choices = []
        for level in range(0, capacity - length + 1):
            if level and not packer.counts[level]:
                continue
            after = packer.counts.copy()
            if level:
                after[level] -= 1
            if level + length < capacity:
                after[level + length] += 1
            choices.append(squares(after, capacity))
        packer.put((i, 0, length))
        assert squares(packer.counts, capacity) == min(choices)
        assert all(len(s) == n for s, n in zip(packer.stacks, packer.counts))


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack_covers_each_id_once(nasty, empty, byte_library, capacity):
    pieces = packing.pack(nasty, BYTE, capacity=capacity).collect()
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
        documents[p["doc_id"]].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] == len(p["piece_ids"]) // 4 > 0
            at += p["length"]
        assert at == capacity or at < capacity and at & (at - 1) == 0  # no padding at all
    texts = {r["doc_id"]: r["text"] for r in nasty.collect()}
    for key, found in documents.items():
        if key is None or key in (4, 10):  # repeated or NULL ids share a key
            continue
        whole = b"".join(bytes(p["piece_ids"]) for p in sorted(found, key=lambda p: p["start"]))
        assert whole == ids_of(byte_library, texts[key] or "") + b"\0\0\0\0"
        assert {p["doc_tokens"] for p in found} == {len(whole) // 4}
    assert sum(p["length"] for p in documents[4]) == 2 * documents[4][0]["doc_tokens"]
    assert packing.pack(empty, BYTE).count() == 0


def test_blocks_round_trip():
    random_ = random.Random(5)
    for _ in range(200):
        n = random_.randrange(1, 9000)
        top = random_.choice([1, 2, 100, 50_000, 2**32])
        ids = np.array([random_.randrange(2**32) if random_.random() < 0.02 else random_.randrange(top) for _ in range(n)], np.uint32)
        payload, index = tokenfile.encode_ids(ids)
        assert (tokenfile.decode_blocks(payload, index) == ids).all()
        k = len(index) // 8
        a, b = sorted((random_.randrange(k + 1), random_.randrange(k + 1)))
        assert (tokenfile.decode_blocks(payload, index, a, b) == ids[4096 * a : 4096 * b]).all()


def test_outliers_do_not_widen_a_block():
    ids = np.full(1024, 7, np.uint32)
    ids[::100] = 2**31
    assert len(tokenfile.encode_block(ids)) < 120
    assert (tokenfile.decode_block(memoryview(tokenfile.encode_block(ids))) == ids).all()


def test_file_set_reads_back(nasty, empty, spark):
    library = Tokenizer.from_file(WORD)
    got = sorted(tokenfile.read_ids(spark, tokenfile.write_ids(nasty, WORD)).collect(), key=lambda r: r["start"])
    texts = {r["doc_id"]: r["text"] for r in nasty.collect() if r["doc_id"] is not None}
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in nasty.collect()), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
        if r["doc_id"] is not None:
            assert zlib.crc32(bytes(r["ids"])) == zlib.crc32(ids_of(library, texts[r["doc_id"]] or "") + b"\x02\0\0\0")
        at += r["n_tokens"]
    assert tokenfile.read_ids(spark, tokenfile.write_ids(empty, WORD)).count() == 0


def test_encoders_leave_the_workers_when_another_operator_begins(spark):
    docs = spark.range(80).selectExpr("id AS doc_id", "concat('some words ', id) AS text").repartition(8)

    def alive(batches):
        import gc

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(type(o).__name__ == "PieceEncoder" for o in gc.get_objects())], pa.int64())], names=["n"])

    for encode in (lambda: packing.pack(docs, BYTE), lambda: bpe.encode_decode(docs, BYTE)):
        assert encode().count() >= 80
        assert map_arrow(docs, alive, "n bigint").agg({"n": "max"}).first()[0] == 0
