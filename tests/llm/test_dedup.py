"""Suffix dedup, near-duplicates and components against brute force."""

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import minhash, repeats, suffixes
from sunledger.llm.graph import components


def prefix_of(a, b, cap):
    k = 0
    while k < min(len(a), len(b), cap) and a[k] == b[k]:
        k += 1
    return k


@pytest.mark.parametrize("block,short", [(1, 3), (16, 3), (512, 1024)])
def test_suffix_array_and_prefixes(monkeypatch, block, short):
    monkeypatch.setattr(suffixes, "LEAST_BLOCK", block)
    monkeypatch.setattr(suffixes, "SHORT", short)
    random_ = random.Random(block)
    for turn in range(150):
        base = [random_.randrange(1, 2 + turn % 20) for _ in range(60)]
        text = []
        for _ in range(random_.randrange(6)):
            a, b = sorted((random_.randrange(60), random_.randrange(60)))
            text += base[a:b] * random_.randrange(1, 4)
        text.append(0)
        with suffixes.Scratch() as scratch:
            order, prefix = suffixes.suffix_array(np.array(text), 25, scratch, cap=20)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        want = [prefix_of(text[a:], text[b:], 20) for a, b in zip(order[:-1], order[1:])]
        assert prefix.tolist()[1:] == want


def test_large_arrays_lie_on_disk(monkeypatch):
    monkeypatch.setattr(suffixes, "MEMORY", 64)
    with suffixes.Scratch() as scratch:
        assert isinstance(scratch.array(100, np.int64, 0), np.memmap)
        order, _ = suffixes.suffix_array(np.array([*b"mississippi" * 9, 0]), 256, scratch, cap=9)
        text = [*b"mississippi" * 9, 0]
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("most", [1, 3, 8])
def test_suffixes_across_blocks(monkeypatch, most):
    monkeypatch.setattr(suffixes, "MOST_BLOCK", most)
    monkeypatch.setattr(suffixes, "LEAST_BLOCK", 1)
    monkeypatch.setattr(suffixes, "SHORT", 3)
    monkeypatch.setattr(suffixes, "MEMORY", 32)
    random_ = random.Random(most)
    for turn in range(40):
        text = [random_.randrange(1, 2 + turn % 6) for _ in range(random_.randrange(60))] * random_.randrange(1, 3) + [0]
        with suffixes.Scratch() as scratch:
            order, prefix = suffixes.suffix_array(np.array(text), 8, scratch, cap=20)
            assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
            assert prefix.tolist()[1:] == [prefix_of(text[a:], text[b:], 20) for a, b in zip(order[:-1], order[1:])]


def test_the_heap_does_not_grow_with_the_text(monkeypatch):
    monkeypatch.setattr(suffixes, "MEMORY", 1 << 16)
    monkeypatch.setattr(suffixes, "MOST_BLOCK", 1 << 12)
    text = np.r_[np.random.default_rng(3).integers(2, 258, 1 << 18), 0].astype(np.uint16)
    tracemalloc.start()
    try:
        with suffixes.Scratch() as scratch:
            suffixes.suffix_array(text, 258, scratch, cap=400)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * len(text)


def covered(rows, size):
    """(row number -> covered mask) by looking at every window."""
    places = defaultdict(list)
    for i, b in enumerate(rows):
        for p in range(len(b) - size + 1):
            places[b[p : p + size]].append((i, p))
    masks = [np.zeros(len(b), bool) for b in rows]
    for found in places.values():
        if len(found) > 1:
            for i, p in found:
                masks[i][p : p + size] = True
    return masks


def check_repeats(df, size):
    # Rows are told apart by a number of the test's own; repeated rows would share an id.
    df = df.withColumn("test_row", F.monotonically_increasing_id())
    rows = df.orderBy("test_row").collect()
    data = [(r["text"] or "").encode() for r in rows]
    got = {r["test_row"]: r for r in repeats.remove_repeats(df, size).collect()}
    assert len(got) == len(rows)
    for r, b, mask in zip(rows, data, covered(data, size)):
        g = got[r["test_row"]]
        assert bytes(g["__kept"]) == np.frombuffer(b, np.uint8)[~mask].tobytes()
        assert (g["__n_bytes"], g["__n_removed"]) == (len(b), int(mask.sum()))
        assert g["__n_spans"] == int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        assert {c: g[c] for c in df.columns} == r.asDict()


def test_repeats_of_odd_rows(nasty, empty):
    check_repeats(nasty.where("doc_id is null or doc_id <> 10"), 400)
    assert repeats.remove_repeats(empty, 400).count() == 0


def test_repeats_do_not_depend_on_the_splits_of_a_job(spark, tmp_path):
    bodies = ["".join(random.Random(i % 3).choices("abcdefgh ", k=700)) for i in range(8)]
    texts = [("x" * i) + b if i % 2 else f"{i}, a text of its own" for i, b in enumerate(bodies)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(8, "doc_id").write.parquet(f"{tmp_path}/docs")
    docs, key = spark.read.parquet(f"{tmp_path}/docs"), "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(key, "1")
        cut = repeats.remove_repeats(docs, 400)
        spark.conf.set(key, "64")
        got = {r["doc_id"]: bytes(r["__kept"]) for r in cut.collect()}
    finally:
        spark.conf.unset(key)
    masks = covered([t.encode() for t in texts], 400)
    assert got == {i: np.frombuffer(t.encode(), np.uint8)[~m].tobytes() for i, (t, m) in enumerate(zip(texts, masks))}
    assert any(m.any() for m in masks)


def test_repeats_with_a_crowded_passage(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 5)
    monkeypatch.setattr(repeats, "STEP_BYTES", 1500)
    random_ = random.Random(6)

    def noise(n):
        return "".join(random_.choice("abcdefgh é") for _ in range(n))

    passage, long = noise(700), noise(2500)
    texts = [noise(random_.randrange(200)) + passage[random_.randrange(200) :][: random_.randrange(380, 520)] + noise(random_.randrange(200)) for _ in range(60)]
    texts += [long, noise(50) + long, long[:2000] + noise(30) + long[1800:], "xyz" * 400, noise(399), None]
    check_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4, "doc_id").sortWithinPartitions("doc_id"), 400)


def test_pieces_of_a_crowd_grow_with_its_rows(spark, monkeypatch):
    """Not with the square of its different texts."""
    monkeypatch.setattr(repeats, "CROWD", 5)
    folded, counts = repeats.folded, []

    def counting(rows, pieces, size, scratch):
        counts.append(pieces.count())
        return folded(rows, pieces, size, scratch)

    monkeypatch.setattr(repeats, "folded", counting)
    rng = np.random.default_rng(7)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = word(320)
    for n in (60, 300):
        docs = spark.createDataFrame([(i, word(200) + passage + word(200)) for i in range(n)], "doc_id long, text string")
        repeats.remove_repeats(docs, size=400).count()
    small, large = counts[::2]
    assert 0 < small and large < 6 * small


def test_copies_of_a_passage_do_not_fill_a_shard(spark, monkeypatch):
    # Every document goes on differently before and behind the passage, so none of its edge runs folds as a whole.
    monkeypatch.setattr(repeats, "CROWD", 5)
    counted, random_ = [], random.Random(12)
    real = repeats.materialize

    def watched(df, purpose, *rest):
        out = real(df, purpose, *rest)
        if purpose == "cuts":
            counted.append(out.agg(F.sum("size")).first()[0] or 0)
        return out

    monkeypatch.setattr(repeats, "materialize", watched)
    passage = "".join(random_.choices("abcdefgh ", k=900))
    for copies in (40, 160):
        texts = ["".join(random_.choices("ijklmnop ", k=150)) + passage + "".join(random_.choices("ijklmnop ", k=150)) for _ in range(copies)]
        check_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4, "doc_id").sortWithinPartitions("doc_id"), 400)
    assert counted[1] <= counted[0] + 10_000


def test_components(spark):
    random_ = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(random_.randrange(2000, 2400), random_.randrange(2000, 2400)) for _ in range(260)]
    links += [(5, None), (None, 7), (9, 9), (3000, 3000), *links[:20]]
    parent = {}

    def find(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: find(i) for i in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingle_counts(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in set(x) & set(y))


def some_texts(n, seed):
    random_ = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        words = random_.choices(vocabulary, k=random_.randrange(3, 120))
        out.append(" ".join(words))
        for _ in range(random_.randrange(6)):
            changed = list(words)
            for _ in range(random_.randrange(0, 4)):
                changed[random_.randrange(len(changed))] = random_.choice(vocabulary)
            out.append(" ".join(changed * random_.choice([1, 1, 1, 2])))
    return out


def test_probability_jaccard_is_exact():
    for text, other in zip(some_texts(40, 1), some_texts(40, 1)[1:]):
        a, b = minhash.shingles([text, other])
        assert abs(minhash.probability_jaccard(a, b) - jaccard(shingle_counts(text), shingle_counts(other))) < 1e-9


def test_registers_agree_with_probability_jaccard():
    base = " ".join(f"w{i}" for i in range(60))
    pairs = [(base, base.replace("w30 ", "x ")), (base + " " + base, base), (base, base + " " + " ".join(f"v{i}" for i in range(30)))]
    for x, y in pairs:
        sets = minhash.shingles([x, y])
        won = minhash.signatures(sets, 4096)
        assert abs((won[0] == won[1]).mean() - minhash.probability_jaccard(*sets)) < 0.04


def brute_classes(texts):
    counts = [shingle_counts(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if counts[i] and counts[i].keys() & counts[j].keys() and jaccard(counts[i], counts[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def test_classes_equal_brute_force(spark):
    texts = some_texts(40, 2)
    got = {r["id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_a_crowd_of_near_copies_is_one_class(spark):
    random_ = random.Random(8)
    words = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        changed = list(words)
        for _ in range(2):
            changed[random_.randrange(150)] = f"x{random_.randrange(10**6)}"
        texts.append(" ".join(changed))
    got = {r["id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)


def test_classes_of_odd_rows(nasty, empty):
    rows = nasty.select(F.col("doc_id").alias("id"), "text")
    got = [(r["id"], r["class_id"]) for r in minhash.classes(rows).collect()]
    assert len(got) == nasty.count() and (None, None) in got
    by_id = dict(got)
    assert by_id[5] == 4 and by_id[7] == 6 and by_id[0] == 0 and by_id[1] == 1 and by_id[2] == 2
    assert minhash.classes(empty.select(F.col("doc_id").alias("id"), "text")).count() == 0


def test_families_are_compared_in_tiles(spark, monkeypatch):
    # Many texts around one text that is not among them: few pairs reach the threshold, and all share buckets.
    monkeypatch.setattr(minhash, "TILE", 7)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    random_ = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(45):
        changed = list(words)
        for _ in range(random_.choice([1, 2, 3])):
            changed[random_.randrange(120)] = f"x{random_.randrange(10**6)}"
        texts.append(" ".join(changed + (words[:20] if i % 9 == 0 else [])))
    got = {r["id"]: r["class_id"] for r in minhash.classes(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == brute_classes(texts)
    sets = minhash.shingles(texts)
    i, j = minhash.similar_pairs(sets, sets, np.ones((len(sets), len(sets)), bool), 0.8)
    want = {(a, b) for a in range(len(sets)) for b in range(len(sets)) if minhash.probability_jaccard(sets[a], sets[b]) >= 0.8 - 1e-12}
    assert set(zip(i.tolist(), j.tolist())) == want
