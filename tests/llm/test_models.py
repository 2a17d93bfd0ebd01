"""Language and quality models: gradients, sparsity, held-out accuracy, odd rows."""

import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sunledger.llm import langid, quality
from tests.oracle import SF_ROOT

SF = f"{SF_ROOT}/sf0.1"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_grams_see_word_edges_and_drop_the_rest():
    a, b, none, empty = langid.gram_counts(["Ab, cd", "ab  CD 7", "12 !", ""])
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and none is None and empty is None
    assert a[1].sum() == 7 + 6 + 5  # " ab cd " has 7 single characters


def test_batch_and_single_text_agree():
    texts = ["Der Hund", "", "le chat noir", "7", "x" * 3000]
    for one, many in zip([langid.gram_counts([t])[0] for t in texts], langid.gram_counts(texts)):
        assert (one is None) == (many is None)
        assert one is None or ((one[0] == many[0]).all() and (one[1] == many[1]).all())
    x, n = quality.passages(texts)
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends):
        assert np.allclose(quality.passages([t])[0], x[a:b])


def test_ftrl_is_sparse_and_separates():
    random_ = np.random.default_rng(0)
    model = langid.Ftrl(2, 50)
    for _ in range(400):
        label = int(random_.integers(2))
        held = np.array([label, *random_.integers(2, 50, 4)])
        model.learn(held, np.ones(5), label)
    w = model.weights()
    assert w[0, 0] > 0 > w[1, 0] and w[1, 1] > 0 > w[0, 1]
    strong = langid.Ftrl(2, 50, l1=1e6)
    strong.learn(np.array([1, 2]), np.ones(2), 0)
    assert not strong.weights().any()


def test_temperature_softens_wrong_confidence():
    logits = np.array([[4.0, 0.0]] * 10)
    assert langid.fit_temperature(logits, np.array([0] * 6 + [1] * 4)) > 3
    assert langid.fit_temperature(logits[:0], np.array([], int)) == 1.0


def test_temperature_of_rows_that_are_all_told_right():
    logits = np.array([[4.0, 0.0], [0.0, 4.0]] * 20)
    t = np.log(langid.fit_temperature(logits, np.array([0, 1] * 20)))
    assert langid.COLDEST + 1 < t < langid.HOTTEST - 1
    # Labels 21/22 and 1/22: the best logit is their log ratio.
    assert np.isclose(4 / np.exp(t), np.log(21), atol=1e-3)


def test_language_on_held_out_rows(documents):
    model = langid.train(documents, ~langid.held_out(F.col("doc_id")), per_language=400)
    rows = langid.predict(documents.where(langid.held_out(F.col("doc_id"))), model).collect()
    right = np.array([r["lang_pred"] == r["lang"] for r in rows])
    score = np.array([r["score"] for r in rows])
    assert right.mean() > 0.98
    assert ((0 <= score) & (score <= 1)).all() and (model.weights == 0).mean() > 0.5
    assert langid.COLDEST + 1 < np.log(model.temperature) < langid.HOTTEST - 1
    # Ten bins: where rows are many, those of a bin are right at least as often as their scores say, but for a tenth.
    for b in range(10):
        bin_ = (score * 10).astype(int).clip(0, 9) == b
        assert bin_.sum() < 50 or right[bin_].mean() > score[bin_].mean() - 0.1
    # A script or a handful of letters that was not learned lies clearly below.
    foreign = [p for _, p in model.predict(["これは日本語の文章です。" * 20, "Это русский текст для проверки " * 9, "xyz"])]
    assert max(foreign) < 0.5 < np.quantile(score, 0.01)


def test_long_texts_are_counted_in_steps():
    random_ = np.random.default_rng(5)
    text = "".join(random_.choice(list("abcÄß  .7\nΣ"), 5000))
    for t in (text, "x" * 999, "..a", "a..", "7", "", "ΑΣ ΑΣ"):
        want = langid.gram_counts([t])[0]
        for step in (1, 2, 3, 7, 1000, 4999):
            got = langid.long_counts(t, step)
            assert (got is None) == (want is None)
            assert got is None or ((got[0] == want[0]).all() and (got[1] == want[1]).all())


def test_memory_of_a_long_text_is_bounded():
    text = "le chat noir dort " * 1_700_000  # 30 million characters
    tracemalloc.start()
    try:
        grams = langid.gram_counts([text, "le chat"])
        share = langid.evidence(text, langid.letters())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert grams[0][1].sum() == 3 * (len(text) + 1) - 3 and share > 0.99
    assert peak < 200 << 20


def test_language_of_odd_rows(nasty, empty):
    docs = nasty.drop("score", "order")
    model = langid.train(docs, F.lit(True))
    got = langid.predict(docs, model).collect()
    assert len(got) == nasty.count()
    for r in got:
        letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in ("en", "fr")) if letter else (r["lang_pred"] == "und" and r["score"] == 0)
    with pytest.raises(ValueError):
        langid.predict(nasty, model)
    nothing = langid.train(empty, F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(empty.drop("score"), model).count() == 0


def test_folds_follow_the_id_as_text(spark):
    ids = [0, 1, 49, 123456789012, -3]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", langid.held_out(F.col("doc_id")), quality.held_out(F.col("doc_id"))).collect()
    for i, five, three in got:
        assert five == (zlib.crc32(str(i).encode()) % 5 == 0) and three == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_attention_gradients():
    x, n = quality.passages(["some words here " * 60, "OTHER!! WORDS!! " * 90, ""])
    model = quality.fit([(i, i % 2, part) for i, part in enumerate(np.split(x, np.cumsum(n)[:-1]))], epochs=1)
    model.params = {k: v.astype(float) for k, v in model.params.items()}
    x, bounds, y = ((x - model.mean) / model.scale).astype(float), np.r_[0, np.cumsum(n)[:-1]], np.array([0.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, bounds)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, gradient in quality.gradients(model, x, bounds, y).items():
        values = model.params[name]
        for place in ((0,) * values.ndim, tuple(s - 1 for s in values.shape)):
            old = values[place]
            values[place] = old + 1e-5
            high = loss()
            values[place] = old - 1e-5
            low = loss()
            values[place] = old
            assert abs((high - low) / 2e-5 - gradient[place]) < 1e-5


def test_attention_finds_the_telling_passage():
    rng, rows = np.random.default_rng(1), []
    for i in range(300):
        x = rng.standard_normal((int(rng.integers(1, 8)), quality.FEATURES)).astype(np.float32)
        label = i % 2
        if label:
            x[int(rng.integers(len(x))), :3] += 4
        rows.append((i, label, x))
    model = quality.fit(rows[:200], epochs=60)
    x = np.concatenate([r[2] for r in rows[200:]])
    bounds = np.r_[0, np.cumsum([len(r[2]) for r in rows[200:]])[:-1]]
    p = model.forward((x - model.mean) / model.scale, bounds)["p"]
    assert ((p >= 0.5) == np.array([r[1] for r in rows[200:]])).mean() > 0.85


def test_quality_on_held_out_rows(documents, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(documents, labels, ~quality.held_out(F.col("doc_id")), per_class=600)
    scored = quality.score(documents.where(quality.held_out(F.col("doc_id"))), model).join(labels, "doc_id").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in scored]) > 0.97


def test_quality_of_odd_rows(nasty, empty, spark):
    docs = nasty.drop("score")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(12)] + [(None, 1, 0), (3, None, 0), (4, 7, 0), (999, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, labels, F.lit(True))).collect()
    assert len(got) == nasty.count() and all(0 <= r["score"] <= 1 for r in got)
    one_sided = quality.train(docs, labels.where("quality = 1"), F.lit(True))
    assert {round(r["score"], 3) for r in quality.score(docs, one_sided).collect()} == {round(7 / 8, 3)}
    assert {r["score"] for r in quality.score(docs, quality.train(docs, labels.limit(0), F.lit(True))).collect()} == {0.5}
    assert quality.score(empty.drop("score"), one_sided).count() == 0
    with pytest.raises(ValueError):
        quality.score(nasty, one_sided)
