"""Quality rules against a plain count of the same things."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sunledger.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BODY = " ".join(f"word{i} the" for i in range(40))
TEXTS = [
    None, "", " \n\t ", "one two", "a b c a b c", "a b c d a b c x b c d", "x " * 60, "x x x", "x x x x",
    "same line\nother\nsame line\n\n \nsame line \nsame line", "UPPER WORDS! Ünd ß É 12 ab", "a#b $ % & | <> * plain",
    "- one\n• two\n* three\nfour...\nfive… \n six", BODY, BODY + "\n" + BODY, "\x0b\x0c\r tab\x1cword nbsp　wide",
    "👍🏽 naïve é", "long " * 50_000 + "end", " ".join(f"w{i % 4001}" for i in range(40_000)),
]


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def rated(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4]), (None, "x y")]
    return rules.rate(spark.createDataFrame(rows, "doc_id int, text string").repartition(3)).collect()


def test_counts_equal_plain_counts(rated):
    assert len(rated) == len(TEXTS) + 2
    for r in rated:
        x = r["rated"]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == plain(r["text"]), r["doc_id"]


def test_verdicts(rated):
    by_id = {r["doc_id"]: r["rated"] for r in rated}
    assert by_id[0]["base_broken"] == ["words"] and not by_id[0]["kept"] and by_id[0]["n_words"] == 0
    assert by_id[6]["base_broken"] == ["repeated_words"]
    assert by_id[13]["kept"] and by_id[13]["broken"] == [] and by_id[13]["n_stop_words"] == 40
    assert by_id[14]["base_broken"] == ["repeated_words"]
    assert (by_id[12]["n_bullet_lines"], by_id[12]["n_ellipsis_lines"], by_id[12]["n_lines"]) == (3, 2, 6)
    assert (by_id[10]["n_capital_words"], by_id[10]["n_letter_words"]) == (2, 6)
    for r in rated:
        x = r["rated"]
        assert x["kept"] == (not x["base_broken"] and not x["broken"])


def test_each_rule_has_its_threshold(spark):
    df = spark.createDataFrame([(" ".join(["#"] * k + ["the"] * (60 - k)),) for k in (0, 6, 7)], "text string")
    table = [rules.Rule("symbols", "n_symbols", "n_words", None, 100)]
    assert [r["rated"]["broken"] for r in rules.rate(df, base=[], rules=table).collect()] == [[], [], ["symbols"]]
    assert [r["rated"]["kept"] for r in rules.rate(df, base=[], rules=[]).collect()] == [True] * 3


def test_many_windows_with_one_hash(spark, monkeypatch):
    """With places in all bits but a few of the hash, different windows meet and are told apart by their words."""
    monkeypatch.setattr(rules, "PLACE_BITS", 62)
    df = spark.createDataFrame([(t,) for t in TEXTS if t and len(t) < 10_000], "text string")
    for r in rules.rate(df).collect():
        assert r["rated"]["n_repeat_words"] == plain(r["text"])[4]
    monkeypatch.setattr(rules, "PLACE_BITS", 2)  # places do not fit: every window is sorted by its words
    for r in rules.rate(df).collect():
        assert r["rated"]["n_repeat_words"] == plain(r["text"])[4]


def test_odd_and_empty_tables(spark, nasty, empty):
    out = rules.rate(nasty)
    assert out.columns == [*nasty.columns, "rated"] and out.count() == nasty.count()
    assert rules.rate(empty).count() == 0
    with pytest.raises(ValueError):
        rules.rate(nasty.withColumn("rated", F.lit(1)))


def test_one_projection_without_python(spark, nasty):
    plan = rules.rate(nasty.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Join") == 0
