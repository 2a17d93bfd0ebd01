import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
PASSAGE = "shared passage " + " ".join(f"term{i}" for i in range(90))
TEXTS = [
    None,
    "",
    "   \n\t ",
    "12 345 !!",
    "The quick brown fox jumps over the lazy dog near the river bank today",
    "The quick brown fox jumps over the lazy dog near the river bank today",
    "one two",
    "one two",
    "naïve café " * 60 + PASSAGE,
    PASSAGE + " and its own end é",
    LONG,
    "a" * 3000,
    "Released under the MIT License.\nBody of the text.",
    "\x00 odd   white　space <|endoftext|> 👍🏽 ́ İ",
]


@pytest.fixture(scope="session")
def nasty(spark):
    """Odd rows: NULLs in every column, repeated rows, and extra columns whose names the operators use themselves."""
    rows = [(i, t, ["en", "fr", None][i % 3], None if i % 4 == 0 else "s", len(t) if t else None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[10], (None, "row without an id but with a few words in it", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = {n: F.lit("x") for n in ("id", "rid", "rep", "key", "score", "order", "ids", "bytes", "row", "a", "b", "class", "part", "first", "label", "embedding")}
    return df.repartition(3, "source").sortWithinPartitions("doc_id").withColumns(extra)


@pytest.fixture(scope="session")
def empty(nasty):
    return nasty.where("1 = 0")
