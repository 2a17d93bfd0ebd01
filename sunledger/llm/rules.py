"""Quality rules: a table of thresholds compiled into one projection of counts and ratios, without user functions.

A rule bounds a ratio of two counts of a text, in thousandths, so that it is decided by whole numbers. All counts of a text come from
three arrays (words, lines, three-word windows) that are each made once per row; nothing is shuffled and nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the languages of the corpus.
STOP_WORDS = {
    "de": "als auf auch aus bei das dass dem den der des die ein eine es für im in ist mit nicht nach sich sie und von vor wie wird zu zur",
    "en": "a an and are as at be but by for from had has have in is it not of on or that the this to was were which with",
    "es": "al como con de del el en es la las lo los más no o para pero por que se sin su un una y",
    "fr": "à au aux avec ce dans de des du elle en est et il la le les ne on ou par pas plus pour que qui se sur un une",
}
ALL_STOP_WORDS = sorted({w + stop for words in STOP_WORDS.values() for w in words.split() for stop in ("", ",", ".")})


class Rule(NamedTuple):
    """``least`` <= 1000 * ``count`` / ``of`` <= ``most``; an open end is None. A ratio of nothing holds."""

    name: str
    count: str
    of: str
    least: int | None
    most: int | None


# Too little text, and text that repeats itself, fail before any other rule.
BASE = [
    Rule("words", "n_words", "one", 50_000, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 500),
]
RULES = [
    Rule("word_length", "word_chars", "n_words", 2_000, 14_000),
    Rule("symbols", "n_symbols", "n_words", None, 100),
    Rule("stop_words", "n_stop_words", "n_words", 20, None),
    Rule("words_with_letters", "n_letter_words", "n_words", 700, None),
    Rule("capital_words", "n_capital_words", "n_words", None, 400),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 300),
]
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_stop_words", "n_letter_words", "n_capital_words",
    "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_repeat_words",
]

WINDOW = 3
PLACE_BITS = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def total(flags: Column) -> Column:
    return F.size(flags).cast("bigint")


def repeated_words(words: Column) -> Column:
    """Words inside windows of three that stand twice or more in the array, the first one included.

    Windows meet by a sorted array of longs (hash and place), which Spark sorts fast; only those whose hash stands twice are sorted by their words.
    """

    def covered(places: Column) -> Column:
        step = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda n, s: n + s)

    def neighbours(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
        """The members that equal the one before or behind them in a sorted array."""
        none = F.lit(False)
        return F.filter(ordered, lambda x, k: ((k > 0) & F.coalesce(same(x, F.get(ordered, k - 1)), none)) | F.coalesce(same(x, F.get(ordered, k + 1)), none))

    def same_words(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def exact(places: Column) -> Column:
        rows = F.transform(places, lambda i: F.struct(words[i].alias("a"), words[i + 1].alias("b"), words[i + 2].alias("c"), i.alias("i")))
        found = let(F.sort_array(rows), lambda ordered: F.transform(neighbours(ordered, same_words), lambda x: x["i"]))
        return let(F.sort_array(found), covered)

    n = F.greatest(F.size(words) - WINDOW + 1, F.lit(0))
    windows = F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c"))
    keys = F.transform(windows, lambda x, i: F.shiftleft(F.xxhash64(x["a"], x["b"], x["c"]), PLACE_BITS).bitwiseOR(i.cast("bigint")))
    same_hash = lambda x, y: F.shiftright(x, PLACE_BITS) == F.shiftright(y, PLACE_BITS)
    place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    likely = let(F.sort_array(keys), lambda ordered: F.transform(neighbours(ordered, same_hash), place))
    every = F.transform(F.slice(words, 1, n), lambda x, i: i)  # places of so long a text do not fit into the keys
    return let(F.when(n < 1 << PLACE_BITS, likely).otherwise(every), lambda places: F.when(F.size(places) > 0, exact(places)).otherwise(F.lit(0).cast("bigint")))


def counts(text: Column) -> Column:
    """A struct of all ``COUNTS`` (long) of a text and ``one``; a NULL text counts as an empty one."""

    def of_words(t: Column, w: Column) -> Column:
        return F.struct(
            total(w).alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            total(F.filter(w, lambda x: F.lower(x).isin(ALL_STOP_WORDS))).alias("n_stop_words"),
            total(F.filter(w, lambda x: F.upper(x) != F.lower(x))).alias("n_letter_words"),
            total(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.length(x) > 1))).alias("n_capital_words"),
            repeated_words(w).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            total(lines).alias("n_lines"),
            (total(lines) - total(F.array_distinct(lines))).alias("n_dup_lines"),
            total(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^[-•*·]"))).alias("n_bullet_lines"),
            total(F.filter(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_ellipsis_lines"),
        )

    def both(t: Column) -> Column:
        words = F.filter(F.split(t, BLANKS), lambda x: x != "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(let(words, lambda w: of_words(t, w)).alias("w"), let(lines, of_lines).alias("l"))

    def flat(x: Column) -> Column:
        fields = [x["l"][n] if n.endswith("_lines") or n == "n_lines" else x["w"][n] for n in COUNTS]
        return F.struct(*[f.alias(n) for f, n in zip(fields, COUNTS)], F.lit(1).cast("bigint").alias("one"))

    return let(let(F.coalesce(text, F.lit("")), both), flat)


def compiled(rules: Sequence[Rule], counted: Column) -> Column:
    """The names of the rules that ``counted`` breaks, in table order, as one expression."""
    broken = []
    for r in rules:
        scaled, of = counted[r.count] * 1000, counted[r.of]
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (scaled < of * r.least)
        if r.most is not None:
            bad = bad | (scaled > of * r.most)
        broken.append(F.when(bad, F.lit(r.name)))
    return F.filter(F.array(*broken), lambda x: x.isNotNull())


def rate(docs: DataFrame, text: str = "text", base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES, name: str = "rated") -> DataFrame:
    """``docs`` with one more column ``name``: a struct of all counts, ``base_broken`` and ``broken`` (names of the rules that the text
    breaks) and ``kept`` (no rule of either table is broken).

    A NULL text counts as empty: all counts are 0, it has too few words and is not kept. Repeated rows are judged alike, a table without rows
    gives none, and all other columns pass through; ``name`` must not be among them.
    """
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")

    def judged(c: Column) -> Column:
        lists = let(F.struct(compiled(base, c).alias("b"), compiled(rules, c).alias("r")), lambda x: F.struct(
            x["b"].alias("base_broken"), x["r"].alias("broken"), ((F.size(x["b"]) == 0) & (F.size(x["r"]) == 0)).alias("kept")
        ))
        return let(lists, lambda x: F.struct(*[c[n].alias(n) for n in COUNTS], *[x[n].alias(n) for n in ("base_broken", "broken", "kept")]))

    return docs.withColumn(name, let(counts(F.col(text).cast("string")), judged))


def rate_sql(base: Sequence[Rule] = BASE, rules: Sequence[Rule] = RULES) -> str:
    """The query of ``rate`` over ``documents`` as SQL of its own: windows are rows there, and lines and words are lists."""

    def holds(rs: Sequence[Rule]) -> str:
        parts = [f"1000 * {r.count} >= {r.least} * {'1' if r.of == 'one' else r.of}" for r in rs if r.least is not None]
        return " AND ".join(parts + [f"1000 * {r.count} <= {r.most} * {'1' if r.of == 'one' else r.of}" for r in rs if r.most is not None])

    stops = ", ".join(f"'{w}'" for w in ALL_STOP_WORDS)
    return rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
      a AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
              list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
      g AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM a)),
      p AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
      v AS (SELECT r, count(DISTINCT i + k) AS n FROM p, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
      m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS chars,
              CAST(length(t) - length(regexp_replace(t, '{SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
              len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS n_stop_words,
              len(list_filter(w, lambda x: upper(x) <> lower(x))) AS n_letter_words,
              len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 1)) AS n_capital_words,
              len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
              len(list_filter(l, lambda x: regexp_matches(ltrim(x, ' '), '^[-•*·]'))) AS n_bullet_lines,
              len(list_filter(l, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_ellipsis_lines,
              CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words FROM a LEFT JOIN v USING (r)),
      n AS (SELECT *, coalesce(chars, 0) AS word_chars FROM m)
      SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT ({holds(base)}) AS base_failed, {holds(base)} AND {holds(rules)} AS kept FROM n"""
