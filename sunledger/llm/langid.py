"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The weights are trained with follow-the-regularised-leader (FTRL-proximal) under an elastic-net penalty, so most are exactly
zero, and a temperature calibrates the probabilities. It is fitted on documents that the weights have not seen, whole and cut to
50 to 200 characters, against smoothed labels, so that it stays finite when every one of them is told right.

Logits are scaled by the evidence of a text: its letters that the learned rows hold too, over all its letters and ``SHORT`` more. A
script that was not learned thus ends near an even share for each language, whatever its n-grams collide with.

Document frequencies are counted over all learnable rows. The learner sees a bounded sample of them, at most about
``per_language`` documents of each language (chosen by a hash of the id); the bound is that parameter. Prediction reads every
whole text in place, without a shuffle; long texts are counted in steps, so that memory does not follow their length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from sunledger.llm.common import MIX_A, MIX_B, TEXT_BATCH_BYTES, code_points, fold, map_arrow, mix64, text_steps

BUCKETS = 1 << 15
LONGEST_GRAM = 3
UNKNOWN = "und"
SHORT = 8  # letters at which a text counts for half
LEAST_LETTER_SHARE = 1e-6  # a letter is known if it makes up at least this part of the learned letters
PIECES = (50, 100, 150, 200)  # characters of the short texts that take part in the calibration
CODES = 0x110000

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(CODES)), bool, CODES))
    return _LETTERS[0]


def grams_of(plain: np.ndarray) -> list[np.ndarray]:
    """Buckets of the grams of 1, 2, ... characters that start at each place."""
    out = []
    with np.errstate(over="ignore"):
        h = np.zeros(len(plain), np.uint64)
        for n in range(1, LONGEST_GRAM + 1):
            if len(plain) < n:
                out.append(np.zeros(0, np.int64))
                continue
            h = h[: len(plain) - n + 1] * MIX_A + plain[n - 1 :] * MIX_B + np.uint64(n)
            out.append((mix64(h) & np.uint64(BUCKETS - 1)).astype(np.int64))
    return out


def long_counts(text: str, step: int = TEXT_BATCH_BYTES // 4) -> tuple[np.ndarray, np.ndarray] | None:
    """``gram_counts`` of one text in steps of ``step`` characters; the last characters of a step are carried into the next."""
    text = " " + text.lower() + " "
    total, tail, after_letter, found = np.zeros(BUCKETS, np.int64), np.zeros(0, np.uint64), True, False
    for at in range(0, len(text), step):
        codes = np.frombuffer(text[at : at + step].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = letters()[codes]
        keep = letter | np.r_[after_letter, letter[:-1]]
        plain = np.r_[tail, np.where(letter, codes, 32).astype(np.uint64)[keep]]
        for n, g in enumerate(grams_of(plain)):
            total += np.bincount(g[max(0, len(tail) - n) :], minlength=BUCKETS)
        tail, after_letter, found = plain[-(LONGEST_GRAM - 1) :], letter[-1], found or bool(letter.any())
    held = np.flatnonzero(total)
    return (held, total[held]) if found else None


def gram_counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For each text the n-gram buckets it holds and how often; None if it has no letter.

    Texts are lower-cased; each run of other characters counts as one space, also at both ends, so grams see word edges.
    """
    if any(len(t) > TEXT_BATCH_BYTES for t in texts):
        return [long_counts(t) if len(t) > TEXT_BATCH_BYTES else gram_counts([t])[0] for t in texts]
    codes, firsts = code_points([" " + t.lower() + " " for t in texts])
    letter = letters()[codes]
    plain = np.where(letter, codes, 32).astype(np.uint64)
    keep = letter | np.r_[True, letter[:-1]]
    keep[firsts[:-1]] = True
    places = np.cumsum(keep)
    bounds = np.r_[0, places[firsts[1:] - 1]]
    has_letter = np.add.reduceat(letter, firsts[:-1]) if len(texts) else []
    grams = grams_of(plain[keep])
    out: list[tuple[np.ndarray, np.ndarray] | None] = []
    for i in range(len(texts)):
        if not has_letter[i]:
            out.append(None)
            continue
        a, b = bounds[i], bounds[i + 1]
        counts = np.bincount(np.concatenate([g[a : max(a, b - n)] for n, g in enumerate(grams)]), minlength=BUCKETS)
        held = np.flatnonzero(counts)
        out.append((held, counts[held]))
    return out


def letter_steps(text: str):
    """Code points of the lower-cased text's letters, in steps."""
    for at in range(0, len(text), TEXT_BATCH_BYTES):
        codes = np.frombuffer(text[at : at + TEXT_BATCH_BYTES].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        yield codes[letters()[codes]]


def evidence(text: str, known: np.ndarray) -> float:
    """Known letters over all letters and ``SHORT`` more, between 0 and 1."""
    n = good = 0
    for codes in letter_steps(text):
        n += len(codes)
        good += int(known[codes].sum())
    return good / (n + SHORT)


def short_pieces(text: str) -> list[str]:
    """Pieces of the lengths of ``PIECES``, spread over the text; those that a shorter text cannot give are left out."""
    usable = [n for n in PIECES if n < len(text)]
    return [text[(len(text) - n) * (i + 1) // (len(usable) + 1) :][:n] for i, n in enumerate(usable)]


def tf_idf(held: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[held]
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


@dataclass
class Ftrl:
    """Multinomial FTRL-proximal learner with L1 and L2 penalties."""

    classes: int
    size: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01

    def __post_init__(self):
        self.z, self.n = np.zeros((self.classes, self.size)), np.zeros((self.classes, self.size))

    def weights(self, held=slice(None)) -> np.ndarray:
        z, n = self.z[:, held], self.n[:, held]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, held: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(held)
        error = softmax(w @ x)
        error[label] -= 1
        g = error[:, None] * x
        n = self.n[:, held]
        self.z[:, held] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, held] += g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


COLDEST, HOTTEST = -6.0, 3.0  # logarithms of the temperatures that are searched


def fit_temperature(logits: np.ndarray, labels: np.ndarray, documents: np.ndarray | None = None) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm.

    Labels are smoothed as in Platt's method: with n ``documents`` (default: rows) of a label among k labels the label itself is
    given (n + 1) / (n + k) and each other one 1 / (n + k). Rows that are all told right thus do not drive the temperature to zero.
    """
    if not len(labels):
        return 1.0
    k = logits.shape[1]
    n = np.bincount(labels, minlength=k) if documents is None else documents
    wanted = np.repeat((1 / (n[labels] + k))[:, None], k, axis=1)
    wanted[np.arange(len(labels)), labels] = (n[labels] + 1) / (n[labels] + k)

    def loss(log_t):
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return (wanted * (np.log(np.exp(z).sum(axis=1, keepdims=True)) - z)).sum(axis=1).mean()

    low, high, ratio = COLDEST, HOTTEST, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (buckets + 1, languages); the last row is the intercept
    idf: np.ndarray
    temperature: float
    known: np.ndarray  # for each code point whether the learned rows hold it as a letter

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for text, grams in zip(texts, gram_counts(texts)):
            if grams is None or not self.languages:
                out.append((UNKNOWN, 0.0))
                continue
            held, counts = grams
            logits = tf_idf(held, counts, self.idf) @ self.weights[held] + self.weights[-1]
            p = softmax(logits * evidence(text, self.known) / self.temperature)
            best = int(np.argmax(p))
            out.append((self.languages[best], float(p[best])))
        return out


WEIGHTS, WHOLE, PIECE = 0, 1, 2  # what a row is used for: weights, or the temperature (a whole document or a piece of one)


def learn(rows: list[tuple], languages: list[str], idf: np.ndarray, epochs: int = 3) -> tuple[np.ndarray, float]:
    """Weights and temperature from (order, use, language, held, counts, evidence) rows."""
    rows = sorted(rows, key=lambda r: r[:2])
    data = [(use, np.r_[held, BUCKETS], np.r_[tf_idf(held, counts, idf), 1.0], languages.index(lang), e) for _, use, lang, held, counts, e in rows]
    kept = [d for d in data if d[0] != WEIGHTS]
    seen = [d for d in data if d[0] == WEIGHTS] or [d for d in data if d[0] == WHOLE]
    model = Ftrl(len(languages), BUCKETS + 1)
    for _ in range(epochs):
        for _, held, x, label, _ in seen:
            model.learn(held, x, label)
    w = model.weights().T
    logits = np.array([x @ w[held] * e for _, held, x, _, e in kept]).reshape(len(kept), len(languages))
    documents = np.bincount([d[3] for d in kept if d[0] == WHOLE], minlength=len(languages))
    return w.astype(np.float32), fit_temperature(logits, np.array([d[3] for d in kept], int), documents)


def train(docs: DataFrame, learnable: Column, per_language: int = 2000) -> LanguageModel:
    """Learn from the rows of (doc_id, text, lang) where ``learnable`` holds, lang is not NULL and the text has a letter."""
    rows = docs.where(learnable & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))

    # One row per bucket or letter and task leaves the tasks; the result has a row per bucket and letter at most.
    def count(batches):
        df, n, seen = np.zeros(BUCKETS, np.int64), 0, np.zeros(CODES, np.int64)
        for batch in batches:
            for _, texts in text_steps(batch.column("text")):
                for grams in gram_counts(texts):
                    if grams is not None:
                        df[grams[0]] += 1
                        n += 1
                for text in texts:
                    for codes in letter_steps(text):
                        found, times = np.unique(codes, return_counts=True)
                        seen[found] += times
        held, used = np.flatnonzero(df), np.flatnonzero(seen)
        places = np.r_[held, BUCKETS, BUCKETS + 1 + used].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.r_[df[held], n, seen[used]])], names=["bucket", "df"])

    df = np.zeros(BUCKETS + 1 + CODES, np.int64)
    for bucket, n in map_arrow(rows.select("text"), count, "bucket int, df bigint").groupBy("bucket").agg(F.sum("df")).collect():
        df[bucket] = n
    idf = np.log((1 + df[BUCKETS]) / (1 + df[:BUCKETS])) + 1
    found_letters = df[BUCKETS + 1 :]
    known = found_letters > np.floor(LEAST_LETTER_SHARE * found_letters.sum())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts or not df[BUCKETS]:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), idf, 1.0, known)
    languages = sorted(counts)
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / n))) for k, n in counts.items()])
    order = F.xxhash64("doc_id")
    feature_schema = pa.schema(
        [("order", pa.int64()), ("use", pa.int32()), ("lang", pa.string()), ("held", pa.binary()), ("counts", pa.binary()), ("evidence", pa.float64())]
    )
    sample = rows.withColumn("order", order).where(F.pmod("order", F.lit(1 << 20)) < share * (1 << 20))

    # A fifth of the sample, chosen by other bits of the hash, is kept for the temperature.
    sample = sample.withColumn("kept", F.pmod(F.shiftright("order", 20), F.lit(5)) == 0)

    def features(batches):
        for batch in batches:
            for first, texts in text_steps(batch.column("text")):
                orders, langs, keeps = (batch.column(c).slice(first, len(texts)).to_pylist() for c in ("order", "lang", "kept"))
                out = []
                for text, grams, order, lang, keep in zip(texts, gram_counts(texts), orders, langs, keeps):
                    rows = [(WHOLE if keep else WEIGHTS, text, grams)]
                    if keep:
                        pieces = short_pieces(text)
                        rows += [(PIECE, piece, g) for piece, g in zip(pieces, gram_counts(pieces))]
                    out += [
                        (order, use, lang, np.asarray(g[0], "<i4").tobytes(), np.asarray(g[1], "<i4").tobytes(), evidence(t, known)) for use, t, g in rows if g is not None
                    ]
                yield pa.RecordBatch.from_pylist([dict(zip(feature_schema.names, r)) for r in out], schema=feature_schema)

    found = map_arrow(sample.select("text", "order", "lang", "kept"), features, "order bigint, use int, lang string, held binary, counts binary, evidence double")

    def fit(batches):
        data = []
        for batch in batches:
            for r in batch.to_pylist():
                data.append((r["order"], r["use"], r["lang"], np.frombuffer(r["held"], "<i4"), np.frombuffer(r["counts"], "<i4"), r["evidence"]))
        if data:
            w, t = learn(data, languages, idf)
            yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([t])], names=["weights", "temperature"])

    # The sample has a bound, so its learner is one task; what comes back is one row of buckets x languages.
    fitted = found.repartition(1).mapInArrow(fit, "weights binary, temperature double").collect()
    if not fitted:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0), np.float32), idf, 1.0, known)
    weights = np.frombuffer(fitted[0]["weights"], "<f4").reshape(BUCKETS + 1, len(languages))
    return LanguageModel(languages, weights, idf, fitted[0]["temperature"], known)


def predict(docs: DataFrame, model: LanguageModel, label: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with two more columns: the language (``und`` if the text is NULL or has no letter, or nothing was learned; score 0) and its
    calibrated probability. All other columns and rows pass through unread; the new names must not be among them."""
    clash = {label, score} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist already")

    def run(batches):
        for batch in batches:
            found = [p for _, texts in text_steps(batch.column("text")) for p in model.predict(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([p[0] for p in found], pa.string()), pa.array([p[1] for p in found], pa.float64())],
                names=[*batch.schema.names, label, score],
            )

    fields = [*docs.schema.fields, StructField(label, StringType()), StructField(score, DoubleType())]
    return map_arrow(docs, run, StructType(fields))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0
