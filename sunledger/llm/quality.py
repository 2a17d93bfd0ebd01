"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` characters each; an empty text is one empty passage). Every passage is encoded, a
gated attention weighs the encodings,

    h = tanh(x W + b),   a = softmax over passages of ((tanh(h V) * sigmoid(h U)) w),   score = sigmoid(sum(a h) c + d)

and only the document's label teaches it. Features are statistics of the passage's own characters and words, hashed words, and
how much of it the same document says elsewhere.

The learner sees at most about ``per_class`` labelled documents of each class (chosen by a hash of the id; that parameter
is the bound). Scoring reads every whole text in place, without a shuffle.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sunledger.llm.common import code_points, distinct_sorted, fold, map_arrow, mix64, span_hashes, text_steps, words

PASSAGE = 512
HASHED = 64
CLASSES = ["upper", "lower", "letter", "digit", "space", "break", "exclaim", "stop", "comma", "mark", "other"]
FEATURES = len(CLASSES) + 6 + HASHED

_CLASS_OF: list[np.ndarray] = []


def class_of() -> np.ndarray:
    """Class number of each code point; made once per worker."""
    if not _CLASS_OF:

        def one(c: str) -> int:
            fixed = {"\n": 5, "!": 6, ".": 7, ",": 8}
            if c in fixed:
                return fixed[c]
            if c.isupper():
                return 0
            if c.islower():
                return 1
            if c.isalpha():
                return 2
            if c.isdigit():
                return 3
            return 4 if c.isspace() else 9 if ord(c) < 128 else 10

        _CLASS_OF.append(np.fromiter((one(chr(c)) for c in range(0x110000)), np.uint8, 0x110000))
    return _CLASS_OF[0]


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages and the number of passages of each text."""
    codes, firsts = code_points(texts)
    lengths = np.diff(firsts) - 1
    n_of = np.maximum(1, -(-lengths // PASSAGE))
    first_passage = np.r_[0, np.cumsum(n_of)]
    total = int(first_passage[-1])
    text_of = np.repeat(np.arange(len(texts)), np.diff(firsts))
    inside = np.arange(len(codes)) - firsts[:-1][text_of]
    real = inside < lengths[text_of]
    passage_of = first_passage[:-1][text_of] + np.minimum(inside // PASSAGE, n_of[text_of] - 1)
    k = len(CLASSES)
    by_class = np.bincount(passage_of[real] * k + class_of()[codes[real]], minlength=total * k).reshape(total, k)
    chars = by_class.sum(axis=1)

    starts, ends = words(codes)
    hashes = span_hashes(codes, starts, ends)
    p, d, long = passage_of[starts], text_of[starts], ends - starts
    n_words = np.bincount(p, minlength=total)
    per_word = np.maximum(n_words, 1)
    mean_long = np.bincount(p, long, total) / per_word
    spread = np.sqrt(np.maximum(np.bincount(p, long * long, total) / per_word - mean_long**2, 0))

    def new_share(group: np.ndarray, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Share of a passage's keys that stand once in their group."""
        joined = mix64(keys ^ mix64(group.astype(np.uint64)))
        order = np.argsort(joined, kind="stable")
        first, runs = distinct_sorted(joined[order])
        single = np.zeros(len(keys))
        single[order[first[runs == 1]]] = 1
        return np.bincount(at, single, total) / np.maximum(np.bincount(at, minlength=total), 1)

    once = new_share(p, hashes, p)
    last = len(hashes) - 2
    with np.errstate(over="ignore"):
        triple = hashes[:last] * np.uint64(3) + hashes[1 : last + 1] * np.uint64(5) + hashes[2:] * np.uint64(7) if last > 0 else hashes[:0]
    whole = d[: len(triple)] == d[2 : len(triple) + 2]
    own = new_share(d[: len(triple)][whole], triple[whole], p[: len(triple)][whole])
    hashed = np.bincount(p * HASHED + (hashes & np.uint64(HASHED - 1)).astype(np.int64), minlength=total * HASHED).reshape(total, HASHED)
    x = np.concatenate(
        [
            by_class / np.maximum(chars, 1)[:, None],
            np.stack([np.log1p(chars), np.log1p(n_words), np.log1p(mean_long), spread / (1 + mean_long), once, own], axis=1),
            np.sqrt(hashed / per_word[:, None]),
        ],
        axis=1,
    )
    return x.astype(np.float32), n_of


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Parameters, and the feature scale they were learned with."""

    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    prior: float | None = None  # score of every document if the labels had one class only

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        """``bounds``: first passage of each document."""
        q = self.params
        h = np.tanh(x @ q["W"] + q["b"])
        t, g = np.tanh(h @ q["V"]), sigmoid(h @ q["U"])
        e = (t * g) @ q["w"]
        bag = np.repeat(np.arange(len(bounds)), np.diff(np.r_[bounds, len(x)]))
        a = np.exp(e - np.maximum.reduceat(e, bounds)[bag])
        a /= np.add.reduceat(a, bounds)[bag]
        z = np.add.reduceat(a[:, None] * h, bounds)
        return {"h": h, "t": t, "g": g, "a": a, "bag": bag, "z": z, "p": sigmoid(z @ q["c"] + q["d"][0])}

    def score(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None or not texts:
            return np.full(len(texts), self.prior or 0.0)
        x, n = passages(texts)
        return self.forward((x - self.mean) / self.scale, np.r_[0, np.cumsum(n)[:-1]])["p"].astype(float)


def gradients(model: AttentionModel, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    q, f = model.params, model.forward(x, bounds)
    h, t, g, a, bag = f["h"], f["t"], f["g"], f["a"], f["bag"]
    top = (f["p"] - y) / len(y)
    dz = top[:, None] * q["c"]
    da = (dz[bag] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, bounds)[bag])
    dt, dg = de[:, None] * q["w"] * g * (1 - t * t), de[:, None] * q["w"] * t * g * (1 - g)
    dh = (a[:, None] * dz[bag] + dt @ q["V"].T + dg @ q["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": f["z"].T @ top, "d": np.array([top.sum()])}


def fit(rows: list[tuple[int, int, np.ndarray]], hidden: int = 24, gate: int = 12, epochs: int = 40, rate: float = 0.01, decay: float = 1e-4) -> AttentionModel:
    """Adam on mini-batches of documents; ``rows`` hold (order, label, passage features)."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    y = np.array([r[1] for r in rows], np.float32)
    n = np.array([len(r[2]) for r in rows])
    x = np.concatenate([r[2] for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    if len(set(y.tolist())) < 2:
        return AttentionModel({}, mean, scale, prior=float((y.sum() + 1) / (len(y) + 2)))
    x = (x - mean) / scale
    first = np.r_[0, np.cumsum(n)]
    random = np.random.default_rng(7)

    def start(*shape):
        return (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    q = {"W": start(x.shape[1], hidden), "b": np.zeros(hidden, np.float32), "V": start(hidden, gate), "U": start(hidden, gate), "w": start(gate), "c": start(hidden), "d": np.zeros(1, np.float32)}
    model = AttentionModel(q, mean, scale)
    m, v, step = {k: np.zeros_like(p) for k, p in q.items()}, {k: np.zeros_like(p) for k, p in q.items()}, 0
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for at in range(0, len(order), 128):
            some = order[at : at + 128]
            places = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            grad = gradients(model, x[places], np.r_[0, np.cumsum(n[some])[:-1]], y[some])
            step += 1
            for k in q:
                g = grad[k] + decay * q[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                q[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = 3000) -> AttentionModel:
    """Learn ``quality`` (0 or 1) of the rows of ``labels`` where ``learnable`` (on doc_id) holds, from the texts in ``docs``.

    Labels that are neither 0 nor 1, and labels without a document, teach nothing. Without any label every score is 0.5.
    """
    known = labels.where(learnable & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("__label"))
    counts = {r["__label"]: r["n"] for r in known.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.coalesce(*[F.when(F.col("__label") == k, F.lit(min(1.0, per_class / n))) for k, n in counts.items()], F.lit(0.0))
    order = F.xxhash64("doc_id")
    chosen = known.withColumn("__order", order).where(F.pmod("__order", F.lit(1 << 20)) < share * (1 << 20))
    # The sample holds about 2 * per_class pairs of numbers at the most.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "__label", "__order")

    def features(batches):
        for batch in batches:
            for at, texts in text_steps(batch.column("text")):
                x, n = passages(texts)
                ends = np.cumsum(n)
                data = [x[e - k : e].tobytes() for e, k in zip(ends, n)]
                some = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([some.column("__order"), some.column("__label"), pa.array(data, pa.binary())], names=["order", "label", "x"])

    def learn(batches):
        data = [(r["order"], r["label"], np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES)) for b in batches for r in b.to_pylist()]
        if data:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(data))], pa.binary())], names=["model"])

    found = map_arrow(rows, features, "order bigint, label int, x binary")
    # A bounded sample, so one task learns; one row of parameters comes back.
    fitted = found.repartition(1).mapInArrow(learn, "model binary").collect()
    if not fitted:
        return AttentionModel({}, np.zeros(FEATURES), np.ones(FEATURES), prior=0.5)
    return pickle.loads(fitted[0]["model"])


def score(docs: DataFrame, model: AttentionModel, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``: the probability of label 1, for NULL (as empty) and empty texts too.

    All other columns and rows pass through unread; the new name must not be among them."""
    if name in docs.columns:
        raise ValueError(f"column {name} exists already")

    def run(batches):
        for batch in batches:
            found = [model.score(texts) for _, texts in text_steps(batch.column("text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 1
