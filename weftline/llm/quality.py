"""Quality classifier: random-indexing vectors, a two-layer network, calibrated scores.

Every unit of a text (a word, the shape of a word, a repetition mark) owns a sparse random
index vector; the vector of a unit is the sum of the index vectors seen around it.  A
document is the mean of its units' vectors with the rates of shapes and repetitions.  A
two-layer network scores it, and one temperature, fitted on labelled rows that the network
was not trained on, calibrates the probabilities.

The model is fitted on at most ``sample_rows`` labelled rows, chosen by hash; every document
is scored, from its whole text and from nothing else.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.runtime import materialize, small_batches

#: Word and shape tables: units hash into so many slots.
SLOTS, SHAPES, DIM = 1 << 14, 256, 48
REPEATS = (1, 2, 3, 4, 5, 6, 8)
N_FEATURES = DIM * 2 + SHAPES + len(REPEATS) + 3
FOLDS = 5


@dataclass(frozen=True)
class QualityParams:
    """``sample_rows`` bounds the labelled rows that are fitted on, at any input size."""

    sample_rows: int = 6000
    hidden: int = 24
    epochs: int = 60
    batch: int = 128
    rate: float = 3e-3
    decay: float = 1e-4
    seed: int = 7
    #: Tasks over which the sample is spread; each sends one table of SLOTS vectors.
    sample_tasks: int = 6


_CLASS = bytes.maketrans(
    bytes(range(256)),
    bytes(
        65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c for c in range(256)
    ),
)
_RUN = re.compile(rb"(.)\1+", re.S)


class Units(dict):
    """Token -> (slot, shape, 40 bits of hash) packed in one integer; cleared when large."""

    def __missing__(self, token: str) -> int:
        if len(self) > 150_000:
            self.clear()
        raw = token.encode("utf-8", "surrogatepass")
        word = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        caps = b"^" if token.isupper() and len(token) > 1 else b""
        shape = zlib.crc32(caps + _RUN.sub(rb"\1\1", raw.translate(_CLASS)))
        value = self[token] = (word << 8 | shape % SHAPES) & 0xFFFFFFFFFF
        return value


def units(text: str | None, cache: Units) -> np.ndarray:
    """The packed units of the text's tokens (split at white space)."""
    return np.array([cache[t] for t in text.split()] if text else [], np.int64)


def _slots(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (u >> 8) % SLOTS, u & (SHAPES - 1)


def index_vectors(n: int, seed: int) -> np.ndarray:
    """``n`` sparse ternary vectors: four entries of +1 or -1 each."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, DIM), np.float32)
    for _ in range(4):
        out[np.arange(n), rng.integers(0, DIM, n)] += rng.choice(np.array([-1, 1], np.float32), n)
    return out


def context_sums(token_lists: Iterator[np.ndarray], seed: int, window: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the index vectors of shapes and words around each word slot, and slot counts."""
    words, shapes = index_vectors(SLOTS, seed), index_vectors(SHAPES, seed + 1)
    sums, counts = np.zeros((SLOTS, DIM), np.float32), np.zeros(SLOTS, np.float32)
    for u in token_lists:
        if not len(u):
            continue
        s, h = _slots(u)
        ctx = words[s] + 2 * shapes[h]
        around = np.zeros_like(ctx)
        for d in range(1, min(window, len(u) - 1) + 1):
            around[d:] += ctx[:-d]
            around[:-d] += ctx[d:]
        np.add.at(sums, s, around)
        np.add.at(counts, s, 1)
    return sums, counts


def features(u: np.ndarray, vectors: np.ndarray, shape_vectors: np.ndarray) -> np.ndarray:
    """Features of a document: pooled word and shape vectors, shape rates, repetition rates."""
    out = np.zeros(N_FEATURES, np.float32)
    n = len(u)
    if not n:
        return out
    s, h = _slots(u)
    out[:DIM] = np.bincount(s, minlength=SLOTS).astype(np.float32) @ vectors / n if n > SLOTS else vectors[s].mean(0)
    rates = np.bincount(h, minlength=SHAPES).astype(np.float32) / n
    out[DIM : 2 * DIM] = rates @ shape_vectors
    out[2 * DIM : 2 * DIM + SHAPES] = rates
    at = 2 * DIM + SHAPES
    for i, k in enumerate(REPEATS):
        if n > k:
            out[at + i] = (u[k:] == u[:-k]).mean()
    out[at + len(REPEATS) :] = (np.log1p(n) / 10, len(np.unique(s)) / n, 1.0)
    return out


@dataclass
class QualityModel:
    """Everything that scoring needs, a few MB: vectors, scaling, two layers, temperature."""

    vectors: np.ndarray
    shape_vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -6, 6)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, shape_vectors: np.ndarray, p: QualityParams) -> QualityModel:
    """Adam on the logistic loss; every fifth row is kept for stopping and the temperature.

    With no rows, or rows of one class, scores are the (smoothed) share of class 1.
    """
    d = N_FEATURES
    prior = float((y.sum() + 1) / (len(y) + 2))
    model = QualityModel(
        vectors, shape_vectors, np.zeros(d, np.float32), np.ones(d, np.float32), np.zeros((d, p.hidden)),
        np.zeros(p.hidden), np.zeros(p.hidden), float(np.log(prior / (1 - prior))),
    )
    if len(y) < 10 or y.min() == y.max():
        return model
    rng = np.random.default_rng(p.seed)
    order = rng.permutation(len(y))
    held, fit = order[: len(y) // 5], order[len(y) // 5 :]
    model.mean = x[fit].mean(0)
    model.scale = 1 / np.maximum(x[fit].std(0), 1e-3)
    w = {
        "w1": rng.normal(0, 1 / np.sqrt(d), (d, p.hidden)), "b1": np.zeros(p.hidden),
        "w2": rng.normal(0, 1 / np.sqrt(p.hidden), p.hidden), "b2": np.array(model.b2),
    }
    m, v, t = {k: np.zeros_like(a) for k, a in w.items()}, {k: np.zeros_like(a) for k, a in w.items()}, 0
    z = np.clip((x - model.mean) * model.scale, -6, 6)
    best, kept = np.inf, {k: a.copy() for k, a in w.items()}
    for _ in range(p.epochs):
        for rows in np.array_split(rng.permutation(fit), max(1, len(fit) // p.batch)):
            a = np.tanh(z[rows] @ w["w1"] + w["b1"])
            g = (1 / (1 + np.exp(-np.clip(a @ w["w2"] + w["b2"], -40, 40))) - y[rows]) / len(rows)
            back = np.outer(g, w["w2"]) * (1 - a * a)
            grads = {"w1": z[rows].T @ back, "b1": back.sum(0), "w2": a.T @ g, "b2": np.array(g.sum())}
            t += 1
            for k, grad in grads.items():
                grad = grad + p.decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                w[k] = w[k] - p.rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        now = _loss(np.tanh(z[held] @ w["w1"] + w["b1"]) @ w["w2"] + w["b2"], y[held])
        if now < best:
            best, kept = now, {k: a.copy() for k, a in w.items()}
    model.w1, model.b1, model.w2, model.b2 = kept["w1"], kept["b1"], kept["w2"], float(kept["b2"])
    logits = model.logits(x[held])
    temperatures = np.geomspace(0.25, 8, 61)
    model.temperature = float(min(temperatures, key=lambda s: _loss(logits / s, y[held])))
    return model


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are never learned from."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, p: QualityParams, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, y) of at most ``sample_rows`` labelled documents outside fold 0.

    Labels that are null, not 0 or 1, or contradict each other are left out; of documents
    that share an id one text is taken.
    """
    label = F.col(label_col).cast("int")
    clean = (
        labels.where(F.col(id_col).isNotNull() & label.isin(0, 1) & (fold(F.col(id_col)) != 0))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label).alias("y"), F.max(label).alias("y1"))
        .where("y = y1")
    )
    # Bounded by the parameter, so it may be broadcast whatever the input.
    chosen = clean.orderBy(F.xxhash64("id"), "id").limit(p.sample_rows).select("id", "y")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("text", "y")).alias("r"))
    return materialize(rows.select("r.text", "r.y").repartition(p.sample_tasks), "quality-sample")


def fit_quality(
    docs: DataFrame, labels: DataFrame, params: QualityParams | None = None,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> QualityModel:
    """Fit word vectors and network on a bounded sample of labelled rows."""
    p = params or QualityParams()
    small_batches(docs.sparkSession)
    sample = training_sample(docs, labels, p, id_col, text_col, label_col)
    seed = p.seed

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Units()
        s, n = context_sums((units(t, cache) for b in batches for t in b.column("text").to_pylist()), seed)
        yield pa.RecordBatch.from_arrays(
            [pa.array([s.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["s", "n"]
        )

    total, count = np.zeros((SLOTS, DIM), np.float32), np.zeros(SLOTS, np.float32)
    for row in sample.mapInArrow(sums, "s binary, n binary").toLocalIterator():  # a table per task of the sample
        total += np.frombuffer(row["s"], np.float32).reshape(SLOTS, DIM)
        count += np.frombuffer(row["n"], np.float32)
    # Unseen words have no context; their slot falls back to its own index vector.
    vectors = np.where(count[:, None] > 0, total, index_vectors(SLOTS, seed))
    vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)).astype(np.float32)
    shape_vectors = index_vectors(SHAPES, seed + 1)

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Units()
        for b in batches:
            x = [features(units(t, cache), vectors, shape_vectors).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column("y")], names=["x", "y"])

    rows = sample.mapInArrow(embed, "x binary, y int").collect()  # at most sample_rows
    rows = sorted((r["x"], r["y"]) for r in rows)  # the same model whatever order rows come in
    x = np.frombuffer(b"".join(r[0] for r in rows), np.float32).reshape(len(rows), N_FEATURES)
    return fit_network(x, np.array([r[1] for r in rows], np.float64), vectors, shape_vectors, p)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and ``score``, the probability of label 1.

    Null and empty texts score like a text without words; whole texts are read.  Other
    columns are never inputs.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, Units()
        for b in batches:
            x = np.zeros((b.num_rows, N_FEATURES), np.float32)
            for i, t in enumerate(b.column("text").to_pylist()):
                x[i] = features(units(t, cache), m.vectors, m.shape_vectors)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(m.scores(x), pa.float64())], names=["doc_id", "score"]
            )

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def keep_quality(
    docs: DataFrame, model: QualityModel, threshold: float = 0.3, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns as they are."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = shared.value, Units()
        for b in batches:
            x = np.zeros((b.num_rows, N_FEATURES), np.float32)
            for i, t in enumerate(b.column(at).to_pylist()):
                x[i] = features(units(t, cache), m.vectors, m.shape_vectors)
            yield b.filter(pa.array(m.scores(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
