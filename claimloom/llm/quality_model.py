"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network.

Every token falls into one of a fixed number of buckets and has a sparse ternary index vector. A
bucket's word vector adds up the index vectors of the tokens around it, over the whole corpus. A
document is the mean and the spread of its tokens' vectors. A two-layer network learns from a
bounded sample of labelled documents; its probabilities are calibrated by a temperature that
minimises the log loss on a part of the sample it did not learn from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]|_")
#: Words remembered by a worker.
KNOWN_WORDS = 500_000
SHAPE = 1 << 32


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled documents that the network learns from."""

    buckets: int = 1 << 14
    size: int = 64
    nonzero: int = 4
    window: int = 2
    sample: int = 20_000
    hidden: int = 32
    epochs: int = 40
    rate: float = 3e-3
    decay: float = 1e-4
    threshold: float = 0.3
    seed: int = 42


class Buckets(dict):
    """Token to bucket, with the bucket of its shape above ``SHAPE`` (0: lower case or a sign)."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def _bucket(self, name: str) -> int:
        return zlib.crc32(name.encode()) % self.buckets

    def __missing__(self, token: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        lower = token.lower()
        shape = 0
        if token != lower:
            kind = "upper" if len(token) > 1 and token.isupper() else "title" if token.istitle() else "mixed"
            shape = self._bucket(f" {kind}") + 1
        elif token.isdigit():
            lower, shape = " digits", self._bucket(f" digits{min(len(token), 8)}") + 1
        self[token] = value = self._bucket(lower) + shape * SHAPE
        return value

    def ids(self, text: str | None) -> np.ndarray:
        """Buckets of the tokens in order, a shape before its word."""
        packed = np.fromiter(map(self.__getitem__, TOKEN.findall(text or "")), np.int64)
        word, shape = packed % SHAPE, packed // SHAPE
        counts = 1 + (shape > 0)
        out = np.repeat(word, counts)
        first = np.cumsum(counts) - counts
        out[first[shape > 0]] = shape[shape > 0] - 1
        return out


def index_vectors(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries, by bucket."""
    random = np.random.default_rng(settings.seed)
    shape = (settings.buckets, settings.nonzero)
    return random.integers(0, settings.size, shape), random.choice([-1.0, 1.0], shape)


def _context_sums(settings: Settings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors(settings)
        buckets = Buckets(settings.buckets)
        sums = np.zeros(settings.buckets * settings.size)

        def add(documents: list[np.ndarray]) -> None:
            ids = np.concatenate(documents)
            owner = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
            for by in range(1, settings.window + 1):
                same = owner[by:] == owner[:-by]
                left, right = ids[:-by][same], ids[by:][same]
                for word, near in ((left, right), (right, left)):
                    for k in range(settings.nonzero):
                        flat = word * settings.size + places[near, k]
                        sums[:] += np.bincount(flat, signs[near, k], len(sums))

        held: list[np.ndarray] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for text in batch.column(0).slice(at, 64).to_pylist():
                    held.append(buckets.ids(text))
                    rows += len(held[-1])
                    if rows > 500_000:
                        add(held)
                        held, rows = [], 0
        if rows:
            add(held)
        table = sums.reshape(settings.buckets, settings.size)
        some = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(some.astype(np.int32))]
        columns += [pa.array(table[some, d].astype(np.int64)) for d in range(settings.size)]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["bucket"] + [f"v{d}" for d in range(settings.size)]
    return run


def word_vectors(docs: DataFrame, text_col: str, settings: Settings) -> np.ndarray:
    """A vector per bucket, from all of ``docs``.

    A task sums up its share of the corpus in one matrix and returns a row per bucket; what
    reaches the driver is ``buckets * size`` numbers, whatever the corpus.
    """
    names = [f"v{d}" for d in range(settings.size)]
    schema = "bucket int, " + ", ".join(f"{n} long" for n in names)
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(_context_sums(settings), schema)
    table = parts.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
    context = np.zeros((settings.buckets, settings.size))
    if table.num_rows:
        at = table.column("bucket").to_numpy()
        context[at] = np.stack([table.column(n).to_numpy() for n in names], axis=1)
    places, signs = index_vectors(settings)
    own = np.zeros_like(context)
    np.add.at(own, (np.arange(settings.buckets)[:, None], places), signs)
    return (_unit(_unit(context) - _unit(context).mean(axis=0)) + _unit(own)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def pooled(text: str | None, buckets: Buckets, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and log count of a document's tokens; zeros for no tokens."""
    ids = buckets.ids(text)
    size = vectors.shape[1]
    if not len(ids):
        return np.zeros(2 * size + 1, np.float32)
    used, counts = np.unique(ids, return_counts=True)
    weights = (counts / len(ids)).astype(np.float32)
    rows = vectors[used]
    mean = weights @ rows
    spread = np.sqrt(np.maximum(weights @ (rows * rows) - mean * mean, 0))
    return np.concatenate([mean, spread, [np.float32(np.log1p(len(ids)))]]).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """A two-layer network with its input scaling and temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _constant(inputs: int, y: np.ndarray) -> Network:
    """The smoothed share of good documents, for samples that teach nothing else."""
    odds = (y.sum() + 1) / (len(y) - y.sum() + 1)
    zeros = np.zeros(inputs)
    return Network(zeros, zeros + 1, np.zeros((inputs, 1)), np.zeros(1), np.zeros(1), float(np.log(odds)))


def train(x: np.ndarray, y: np.ndarray, settings: Settings) -> Network:
    """Fit on four fifths of the rows, calibrate on the last fifth."""
    random = np.random.default_rng(settings.seed)
    order = random.permutation(len(y))
    fit, rest = order[len(y) // 5 :], order[: len(y) // 5]
    if len(y) < 10 or y[fit].min() == y[fit].max():
        return _constant(x.shape[1], y)
    shift, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    z = (x - shift) / scale
    parts = [
        random.standard_normal((x.shape[1], settings.hidden)) / np.sqrt(x.shape[1]),
        np.zeros(settings.hidden),
        random.standard_normal(settings.hidden) / np.sqrt(settings.hidden),
        np.zeros(1),
    ]
    first, second = ([np.zeros_like(p) for p in parts] for _ in range(2))
    step = 0
    for _ in range(settings.epochs):
        shuffled = random.permutation(fit)
        for at in range(0, len(shuffled), 256):
            rows = shuffled[at : at + 256]
            hidden = np.tanh(z[rows] @ parts[0] + parts[1])
            error = (_sigmoid(hidden @ parts[2] + parts[3]) - y[rows]) / len(rows)
            back = np.outer(error, parts[2]) * (1 - hidden * hidden)
            slopes = [z[rows].T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for k, slope in enumerate(slopes):
                slope = slope + settings.decay * parts[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                rate = settings.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                parts[k] = parts[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
    network = Network(shift, scale, parts[0], parts[1], parts[2], float(parts[3][0]))
    logits = network.logits(x[rest])
    low, high = 0.05, 20.0
    for _ in range(60):  # the log loss falls and then rises with the temperature
        t = (low + high) / 2
        slope = -((_sigmoid(logits / t) - y[rest]) * logits).sum()
        low, high = (t, high) if slope < 0 else (low, t)
    return Network(shift, scale, *parts[:3], float(parts[3][0]), (low + high) / 2)


def fold(id_: Column) -> Column:
    """Documents of fold 0 are held out; a NULL identifier counts as empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5


def _vectors_of(settings: Settings, vectors):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(settings.buckets)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [pooled(t, buckets, vectors.value) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(rows, pa.list_(pa.float32()))],
                    names=["id", "label", "pooled"],
                )

    return run


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings
) -> tuple[np.ndarray, Network]:
    """Word vectors and network. Labels of held-out documents are not read."""
    vectors = word_vectors(docs, text_col, settings)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    learnt = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(fold(F.col("id")) != 0)
        .where("label IN (0, 1)")
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(settings.sample)
    )
    # Bounded by ``sample`` rows of two numbers.
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = known.join(F.broadcast(learnt), "id").select("id", "label", "text")
    table = rows.mapInArrow(_vectors_of(settings, shared), "id long, label int, pooled array<float>")
    found = table.groupBy("id").agg(F.max_by("pooled", "pooled").alias("pooled"), F.avg("label").alias("label"))
    found = found.toArrow().sort_by("id")
    x = np.array(found.column("pooled").to_pylist(), np.float64).reshape(-1, 2 * settings.size + 1)
    y = found.column("label").to_numpy().astype(np.float64)
    return vectors, train(x, (y >= 0.5).astype(np.float64), settings)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    settings: Settings = Settings(),
) -> DataFrame:
    """``<id>, held_out, score, predicted`` of every document.

    Scores depend on the text only. NULL and empty texts are scored as documents without tokens.
    Documents whose labels repeat count once, by their mean label, ties good; labels other than 0
    and 1 are ignored. Without labels of both kinds every score is their smoothed share. NULL and
    repeated identifiers keep their rows. An empty table gives no rows. Other columns are not
    read.
    """
    vectors, network = fit_quality(docs, labels, id_col, text_col, label_col, settings)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(settings.buckets)
        vectors, network = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = np.stack([pooled(t, buckets, vectors) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(network.scores(rows), pa.float64())], names=["id", "score"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        (fold(F.col("id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"),
    )
