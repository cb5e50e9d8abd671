"""Quality classifier: random-indexing word vectors, pooled per document, under a small network.

Random indexing. Every word has a sparse random index vector; a word's context vector is the sum of the
index vectors of the words near it, over all documents. Words are counted in two forms, as written in
lower case and by shape ("Aa", "a#", "A!" ...), so that words never met still have the vector of
their shape. Either form is hashed to one of a fixed number of rows, so every word has a row, and tasks
sum whole numbers by row, which gives the same vectors in whatever order they run. A document is the mean
of its words' vectors, with the number of words pooled and the share of them that differ.

A network with one hidden layer, written in numpy, is trained on the labelled sample; a temperature
fitted on the part of the sample it was not trained on calibrates its probabilities.

The vectors need no labels and come from all texts. Network and temperature are fitted on a bounded number
of labelled documents, whose texts are pooled in tasks: the driver gets their numbers and never a text. Every
text is read whole. Of several texts with one id the smallest is fitted on. Documents without a word have the
zero vector and the network's answer to it. With no labelled document every score is 0.5; if all labels
agree, the network learns the constant. Null text counts as empty, null labels are left out, repeated rows
repeat their score, an empty table gives an empty result, and other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from marketlens.llm.common import FOLD, Known, bounded_sample, mixed, slices, texts
from marketlens.session import staged

DIMENSIONS = 64
NONZERO = 4  # entries of an index vector that are not 0
WINDOW = 2  # words to either side that make a word's context
WORD_ROWS, SHAPE_ROWS = 1 << 16, 1 << 12  # rows that words as written and shapes are hashed to
CHUNK = 1 << 13  # words whose neighbours a task sums at a time
_LOW = (1 << 32) - 1
GAP = (WORD_ROWS + SHAPE_ROWS) * (1 | 1 << 32)  # stands between texts: no row, and no vector for its neighbours
SAMPLE_DOCS = 4000  # labelled documents that the network is fitted on, at most
HIDDEN = 32
EPOCHS = 200
SEED = 7

_SHAPE = bytes(
    ord("A") if 65 <= b < 91 else ord("a") if 97 <= b < 123 or b >= 128 else ord("0") if 48 <= b < 58 else b for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+", re.S)


def _shape_row(letters: bytes) -> int:
    """Row of a shape, given a word with letters as A or a and digits as 0: every run counts as one character."""
    return WORD_ROWS + xxh3_64_intdigest(_RUNS.sub(rb"\1", letters)) % SHAPE_ROWS


def rows_of(word: bytes) -> tuple[int, int]:
    """Rows of a word as written and of its shape."""
    return xxh3_64_intdigest(word.translate(FOLD)) % WORD_ROWS, _shape_row(word.translate(_SHAPE))


@cache
def _entries() -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and signs of the entries of every row's index vector; all signs are 0 for gaps between texts."""
    dims, signs = (np.zeros((WORD_ROWS + SHAPE_ROWS + 1, NONZERO), kind) for kind in (np.int64, np.float64))
    state = np.arange(WORD_ROWS + SHAPE_ROWS, dtype=np.uint64)
    for i in range(NONZERO):
        state = mixed(state + np.uint64(0x9E3779B97F4A7C15))
        dims[:-1, i], signs[:-1, i] = state % np.uint64(DIMENSIONS), np.where(state >> np.uint64(63), 1, -1)
    return dims, signs


@cache
def index_vectors() -> np.ndarray:
    """A sparse vector for every row, with ``NONZERO`` entries of +1 or -1."""
    dims, signs = (part[:-1] for part in _entries())
    out = np.zeros((len(dims), DIMENSIONS), np.int32)
    np.add.at(out, (np.arange(len(dims))[:, None], dims), signs.astype(np.int32))
    return out


def add_contexts(sums: np.ndarray, codes: np.ndarray) -> None:
    """Adds the neighbours of the words of one text, or of texts with gaps between them, to ``sums``.

    Words go piece by piece; a piece takes along the words around it, so no neighbour is lost. An index vector has few
    entries, so they are counted by row and dimension, and no vector of a word's neighbours is formed.
    """
    dims, signs = _entries()
    for at in range(0, len(codes), CHUNK):
        low, end = max(0, at - WINDOW), min(len(codes), at + CHUNK)
        around = codes[low : end + WINDOW]
        forms = np.stack([around & _LOW, around >> 32], axis=1)
        near, sign = (part[forms].reshape(len(around), -1) for part in (dims, signs))
        # Pairs of a word of the piece and a neighbour, as their places in it.
        words = np.arange(at - low, end - low)
        pairs = [(mine, mine + d) for d in range(-WINDOW, WINDOW + 1) if d for mine in [words[(words + d >= 0) & (words + d < len(around))]]]
        mine, other = (np.concatenate(x) for x in zip(*pairs))
        near, sign = near[other], sign[other].ravel()
        for form in (0, 1):
            rows, place = np.unique(forms[:, form], return_inverse=True)
            key = place[mine, None] * DIMENSIONS + near
            parts = np.bincount(key.ravel(), sign, len(rows) * DIMENSIONS).reshape(-1, DIMENSIONS)
            known = rows < len(sums)
            sums[rows[known]] += parts[known].astype(sums.dtype)


class Rows(Known):
    """Both rows of the words met last, packed into one number and found once each.

    Many words share their letters' kinds, so rows of shapes are found once for each of these.
    """

    def __init__(self):
        shapes = self.shapes = Known(_shape_row)
        super().__init__(lambda word: xxh3_64_intdigest(word.translate(FOLD)) % WORD_ROWS | shapes[word.translate(_SHAPE)] << 32)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        if len(self.shapes) > 50_000:
            self.shapes.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Model:
    vectors: np.ndarray
    layers: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0

    def pooled(self, data: list[bytes], known: Rows) -> np.ndarray:
        """The mean of the vectors of a document's words and of their shapes, how many words there are
        and which share of them differ."""
        out = np.zeros((len(data), 2 * DIMENSIONS + 2), np.float32)
        for i, text in enumerate(data):
            words = text.split()
            if not words:
                continue
            out[i, -2:] = np.log1p(len(words)), len(set(words)) / len(words)
            at, n = np.unique(known.of(words), return_counts=True)
            share = n.astype(np.float32) / len(words)
            out[i, :DIMENSIONS] = share @ self.vectors[at & _LOW]
            out[i, DIMENSIONS:-2] = share @ self.vectors[at >> 32]
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not self.layers:
            return np.zeros(len(x))
        mean, scale, w1, b1, w2, b2 = self.layers
        return np.tanh((x - mean) / scale @ w1 + b1) @ w2 + b2[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def vectors_of(sums: np.ndarray) -> np.ndarray:
    """Context vectors at unit length beside the rows' own index vectors, which keep words apart that stand in
    like contexts. A row without a context is zero."""
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    vectors = sums / np.maximum(size, 1e-9) + index_vectors() / np.sqrt(NONZERO)
    return np.where(size > 0, vectors, 0).astype(np.float32)


def fit_vectors(docs: DataFrame, text: str = "text") -> Model:
    """Word vectors from the contexts in all texts. A task sends one row of sums for each row that it met, and
    the driver gets one row of sums for each row of the vectors, however many documents there are."""
    names = [f"d{i}" for i in range(DIMENSIONS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known = np.zeros((WORD_ROWS + SHAPE_ROWS, DIMENSIONS), np.int64), Rows()
        gap, held, n = np.full(WINDOW, GAP), [], 0
        for batch in slices(batches, text):
            for data in texts(batch, text):
                held += [known.of(data.split()), gap]
                n += len(held[-2])
                if n >= CHUNK:
                    add_contexts(sums, np.concatenate(held))
                    held, n = [], 0
        if held:
            add_contexts(sums, np.concatenate(held))
        met = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met), *(pa.array(sums[met, i]) for i in range(DIMENSIONS))], names=["row", *names])

    parts = docs.select(text).mapInArrow(run, ", ".join(f"{n} bigint" for n in ["row", *names]))
    found = parts.groupBy("row").agg(*(F.sum(n).cast("float").alias(n) for n in names)).toArrow()
    sums = np.zeros((WORD_ROWS + SHAPE_ROWS, DIMENSIONS))
    sums[found["row"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1)
    return Model(vectors_of(sums))


def train_network(model: Model, x: np.ndarray, y: np.ndarray) -> None:
    """Adam on the logistic loss, classes weighed alike; every fifth row only sets the temperature."""
    rng = np.random.default_rng(SEED)
    held = np.arange(len(y)) % 5 == 4 if len(y) >= 10 else np.zeros(len(y), bool)
    xt, yt = x[~held].astype(np.float64), y[~held]
    mean, scale = xt.mean(0), xt.std(0) + 1e-3
    xs = (xt - mean) / scale
    rate = min(max(yt.mean(), 1e-3), 1 - 1e-3)
    weight = np.where(yt == 1, 0.5 / rate, 0.5 / (1 - rate)) if 0 < yt.mean() < 1 else np.ones(len(yt))
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(yt))
        for at in range(0, len(order), 256):
            b = order[at : at + 256]
            h = np.tanh(xs[b] @ p[0] + p[1])
            error = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -30, 30))) - yt[b]) * weight[b] / len(b)
            back = np.outer(error, p[2]) * (1 - h * h)
            grads = [xs[b].T @ back + 1e-3 * p[0], back.sum(0), h.T @ error + 1e-3 * p[2], np.array([error.sum()])]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    model.layers = [mean, scale, *p]
    if held.any():
        logits, yh = model.logits(x[held]), y[held]

        def loss(t: float) -> float:
            return float(np.logaddexp(0, np.where(yh == 1, -logits, logits) / t).mean())

        model.temperature = min(np.geomspace(0.5, 10, 60), key=loss)


def fit_model(docs: DataFrame, labels: DataFrame, train: Column, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = SAMPLE_DOCS) -> Model:
    """Word vectors of all documents, and a network from at most ``most`` labelled rows where ``train`` holds.

    The labelled rows are drawn by the hashes of their keys. A document with several labels counts by their mean.
    """
    model = fit_vectors(docs, text)
    known = labels.filter(train & F.col(label).isNotNull()).groupBy(key).agg(F.avg(label).alias("label"))
    known = staged(bounded_sample(known, key, most), "labels")
    found = docs.select(key, text).join(F.broadcast(known), key).groupBy(key, "label").agg(F.min(text).alias("text"))
    pooled = pooled_rows(found.select(F.xxhash64(key).alias("place"), F.col(key).alias("id"), "label", "text"), model)
    rows = pooled.orderBy("place", "id").limit(most).collect()
    if rows:
        train_network(model, np.array([r["x"] for r in rows], np.float32), np.array([float(r["label"] >= 0.5) for r in rows]))
    return model


def _per_text(kept: DataFrame, model: Model, added: str, values: Callable[[Model, np.ndarray], list[pa.Array]]) -> DataFrame:
    """The columns of ``kept`` without its last, the text, and what ``values`` says of the pooled texts."""
    shared = kept.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    names = [*kept.columns[:-1], *(a.split()[0] for a in added.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Rows()
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *values(shared.value, shared.value.pooled(texts(batch), known))], names=names)

    return kept.mapInArrow(run, f"{fields}, {added}")


def pooled_rows(kept: DataFrame, model: Model) -> DataFrame:
    """``kept`` with the pooled vector ``x`` in place of the text, its last column."""
    return _per_text(kept, model, "x array<float>", lambda _, x: [pa.array(list(x), pa.list_(pa.float32()))])


def score_quality(docs: DataFrame, model: Model, keep: dict[str, Column] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, the columns in ``keep``, probability of quality 1 and the answer."""
    kept = docs.select(F.col(key).alias("doc_id"), *(c.alias(n) for n, c in (keep or {}).items()), F.col(text).alias("text"))

    def judged(model: Model, x: np.ndarray) -> list[pa.Array]:
        score = model.probabilities(x)
        return [pa.array(score, pa.float64()), pa.array(score >= 0.5).cast(pa.int32())]

    return _per_text(kept, model, "score double, predicted int", judged)
