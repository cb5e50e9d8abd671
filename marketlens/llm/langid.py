"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram binds the vectors of its
letters, each permuted (rotated) by its place, by multiplying them; a document's vector bundles its
n-gram vectors by adding them, and a language's prototype bundles its documents. A document gets the
language whose prototype has the highest cosine with it.

The prototypes are fitted on a bounded sample of labelled documents; every text is then read whole.
Bundling is linear, so a document is counted by n-gram first and its vector is one product of the
counts with the n-gram vectors.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if there is no
labelled document with a letter. Languages that tie go to the first in alphabetical order. Repeated
rows repeat their result, an empty table gives an empty result, and other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import bounded_sample, column, slices, texts

DIMENSIONS = 1024
N = 3
CODES = 64  # letter codes, 0 for what stands between words
SAMPLE_DOCS = 4000  # labelled documents that the prototypes are fitted on, about at most
SLICE = 2 << 20  # bytes of text that a task holds at a time
SEED = 20240229


@cache
def letter_codes() -> np.ndarray:
    """A code for every code point: 0 for all but letters, 1 to 26 for a to z in either case, others by rule."""
    codes = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000 and (char := chr(point)).isalpha():
            low = ord(char.lower()[0])
            codes[point] = low - 96 if 97 <= low <= 122 else 27 + low % (CODES - 27)
    return codes


@cache
def letters(dimensions: int) -> tuple[np.ndarray, ...]:
    """The letters' vectors, rotated for each place in an n-gram."""
    plain = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (CODES, dimensions))
    return tuple(np.roll(plain, N - 1 - place, axis=1) for place in range(N))


def grams(data: bytes, codes: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams of a text; runs of other characters count as one gap."""
    points = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    found = codes[points]
    if not found.any():
        return np.zeros(0, np.int32)
    padded = np.zeros(len(found) + 2, np.int32)
    padded[1:-1] = found
    padded = padded[np.concatenate([[True], (padded[1:] != 0) | (padded[:-1] != 0)])]
    return padded[:-2] * CODES * CODES + padded[1:-1] * CODES + padded[2:]


class Vectors:
    """Vectors of the n-grams met so far, and where each n-gram's vector stands."""

    def __init__(self, dimensions: int):
        self.places = letters(dimensions)
        self.index = np.full(CODES**N, -1, np.int32)
        self.rows = np.zeros((1024, dimensions), np.float32)
        self.n = 0

    def places_of(self, found: np.ndarray) -> np.ndarray:
        at = self.index[found]
        if (at < 0).any():
            fresh = np.unique(found[at < 0])
            if self.n + len(fresh) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((len(self.rows) // 2 + len(fresh), self.rows.shape[1]), np.float32)])
            a, b, c = fresh // CODES**2, fresh // CODES % CODES, fresh % CODES
            self.rows[self.n : self.n + len(fresh)] = self.places[0][a] * self.places[1][b] * self.places[2][c]
            self.index[fresh] = np.arange(self.n, self.n + len(fresh))
            self.n += len(fresh)
            at = self.index[found]
        return at

    def bundles(self, texts_: list[bytes], codes: np.ndarray, block: int = 64) -> np.ndarray:
        """One row per text, zero for texts without a letter."""
        out = []
        for k in range(0, len(texts_), block):
            found = [self.places_of(grams(t, codes)) for t in texts_[k : k + block]]
            counts = np.stack([np.bincount(f, minlength=self.n) for f in found]).astype(np.float32)
            out.append(counts @ self.rows[: self.n])
        return np.concatenate(out) if out else np.zeros((0, self.rows.shape[1]), np.float32)


def fit_prototypes(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = SAMPLE_DOCS) -> dict[str, np.ndarray]:
    """A unit vector per language, from the rows where ``train`` holds and language and text are known.

    Tasks bundle what they read, so the driver gets one vector per language.
    """
    known = docs.filter(train & F.col(lang).isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, vectors, sums = letter_codes(), Vectors(DIMENSIONS), {}
        for batch in slices(batches, text, SLICE):
            bundled = vectors.bundles(texts(batch, text), codes)
            for name, v in zip(column(batch, lang).to_pylist(), bundled, strict=True):
                size = np.linalg.norm(v)
                if size:
                    sums[name] = sums.get(name, 0) + v.astype(np.float64) / size
        names = [n for n in sums for _ in range(DIMENSIONS)]
        values = np.concatenate(list(sums.values())) if sums else np.zeros(0)
        at = np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(at), pa.array(values)], names=["lang", "at", "value"])

    sample = bounded_sample(known, key, most).filter(F.col(text).isNotNull()).select(text, lang)
    parts = sample.mapInArrow(run, "lang string, at int, value double")
    rows = parts.groupBy("lang", "at").agg(F.sum("value").alias("value")).collect()
    found: dict[str, np.ndarray] = {}
    for r in rows:
        found.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["at"]] = r["value"]
    return {name: v / np.linalg.norm(v) for name, v in sorted(found.items()) if v.any()}


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: dict[str, Column] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, the columns in ``keep``, predicted language and score.

    The score is the cosine with the prototype of the predicted language, not below 0.
    """
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())).astype(np.float32).T if names else np.zeros((DIMENSIONS, 0), np.float32)
    kept = docs.select(F.col(key).alias("doc_id"), *(c.alias(n) for n, c in (keep or {}).items()), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, vectors = letter_codes(), Vectors(DIMENSIONS)
        for batch in slices(batches, "text", SLICE):
            bundled = vectors.bundles(texts(batch, "text"), codes)
            sizes = np.linalg.norm(bundled, axis=1)
            if names:
                cosines = bundled @ matrix / np.maximum(sizes, 1e-9)[:, None]
                best = cosines.argmax(axis=1)
                score = np.clip(cosines[np.arange(len(best)), best], 0, 1)
                said = ["und" if not s else names[b] for b, s in zip(best, sizes, strict=True)]
            else:
                said, score = ["und"] * len(sizes), np.zeros(len(sizes))
            score = np.where(sizes > 0, score, 0.0).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(said, pa.string()), pa.array(score)],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double")
