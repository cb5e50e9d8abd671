"""Importance resampling of documents towards a target text.

Runs of 1 to ``n`` consecutive words are hashed into a fixed number of buckets. Both the corpus and the
target are counted by bucket; a bucket's gain is the logarithm of its smoothed share in the target over
its share in the corpus, and a document's weight is the sum of the gains of its features. Adding Gumbel
noise to the weights and taking the highest scores draws documents without replacement, with
probabilities in proportion to their likelihood under the target.

A 256-byte table lower-cases A-Z and blanks the separators in UTF-8, ``bytes.split`` yields the words,
and ``crc32`` seeded with the code of a run extends the run by a word. Tasks count words in Counters and
hash different words once; the driver gets one number per bucket, whatever the size of the corpus.
Long texts are cut into pieces between words, so a task's memory does not depend on their length.
The draw sorts narrow rows by range and numbers them from one count per partition.

Null and blank texts have no features, weight 0, and are never drawn with the default least length.
Null keys are hashed as empty text and stand after others among equal scores. Repeated rows each count
and are drawn each; rows that tie in key and score are drawn in order of weight and length. An empty
table gives an empty result and an empty target flattens the corpus. Other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import FOLD, Known, column, pieces, slices, texts
from marketlens.operators.keys import dense_index
from marketlens.session import staged

BUCKETS = 10_000
N = 1
SEED = 2024
SHARE = 10  # per cent of the documents that are long enough
MIN_WORDS = 20
PIECE = 4 << 20  # bytes of text that are cut into words at a time
SEPARATE = bytes(c if c in b"0123456789abcdefghijklmnopqrstuvwxyz" or c >= 0x80 else 0x20 for c in FOLD)


def codes(words: list[bytes], n: int, before: list[bytes]) -> list[int]:
    """crc32 of the runs of 1 to ``n`` words that end in ``words``; ``before`` are the words ahead of them."""
    out, every = list(map(crc32, words)), before + words
    joined, seeds = [b" " + w for w in every], list(map(crc32, every))
    for length in range(2, n + 1):
        seeds = [crc32(w, s) for w, s in zip(joined[length - 1 :], seeds, strict=False)]
        out += seeds[max(0, len(before) - length + 1) :]
    return out


def _features(text: bytes, n: int, piece: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """The words of each piece of a text, with the last ``n - 1`` words before it."""
    before: list[bytes] = []
    for part in pieces(text, SEPARATE, piece):
        words = part.split()
        yield words, before
        before = (before + words)[-(n - 1) :] if n > 1 else []


def bucket_counts(docs: DataFrame, text: str = "text", n: int = N, buckets: int = BUCKETS, piece: int = PIECE) -> np.ndarray:
    """Features of all rows by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, held = np.zeros(buckets, np.int64), Counter()

        def add(found: dict[int, int]) -> None:
            at = np.fromiter(found, np.int64, len(found)) % buckets
            np.add.at(sums, at, np.fromiter(found.values(), np.int64, len(found)))

        def settle() -> None:
            add(_by_code(held))
            held.clear()

        for batch in slices(batches, text, piece):
            for words, before in chain.from_iterable(_features(t, n, piece) for t in texts(batch, text)):
                if n == 1:
                    held.update(words)
                    if len(held) > 200_000:
                        settle()
                else:
                    add(Counter(codes(words, n, before)))
        settle()
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some])], names=["bucket", "n"])

    parts = docs.select(text).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def _by_code(words: Counter) -> Counter:
    """Counts of words as counts of their codes, of which two words may share one."""
    out: Counter = Counter()
    for word, n in words.items():
        out[crc32(word)] += n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """A thousand times the logarithm of the smoothed share in the target over that in the corpus, rounded down."""
    buckets, s, t = float(len(corpus)), float(corpus.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets))))
        for a, b in zip(map(float, corpus), map(float, target), strict=True)
    ]


def weights(docs: DataFrame, gain: list[int], key: str = "doc_id", text: str = "text", n: int = N, piece: int = PIECE) -> DataFrame:
    """One row per row of ``docs``: key, words, features and the sum of their gains."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(lambda word: gain[crc32(word) % buckets])
        for batch in slices(batches, "text", piece):
            rows = []
            for t in texts(batch):
                n_words = weight = 0
                for words, before in _features(t, n, piece):
                    n_words += len(words)
                    if n == 1:
                        weight += sum(map(known.__getitem__, words))
                    else:
                        weight += sum(gain[c % buckets] for c in codes(words, n, before))
                    if len(known) > 200_000:
                        known.clear()
                rows.append((n_words, sum(max(0, n_words - k) for k in range(n)), weight))
            counted = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *counted], names=["doc_id", "n_words", "n_features", "weight"])

    kept = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """A thousand times a Gumbel number made from a hash of seed and key, rounded down."""
    code = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(code, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 … for the highest scores, null for rows that are not drawn."""
    fits = F.col("n_words") >= min_words
    long_enough = scored.filter(fits)
    most = share * long_enough.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    placed = dense_index(long_enough, order, "at")
    ranked = placed.withColumn("rank", F.when(F.col("at") < most, F.col("at") + 1)).drop("at")
    short = scored.filter(~fits).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", n: int = N, buckets: int = BUCKETS, share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED, piece: int = PIECE) -> DataFrame:
    """One row per row of ``docs``: key, words, features, weight, score and rank."""
    gain = gains(bucket_counts(docs, text, n, buckets, piece), bucket_counts(target, target_text, n, buckets, piece))
    scored = weights(docs, gain, key, text, n, piece).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return draw(staged(scored, "weights"), share, min_words)


def sampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``docs`` whose key is drawn, with the columns of ``docs``; keys should be unique."""
    drawn = resample(docs, target, key, **settings).filter("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(drawn, docs[key] == drawn["_drawn"], "left_semi")
