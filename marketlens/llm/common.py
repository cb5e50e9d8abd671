"""Words, hashes and Arrow batches shared by the text operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

# Words are runs of characters other than the six ASCII blanks; bytes.split() cuts UTF-8 the same way.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], name: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, so that a task's memory does not
    depend on how many rows the session puts into a batch."""
    for batch in batches:
        size = column(batch, name).nbytes
        step = max(1, batch.num_rows * most // max(size, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def pieces(text: bytes, byte_table: bytes, most: int = 4 << 20) -> Iterator[bytes]:
    """A text through a table that blanks what separates words, in pieces of about ``most`` bytes that are
    cut at blanks, so that no list of words depends on the length of the text."""
    at = 0
    while len(text) - at > most:
        piece = text[at : at + most].translate(byte_table)
        cut = piece.rfind(b" ", 1)
        # A word longer than a piece is taken whole.
        while cut < 0 and at + len(piece) < len(text):
            seen = len(piece)
            piece += text[at + seen : at + seen + most].translate(byte_table)
            cut = piece.find(b" ", seen)
        cut = len(piece) if cut < 0 else cut
        yield piece[:cut]
        at += cut
    yield text[at:].translate(byte_table)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Hashes:
    """64-bit hashes of words, equal in every process, remembered up to a number of words."""

    def __init__(self, most: int = 150_000):
        self.most, self.known = most, Known(xxh3_64_intdigest)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


class Known(dict):
    """Values of words, found once each by ``value``."""

    def __init__(self, value: Callable[[bytes], int]):
        super().__init__()
        self.value = value

    def __missing__(self, word: bytes) -> int:
        found = self[word] = self.value(word)
        return found


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, given the hashes of the words.

    A run's polynomial hash is put together from those of runs of 1, 2, 4 ... words.
    """
    count = len(words) - n + 1
    if count < 1:
        return np.zeros(0, np.uint64)
    out, done = np.zeros(count, np.uint64), 0
    part, length, power = words, 1, int(_ODD)
    while True:
        if n & length:
            out = out * np.uint64(power) + part[done : done + count]
            done += length
        if done == n:
            return mixed(out)
        part = part[:-length] * np.uint64(power) + part[length:]
        length, power = 2 * length, power * power % (1 << 64)


def crc_part(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def crc_of(doc_id: object) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All rows if there are at most ``most``, else those whose keys' hashes lie in a share of the range
    that about 95 per cent of ``most`` rows fall into. Nothing is sorted or moved to draw it."""
    n = rows.count()
    if n <= most:
        return rows
    low = -(1 << 63)
    return rows.filter(F.xxhash64(key) < low + int((1 << 64) * 0.95 * most / n))
