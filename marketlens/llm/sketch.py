"""Count-min sketches: filled by tasks, merged by Spark, read by every task of a later pass.

A sketch is ``depth`` rows of ``width`` small counters. A task sends the cells it has counted as
16-bit places within blocks of 65,536 cells, so what is sent grows with what was counted and not with
the sketch. Merging holds one block's counters per block and reads its parts as a stream. The merged
sketch has four bits a cell, on a scale that is exact up to 3 and then grows by about half a step of
two; its size is fixed by width and depth, and it is the only thing that every task gets.

Counts are never too low: merging adds up, and the scale rounds to a level that all equal counts share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import column, mixed
from marketlens.session import discard

BLOCK = 1 << 16
PART = "block int, places binary"
# Level of a count: 0, 1, 2, 3, then one level for each factor of about 1.5; 15 stands for all above.
LEVELS = np.array([0, 1, 2, 3, 4, 6, 9, 14, 21, 32, 48, 72, 108, 162, 243, 365])


def width_for(expected: float, least: int = 1 << 16, most: int = 1 << 26) -> int:
    """A power of two, about eight cells for each of ``expected`` things, within the two bounds."""
    return int(min(most, max(least, 1 << int(np.ceil(np.log2(max(expected, 1) * 8))))))


def cells(hashes: np.ndarray, width: int, depth: int) -> np.ndarray:
    """The cells of each hash, row by row: an array of shape (depth, number of hashes)."""
    salts = mixed(np.arange(1, depth + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    found = mixed(hashes[None, :] ^ salts[:, None]) & np.uint64(width - 1)
    return found + (np.arange(depth, dtype=np.uint64) * np.uint64(width))[:, None]


def parts(found: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of the merge's input for the cells counted by a task."""
    found = np.sort(found.ravel())
    block = (found >> np.uint64(16)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(block)) + 1
    starts = np.concatenate([[0], cuts]) if len(found) else np.zeros(0, int)
    places = np.split((found & np.uint64(BLOCK - 1)).astype("<u2"), cuts) if len(found) else []
    yield pa.RecordBatch.from_arrays(
        [pa.array(block[starts.astype(int)], pa.int32()), pa.array([p.tobytes() for p in places], pa.binary())], names=["block", "places"]
    )


def merge(rows: DataFrame) -> DataFrame:
    """One row per block that anything was counted in: its levels, two cells to a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, places in zip(column(batch, "block").to_pylist(), column(batch, "places").to_pylist(), strict=True):
                if block not in counts:
                    counts[block] = np.zeros(BLOCK, np.uint16)
                held = counts[block]
                at, n = np.unique(np.frombuffer(places, "<u2"), return_counts=True)
                held[at] = np.minimum(held[at].astype(np.int64) + n, 65_535)
        packed = []
        for held in counts.values():
            level = (np.searchsorted(LEVELS, held, side="right") - 1).astype(np.uint8)
            packed.append((level[::2] | (level[1::2] << 4)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(packed, pa.binary())], names=["block", "levels"])

    return rows.repartition("block").mapInArrow(run, "block int, levels binary")


class Sketch:
    def __init__(self, width: int, depth: int, packed: np.ndarray):
        self.width, self.depth, self.packed = width, depth, packed

    @classmethod
    def load(cls, merged: DataFrame, width: int, depth: int) -> Sketch:
        """The merged sketch on the driver, width * depth / 2 bytes; its table is not read again."""
        packed = np.zeros(width * depth // 2, np.uint8)
        half = BLOCK // 2
        for row in merged.toLocalIterator():
            packed[row["block"] * half : (row["block"] + 1) * half] = np.frombuffer(row["levels"], np.uint8)
        discard(merged)
        return cls(width, depth, packed)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """The level of each hash: 1 for what was counted once at most, 2 for twice at most ..."""
        found = cells(hashes, self.width, self.depth).astype(np.int64)
        return ((self.packed[found >> 1] >> ((found & 1) * 4).astype(np.uint8)) & 15).min(axis=0, initial=15)

    def mean_shared(self) -> float:
        """Mean count of a cell counted twice or more, as seen by what falls into it."""
        pairs = np.zeros(256, np.int64)
        for at in range(0, len(self.packed), 1 << 20):
            pairs += np.bincount(self.packed[at : at + (1 << 20)], minlength=256)
        n = (pairs.reshape(16, 16).sum(0) + pairs.reshape(16, 16).sum(1))[2:]
        return float((n * LEVELS[2:] ** 2).sum() / max((n * LEVELS[2:]).sum(), 1))


def text_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of text in all rows, which the width of a sketch is chosen by."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
