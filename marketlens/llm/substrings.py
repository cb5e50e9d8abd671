"""Substring dedup: words covered by a window of words that also starts elsewhere.

A window of 35 words stands under its anchor, the least of the hashes of its 8-word runs: equal
windows have equal anchors, and about one place in fourteen is an anchor.

1. Every task counts the anchors of its documents in a count-min sketch; the partial sketches are
   merged. Estimates are never too low, so a window under an anchor estimated once occurs once.
2. A second pass sends the remaining windows, as one row per place of an anchor, to be grouped
   exactly by anchor and window. What repeats within the few megabytes of text that a task holds is
   settled there: it is sent once as known to repeat, so that a passage which a third of all rows
   share is sent once per such slice and not once per row.
3. Documents with windows that only the exact groups can settle are joined with their repeats.

Whether a window repeats is judged on the input. The sketch's size is bounded (``MOST_WIDTH``);
input beyond what it separates sends more windows through the exact groups and loses none.
Windows are equal if the 64-bit hashes of window and anchor are both equal.

Null text has no words. Texts shorter than a window lose nothing. Repeated rows count as repeats, so
every window of such a text is removed from all of them. Empty tables give empty results, null keys
are kept, and other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marketlens.llm import sketch
from marketlens.llm.common import Hashes, column, gram_hashes, slices, texts
from marketlens.session import staged

WINDOW = 35
RUN = 8
DEPTH = 4
MOST_WIDTH = 1 << 25
SLICE = 3 << 20  # bytes of text that a task holds at a time


class Windows:
    """The windows of the texts of a slice: where they start, their anchors, and the words' hashes."""

    def __init__(self, data: list[bytes], hashes: Hashes):
        self.words = [t.split() for t in data]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.hashes = np.concatenate([hashes(w) for w in self.words]) if self.words else np.zeros(0, np.uint64)
        fits = np.maximum(self.sizes - WINDOW + 1, 0)
        self.doc = np.repeat(np.arange(len(self.words)), fits)
        ends = np.cumsum(fits)
        self.start = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - fits, fits) + np.repeat(self.first[:-1], fits)
        self.runs = gram_hashes(self.hashes, RUN)
        self.anchor = self._least()[self.start] if len(self.start) else np.zeros(0, np.int64)

    def _least(self) -> np.ndarray:
        """The place of the first least run of every window, by doubling the reach."""
        span, reach = WINDOW - RUN + 1, 1
        at = np.arange(len(self.runs))
        while reach < span:
            step = min(reach, span - reach)
            a, b = at[:-step], at[step:]
            at = np.where(self.runs[a] <= self.runs[b], a, b)
            reach += step
        return at

    def anchors(self) -> np.ndarray:
        """Hashes of the distinct places that are an anchor."""
        return self.runs[np.unique(self.anchor)]


def _sketch(docs: DataFrame, text: str) -> sketch.Sketch:
    width = sketch.width_for(sketch.text_bytes(docs, text) / 85, most=MOST_WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found, held = Hashes(), [], 0
        for batch in slices(batches, text, SLICE):
            found.append(sketch.cells(Windows(texts(batch, text), hashes).anchors(), width, DEPTH).ravel())
            held += len(found[-1])
            if held > 4_000_000:
                yield from sketch.parts(np.concatenate(found))
                found, held = [], 0
        yield from sketch.parts(np.concatenate([*found, np.zeros(0, np.uint64)]))

    merged = staged(sketch.merge(docs.select(text).mapInArrow(run, sketch.PART)), "anchors")
    return sketch.Sketch.load(merged, width, DEPTH)


def _kept(words: list[bytes], covered: np.ndarray) -> tuple[int, str]:
    """How many words go, and the digest of the rest."""
    rest = words if not covered.any() else [w for w, c in zip(words, covered, strict=True) if not c]
    return int(covered.sum()), hashlib.sha256(b" ".join(rest)).hexdigest()


def _covered(size: int, starts: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + WINDOW, size), -1)
    return np.cumsum(edge[:-1]) > 0


def _passed(docs: DataFrame, estimates: sketch.Sketch, text: str) -> DataFrame:
    """The second pass, as rows of three kinds.

    ``done``: a document whose words are settled. ``open``: one whose words are not, with its text and
    the starts known to repeat. ``part``: windows under one anchor; with a document's number and the
    first start for windows met once in the slice, without for windows known to repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(estimates)
    key = docs.schema.names[0]
    arrow = to_arrow_type(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = Hashes(), TaskContext.get().partitionId() << 40
        for batch in slices(batches, text, SLICE):
            data = texts(batch, text)
            found = Windows(data, hashes)
            places, which = np.unique(found.anchor, return_inverse=True)
            maybe = shared.value.levels(found.runs[places])[which] >= 2 if len(places) else np.zeros(0, bool)
            at = np.flatnonzero(maybe)
            window = gram_hashes(found.hashes, WINDOW)[found.start[at]] if len(at) else np.zeros(0, np.uint64)
            anchor, doc, start = found.runs[found.anchor[at]], found.doc[at], found.start[at]
            # Equal windows of this slice stand together after sorting.
            order = np.lexsort((window, anchor))
            same = np.zeros(len(at), bool)
            if len(at):
                again = (window[order][1:] == window[order][:-1]) & (anchor[order][1:] == anchor[order][:-1])
                same[order[1:]] |= again
                same[order[:-1]] |= again
            once = np.flatnonzero(~same)
            unsettled = np.zeros(len(data), bool)
            unsettled[doc[once]] = True
            rows_done, rows_open = np.flatnonzero(~unsettled), np.flatnonzero(unsettled)
            known = start[same]
            bounds = np.searchsorted(doc[same], np.arange(len(data) + 1))
            sure = [known[bounds[i] : bounds[i + 1]] - found.first[i] for i in range(len(data))]
            yield _rows(arrow, "done", column(batch, key).take(pa.array(rows_done)), number + rows_done, n_words=found.sizes[rows_done], kept=[_kept(found.words[i], _covered(int(found.sizes[i]), sure[i])) for i in rows_done])
            yield _rows(arrow, "open", column(batch, key).take(pa.array(rows_open)), number + rows_open, n_words=found.sizes[rows_open], text=[data[i] for i in rows_open], starts=[sure[i] for i in rows_open])
            # Windows met once: a row per document and anchor place. Known repeats: a row per anchor.
            yield _grouped(arrow, number, anchor[once], found.anchor[at][once], doc[once], start[once] - found.first[doc[once]], window[once])
            first = order[np.concatenate([[True], ~again])] if len(at) else order
            first = first[same[first]]
            yield _grouped(arrow, None, anchor[first], anchor[first], None, None, window[first])
            number += len(data)

    fields = "kind string, doc_id {}, number long, n_words long, n_removed long, kept_sha256 string, text string, starts array<int>, anchor long, windows array<long>"
    return docs.select(key, text).mapInArrow(run, fields.format(docs.schema[key].dataType.simpleString()))


def _rows(arrow: pa.DataType, kind: str, keys: pa.Array, number: np.ndarray, n_words=None, kept=None, text=None, starts=None, anchor=None, windows=None) -> pa.RecordBatch:
    n = len(keys)

    def filled(values, kind_: pa.DataType) -> pa.Array:
        return pa.nulls(n, kind_) if values is None else pa.array(values, kind_)

    texts_ = pa.nulls(n, pa.string()) if text is None else pa.array(text, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * n, pa.string()), keys.cast(arrow), filled(number, pa.int64()), filled(n_words, pa.int64()),
            filled(kept and [k[0] for k in kept], pa.int64()), filled(kept and [k[1] for k in kept], pa.string()),
            texts_, starts if isinstance(starts, pa.Array) else filled(starts, pa.list_(pa.int32())), filled(anchor, pa.int64()),
            windows if isinstance(windows, pa.Array) else filled(windows, pa.list_(pa.int64())),
        ],
        names=["kind", "doc_id", "number", "n_words", "n_removed", "kept_sha256", "text", "starts", "anchor", "windows"],
    )


def _grouped(arrow: pa.DataType, number: int | None, anchor: np.ndarray, place: np.ndarray, doc: np.ndarray | None, start: np.ndarray | None, window: np.ndarray) -> pa.RecordBatch:
    """One row per run of equal ``place``, with the windows and their starts as lists."""
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1, [len(place)]]) if len(place) else np.zeros(1, int)
    head = cuts[:-1]
    offsets = pa.array(cuts.astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(window.view(np.int64)))
    starts = None if start is None else pa.ListArray.from_arrays(offsets, pa.array(start.astype(np.int32)))
    numbers = None if doc is None else number + doc[head]
    return _rows(arrow, "part", pa.nulls(len(head), arrow), numbers, starts=starts, anchor=anchor[head].view(np.int64), windows=lists)


def _finish(rows: DataFrame, key_kind: str) -> DataFrame:
    """Open documents with all their repeats known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE):
            out = []
            starts, more = column(batch, "starts").to_pylist(), column(batch, "more").to_pylist()
            for t, a, b in zip(texts(batch), starts, more, strict=True):
                words = t.split()
                out.append(_kept(words, _covered(len(words), np.array((a or []) + (b or []), np.int64))))
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), column(batch, "n_words"), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return rows.mapInArrow(run, f"doc_id {key_kind}, n_words long, n_removed long, kept_sha256 string")


def repeated_windows(parts: DataFrame) -> DataFrame:
    """(number, start) of the windows met once in their slice that occur elsewhere too.

    Known repeats are made unique first, with a map-side combine: every slice sends those of a passage
    that many documents share.
    """
    known = parts.filter("number IS NULL").select("anchor", "windows").distinct()
    lists = known.select("anchor", F.lit(None).cast("long").alias("number"), "windows", F.array().cast("array<int>").alias("starts"))
    rows = parts.filter("number IS NOT NULL").select("anchor", "number", "windows", "starts").unionByName(lists)
    by_anchor = rows.repartition("anchor").withColumn("of_anchor", F.count("*").over(W.partitionBy("anchor")))
    several = by_anchor.filter("of_anchor > 1")
    # A known repeat has no starts, which leaves them null.
    windows = several.select("anchor", "number", F.explode(F.arrays_zip(F.col("windows").alias("w"), F.col("starts").alias("s"))).alias("x"))
    counted = windows.select("anchor", "number", F.col("x.w").alias("w"), F.col("x.s").alias("s"))
    # A row without a number stands for two or more windows, one with a number for one.
    again = W.partitionBy("anchor", "w")
    total = F.sum(F.when(F.col("number").isNull(), 2).otherwise(1)).over(again)
    return counted.withColumn("n", total).filter("n > 1 AND number IS NOT NULL").select("number", "s")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: words, words removed, digest of the words kept."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    passed = _passed(rows, _sketch(rows, "text"), "text")
    settled = staged(passed, "windows", by="kind")
    done = settled.filter("kind = 'done'").select("doc_id", "n_words", "n_removed", "kept_sha256")
    repeats = repeated_windows(settled.filter("kind = 'part'").select("anchor", "number", "windows", "starts"))
    repeats = repeats.groupBy("number").agg(F.collect_list("s").alias("more")).withColumnRenamed("number", "of")
    waiting = settled.filter("kind = 'open'").select("number", "doc_id", "n_words", "text", "starts")
    joined = waiting.join(repeats, waiting.number == repeats.of, "left").select("doc_id", "n_words", "text", "starts", "more")
    return done.unionByName(_finish(joined, kind))
