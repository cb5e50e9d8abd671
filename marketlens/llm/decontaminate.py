"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The n-grams of the test items are counted in all documents. An item's seeds are its n-grams that few
documents hold, and those that are not much more frequent than the item's n-grams are in general: where
an item is copied often, its own n-grams are frequent and still tell its copies. Every other n-gram of
the item is a seed as well wherever an alignment through it could still be accepted, which the words
around it bound from above, so no frequent n-gram loses its documents. Documents meet an item where they share
seeds, unless the words and n-grams they share are too few for any accepted passage; around the shared seeds, passage and item are aligned word by word with the local alignment of
Smith and Waterman, so copies with words replaced, added or left out keep a high score. The score is
the alignment's score as a share of the full score of the item. A passage is accepted by that share, or
by its length alone: 13 equal words, and four more for every word replaced, added or left out among them,
are evidence however long the item is.

Words are compared in lower case and without punctuation at their ends. Items meet documents in
blocks of bounded size: each block is an index that every task holds, and is a stated query set
against all rows. No document travels; nothing grows with their number but counts.

Items of fewer than two n-grams' words are looked for by n-grams of half the length, so that a replaced
word in the middle does not hide them; they need at least all but one of their words, or four, with one
error. Null and empty texts match nothing, and neither do items of fewer words than an n-gram. A document
row that matches an item gives one row, with its best passage (of equal ones the first); repeated
document rows repeat it, repeated items count once per item id and text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import Known, column, mixed, slices, texts

N = 4
RARE_SHARE = 1e-3  # of the documents
SLICE = 4 << 20  # bytes of text that a task holds at a time
MOST_KNOWN = 200_000  # words whose numbers a task remembers
BLOCK_WORDS = 1_000_000  # words of test items that one pass over the documents looks for
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
LONG = 13  # equal words in a row that are evidence by themselves, whatever share of the item they are
ERROR = -4  # what an error in such a row costs, in equal words
ENTRIES = 2_000_000  # n-grams of items, one for each text that holds them, that a task looks at at a time
PAIRS = 20_000  # pairs of text and item, likewise
STRETCH = 1 << 20  # words of a text between the first and the last seed of an alignment
EDGE = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_SHIFT = 24
_MASK = (1 << _SHIFT) - 1


def bare(word: bytes) -> bytes:
    return word.decode("utf-8", "replace").lower().encode().strip(EDGE)


class Index:
    """The words of a block of items as numbers, and where each n-gram stands in which items."""

    def __init__(self, ids: list, items: list[bytes], n: int = N):
        self.n, self.short, self.ids = n, max(1, n // 2), ids
        self.vocabulary: dict[bytes, int] = {}
        self.items = []
        for text in items:
            words = [w for w in map(bare, text.split()) if w]
            self.items.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.bags = [np.unique(a, return_counts=True) for a in self.items]
        self.lengths = np.array([len(a) for a in self.items], np.int64)
        self.bag_words, self.bag_times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*self.bags, strict=True) if self.bags else ((), ())))
        self.bag_bounds = np.concatenate([[0], np.cumsum([len(words) for words, _ in self.bags])]).astype(np.int64)
        sizes = [n if len(a) >= 2 * n else self.short for a in self.items]
        self.sizes = sorted({k for k, a in zip(sizes, self.items, strict=True) if len(a) >= n})
        grams = [self.hashes(np.lib.stride_tricks.sliding_window_view(a, k)) if len(a) >= n else np.zeros(0, np.uint64) for k, a in zip(sizes, self.items, strict=True)]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, int)
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        self.grams, inverse = np.unique(every, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.bounds = np.searchsorted(inverse[order], np.arange(len(self.grams) + 1))
        self.seed = np.ones(len(self.grams), bool)

    @staticmethod
    def hashes(grams: np.ndarray) -> np.ndarray:
        """Hashes of n-grams, one per row."""
        out = np.zeros(len(grams), np.uint64)
        for k in range(grams.shape[1]):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + grams[:, k].astype(np.uint64))
        return out

    def choose_seeds(self, held_by: np.ndarray, rare: float) -> None:
        """``held_by``: documents per n-gram. Sure seeds are held by few, or by no more than twice the item's median."""
        self.seed = held_by <= rare
        gram = np.repeat(np.arange(len(self.grams)), np.diff(self.bounds))
        order = np.argsort(self.owner, kind="stable")
        gram, cuts = gram[order], np.searchsorted(self.owner[order], np.arange(len(self.items) + 1))
        for item in range(len(self.items)):
            own = gram[cuts[item] : cuts[item + 1]]
            own = own[held_by[own] > 0]
            if len(own):
                self.seed[own[held_by[own] <= 2 * np.median(held_by[own])]] = True

    def reach(self, owner: int, words: np.ndarray) -> int:
        """The most words that any alignment of an item with these words can match."""
        own, times = self.bags[owner]
        at = np.minimum(np.searchsorted(own, words), len(own) - 1)
        return int(np.minimum(np.bincount(at[own[at] == words], minlength=len(own)), times).sum())

    def known(self) -> Known:
        """Numbers of words as they stand in texts: 0 for words of no item, -1 for words that are all punctuation."""
        return Known(lambda w: self.vocabulary.get(b, 0) if (b := bare(w)) else -1)


class Numbered:
    """The words of a slice's texts as numbers, without those that are all punctuation."""

    def __init__(self, data: list[bytes], known: Known):
        if len(known) > MOST_KNOWN:
            known.clear()
        words = [t.split() for t in data]
        sizes = np.array([len(w) for w in words], np.int64)
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        kept = np.flatnonzero(numbers >= 0)
        self.numbers = numbers[kept]
        self.doc = np.repeat(np.arange(len(data)), sizes)[kept]
        self.place = kept - (np.cumsum(sizes) - sizes)[self.doc]

    def found(self, index: Index) -> tuple[np.ndarray, np.ndarray]:
        """Places of n-grams of items in the slice, and which n-grams they are."""
        parts = [self._found(index, n) for n in index.sizes]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([at for at, _ in parts]), np.concatenate([which for _, which in parts])

    def _found(self, index: Index, n: int) -> tuple[np.ndarray, np.ndarray]:
        count = len(self.numbers) - n + 1
        if count < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # An n-gram with a word of no item cannot stand in one, and none reaches into the next text.
        inside = self.numbers > 0
        whole = self.doc[:count] == self.doc[n - 1 :]
        for k in range(n):
            whole &= inside[k : k + count]
        at = np.flatnonzero(whole)
        hashes = index.hashes(np.stack([self.numbers[at + k] for k in range(n)], axis=1)) if len(at) else np.zeros(0, np.uint64)
        which = np.minimum(np.searchsorted(index.grams, hashes), len(index.grams) - 1)
        same = index.grams[which] == hashes
        return at[same], which[same]


def align(item: np.ndarray, passage: np.ndarray, match: int = MATCH, mismatch: int = MISMATCH, gap: int = GAP) -> tuple[int, int, int]:
    """Best local alignment: score, first and one-past-last place in ``passage``.

    A cell holds its score and, in the low bits, where its alignment begins; a row is finished by a
    running maximum, as a gap in the passage costs the same for every word.
    """
    starts = np.arange(len(passage) + 1, dtype=np.int64)
    slope = starts * (-gap << _SHIFT)
    above = starts.copy()
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, match, mismatch).astype(np.int64) << _SHIFT
        row = np.maximum(starts, above + (gap << _SHIFT))
        row[1:] = np.maximum(row[1:], above[:-1] + step)
        row = np.maximum.accumulate(row + slope) - slope
        row = np.where(row < starts, starts, row)
        k = int(row.argmax())
        if row[k] >> _SHIFT > best >> _SHIFT:
            best, end = int(row[k]), k
        above = row
    return best >> _SHIFT, best & _MASK, end


def _long(item: np.ndarray, passage: np.ndarray, score: int) -> bool:
    """Whether the passage holds a long row of nearly equal words, whose score is ``MATCH * LONG`` at least."""
    return score >= MATCH * LONG and align(item, passage, 1, ERROR, ERROR)[0] >= LONG


def _least(m: int | np.ndarray, n: int, threshold: float) -> float | np.ndarray:
    """The least score by which a passage of an item of ``m`` words is accepted as a share of it."""
    return np.maximum(threshold * MATCH * m, MATCH * np.minimum(n, m - 1) - 1)


def _expanded(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``starts[i]`` … of ``counts[i]`` each, and the i of each."""
    which = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts), which


def candidates(index: Index, text: Numbered, at: np.ndarray, which: np.ndarray, threshold: float) -> np.ndarray:
    """Numbers (text * items + item) of the pairs that share an n-gram and may hold an accepted passage.

    A pair is left out if the words that text and item have in common are too few for the share, and their
    common n-grams too few for a long row: what shares no more than a stock phrase is never aligned.
    """
    items = len(index.items)
    seen = np.unique(text.doc[at] * len(index.grams) + which)
    doc, gram = np.divmod(seen, len(index.grams))
    counts = index.bounds[gram + 1] - index.bounds[gram]
    # Words of items in the texts that share an n-gram.
    told = (text.numbers > 0) & np.bincount(doc, minlength=int(text.doc[-1]) + 1).astype(bool)[text.doc]
    words, times = np.unique(text.doc[told] * (len(index.vocabulary) + 1) + text.numbers[told], return_counts=True)
    firsts = np.flatnonzero(np.diff(doc, prepend=-1))  # of the texts: one has at most as many entries as the index
    done, total = [np.zeros(0, np.int64)], np.concatenate([[0], np.cumsum(counts)])
    k = 0
    while k < len(firsts):
        nxt = max(k + 1, int(np.searchsorted(total[firsts], total[firsts[k]] + ENTRIES, "right")) - 1)
        low, high = firsts[k], firsts[nxt] if nxt < len(firsts) else len(doc)
        entry, of = _expanded(index.bounds[gram[low:high]], counts[low:high])
        pair, places = np.unique(doc[low:high][of] * items + index.owner[entry], return_counts=True)
        for block in range(0, len(pair), PAIRS):
            some, held = pair[block : block + PAIRS], places[block : block + PAIRS]
            row, item = np.divmod(some, items)
            place, of = _expanded(index.bag_bounds[item], np.diff(index.bag_bounds)[item])
            wanted = row[of] * (len(index.vocabulary) + 1) + index.bag_words[place]
            hit = np.minimum(np.searchsorted(words, wanted), len(words) - 1)
            common = np.where(words[hit] == wanted, np.minimum(times[hit], index.bag_times[place]), 0)
            common = np.bincount(of, common, len(some))
            done.append(some[(MATCH * common >= _least(index.lengths[item], index.n, threshold)) | (held > LONG - index.n)])
        k = nxt
    return np.concatenate(done)


def passages(index: Index, data: list[bytes], known: Known, threshold: float) -> list[tuple[int, int, float, int, int, int]]:
    """(text, item, score, first word, one past the last word, seeds) of the best accepted passage per text and item."""
    text = Numbered(data, known)
    at, which = text.found(index)
    pairs = candidates(index, text, at, which, threshold) if len(at) else at
    if not len(pairs):
        return []
    # Occurrences of the n-grams in the texts that are left, entry by entry, for the pairs that are left.
    some = np.isin(text.doc[at], np.unique(pairs // len(index.items)))
    at, which = at[some], which[some]
    counts = index.bounds[which + 1] - index.bounds[which]
    parts, k, total = [], 0, np.concatenate([[0], np.cumsum(counts)])
    while k < len(at):
        nxt = max(k + 1, int(np.searchsorted(total, total[k] + ENTRIES, "right")) - 1)
        entry, of = _expanded(index.bounds[which[k:nxt]], counts[k:nxt])
        pair = text.doc[at[k:nxt]][of] * len(index.items) + index.owner[entry]
        hit = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        mine = pairs[hit] == pair
        begin = at[k:nxt][of] - index.place[entry]  # where the item would begin, counted from the slice's first word
        parts.append(np.stack([pair[mine], begin[mine], index.seed[which[k:nxt]][of][mine]]))
        k = nxt
    pair, begin, sure = np.concatenate(parts, axis=1)
    doc, owner = np.divmod(pair, len(index.items))
    # Short n-grams are too frequent to be sure seeds.
    sure = (sure > 0) & (index.lengths[owner] >= 2 * index.n)
    order = np.lexsort((begin, owner, doc))
    owner, doc, begin, sure = owner[order], doc[order], begin[order], sure[order]
    low_of, high_of = np.searchsorted(text.doc, [np.arange(len(data)), np.arange(1, len(data) + 1)])
    out = []
    cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(doc) != 0)) + 1
    for b in np.split(np.arange(len(owner)), cuts):
        item, i = index.items[owner[b[0]]], int(doc[b[0]])
        m = len(item)
        slack = m // 3 + index.n
        best = None
        least = float(_least(m, index.n, threshold))
        # A frequent n-gram is a seed unless too few words of the item stand around it for any alignment
        # through it; one that reaches the threshold has no more gaps than ``wide``.
        if not sure[b].all():
            wide = int(MATCH * (1 - threshold) * m) + 1
            reach = {g: index.reach(owner[b[0]], text.numbers[max(low_of[i], g - wide) : min(high_of[i], g + m + wide)]) for g in set(begin[b[~sure[b]]].tolist())}
            # A long row of equal words holds this many n-grams near one diagonal.
            drift = m // -ERROR
            near = np.searchsorted(begin[b], begin[b] + drift, "right") - np.searchsorted(begin[b], begin[b] - drift)
            b = b[sure[b] | (MATCH * np.array([reach.get(g, 0) for g in begin[b].tolist()]) >= least) | (near > LONG - index.n)]
            if not len(b):
                continue
        # Seeds whose passages overlap are aligned as one stretch, up to a length.
        far = (np.diff(begin[b]) > 2 * slack + m) | (np.diff((begin[b] - begin[b[0]]) // STRETCH) > 0)
        for group in np.split(begin[b], np.flatnonzero(far) + 1):
            low, high = max(low_of[i], int(group[0]) - slack), min(high_of[i], int(group[-1]) + m + slack)
            score, first, last = align(item, text.numbers[low:high])
            if (best is None or score > best[0]) and (score >= least or _long(item, text.numbers[low:high], score)):
                best = score, low + first, low + last, len(group)
        if best:
            out.append((i, int(owner[b[0]]), best[0] / (MATCH * m), int(text.place[best[1]]), int(text.place[best[2] - 1]) + 1, best[3]))
    return out


def _blocks(items: DataFrame, key: str, text: str, most: int) -> Iterator[tuple[list, list[bytes]]]:
    ids, data, words = [], [], 0
    for row in items.select(key, text).filter(F.col(text).isNotNull()).distinct().orderBy(key, text).toLocalIterator():
        ids.append(row[0])
        data.append(row[1].encode())
        words += len(row[1].split())
        if words >= most:
            yield ids, data
            ids, data, words = [], [], 0
    if ids:
        yield ids, data


def _count(docs: DataFrame, index: Index, text: str) -> tuple[np.ndarray, int]:
    """Documents per n-gram of the index, and all documents; tasks add up before anything is sent."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known, counts, rows = index.known(), np.zeros(len(index.grams), np.int64), 0
        for batch in slices(batches, text, SLICE):
            rows += batch.num_rows
            words = Numbered(texts(batch, text), known)
            at, which = words.found(index)
            once = np.unique(words.doc[at] * len(index.grams) + which)
            counts += np.bincount(once % max(len(index.grams), 1), minlength=len(index.grams))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int64()), pa.array([rows, *counts[at]], pa.int64())], names=["gram", "n"])

    held = np.zeros(len(index.grams), np.int64)
    found = docs.select(text).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = (found.column(c).to_numpy() for c in ("gram", "n"))
    held[gram[gram >= 0]] = n[gram >= 0]
    shared.destroy()
    return held, int(n[gram < 0].sum())


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of document and test item whose alignment reaches ``threshold``.

    Columns: key, item id, score, the passage's first and one-past-last word (of the blank-separated
    words of the text), and its shared seeds.
    """
    kind = docs.schema[key].dataType.simpleString()
    item_kind = items.schema[item_key].dataType
    parts = []
    for ids, data in _blocks(items, item_key, item_text, BLOCK_WORDS):
        index = Index(ids, data)
        held, n = _count(docs, index, text)
        index.choose_seeds(held, RARE_SHARE * n)
        parts.append(_search(docs, index, key, text, threshold, kind, item_kind))
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, score double, first_word long, end_word long, n_seeds long"
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def _search(docs: DataFrame, index: Index, key: str, text: str, threshold: float, kind: str, item_kind) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    shared = docs.sparkSession.sparkContext.broadcast(index)
    arrow = to_arrow_type(item_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.known()
        for batch in slices(batches, text, SLICE):
            hits = passages(shared.value, texts(batch, text), known, threshold)
            if hits:
                rows, item, score, first, end, seeds = zip(*hits, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        column(batch, key).take(pa.array(rows)),
                        pa.array([shared.value.ids[i] for i in item], arrow),
                        pa.array(score, pa.float64()),
                        *(pa.array(x, pa.int64()) for x in (first, end, seeds)),
                    ],
                    names=["doc_id", "item_id", "score", "first_word", "end_word", "n_seeds"],
                )

    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, score double, first_word long, end_word long, n_seeds long"
    return docs.select(key, text).mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item, with their columns."""
    kept = docs
    for ids, data in _blocks(items, item_key, item_text, BLOCK_WORDS):
        index = Index(ids, data)
        held, n = _count(docs, index, text)
        index.choose_seeds(held, RARE_SHARE * n)
        kept = _without(kept, index, text, threshold)
    return kept


def _without(docs: DataFrame, index: Index, text: str, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.known()
        for batch in slices(batches, text, SLICE):
            clean = np.ones(batch.num_rows, bool)
            clean[[hit[0] for hit in passages(shared.value, texts(batch, text), known, threshold)]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
