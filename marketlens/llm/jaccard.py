"""N-gram Jaccard join: near duplicates by a size-aware heavy-light join.

A document's set is its distinct 5-word shingles. Two documents link when their sets' Jaccard
similarity is 0.75 or more; the result gives each document its component of links.

1. Documents with equal sets are one class from the start; only classes are joined.
2. A count-min sketch of all shingles orders them from rare to frequent. Two sets of ``s`` or more
   shingles that link share at least ``need(s)`` of them, so they share a shingle among the
   ``s - need(s) + 1`` rarest of either, and two among the ``s - need(s) + 2`` rarest. Estimates are
   never too low: a shingle estimated once stands in one class and is left out. Any order gives the
   right result; a good one keeps the lists below short.
3. Light (small) sets enumerate the subsets of two of their rarest shingles; heavy (large) ones go to
   the inverted lists of single shingles. A light set large enough to link with a heavy one goes to
   both. The boundary is the size up to which the subsets of a set cost less than its lists, which
   are read once and again in every round that connects their members, at the mean length of a list
   that the sketch shows.
4. Keys meet in ranges of their hashes, packed 18 bytes each and not as rows, however few the sketch has
   left out: it has a greatest size, and beyond it most keys of a large table look shared. Only what
   has met leaves the task of a range: the pairs of a short list, a chain through a long one, without those
   whose sizes allow no link.
5. A pair of a short list is dropped if it cannot link by its parity marks: a bit for each shingle that
   falls there an odd number of times. Bits that differ are at most the shingles that only one set has.
6. What may link is connected. The sets of such classes are made in a second reading of their texts;
   those of all others are never stored. Each
   candidate component is compared exactly, in blocks of bounded size: the task of a pair of blocks
   scans the inverted lists of its sets, which counts overlaps exactly, and keeps the links that
   connect something new. Pairs never become rows, so a group of thousands of near copies costs its
   blocks and not its square.

Rows with their texts are never stored either: what goes is told by a hash of all its columns and left out when
the table is read again.

Texts without words (null, empty, blank) have no set and link with nothing. Fewer than five words are
one shingle. Repeated rows are one class. A component is named by its least non-null key, or null
if all its keys are null. Empty tables give empty results; other columns pass through untouched.
Classes and shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from marketlens.llm import sketch
from marketlens.llm.common import FOLD, Hashes, column, gram_hashes, mixed, slices, texts
from marketlens.llm.graph import components
from marketlens.session import staged

N = 5
SHARE = 75  # per cent of the union
MOST_WIDTH = 1 << 27
BLOCK_SETS = 2048
BLOCK_SHINGLES = 2_000_000
RANGE_TEXT = 32 << 20  # bytes of text for each range of keys; the keys of long texts take two thirds of it
DOC_ROWS = 1_024
SHORT_LIST = 8  # sets with a key whose pairs are looked at one by one
MOST_SIZE = 65_535  # sizes above meet as if they were this one, which leaves out less
MARK_BITS = 64, 65_536
MOST_BROADCAST = 2_000_000  # hashes of rows that are sent to all executors, about 50 MB
IDENTITY = "_identity_of_row"
_MARKS = np.uint64(0xA0761D6478BD642F)


def need(size: int) -> int:
    """Shingles that a set of this size shares with any set it links with."""
    return -(-SHARE * size // 100)


def shingle_set(words: np.ndarray, n: int = N) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words are one shingle, of their own length."""
    if not len(words):
        return words
    if len(words) < n:
        return mixed(gram_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(gram_hashes(words, n))


class Classes:
    """The sets of a slice's texts and the different classes among them."""

    def __init__(self, data: list[bytes], hashes: Hashes):
        self.sets = [shingle_set(hashes(t.translate(FOLD).split())) for t in data]
        self.names = [xxh3_64_intdigest(s.tobytes()) >> 1 if len(s) else None for s in self.sets]
        # Sets of one or two shingles link only with equal ones.
        self.first = list({c: i for i, c in reversed(list(enumerate(self.names))) if len(self.sets[i]) > 2}.values())

    def shingles(self) -> np.ndarray:
        return np.concatenate([*(self.sets[i] for i in self.first), np.zeros(0, np.uint64)])


def _sketch(docs: DataFrame, text: str, size: int) -> sketch.Sketch:
    width = sketch.width_for(size / 6, most=MOST_WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, found, held = Hashes(), [], 0
        for batch in slices(batches, text):
            found.append(sketch.cells(Classes(texts(batch, text), hashes).shingles(), width, 1).ravel())
            held += len(found[-1])
            if held > 4_000_000:
                yield from sketch.parts(np.concatenate(found))
                found, held = [], 0
        yield from sketch.parts(np.concatenate([*found, np.zeros(0, np.uint64)]))

    merged = staged(sketch.merge(docs.select(text).mapInArrow(run, sketch.PART)), "shingles")
    return sketch.Sketch.load(merged, width, 1)


def _marks(values: DataFrame, name: str) -> sketch.Sketch:
    """A sketch of a column of different longs, in which a value that was never put in is seldom found."""
    width = sketch.width_for(values.count(), most=MOST_WIDTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from sketch.parts(sketch.cells(column(batch, name).to_numpy().view(np.uint64), width, 1))

    merged = staged(sketch.merge(values.select(name).mapInArrow(run, sketch.PART)), "marks")
    return sketch.Sketch.load(merged, width, 1)


def boundary(mean_list: float) -> int:
    """The largest size whose subsets of two, p(p+1)/2, cost no more than its p lists.

    Connecting the members of a list takes rounds that grow with the logarithm of its length.
    """
    size = 2
    while (size + 1 - need(size + 1) + 2) / 2 <= 1 + np.log2(1 + mean_list):
        size += 1
    return size


def keys(shingles: np.ndarray, levels: np.ndarray, light: int) -> np.ndarray:
    """The keys of a set: shingles for heavy ones, pairs of shingles for light ones, near the boundary both."""
    size = len(shingles)
    prefix = size - need(size) + 1
    # Hashes are sorted, so a stable sort by level orders by (level, hash), the same for all sets.
    order = np.argsort(levels, kind="stable")[: prefix + 1]
    shared = levels[order] > 1
    out = []
    if size > light or size >= need(light + 1):
        out.append(shingles[order[:prefix][shared[:prefix]]])
    if size <= light:
        both = np.sort(shingles[order[shared]])
        a, b = np.triu_indices(len(both), 1)
        out.append(mixed(both[a] * np.uint64(0x9E3779B97F4A7C15) + both[b]))
    return np.concatenate(out)


def parity_marks(shingles: np.ndarray) -> bytes:
    """A power of two of bits, about as many as shingles: set where an odd number of them falls."""
    bits = min(MARK_BITS[1], max(MARK_BITS[0], 1 << int(np.ceil(np.log2(len(shingles))))))
    places = (mixed(shingles ^ _MARKS) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) & 1, bitorder="little").tobytes()


def may_link(a: bytes, b: bytes, sizes: int) -> bool:
    """Whether sets with these marks and sum of sizes may link; marks of more bits are folded to the fewer."""
    x, y = sorted((np.frombuffer(m, np.uint8) for m in (a, b)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), 0)
    overlap = (sizes - int(np.bitwise_count(x ^ y).sum())) // 2
    return 100 * overlap >= SHARE * (sizes - overlap)


def met(names: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (greater, least) of owners of the same key which may link by size: all of short lists, and chains through long ones.

    Sizes rise in a list, so where one and the next cannot link, none before can with any behind.
    """
    order = np.lexsort((owners, sizes, names))
    names, sizes, owners = names[order], sizes[order].astype(np.int64), owners[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (owners[1:] != owners[:-1])
    names, sizes, owners = names[fresh], sizes[fresh], owners[fresh]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(names)) + 1])[: len(names)]
    length = np.diff([*starts, len(names)])
    long = np.repeat(length > SHORT_LIST, length)

    def different(apart: int, of: np.ndarray) -> np.ndarray:
        at = np.flatnonzero((names[apart:] == names[:-apart]) & of[:-apart] & (100 * sizes[:-apart] >= SHARE * sizes[apart:]))
        both = owners[at], owners[at + apart]
        return np.stack([np.maximum(*both), np.minimum(*both)], 1)

    def once(pairs: list[np.ndarray]) -> np.ndarray:
        found = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
        found = found[np.lexsort(found.T)]
        return found[np.concatenate([np.ones(len(found[:1]), bool), (found[1:] != found[:-1]).any(axis=1)])]

    return once([different(d, ~long) for d in range(1, SHORT_LIST)]), once([different(1, long)])


def _passed(docs: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, Broadcast]:
    """What every task holds, and rows of three kinds: ``doc`` (kept columns, size, class, hash of the text, and once in a slice the
    marks of its class), ``pair`` and ``chain`` (two classes that share a key, one by one or to be connected)."""
    size = sketch.text_bytes(docs, text)
    estimates = _sketch(docs, text, size)
    shared = docs.sparkSession.sparkContext.broadcast((estimates, boundary(estimates.mean_shared())))
    packed = docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("content"))
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_TEXT))

    def rows(own: pa.DataType, kind: str, n: int, row: pa.Array | None = None, **values) -> pa.RecordBatch:
        arrays = [pa.array([kind] * n, pa.string()), pa.nulls(n, own) if row is None else row]
        for name, type_ in FIELDS.items():
            arrays.append(pa.array(values[name], type_) if name in values else pa.nulls(n, type_))
        return pa.RecordBatch.from_arrays(arrays, names=["kind", "row", *FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, task = Hashes(), TaskContext.get().partitionId()
        number = task << 40
        counts, light = shared.value
        for at, batch in enumerate(slices(batches)):
            found = Classes(texts(batch), hashes)
            row, content = column(batch, "row"), column(batch, "content")
            n = len(found.sets)
            places = (31 * task + 7 * at + np.arange(n) // DOC_ROWS) % ranges
            made = []
            if found.first:
                levels = counts.levels(found.shingles())
                cuts = np.cumsum([len(found.sets[i]) for i in found.first])[:-1]
                made = [keys(found.sets[i], x, light) for i, x in zip(found.first, np.split(levels, cuts), strict=True)]
            marks = dict.fromkeys(range(n)) | {i: parity_marks(found.sets[i]) for i, k in zip(found.first, made, strict=True) if len(k)}
            of_set = [len(x) for x in found.sets]
            yield rows(row.type, "doc", n, row, part=places, number=number + np.arange(n), size=of_set, cls=found.names, content=content, marks=list(marks.values()))
            number += n
            every = np.concatenate([*made, np.zeros(0, np.uint64)])
            lengths = np.array([len(k) for k in made], np.int64)
            owners = np.repeat(np.array([found.names[i] for i in found.first], np.int64), lengths)
            sizes = np.repeat(np.array([min(MOST_SIZE, of_set[i]) for i in found.first], np.uint16), lengths)
            part = (every % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            starts = np.concatenate([[0], cuts])[: len(part)]
            split = {c: [x.tobytes() for x in np.split(y[order], cuts)[: len(starts)]] for c, y in (("keys", every), ("sizes", sizes), ("owners", owners))}
            yield rows(row.type, "key", len(starts), part=part[starts], **split)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {"keys": (np.uint64, []), "sizes": (np.uint16, []), "owners": (np.int64, [])}
        for batch in batches:
            own = column(batch, "row").type
            yield batch.filter(pc.equal(column(batch, "kind"), "doc"))
            for name, (kind, found) in held.items():
                found += [np.frombuffer(x, kind) for x in column(batch, name).drop_null().to_pylist()]
        if held["keys"][1]:
            for kind, pairs in zip(("pair", "chain"), met(*(np.concatenate(x) for _, x in held.values())), strict=True):
                for at in range(0, len(pairs), 100_000):
                    some = pairs[at : at + 100_000]
                    yield rows(own, kind, len(some), cls=some[:, 0], low=some[:, 1])

    schema = f"kind string, row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{n} {SQL_TYPES[t]}" for n, t in FIELDS.items())
    dealt = packed.mapInArrow(run, schema).repartitionById(ranges, F.col("part"))
    return dealt.mapInArrow(meet, schema).drop("part", "keys", "sizes", "owners"), shared


FIELDS = {
    "part": pa.int32(), "number": pa.int64(), "size": pa.int64(), "cls": pa.int64(), "content": pa.int64(), "low": pa.int64(),
    "marks": pa.binary(), "keys": pa.binary(), "sizes": pa.binary(), "owners": pa.binary(),
}
SQL_TYPES = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}


def _bounded(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``pairs`` of classes which may link by their marks."""
    known = rows.filter("marks IS NOT NULL").select("cls", "size", "marks").dropDuplicates(["cls"])
    theirs = known.toDF("low", "low_size", "low_marks")
    both = pairs.join(known, "cls").join(theirs, "low").select("cls", "low", "marks", "low_marks", (F.col("size") + F.col("low_size")).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column(batch, c).to_pylist() for c in ("marks", "low_marks", "sizes")), strict=True)
            yield batch.filter(pa.array([may_link(*r) for r in rows], pa.bool_())).select(["cls", "low"])

    return both.mapInArrow(run, "cls long, low long")


def _sets(docs: DataFrame, text: str, wanted: DataFrame) -> tuple[DataFrame, Broadcast]:
    """(cls, size, shingles) of the texts whose hash is ``wanted``, and of few others; a class may come more than once."""
    shared = docs.sparkSession.sparkContext.broadcast(_marks(wanted, "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, marks = Hashes(), shared.value
        for batch in batches:
            there = marks.levels(column(batch, "content").to_numpy().view(np.uint64)) > 0
            for part in slices(iter([batch.filter(pa.array(there))])):
                found = Classes(texts(part), hashes)
                sets = [found.sets[i] for i in found.first]
                arrays = [pa.array([found.names[i] for i in found.first], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["cls", "size", "shingles"])

    packed = docs.select(docs[text].alias("text"), F.xxhash64(docs[text]).alias("content"))
    return packed.mapInArrow(run, "cls long, size long, shingles binary"), shared


def links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all sets which any links connect.

    A set is scanned by reading the inverted lists of its shingles, which counts its overlap with every
    other set. Once all sets that were not scanned are connected, no further scan can connect more.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate(sets)
    _, token, n = np.unique(every, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    lists = owner[np.argsort(token, kind="stable")]
    begin = np.cumsum(n) - n
    ends = np.cumsum(sizes)
    label = np.arange(len(sets))
    left = np.ones(len(sets), bool)
    found = []
    while left.any():
        open_labels = np.bincount(label[left], minlength=len(sets))
        rest = left & (label != open_labels.argmax())
        if not rest.any():
            break
        i = int(np.flatnonzero(rest)[0])
        left[i] = False
        mine = token[ends[i] - sizes[i] : ends[i]]
        mine = mine[n[mine] > 1]
        if not len(mine):
            continue
        count = n[mine]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[mine], count)
        overlap = np.bincount(lists[at], minlength=len(sets))
        near = np.flatnonzero((100 * overlap >= SHARE * (sizes + sizes[i] - overlap)) & (label != label[i]))
        for j in near:
            if label[j] != label[i]:
                found.append((i, int(j)))
                label[label == label[j]] = label[i]
    return found


def _verified(placed: DataFrame) -> DataFrame:
    """Links (a, b) within each group of rows; groups arrive one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}

        def flush() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            names = list(held)
            return [(names[i], names[j]) for i, j in links([np.frombuffer(s, np.uint64) for s in held.values()])]

        out: list[tuple[int, int]] = []
        for batch in batches:
            groups = zip(*(column(batch, c).to_pylist() for c in ("comp", "i", "j")), strict=True)
            rows = zip(groups, column(batch, "cls").to_pylist(), column(batch, "shingles").to_pylist(), strict=True)
            for g, cls, shingles in rows:
                if g != group:
                    out += flush()
                    group, held = g, {}
                held[cls] = shingles
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])
                out = []
        out = flush()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["a", "b"])

    return placed.mapInArrow(run, "a long, b long")


def _linked(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(node, root): classes that are not the least of their component, and the least one."""
    rows = found.filter("kind = 'doc'").select("cls", "size", "content", "marks")
    pairs, chains = (found.filter(F.col("kind") == k).select("cls", "low").distinct() for k in ("pair", "chain"))
    coarse = components(_bounded(pairs, rows).union(chains), "cls", "low")
    members = staged(coarse.union(coarse.select("root", "root").distinct()).toDF("node", "comp"), "members")
    wanted = staged(rows.join(members, rows.cls == members.node).select("content").distinct(), "wanted")
    sets, shared = _sets(docs, text, wanted)
    sizes = rows.select("cls", "size").distinct()
    blocks = sizes.join(members, sizes.cls == members.node).groupBy("comp").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("k")
    )
    place = members.join(blocks.withColumnRenamed("comp", "c"), F.col("comp") == F.col("c")).select("node", "comp", "k")
    pairs = F.expr(
        "if(k = 1, array(struct(0 AS i, 0 AS j)), "
        "transform(filter(sequence(0, k - 1), x -> x <> b), x -> struct(least(x, b) AS i, greatest(x, b) AS j)))"
    )
    placed = sets.join(place, sets.cls == place.node).withColumn("b", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    placed = placed.select("cls", "shingles", "comp", F.explode(pairs).alias("p")).select("comp", "p.i", "p.j", "cls", "shingles")
    placed = placed.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    linked = components(_verified(placed), "a", "b")
    shared.destroy()
    return linked


def _labelled(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``row``, ``number``, ``size`` and ``comp`` (null without words) of every row."""
    passed, shared = _passed(docs, keep, text)
    found = staged(passed, "shingled", by="kind")
    shared.destroy()
    linked = _linked(found, docs, text)
    rows = found.filter("kind = 'doc'").select("row", "number", "size", "cls")
    return rows.join(linked, rows.cls == linked.node, "left").select("row", "number", "size", F.coalesce("root", "cls").alias("comp"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size of its set, and the least key of its component."""
    rows = staged(_labelled(docs, [key], text).select(F.col("row")[key].alias("doc_id"), "size", "comp"), "components")
    least = rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    least = staged(least.select(F.col("comp").alias("of"), "least"), "least")
    named = F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.join(least, rows.comp == least.of, "left").select("doc_id", F.col("size").alias("n_shingles"), named.alias("component_id"))


def _identity(docs: DataFrame) -> Column:
    """A hash of all columns of a row, nulls and their places included."""
    plain = [F.to_json(F.struct(docs[f.name]), {"ignoreNullFields": "false"}) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else docs[f.name] for f in docs.schema]
    return F.xxhash64(*plain, *(docs[c].isNull() for c in docs.columns))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of every component, that of the least key; rows without words all stay."""
    named = docs.withColumn(IDENTITY, _identity(docs))
    rows = _labelled(named, [key, IDENTITY], text)
    light = rows.filter("comp IS NOT NULL").select("number", F.col("row")[key].alias("key"), F.col("row")[IDENTITY].alias("identity"), "comp")
    light = staged(light, "members")
    order = F.struct(F.col("key").isNull().alias("last"), "key", "number")
    first = light.groupBy("comp").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = staged(first.select(F.col("comp").alias("of"), F.col("first.number").alias("stays")), "first")
    # Rows that are equal in all columns have one identity; of those of the one that stays, any one does.
    met = light.join(first, light.comp == first.of).groupBy("identity")
    found = met.agg(F.max(F.col("number") == F.col("stays")).alias("stays"), F.count("*").alias("n")).filter("n > 1 OR NOT stays")
    found = staged(found.select(F.col("identity").alias(IDENTITY), "stays"), "found")
    there = found.count()

    def of(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if there <= MOST_BROADCAST else rows

    repeated = named.join(of(found.filter("stays").select(IDENTITY)), [IDENTITY], "left_semi")
    others = named.join(of(found.select(IDENTITY)), [IDENTITY], "left_anti")
    return others.union(repeated.dropDuplicates([IDENTITY])).drop(IDENTITY)
