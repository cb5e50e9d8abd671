"""Near duplicates among embeddings: spherical k-means cells, cosine products in blocks within cells.

1. Equal vectors of a label are one class from the start, which counts as often as it occurs.
2. Spherical k-means on a bounded sample of classes (``SAMPLE`` of them at most, by hash) gives unit
   centroids, one per ``CELL`` classes. Every class lives in the cell of its nearest centroid and is
   copied to each other cell whose boundary it is near: two vectors that link but live in cells a and b
   lie on both sides of the plane between the centroids, and their distances from it add up to the part
   of their difference along its normal, so one of them is within half of that part and meets the other
   in the other's cell.
   Linked unit vectors are at most ``sqrt(2 - 2 * least)`` apart. ``deviations=None`` takes the whole
   of that, which is exact whatever the data. By default that part is taken to be at most ``DEVIATIONS``
   standard deviations of it for differences without a preferred direction, which misses fewer than one
   in 10,000 pairs at the limit across a boundary and far fewer of closer ones; with 16 dimensions or fewer,
   or one cell, the two agree.
3. A cell of a label is cut into blocks. A task gets a pair of blocks and multiplies them a stripe at a time;
   products close to the limit are computed again, correctly rounded. It returns the number of links of each class
   and links that connect what the links of its blocks connect. Pairs never become rows, so a group of near
   copies costs products but no rows beyond its blocks.
4. The links are connected, and the least key of a component stays.

Vectors that are null, zero, or hold null or infinite components or NaN, and those without a label, link with
nothing; vectors of different length do not link. Rows are vectors of their own, also when they repeat: equal rows
link with each other, and rows that tie for the least key all stay. A component whose keys are all null has a null
name and keeps them all. Empty tables give empty results, and other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from marketlens.llm.common import bounded_sample, column
from marketlens.llm.graph import components
from marketlens.session import staged

LEAST = 0.93
DEVIATIONS = 4.0
SAMPLE = 16_384  # classes that k-means is fitted on
CELL = 2_000  # classes per cell
MOST_CELLS = 1_024
BLOCK = 4_096  # classes of a block, on average
ROUNDS = 6
STRIPE = 512
CLOSE = 1e-9  # products this near to the limit are computed again


def _vectors(rows: DataFrame, key: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, cls, label, dim, vec) of every row; all but the key null where the vector links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = column(batch, "label").to_pylist()
            found = []
            for name, cell in zip(labels, column(batch, "embedding"), strict=True):
                values = cell.values if name is not None and cell.is_valid else None
                if values is None or values.null_count or not len(values):
                    found.append((None, None, None))
                    continue
                vector = values.to_numpy().astype(np.float64) + 0.0  # one zero, not two
                largest = np.abs(vector).max()
                if not 0 < largest < np.inf:
                    found.append((None, None, None))
                    continue
                data = vector.tobytes()
                found.append((xxh3_128_digest(name.encode() + b"\0" + data), len(vector), data))
            cls, dim, vec = zip(*found, strict=True) if found else ((), (), ())
            arrays = [column(batch, "vec_id"), pa.array(cls, pa.binary()), column(batch, "label"), pa.array(dim, pa.int32()), pa.array(vec, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cls", "label", "dim", "vec"])

    plain = rows.select(F.col(key).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).cast("string").alias("label"))
    kind = plain.schema["vec_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"vec_id {kind}, cls binary, label string, dim int, vec binary")


def unit(vectors: list[bytes]) -> np.ndarray:
    """Vectors of one length as rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Correctly rounded sums, so that the order of the components does not matter."""
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def spherical_kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of the rows of ``x``. An emptied cell takes the row that its centroid fits least."""
    centroids = x[np.linspace(0, len(x) - 1, cells).astype(int)]
    for _ in range(rounds):
        products = x @ centroids.T
        home = products.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        size = np.linalg.norm(sums, axis=1)
        worst = np.argsort(products.max(axis=1), kind="stable")
        empty = size < 1e-9
        sums[empty] = x[worst[: empty.sum()]]
        centroids = sums / np.where(empty, 1.0, size)[:, None]
    return centroids


def fit_cells(classes: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> np.ndarray:
    """Centroids for vectors of the commonest length, one per ``cell`` classes and at most one per 4 in the sample."""
    n = classes.count()
    cells = min(MOST_CELLS, -(-n // cell))
    if cells < 2:
        return np.zeros((0, 0))
    drawn = bounded_sample(classes, "cls", sample).select("cls", "dim", "vec").orderBy("cls").collect()
    dims = [r["dim"] for r in drawn]
    common = max(sorted(set(dims)), key=dims.count)
    x = unit([bytes(r["vec"]) for r in drawn if r["dim"] == common])
    return spherical_kmeans(x, max(1, min(cells, len(x) // 4)))


def reach(dim: int, least: float, deviations: float | None) -> float:
    """How far from a boundary a vector may be to be copied across."""
    apart = math.sqrt(max(0.0, 2 - 2 * least))
    return apart / 2 if deviations is None else apart / 2 * min(1.0, deviations / math.sqrt(dim))


def _assigned(classes: DataFrame, centroids: np.ndarray, least: float, deviations: float | None) -> DataFrame:
    """``classes`` with ``home`` and ``near``, the other cells that the class is copied to."""
    k, dim = centroids.shape
    names = ["cls", "label", "dim", "vec", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = np.sqrt(np.maximum(1e-12, 2 - 2 * centroids @ centroids.T))
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = column(batch, "dim").to_numpy()
                home, near = np.zeros(len(dims), np.int32), [[] for _ in dims]
                fits = np.flatnonzero(dims == dim) if k > 1 else []
                if len(fits):
                    vectors = column(batch, "vec").to_pylist()
                    products = unit([vectors[i] for i in fits]) @ centroids.T
                    own = products.argmax(axis=1)
                    home[fits] = own
                    distance = (products[np.arange(len(own)), own][:, None] - products) / gaps[own]
                    close = distance <= reach(dim, least, deviations) + CLOSE
                    close[np.arange(len(own)), own] = False
                    for i, row in zip(fits, close, strict=True):
                        near[i] = np.flatnonzero(row).tolist()
                arrays = [column(batch, c) for c in names] + [pa.array(home), pa.array(near, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, "home", "near"])

    return classes.select(*names).mapInArrow(run, "cls binary, label string, dim int, vec binary, n long, home int, near array<int>")


def _placed(assigned: DataFrame, block: int) -> DataFrame:
    """Members of the cells of every label, once for each pair of blocks they are part of.

    Homes meet homes (``i`` <= ``j``), and copies meet homes (``copies``, with ``j`` the copies' block).
    """
    cell = ["label", "dim", "cell"]
    inside = assigned.withColumns({"cell": F.col("home"), "copy": F.lit(False)})
    across = assigned.withColumn("cell", F.explode("near")).withColumn("copy", F.lit(True))
    members = inside.unionByName(across)
    parts = members.groupBy(*cell).agg(F.sum(F.when(F.col("copy"), 0).otherwise(1)).alias("homes"), F.sum(F.when(F.col("copy"), 1).otherwise(0)).alias("copied"))
    # A cell without a class that lives there compares nothing.
    parts = parts.filter("homes > 0").select(*cell, *(F.ceil(F.col(c) / block).cast("int").alias(n) for c, n in (("homes", "kh"), ("copied", "kc"))))
    sized = members.join(parts, cell).withColumn("b", F.pmod(F.xxhash64("cls"), F.when(F.col("copy"), F.col("kc")).otherwise(F.col("kh"))).cast("int"))
    tasks = F.expr(
        "CASE WHEN copy THEN transform(sequence(0, kh - 1), x -> struct(true AS copies, x AS i, b AS j)) "
        "ELSE concat(transform(sequence(0, kh - 1), x -> struct(false AS copies, least(x, b) AS i, greatest(x, b) AS j)), "
        "CASE WHEN kc > 0 THEN transform(sequence(0, kc - 1), x -> struct(true AS copies, b AS i, x AS j)) "
        "ELSE CAST(array() AS array<struct<copies:boolean,i:int,j:int>>) END) END"
    )
    group = [*cell, "copies", "i", "j"]
    out = sized.withColumn("task", F.explode(tasks)).select(*cell, "task.*", "copy", "b", "cls", "n", "vec", "home", "near")
    return out.repartition(*group).sortWithinPartitions(*group)


class Joined:
    """Sets of numbers 0 … n-1 that are joined as links are met."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, i: int, others: np.ndarray) -> None:
        mine = self.label[i]
        labels = np.unique(self.label[others])
        for other in labels[labels != mine]:
            self.links.append((i, int(others[self.label[others] == other][0])))
            self.label[self.label == other] = mine


def compare(x: np.ndarray, y: np.ndarray | None, n_x: np.ndarray, n_y: np.ndarray | None, least: float, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Links of the rows of ``x`` with those of ``y``, or with each other: how many each has, weighted by the
    other's ``n``, and links that connect the same rows (those of ``y`` numbered after those of ``x``).

    ``left_out`` says which pairs are counted elsewhere.
    """
    inside = y is None
    other, n_other, shift = (x, n_x, 0) if inside else (y, n_y, len(x))
    joined = Joined(len(x) if inside else len(x) + len(y))
    of_x, of_y = np.zeros(len(x), np.int64), np.zeros(len(other), np.int64)
    for at in range(0, len(x), STRIPE):
        rows = slice(at, at + STRIPE)
        products = x[rows] @ other.T
        linked = products >= least
        for i, j in zip(*np.nonzero(np.abs(products - least) < CLOSE), strict=True):
            linked[i, j] = cosine(x[at + i], other[j]) >= least
        if inside:
            linked[np.arange(len(linked)), at + np.arange(len(linked))] = False
        elif left_out is not None:
            linked &= ~left_out[rows]
        of_x[rows] = linked @ n_other
        of_y += n_x[rows] @ linked
        for i in np.flatnonzero(linked.any(axis=1)):
            joined.add(at + int(i), shift + np.flatnonzero(linked[i]))
    return of_x, of_y, joined.links


def _compared(placed: DataFrame, least: float) -> DataFrame:
    """(cls, n, other): a class with a number of links, or with a class it links to."""
    group = ["label", "dim", "cell", "copies", "i", "j"]

    def linked(key: tuple, rows: list[tuple]) -> pa.RecordBatch | None:
        cell, copies, i, j = key[2:]
        left = [r for r in rows if (not r[0] if copies else r[1] == i)]
        right = [r for r in rows if r[0]] if copies else ([r for r in rows if r[1] == j] if i != j else None)
        if not left or right == [] or (right is None and len(left) < 2):
            return None
        x, n_x = unit([r[4] for r in left]), np.array([r[3] for r in left], np.int64)
        y, n_y = (None, None) if right is None else (unit([r[4] for r in right]), np.array([r[3] for r in right], np.int64))
        # A pair that meets in both of its cells is counted in the lower one.
        left_out = _met_before(left, right, cell) if copies else None
        of_x, of_y, links = compare(x, y, n_x, n_y, least, left_out)
        names = [r[2] for r in left + (right or [])]
        counts = of_x if right is None else np.concatenate([of_x, of_y])
        some = np.flatnonzero(counts)
        a, b = zip(*links, strict=True) if links else ((), ())
        cls = [names[k] for k in some] + [names[k] for k in a]
        return pa.RecordBatch.from_arrays(
            [pa.array(cls, pa.binary()), pa.array([*counts[some].tolist(), *[None] * len(a)], pa.int64()), pa.array([None] * len(some) + [names[k] for k in b], pa.binary())],
            names=["cls", "n", "other"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            keys = zip(*(column(batch, c).to_pylist() for c in group), strict=True)
            rows = zip(*(column(batch, c).to_pylist() for c in ("copy", "b", "cls", "n", "vec", "home", "near")), strict=True)
            for key, row in zip(keys, rows, strict=True):
                if key != now:
                    if held and (out := linked(now, held)):
                        yield out
                    now, held = key, []
                held.append(row)
        if held and (out := linked(now, held)):
            yield out

    return placed.mapInArrow(run, "cls binary, n long, other binary")


def _met_before(left: list[tuple], right: list[tuple], cell: int) -> np.ndarray:
    """Which pairs of a class living in ``cell`` and a copy also meet in the copy's home, if that is lower."""
    homes, at = np.unique([r[5] for r in right], return_inverse=True)
    there = np.zeros((len(left), len(homes)), bool)
    owner = np.repeat(np.arange(len(left)), [len(r[6]) for r in left])
    near = np.array([c for r in left for c in r[6]], np.int64)
    place = np.searchsorted(homes, near)
    hit = (place < len(homes)) & (near < cell)
    hit[hit] = homes[place[hit]] == near[hit]
    there[owner[hit], place[hit]] = True
    return there[:, at]


def near_duplicates(rows: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = LEAST, deviations: float | None = DEVIATIONS, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``rows``: key, links with other rows, least key of its component, and whether it is that."""
    vectors = staged(_vectors(rows, key, embedding, label), "vectors")
    sound = vectors.filter("cls IS NOT NULL")
    classes = sound.groupBy("cls").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    classes = staged(classes, "classes")
    assigned = staged(_assigned(classes, fit_cells(classes, cell=cell), least, deviations), "cells")
    found = staged(_compared(_placed(assigned, block), least), "links")
    counts = found.filter("n IS NOT NULL").groupBy("cls").agg(F.sum("n").alias("links"))
    roots = components(found.filter("other IS NOT NULL"), "cls", "other").withColumnRenamed("node", "cls")
    named = classes.select("cls", "least", "n").join(counts, "cls", "left").join(roots, "cls", "left")
    named = staged(named.select("cls", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root")), "named")
    first = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = staged(named.join(first, "root").filter("n_links > 0").select("cls", "n_links", "component_id"), "components")
    met = vectors.select("vec_id", "cls").join(labelled.withColumnRenamed("cls", "of"), F.col("cls") == F.col("of"), "left")
    component = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = met.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
