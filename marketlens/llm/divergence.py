"""How far the sources of a language differ in their use of terms.

Every source of a language is one group, and each of them gives every kept term of the language a
smoothed share ``p`` in billionths. Two groups differ by the sum over all kept terms of the squared
difference of their shares over the sum of the shares; a group's own terms are those with a higher share
than in the language as a whole.

1. Tasks count terms in Counters per group; counts are merged by (group, term). The terms that enough
   documents of the language hold are kept and numbered in their byte order.
2. A group becomes sorted arrays of (term id, count), one for each range of ids, so that no array grows
   with the vocabulary. Groups of a language are dealt into blocks, and a task gets two blocks of one range.
3. A pair of arrays is merged by searching the ids of the shorter in the longer. What only one group
   holds is priced by the few different counts it has, and what neither holds by one product; so a pair
   costs its overlap. A pair is priced once and reported both ways.

All arithmetic is on integers, exact for groups of up to 9e15 terms. Null texts, languages and sources
count as empty. A group without kept terms has a count of 0 everywhere, and in a language without kept
terms all differences are 0. Repeated rows are documents of their own; ties are in byte order of the
item. Empty tables give empty results, and other columns are never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import FOLD, LOWER, column, pieces, slices, texts
from marketlens.operators.keys import dense_index
from marketlens.session import staged

MIN_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
PIECE = 4 << 20  # bytes of text that are cut into terms at a time
RANGE = 1 << 15  # term ids of an array
BLOCK = 24  # groups of a block, on average
SEPARATE = bytes(c if c in LOWER.encode() or c >= 0x80 else 0x20 for c in FOLD)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group.

    Every group has a row for the empty term, which stands for the group itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def settled() -> pa.RecordBatch:
            rows = [(*group, term, n, found.get(term, 0)) for group, (total, found) in held.items() for term, n in total.items()]
            held.clear()
            kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds]
            arrays[2] = arrays[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])

        for batch in slices(batches, "text", PIECE):
            groups = zip(column(batch, "lang").to_pylist(), column(batch, "source").to_pylist(), strict=True)
            for group, t in zip(groups, texts(batch), strict=True):
                total, found = held.setdefault(group, (Counter({b"": 0}), Counter()))
                seen: set[bytes] = set()
                for piece in pieces(t, SEPARATE, PIECE):
                    words = piece.split()
                    total.update(words)
                    seen.update(words)
                found.update(seen)
            if sum(len(total) for total, _ in held.values()) > 400_000:
                yield settled()
        yield settled()

    named = {"lang": lang, "source": source, "text": text}
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()))
    counted = plain.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(n: np.ndarray | int, whole: int) -> np.ndarray:
    """1 + floor(UNIT * (n + 2) / whole) in 64 bits: three decimal digits at a time."""
    out, rest = np.divmod(np.asarray(n, np.int64) + 2, np.int64(whole))
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, np.int64(whole))
        out = out * 1000 + digits
    return out + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Group:
    """A group's part of one range of terms: sorted ids, their counts, and how often each count occurs."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, whole: int):
        self.ids, self.whole = ids, whole
        self.levels, at, self.times = np.unique(n, return_inverse=True, return_counts=True)
        # Shares are found once for each different count.
        self.level_prices = price(self.levels, whole) if whole else self.levels
        self.prices = self.level_prices[at]
        self.none = int(price(0, whole)) if whole else 0

    def alone(self, other: int) -> int:
        """All terms of the group against the share ``other``."""
        return int((self.times * apart(self.level_prices, np.int64(other))).sum())


def difference(a: Group, b: Group, terms: int) -> int:
    """The sum over all ``terms`` of a range."""
    short, long = (a, b) if len(a.ids) <= len(b.ids) else (b, a)
    at = np.searchsorted(long.ids, short.ids)
    met = at < len(long.ids)
    met[met] = long.ids[at[met]] == short.ids[met]
    x, y = short.prices[met], long.prices[at[met]]
    both = apart(x, y) - apart(x, np.int64(long.none)) - apart(y, np.int64(short.none))
    absent = terms - len(short.ids) - len(long.ids) + len(x)
    return int(both.sum()) + short.alone(long.none) + long.alone(short.none) + absent * int(apart(np.int64(short.none), np.int64(long.none)))


def _pairs(table: pa.Table, width: int) -> pa.Table:
    """Differences of the pairs of groups of a pair of blocks in a range of ``width`` term ids."""
    i, j, part, v = (table.column(c)[0].as_py() for c in ("i", "j", "part", "v"))
    terms = min(width, v - part * width)
    names, blocks, wholes = (table.column(c).to_pylist() for c in ("source", "b", "whole"))
    groups = []
    for cell, whole in zip(table.column("terms"), wholes, strict=True):
        ids, n = (cell.values.field(k).to_numpy() for k in (0, 1)) if cell.is_valid else (np.zeros(0, np.int64),) * 2
        groups.append(Group(ids, n, whole))
    out = []
    for x, y in np.ndindex(len(groups), len(groups)):
        # Within a block each pair once, across two blocks those with one group of each.
        if names[x] < names[y] if i == j else (blocks[x], blocks[y]) == (i, j):
            out.append((names[x], names[y], difference(groups[x], groups[y], terms) if terms > 0 else 0))
    a, b, value = zip(*out, strict=True) if out else ((), (), ())
    langs = pa.array([table.column("lang")[0].as_py()] * len(out), pa.string())
    return pa.table({"lang": langs, "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})


def _share(n: str, whole: str) -> Column:
    """:func:`price` as an expression, in decimals as the product may pass 64 bits."""
    top = f"CAST({UNIT} AS decimal(10,0)) * (CAST({n} AS decimal(19,0)) + 2)"
    return F.expr(f"1 + ({top}) div CAST({whole} AS decimal(19,0))")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= most) if most else ranked


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, width: int = RANGE, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank, p, q).

    Part ``pair`` has a row for each other source of the language; part ``term`` has the ``top`` terms that the
    source uses more than the language, with their shares ``p`` and ``q`` in both.
    """
    counted = staged(term_counts(docs, text, lang, source), "terms")
    held = counted.filter("term <> ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    placed = staged(dense_index(held.filter(F.col("docs") >= min_docs), ["lang", "term"], "at"), "kept")
    sizes = placed.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"), F.min("at").alias("first"))
    groups = counted.filter("term = ''").select("lang", "source")
    langs = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left")
    langs = staged(langs.na.fill(0, ["v", "lang_total", "first"]), "langs")

    cells = counted.select("lang", "source", "term", "n").join(placed.select("lang", "term", "at", "total"), ["lang", "term"])
    cells = staged(cells, "cells")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["group_total"]).join(langs, "lang")
    groups = staged(groups.withColumn("whole", F.expr("group_total + 2 * v")), "groups")

    # Terms: shares as 64-bit integers, their squared difference is at most UNIT squared.
    rated = cells.join(groups.select("lang", "source", "whole", F.expr("lang_total + 2 * v").alias("lang_whole")), ["lang", "source"])
    rated = rated.filter("n > 0").select("lang", "source", F.col("term").alias("item"), _share("n", "whole").alias("p"), _share("total", "lang_whole").alias("q"))
    own = rated.filter("p > q").select("lang", "source", "item", "p", "q", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    own = _ranked(own, top).withColumn("part", F.lit("term"))

    # Pairs: every group has a place in every range of its language, with or without terms there.
    part = F.expr(f"(at - first) div {width}").cast("int")
    arrays = cells.join(langs.select("lang", "first"), "lang").groupBy("lang", "source", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("terms"))
    grid = groups.select(
        "lang", "source", "whole", "v",
        F.ceil(F.col("sources") / block).cast("int").alias("k"),
        F.explode(F.expr(f"sequence(0, CAST(greatest(0, (v - 1) div {width}) AS int))")).alias("part"),
    )
    spread = grid.join(arrays, ["lang", "source", "part"], "left").withColumn("b", F.pmod(F.xxhash64("source"), F.col("k")).cast("int"))
    met = spread.withColumn("with", F.explode(F.expr("sequence(0, k - 1)")))
    met = met.select("lang", "part", F.least("b", "with").alias("i"), F.greatest("b", "with").alias("j"), "source", "b", "whole", "v", "terms")
    priced = met.groupBy("lang", "part", "i", "j").applyInArrow(lambda t: _pairs(t, width), "lang string, a string, b string, value long")
    pairs = staged(priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(pairs.select("lang", "b", "a", "value"))
    both = _ranked(both).withColumns({"part": F.lit("pair"), "p": F.lit(None).cast("long"), "q": F.lit(None).cast("long")})
    fields = ["lang", "source", "part", "item", "value", "rank", "p", "q"]
    return both.select(fields).unionByName(own.select(fields))
