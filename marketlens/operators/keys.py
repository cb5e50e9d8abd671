"""Deduplication, existence tests and numbering by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import shared_dir

_RANK = "_rank"


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of every key in ``order``.

    Spark pushes the rank limit below the shuffle, so each map task sends at most ``n`` rows
    of a key, however many it holds.
    """
    name = rank or _RANK
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first in ``order``, which by default is all the other columns.

    A caller who knows a shorter total order passes it, so that unused columns stay unread.
    """
    return top_per_key(df, keys, list(order) or [F.col(c) for c in df.columns if c not in keys] or [F.col(keys[0])], 1)


def keep_one_complete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key among the rows without nulls."""
    return keep_one(df.na.drop(), keys)


def _reference(reference: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """Keys to test against; repeats are merged before the join unless there are none."""
    chosen = reference.select(*keys)
    return chosen if unique else chosen.distinct()


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is whole, and those with a null part, which no join would ever find again."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return df.filter(whole), df.filter(~whole)


def existing(df: DataFrame, reference: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows whose key occurs in ``reference``; ``unique`` says it holds each key once."""
    return df.join(_reference(reference, keys, unique), list(keys), "left_semi")


def unknown(df: DataFrame, known: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows whose key does not occur in ``known``; ``unique`` says it holds each key once."""
    return df.join(_reference(known, keys, unique), list(keys), "left_anti")


def append_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(rows)


def spread(df: DataFrame, most: int = 50_000, least: int = 500) -> DataFrame:
    """The same rows dealt evenly to tasks of at most ``most`` rows, for steps that cost much more than reading.

    A small table goes to all cores, while a task gets ``least`` rows. The rows are counted first.
    """
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, -(-n // most), min(cores, -(-n // least))))


def dense_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows 0, 1, 2 … in ``order``, without bringing them to one task.

    The sorted rows are checkpointed, so that their place in a partition is fixed; the rows
    before a partition are then found from one count per partition.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.orderBy(*order)
        .select("*", F.monotonically_increasing_id().alias("_place"))
        .checkpoint()
    )
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the sort: the task count bounds this side.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_place", "_offset")
    )
