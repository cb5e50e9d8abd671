"""A text index that is kept up to date by drops of documents.

Every load adds folders of its own below ``base``: the term counts of its documents, the keys it holds, and the
changes of document frequencies and of the number of documents. Changes are sums, so they merge in any order, and a
load reads older counts of its own keys only; nothing that is stored is written again. Weights are derived when they are
asked for. A later load replaces the documents of earlier ones. Loads are numbered, and the newest one may be
repeated, which replaces its own folders; an index has one writer, and a load that died is not read until it is repeated. Rows with a null part in their key are left out; null and empty texts
count as documents without tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.keys import existing, keyed
from marketlens.operators.terms import term_counts, tfidf, without
from marketlens.session import staged
from marketlens.sources.files import partition_folders, path_exists

_COUNTS = [("token", T.StringType()), ("tf", T.LongType())]


def _stored(spark: SparkSession, base: str, part: str, fields: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    schema = T.StructType()
    for name, kind in [*fields, ("load", T.LongType())]:
        schema = schema.add(name, kind)
    path = f"{base}/{part}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _finished(spark: SparkSession, base: str, part: str, fields: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """A part without the rows of a load that died before it had stored its keys, the last of its parts."""
    folders = partition_folders(spark, f"{base}/held")
    done = [int(f.rsplit("=", 1)[1]) for f in folders if path_exists(spark, f"{f}/_SUCCESS")]
    return _stored(spark, base, part, fields).filter(F.col("load").isin(done))


def _replaced(spark: SparkSession, base: str, kinds: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """Every key with the loads that no longer hold it, a small table next to all that is stored."""
    names, held = [name for name, _ in kinds], _finished(spark, base, "held", kinds)
    several = held.groupBy(*names).agg(F.max("load").alias("_now"), F.collect_list("load").alias("_loads")).filter(F.size("_loads") > 1)
    return several.select(*names, "_now", F.explode("_loads").alias("load")).filter(F.col("load") < F.col("_now")).drop("_now")


def _kinds(rows: DataFrame, keys: Sequence[str]) -> list[tuple[str, T.DataType]]:
    return [(key, rows.schema[key].dataType) for key in keys]


def add_drop(docs: DataFrame, base: str, keys: Sequence[str], text: Column, load: int) -> None:
    """Adds documents, which hold each key once, as load number ``load``; it must be the newest."""
    spark, kinds, key = docs.sparkSession, _kinds(docs, keys), list(keys)
    whole, _ = keyed(docs, keys)
    # Counts go to their place at once and are read there; until the keys are stored nobody else reads them.
    term_counts(whole, keys, text).write.mode("overwrite").parquet(f"{base}/counts/load={load}")
    counts = _stored(spark, base, "counts", [*kinds, *_COUNTS])
    fresh = counts.filter(F.col("load") == load)
    mine = staged(whole.select(*keys), "fresh-keys")
    # Documents that this load replaces, with the load that holds them now.
    older = _finished(spark, base, "held", kinds).filter(F.col("load") < load)
    before = staged(existing(older, mine, keys, unique=True).groupBy(*keys).agg(F.max("load").alias("load")), "replaced")
    # The load's own folders are about to be replaced if it is repeated, so only older ones are read.
    old = counts.filter(F.col("load") < load).join(before, [*key, "load"], "left_semi")
    one = F.lit(1).cast("bigint")
    changes = fresh.select("token", one.alias("df")).unionByName(old.select("token", (-one).alias("df")))
    df = changes.groupBy("token").agg(F.sum("df").alias("df")).filter("df <> 0")
    n = mine.select(one.alias("n_docs")).unionByName(before.select((-one).alias("n_docs"))).agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"))
    # The keys come last: a load that dies before them is not read, and is repeated whole.
    for part, rows in (("df", df), ("n", n), ("held", mine)):
        rows.write.mode("overwrite").parquet(f"{base}/{part}/load={load}")


def current_counts(spark: SparkSession, base: str, kinds: Sequence[tuple[str, T.DataType]]) -> DataFrame:
    """Term counts of all documents as the newest of their loads has them."""
    names = [name for name, _ in kinds]
    counts = _finished(spark, base, "counts", [*kinds, *_COUNTS])
    return counts.join(_replaced(spark, base, kinds), [*names, "load"], "left_anti").select(*names, "token", "tf")


def current_vocabulary(spark: SparkSession, base: str, stop_words=None, min_df: int = 2) -> DataFrame:
    """Document frequencies as the sum of all changes; no term count is read."""
    sums = _finished(spark, base, "df", [("token", T.StringType()), ("df", T.LongType())]).groupBy("token").agg(F.sum("df").alias("df"))
    return without(sums.filter(F.col("df") >= min_df), stop_words)


def current_size(spark: SparkSession, base: str) -> DataFrame:
    """One row with the number of documents."""
    return _finished(spark, base, "n", [("n_docs", T.LongType())]).agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"))


def current_weights(spark: SparkSession, base: str, kinds: Sequence[tuple[str, T.DataType]], stop_words=None, min_df: int = 2, scheme: str = "unit_log2") -> DataFrame:
    """TF-IDF weights of all documents, equal to those of an index built at once."""
    counts = current_counts(spark, base, kinds)
    return tfidf(counts, current_vocabulary(spark, base, stop_words, min_df), current_size(spark, base), [name for name, _ in kinds], scheme)
