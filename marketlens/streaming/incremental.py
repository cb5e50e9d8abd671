"""Incremental loads: every file once, known keys skipped, batches upserted.

Rows without a whole key are neither new nor known, so they are refused and kept under the name of their
batch, where a repeated batch replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.keys import append_rows, keep_one, keyed, unknown
from marketlens.session import staged
from marketlens.sources.files import path_exists
from marketlens.sources.partitioned import upsert_partitions
from marketlens.sources.versions import BUCKETS, is_loaded, publish_upsert


def run_available(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    fmt: str = "json",
    files_per_batch: int | None = None,
    with_path: str | None = None,
    **options: str,
) -> None:
    """Hand all files that are new since the last run to ``handle``, then stop.

    ``with_path`` names a column for the file that a row comes from.
    """
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(root)
    if with_path:
        rows = rows.select("*", F.col("_metadata.file_path").alias(with_path))
    query = (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def refuse(rows: DataFrame, folder: str, load: str) -> None:
    """Keeps ``rows`` in place of those that the same load has refused before."""
    rows.write.mode("overwrite").parquet(f"{folder}/load={load}")


def read_refused(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Rows that the handlers of the table or tracking folder ``base`` have refused, with their load."""
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    if not path_exists(spark, f"{base}-refused"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(f"{base}-refused")


def read_tracking(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Keys of all batches so far with the load that took them and their bucket; empty before the first."""
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType()), T.StructField("bucket", T.IntegerType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def new_keys_only(
    tracking: str,
    keys: Sequence[str],
    handle: Callable[[DataFrame, int], None],
    order: Sequence[Column],
    stream: str,
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """Batch handler that passes on one row per unseen key, the first in ``order``, and records those keys.

    The keys of a batch are recorded under ``stream`` (a name that no other source of the same tracking
    folder has) and the batch, so a repeated batch replaces its own record and its keys are not taken
    for known ones. They are bucketed by hash, and a batch reads the buckets of its own keys only.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load = f"{stream}-{batch_id}"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        whole, lacking = keyed(batch, keys)
        refuse(lacking, f"{tracking}-refused", load)
        first = staged(keep_one(whole, keys, order).withColumn("_bucket", bucket), "batch")
        touched = [r[0] for r in first.select("_bucket").distinct().collect()]
        seen = read_tracking(spark, tracking, batch.select(*keys).schema)
        seen = seen.filter((F.col("load") != load) & F.col("bucket").isin(touched)).select(*keys)
        fresh = staged(unknown(first.drop("_bucket"), seen, keys, unique=True), "fresh")
        handle(fresh, batch_id)
        recorded = fresh.select(*keys, bucket.alias("bucket"))
        recorded.write.mode("overwrite").partitionBy("bucket").parquet(f"{tracking}/load={load}")

    return run


def new_keys_stored(spark: SparkSession, root: str, schema: T.StructType | str, keys: Sequence[str], out: str, checkpoint: str, fmt: str = "json", **options: str) -> None:
    """Adds the rows of files that are new since the last run to ``out``, one for each key never seen before, then stops.

    The keys known so far are kept by Spark in the state store of the checkpoint, partitioned by key, so a batch
    reads no older key from a table, and a restarted run goes on where the last one stopped. Of several rows of
    a new key in one batch any is taken: they should agree in what is kept. Rows without a whole key are left out.
    """
    rows = spark.readStream.schema(schema).format(fmt).options(**options).load(root)
    first = keyed(rows, keys)[0].dropDuplicates(list(keys))
    query = first.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination()


def track(tracking: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Candidates not tracked yet, each whole key once, and the tracking table with them added."""
    fresh = keep_one(unknown(keyed(candidates, keys)[0], tracking, keys, unique=True), keys)
    return fresh, append_rows(tracking, fresh.select(*tracking.columns))


def upsert_batches(base: str, keys: Sequence[str], order: Sequence[Column], stream: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that upserts the first row per key in ``order`` into the table at ``base``.

    A batch already published is skipped, so a restart does not apply it twice. ``stream`` names the
    source: batches of different sources have the same numbers, and so has a renewed checkpoint.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        tag = f"{stream}-{batch_id}"
        if not is_loaded(batch.sparkSession, base, tag):
            whole, lacking = keyed(batch, keys)
            refuse(lacking, f"{base}-refused", tag)
            publish_upsert(keep_one(whole, keys, order), base, keys, tag)

    return run


def upsert_partition_batches(path: str, keys: Sequence[str], order: Sequence[Column], buckets: int) -> Callable[[DataFrame, int], None]:
    """Batch handler that upserts the first row per key in ``order`` into the partitioned table at ``path``.

    The checkpoint says which batch is next, so only the last one can come again, and it replaces its own work.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        whole, lacking = keyed(batch, keys)
        refuse(lacking, f"{path}-refused", str(batch_id))
        upsert_partitions(keep_one(whole, keys, order), path, keys, buckets, str(batch_id))

    return run
