"""Tables partitioned by a bucket of their key, upserted by Spark's dynamic partition overwrite.

The partitions that a batch touches are merged with it into a staging folder of the batch and then put in place. If
that second step is cut off, the repeated batch finds its staged partitions and puts them in place again, so rows are
neither lost nor applied twice. A table has one writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.load import upsert
from marketlens.session import staged
from marketlens.sources.files import partition_folders, path_exists

BUCKET = "_bucket"


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_partitions(source: DataFrame, path: str, keys: Sequence[str], buckets: int, load: str) -> None:
    """Upsert ``source``, which holds each key once and no null key, into the table at ``path``.

    ``buckets`` is the table's own for good: some hundred MB of rows to a bucket keep a merge in memory. ``load``
    names the batch; a batch that is repeated must have the same name. An empty batch changes nothing, and the columns
    are those of the first one.
    """
    spark, stage = source.sparkSession, f"{path}-staged/{load}"
    if not path_exists(spark, f"{stage}/_SUCCESS"):
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        fresh = staged(source.withColumn(BUCKET, bucket), "fresh")
        merged = fresh
        if _has_rows(spark, path):
            # One number per bucket at most.
            touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
            merged = upsert(spark.read.parquet(path).filter(F.col(BUCKET).isin(touched)), fresh, keys)
        merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(stage)
    if _has_rows(spark, stage):
        spark.read.parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    _drop_others(spark, f"{path}-staged", load)


def _has_rows(spark: SparkSession, folder: str) -> bool:
    return bool(partition_folders(spark, folder))


def _drop_others(spark: SparkSession, folder: str, load: str) -> None:
    """Staged partitions of earlier batches, which are in place and can no longer be repeated."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        if status.getPath().getName() != load:
            fs.delete(status.getPath(), True)
