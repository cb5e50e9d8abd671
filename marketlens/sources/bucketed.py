"""Tables bucketed by their key, so that joins and existence tests on it move neither side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Stores ``df`` at ``path`` as the catalogue table ``name``, in ``buckets`` files sorted by ``keys``.

    Rows are dealt to their buckets by one shuffle here, which every later join on ``keys`` with a table of equally
    many buckets spares. Names of key columns may differ between tables, their types and order may not.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    dealt.write.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Takes ``name`` out of the catalogue; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
