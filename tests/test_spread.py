"""Rows dealt to all tasks before costly steps."""

from collections import Counter

from pyspark.sql import functions as F

from marketlens.operators.keys import spread
from marketlens.plans import catalogue


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_rows_are_dealt_to_tasks(spark):
    table = spark.range(2_000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v")).coalesce(1)
    dealt = spread(table.unionByName(table).coalesce(1), most=1_000)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) <= 1_000
    assert rows(dealt) == rows(table.unionByName(table))
    assert spread(table.limit(0)).collect() == []


def test_documents_of_a_small_file_are_made_by_several_tasks(spark, tmp_path):
    part = spark.range(3_000).selectExpr(
        "id as p_partkey", "'a b' as p_name", "concat('Brand#', id % 25) as p_brand", "'PROMO' as p_type", "cast(id % 50 as int) as p_size", "1.0D as p_retailprice"
    )
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for brands in (False, True):
        docs = catalogue._product_documents(spark, str(tmp_path), brands)
        assert docs.rdd.getNumPartitions() > 1 and docs.count() == 3_000
    assert docs.columns == ["p_partkey", "brand", "doc"]
