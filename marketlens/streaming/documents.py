"""Crawled documents as a stream: each drop is parsed, sorted out, cleaned and loaded into several tables.

A batch is loaded under its own name into every table, parents first, so a batch that is repeated after a
failure loads the tables that are still missing and no table twice. Documents that cannot be used are kept with
their path and reason, rows that a table refuses are kept by the load.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import documents as D
from marketlens.operators.keys import keep_one, keyed
from marketlens.operators.load import apply_defaults
from marketlens.plans import gold, silver
from marketlens.plans.warehouse import load_warehouse
from marketlens.schemas import WAREHOUSE
from marketlens.session import staged
from marketlens.sources.files import parse_documents
from marketlens.streaming.incremental import read_refused, refuse, run_available


def product_tables(rows: DataFrame) -> Mapping[str, DataFrame]:
    """The tables that flat product rows fill; what the documents do not say of a seller has its default."""
    sellers = rows.select("seller_id", "seller_name", F.col("seller_logo").alias("icon_url"), F.col("seller_url").alias("store_url"))
    spec = WAREHOUSE["sellers"]
    missing = {c.name: F.lit(None).cast(c.type) for c in spec.columns if c.name not in sellers.columns}
    titles = rows.select("category_id", F.split("breadcrumbs", " / ")[0].alias("title"), F.lit(None).cast("string").alias("slug"))
    clean = staged(silver.clean_products(rows), "clean-products")
    return {
        "categories": keep_one(titles.filter("category_id IS NOT NULL"), ["category_id"]),
        "sellers": apply_defaults(silver.silver_sellers(sellers).withColumns(missing), spec),
        "brands": gold.gold_brands(clean),
        "authors": gold.gold_authors(clean),
        "products": gold.gold_products(clean),
        "products_authors": gold.gold_products_authors(clean),
        "images_url": gold.gold_images(clean),
    }


def product_batches(base: str, stream: str) -> Callable[[DataFrame, int], None]:
    """Batch handler for (path, value) rows of product documents, loading the warehouse at ``base``.

    Of documents with equal keys in a batch the first in order of path and text stays; a later batch replaces
    the products of earlier ones.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        load = f"{stream}-{batch_id}"
        parsed = staged(parse_documents(batch.withColumn("doc", F.col("value")), "value", "products"), "drop")
        good, bad = D.split_products(parsed)
        refuse(bad.select("path", "reason"), f"{base}-refused", load)
        rows = D.product_rows(good, ["path", "doc"])
        whole, lacking = keyed(rows, silver.PRODUCT_KEYS)
        chosen = keep_one(whole, silver.PRODUCT_KEYS, [F.col("path"), F.col("doc")]).unionByName(lacking)
        load_warehouse(product_tables(staged(chosen.drop("path", "doc"), "drop-products")), base, load)

    return run


def load_products(spark: SparkSession, root: str, base: str, checkpoint: str, stream: str = "products") -> None:
    """Loads all product documents that are new below ``root``, one in each line of its files."""
    run_available(spark, root, "value string", product_batches(base, stream), checkpoint, "text", recursiveFileLookup="true", with_path="path")


def refused_documents(spark: SparkSession, base: str) -> DataFrame:
    """(path, reason, load) of the documents that could not be used."""
    return read_refused(spark, base, spark.createDataFrame([], "path string, reason string").schema)
