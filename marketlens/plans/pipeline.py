"""Raw documents to a loaded warehouse, each stage written once and read back."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marketlens.operators import documents as D
from marketlens.operators.profile import counted_write
from marketlens.plans import gold, silver
from marketlens.plans.warehouse import load_warehouse
from marketlens.schemas import CATEGORIES_CSV
from marketlens.session import staged
from marketlens.sources import files


def run(spark: SparkSession, bronze: str, lake: str, tag: str = "full", schema: str = "shop") -> dict[str, int]:
    """Build silver, gold and the warehouse below ``lake``; return the row count of each table.

    ``bronze`` holds the product, seller and review documents and ``categories.csv``.
    """
    counts: dict[str, int] = {}

    def store(layer: str, name: str, df):
        path = files.table_path(lake, layer, schema, f"{layer}_{name}")
        counts[f"{layer}.{name}"] = counted_write(df, lambda out: files.write_table(out, path))
        return files.read_table(spark, path)

    def parsed(kind: str):
        """The documents of a kind, read and parsed once."""
        return staged(files.scan_documents(spark, bronze, kind), kind)

    good_sellers, bad_sellers = D.split_readable(parsed("sellers"))
    good_products, bad_products = D.split_products(parsed("products"))
    good_pages, bad_pages = D.split_readable(parsed("reviews"))
    comments, lost_comments = D.split_comments(good_pages)

    rejects = None
    for bad in (bad_sellers, bad_products, bad_pages, lost_comments):
        rows = bad.select("path", "reason")
        rejects = rows if rejects is None else rejects.unionByName(rows)
    store("bronze", "rejects", rejects)

    # Of documents with equal keys the first path stays, of comments the first place in it.
    by_path = [F.col("path")]
    seller_rows = D.seller_rows(good_sellers, ["path"])
    sellers = store("silver", "sellers", silver.silver_sellers(seller_rows, by_path).drop("path"))
    products = store("silver", "products", silver.silver_products(D.product_rows(good_products, ["path"]), sellers, by_path))
    review_rows = D.review_rows(comments, ["path", "position"])
    reviews = store("silver", "reviews", silver.silver_reviews(review_rows, products, [*by_path, F.col("position")]))
    categories = store("silver", "categories", files.read_csv(spark, f"{bronze}/categories.csv", CATEGORIES_CSV))

    tables = {name: store("gold", name, df) for name, df in gold.normalise(products, reviews).items()}
    tables |= {"sellers": sellers, "categories": categories.filter(F.col("category_id").isNotNull())}
    load_warehouse(tables, f"{lake}/warehouse", tag)
    return counts
