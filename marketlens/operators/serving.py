"""Look-ups and the data behind a product page, for all products in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import display as X
from marketlens.operators.keys import top_per_key

ITEM = ["product_id", "seller_id"]


def find(df: DataFrame, **values) -> DataFrame:
    """Rows equal to every given value."""
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def recent_purchases(reviews: DataFrame, n: int = 5, rank: str | None = None) -> DataFrame:
    """The last ``n`` purchases of every customer."""
    order = [F.desc_nulls_last("purchased_at"), F.col("review_id")]
    return top_per_key(reviews, ["customer_id"], order, n, rank)


def product_cards(products: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Card texts per product; with ``images``, also its first thumbnail."""
    cards = products.select(
        *ITEM,
        X.trail(F.col("breadcrumbs")).alias("trail"),
        X.short_name(F.col("product_name")).alias("short_name"),
        X.stars(F.col("rating_average")).alias("stars"),
        X.thousands(F.col("price")).alias("price_text"),
        X.discount_badge(F.col("discount_rate")).alias("discount_badge"),
        F.when(F.col("discount_rate") > 0, X.thousands(F.col("original_price"))).otherwise(F.lit("")).alias("old_price_text"),
        X.without_images(F.col("description")).alias("description"),
    )
    if images is None:
        return cards
    first = images.groupBy(*ITEM).agg(F.min("image_url").alias("image_url"))
    thumbs = first.select(*ITEM, X.image_url(F.col("image_url"), "thumbnail").alias("thumbnail"))
    return cards.join(thumbs, ITEM, "left")


def makers(products: DataFrame, products_authors: DataFrame, authors: DataFrame, brands: DataFrame, mark: str = ",") -> DataFrame:
    """Label and names of the authors of every product, or of its brand when it has none.

    A product with neither gets empty texts. The authors of one product are collected, which
    its own author list bounds.
    """
    written = (
        products_authors.join(authors, "author_id")
        .groupBy(*ITEM)
        .agg(F.array_join(F.sort_array(F.collect_list("author_name")), mark).alias("author_names"))
    )
    labelled = products.select(*ITEM, "brand_id").join(brands, "brand_id", "left").join(written, ITEM, "left")
    has_author, has_brand = F.col("author_names").isNotNull(), F.col("brand_name").isNotNull()
    return labelled.select(
        *ITEM,
        F.when(has_author, X.AUTHOR_LABEL).when(has_brand, X.BRAND_LABEL).otherwise("").alias("label"),
        F.coalesce("author_names", "brand_name", F.lit("")).alias("names"),
    )


def quantity_by_category(products: DataFrame, categories: DataFrame, limit: int | None = None) -> DataFrame:
    """Quantity sold per category title, largest first, as thousands-separated text.

    Quantities are summed per category before the titles are looked up.
    """
    sums = products.groupBy("category_id").agg(F.sum("quantity_sold").alias("quantity"))
    titled = sums.join(categories.select("category_id", "title"), "category_id")
    ranked = titled.groupBy("title").agg(F.sum("quantity").alias("quantity")).orderBy(F.desc("quantity"), "title")
    shown = ranked.limit(limit) if limit else ranked
    return shown.select("title", X.thousands(F.col("quantity")).alias("total_quantity_sold"))


def sql_view(df: DataFrame, name: str, text: str, **args) -> DataFrame:
    """Run parameterised SQL over ``df`` registered as ``name``."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(text, args=args or None)
