"""Normalised tables out of the cleaned ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.keys import keep_one, keep_one_complete

# The columns of the normalised tables.
PRODUCT_COLUMNS = [
    "category_id", "product_id", "seller_id", "brand_id", "product_name", "description",
    "specifications", "breadcrumbs", "original_price", "discount", "price", "discount_rate",
    "quantity_sold", "rating_average", "review_count", "day_ago_created", "product_url",
    "is_authentic", "is_freeship_xtra", "is_top_deal", "return_reason", "inventory_type",
    "warranty_period", "warranty_type", "warranty_location",
]
USER_COLUMNS = [
    "customer_id", "customer_name", "avatar_url", "joined_day", "joined_time", "total_review",
    "total_thank",
]


def gold_products(silver: DataFrame) -> DataFrame:
    return silver.select(*PRODUCT_COLUMNS)


def gold_images(silver: DataFrame) -> DataFrame:
    """One row per picture; repeats stay and are dropped by the load."""
    return silver.select("product_id", "seller_id", F.explode("images_url").alias("image_url"))


def _authors(silver: DataFrame) -> DataFrame:
    return silver.select("product_id", "seller_id", F.explode("authors").alias("author"))


def gold_authors(silver: DataFrame) -> DataFrame:
    return keep_one_complete(_authors(silver).select("author.author_id", "author.author_name"), ["author_id"])


def gold_products_authors(silver: DataFrame) -> DataFrame:
    return _authors(silver).select("product_id", "seller_id", "author.author_id").distinct()


def gold_brands(silver: DataFrame) -> DataFrame:
    return keep_one_complete(silver.select("brand_id", "brand_name"), ["brand_id"])


def gold_users(silver: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """One row per customer; ``order`` may use any silver column and picks the row kept."""
    kept = keep_one(silver, ["customer_id"], order) if order else keep_one(silver.select(*USER_COLUMNS), ["customer_id"])
    return kept.select(*USER_COLUMNS).withColumnsRenamed({"customer_id": "user_id", "customer_name": "user_name"})


def gold_reviews(silver: DataFrame) -> DataFrame:
    """Review rows with the customer key only. The cleaned table already has unique reviews."""
    return silver.drop(*USER_COLUMNS[1:])


def normalise(products: DataFrame, reviews: DataFrame) -> dict[str, DataFrame]:
    """All normalised tables. Pass stored cleaned tables, so that each is read and not rebuilt."""
    return {
        "products": gold_products(products),
        "images_url": gold_images(products),
        "authors": gold_authors(products),
        "products_authors": gold_products_authors(products),
        "brands": gold_brands(products),
        "users": gold_users(reviews),
        "reviews": gold_reviews(reviews),
    }
