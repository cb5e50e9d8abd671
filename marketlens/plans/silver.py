"""Cleaned tables: one row per key, defaults in place of nulls, known parents only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import cleaning as C
from marketlens.operators.keys import existing, keep_one

PRODUCT_KEYS = ["product_id", "seller_id"]

# The columns of the cleaned tables.
PRODUCT_COLUMNS = [
    "product_id", "product_sku", "product_name", "product_url", "images_url", "description",
    "specifications", "category_id", "breadcrumbs", "original_price", "discount", "price",
    "discount_rate", "is_authentic", "is_freeship_xtra", "is_top_deal", "is_top_brand",
    "return_reason", "inventory_status", "inventory_type", "quantity_sold", "day_ago_created",
    "brand_id", "brand_name", "authors", "rating_average", "review_count", "store_id",
    "seller_id", "seller_sku", "seller_name", "seller_url", "seller_logo", "warranty_period",
    "warranty_type", "warranty_location",
]
REVIEW_COLUMNS = [
    "review_id", "product_id", "seller_id", "title", "content", "status", "thank_count",
    "rating", "created_at", "customer_id", "customer_name", "purchased_at", "avatar_url",
    "joined_time", "total_review", "total_thank", "joined_day",
]


def silver_sellers(sellers: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    named = sellers.filter(F.col("seller_id").isNotNull() & (F.col("seller_id") != 0))
    return keep_one(named, ["seller_id"], order)


def silver_products(products: DataFrame, sellers: DataFrame, order: Sequence[Column] = (), unique: bool = False) -> DataFrame:
    """Products of known sellers. The seller test drops whole keys, so it can come first.

    ``unique`` says that ``products`` holds each key once, so that no wide row is sorted for it.
    """
    known = existing(products, sellers, ["seller_id"], unique=True)
    return clean_products(known if unique else keep_one(known, PRODUCT_KEYS, order)).select(*PRODUCT_COLUMNS)


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {
            "brand_id": C.number_or(F.col("brand_id"), C.NO_BRAND_ID),
            "brand_name": C.text_or(F.col("brand_name"), C.NO_BRAND_NAME),
            "warranty_period": C.warranty_days(F.col("warranty_period")),
            "warranty_type": C.warranty_text(F.col("warranty_type")),
            "warranty_location": C.warranty_text(F.col("warranty_location")),
            "return_reason": C.return_label(F.col("return_reason")),
        }
    ).na.fill(0, ["quantity_sold"])


def silver_reviews(reviews: DataFrame, products: DataFrame, order: Sequence[Column] = (), unique: bool = False) -> DataFrame:
    """Reviews of known products, one row per review; ``unique`` says that each review id occurs once."""
    known = existing(reviews, products, PRODUCT_KEYS, unique=True)
    return clean_reviews(known if unique else keep_one(known, ["review_id"], order)).select(*REVIEW_COLUMNS)


def clean_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.withColumns(
        {
            "created_at": C.epoch_timestamp(F.col("created_at")),
            "purchased_at": C.epoch_timestamp(F.col("purchased_at")),
            "joined_day": C.joined_days(F.col("joined_time")),
            "total_review": C.number_or(F.col("total_review"), 0),
            "total_thank": C.number_or(F.col("total_thank"), 0),
        }
    )
