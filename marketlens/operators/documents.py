"""Raw documents to flat rows, with the rejected documents kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.cleaning import flag
from marketlens.schemas import CORRUPT, MISSING

# Warranty entries that become columns; below, the field names of the crawled documents.
WARRANTY_FIELDS = {
    "warranty_period": "thời_gian_bảo_hành",
    "warranty_type": "hình_thức_bảo_hành",
    "warranty_location": "nơi_bảo_hành",
}


def list_or_empty(values: Column, element: str) -> Column:
    return F.coalesce(values, F.array().cast(f"array<{element}>"))


def attribute_lines(groups: Column) -> Column:
    """All attributes of all groups as "name: value" lines; empty text for no groups."""
    empty = F.array().cast("array<struct<name:string,value:string>>")
    pairs = F.flatten(F.transform(groups, lambda g: F.coalesce(g["attributes"], empty)))
    lines = F.transform(
        pairs,
        lambda a: F.concat(F.coalesce(a["name"], F.lit("")), F.lit(": "), F.coalesce(a["value"], F.lit(""))),
    )
    return F.coalesce(F.array_join(lines, "\n"), F.lit(""))


def all_but_last(names: Column, mark: str = " / ") -> Column:
    """Names joined by ``mark`` without the last one."""
    return F.array_join(F.slice(names, 1, F.greatest(F.size(names) - 1, F.lit(0))), mark)


def last_value(entries: Column, key: str) -> Column:
    """Value of the last entry whose name, lower-cased and with ``_`` for blanks, is ``key``."""
    same = F.filter(entries, lambda e: F.replace(F.lower(e["name"]), F.lit(" "), F.lit("_")) == key)
    return F.try_element_at(same, F.lit(-1))["value"]


def reject_reason() -> Column:
    """Why a product document cannot be used; null when it can.

    An author lacks a field that is missing, not one that is given as null.
    """
    return (
        F.when(F.col(CORRUPT).isNotNull(), "unreadable")
        .when(F.coalesce(F.size("breadcrumbs"), F.lit(0)) <= 0, "no category")
        .when(F.size(MISSING) > 0, F.concat(F.lit("author without "), F.col(MISSING)[0]))
    )


def split_products(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable product documents, and the rest with a ``reason``."""
    judged = documents.withColumn("reason", reject_reason())
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def split_readable(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = documents.withColumn("reason", F.when(F.col(CORRUPT).isNotNull(), "unreadable"))
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")


def product_rows(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The flat columns of product documents, after the columns in ``keep``."""
    tracking = F.col("tracking_info.amplitude")
    seller = F.col("current_seller")
    columns = {
        "product_id": F.col("id"),
        "product_sku": F.col("sku"),
        "product_name": F.col("name"),
        "product_url": F.col("short_url"),
        "images_url": list_or_empty(F.col("images.base_url"), "string"),
        "description": F.col("description"),
        "specifications": attribute_lines(F.col("specifications")),
        "category_id": F.try_element_at("breadcrumbs", F.lit(1))["category_id"],
        "breadcrumbs": all_but_last(F.col("breadcrumbs.name")),
        "original_price": F.col("list_price"),
        "discount": F.col("discount"),
        "price": F.col("price"),
        "discount_rate": F.col("discount_rate"),
        "is_authentic": flag(tracking["is_authentic"]),
        "is_freeship_xtra": flag(tracking["is_freeship_xtra"]),
        "is_top_deal": flag(tracking["is_hero"]),
        "is_top_brand": flag(tracking["is_top_brand"]),
        "return_reason": tracking["return_reason"],
        "inventory_status": F.col("inventory_status"),
        "inventory_type": F.col("inventory_type"),
        "quantity_sold": F.col("all_time_quantity_sold"),
        "day_ago_created": F.col("day_ago_created"),
        "brand_id": F.col("brand.id"),
        "brand_name": F.col("brand.name"),
        "authors": F.transform(
            list_or_empty(F.col("authors"), "struct<id:bigint,name:string>"),
            lambda a: F.struct(a["id"].alias("author_id"), a["name"].alias("author_name")),
        ),
        "rating_average": F.col("rating_average"),
        "review_count": F.col("review_count"),
        "store_id": seller["store_id"],
        "seller_id": seller["id"],
        "seller_sku": seller["sku"],
        "seller_name": seller["name"],
        "seller_url": seller["link"],
        "seller_logo": seller["logo"],
        **{name: last_value(F.col("warranty_info"), key) for name, key in WARRANTY_FIELDS.items()},
    }
    return documents.select(*keep, *[expr.alias(name) for name, expr in columns.items()])


def seller_rows(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    seller = F.col("data.seller")
    renamed = {
        "seller_id": "id",
        "seller_name": "name",
        "icon_url": "icon",
        "store_url": "url",
        "avg_rating_point": "avg_rating_point",
        "review_count": "review_count",
        "total_follower": "total_follower",
        "days_since_joined": "days_since_joined",
        "is_official": "is_official",
        "store_level": "store_level",
    }
    return documents.select(*keep, *[seller[source].alias(name) for name, source in renamed.items()])


def split_comments(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comments of all review pages, one row each; those without a seller are rejected."""
    kept = [c for c in ("path",) if c in documents.columns]
    comments = documents.select(*kept, F.posexplode("data").alias("position", "comment"))
    sold = F.col("comment.seller").isNotNull()
    return comments.filter(sold), comments.filter(~sold).withColumn("reason", F.lit("no seller"))


def review_rows(comments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    c = F.col("comment")
    author = c["created_by"]
    summary = author["contribute_info"]["summary"]
    unknown = author.isNull()
    columns = {
        "review_id": c["id"],
        "product_id": c["product_id"],
        "seller_id": c["seller"]["id"],
        "title": c["title"],
        "content": c["content"],
        "status": c["status"],
        "thank_count": c["thank_count"],
        "rating": c["rating"],
        "created_at": c["created_at"],
        "customer_id": c["customer_id"],
        "customer_name": author["full_name"],
        "purchased_at": author["purchased_at"],
        "avatar_url": author["avatar_url"],
        "joined_time": summary["joined_time"],
        "total_review": F.when(unknown, 0).otherwise(summary["total_review"]),
        "total_thank": F.when(unknown, 0).otherwise(summary["total_thank"]),
    }
    return comments.select(*keep, *[expr.alias(name) for name, expr in columns.items()])


def listing_rows(pages: DataFrame, category_id: Column, slug: Column) -> DataFrame:
    """Candidates of category listing pages: one row per product offer."""
    return pages.select(F.explode("data").alias("offer"), category_id.alias("category_id"), slug.alias("slug")).select(
        F.col("offer.id").alias("pid"),
        F.col("offer.seller_product_id").alias("spid"),
        F.col("offer.seller_id").alias("seller_id"),
        "category_id",
        "slug",
    )
