"""Explicit schemas (as DDL text) of the raw documents and declared specs of the warehouse tables.

The raw schemas carry the field names of the crawled documents, the specs carry the column
names, types, keys and defaults of the warehouse; both are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

CORRUPT = "_corrupt_record"
UNREAD = "_unread"  # paths of values that are given but do not convert
MISSING = "_missing"  # fields that some element of the kind's array of named things lacks

# Flags arrive as true/false or 0/1, so they are read as text and cast later.
PRODUCT_DOC = """
    id bigint, sku string, name string, short_url string, description string,
    images array<struct<base_url:string>>,
    specifications array<struct<attributes:array<struct<name:string,value:string>>>>,
    breadcrumbs array<struct<category_id:bigint,name:string>>,
    list_price decimal(15,2), discount decimal(15,2), price decimal(15,2), discount_rate double,
    tracking_info struct<amplitude:struct<is_authentic:string,is_freeship_xtra:string,
        is_hero:string,is_top_brand:string,return_reason:string>>,
    inventory_status string, inventory_type string,
    all_time_quantity_sold bigint, day_ago_created bigint,
    brand struct<id:bigint,name:string>,
    authors array<struct<id:bigint,name:string>>,
    rating_average double, review_count bigint,
    current_seller struct<store_id:bigint,id:bigint,sku:string,name:string,link:string,logo:string>,
    warranty_info array<struct<name:string,value:string>>
"""

SELLER_DOC = """
    data struct<seller:struct<id:bigint,name:string,icon:string,url:string,
        avg_rating_point:double,review_count:bigint,total_follower:bigint,
        days_since_joined:bigint,is_official:boolean,store_level:string>>
"""

REVIEW_DOC = """
    data array<struct<id:bigint,product_id:bigint,seller:struct<id:bigint>,title:string,
        content:string,status:string,thank_count:bigint,rating:double,created_at:bigint,
        customer_id:bigint,
        created_by:struct<full_name:string,purchased_at:bigint,avatar_url:string,
            contribute_info:struct<summary:struct<joined_time:string,total_review:bigint,
                total_thank:bigint>>>>>
"""

LISTING_DOC = "data array<struct<id:bigint,seller_product_id:bigint,seller_id:bigint>>"

CATEGORIES_CSV = "title string, slug string, category_id bigint"
TRACKING_CSV = "pid bigint, spid bigint, seller_id bigint, category_id bigint, slug string"

DOCUMENT_KINDS = {
    "products": ("product*.json*", PRODUCT_DOC),
    "sellers": ("seller*.json*", SELLER_DOC),
    "reviews": ("reviews*.json*", REVIEW_DOC),
}


# Arrays whose elements must have these fields.
NAMED_THINGS = {"products": ("authors", ["id", "name"])}


@dataclass(frozen=True)
class Column:
    """One warehouse column: Spark type, optional text length, nullability and default."""

    name: str
    type: str
    length: int | None = None
    required: bool = False
    default: str | int | float | bool | None = None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...]
    foreign_keys: tuple[ForeignKey, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _id(name: str, required: bool = False) -> Column:
    return Column(name, "string", 64, required)


NO_WARRANTY = "Không bảo hành"

WAREHOUSE = {
    spec.name: spec
    for spec in (
        TableSpec(
            "categories",
            (_id("category_id"), Column("title", "string", 64), Column("slug", "string", 64)),
            ("category_id",),
        ),
        TableSpec(
            "sellers",
            (
                _id("seller_id"),
                Column("seller_name", "string", 255),
                Column("icon_url", "string"),
                Column("store_url", "string"),
                Column("avg_rating_point", "decimal(4,3)", default=0),
                Column("review_count", "int", default=0),
                Column("total_follower", "int", default=0),
                Column("days_since_joined", "int", default=0),
                Column("is_official", "boolean", default=False),
                Column("store_level", "string", 32, default="NONE"),
            ),
            ("seller_id",),
        ),
        TableSpec("brands", (_id("brand_id"), Column("brand_name", "string", 255)), ("brand_id",)),
        TableSpec("authors", (_id("author_id"), Column("author_name", "string", 255)), ("author_id",)),
        TableSpec(
            "users",
            (
                _id("user_id"),
                Column("user_name", "string"),
                Column("avatar_url", "string"),
                Column("joined_day", "int"),
                Column("joined_time", "string"),
                Column("total_review", "int"),
                Column("total_thank", "int"),
            ),
            ("user_id",),
        ),
        TableSpec(
            "products",
            (
                _id("product_id", True),
                _id("seller_id", True),
                _id("category_id"),
                _id("brand_id"),
                Column("product_name", "string"),
                Column("description", "string"),
                Column("specifications", "string"),
                Column("breadcrumbs", "string"),
                Column("original_price", "decimal(15,2)"),
                Column("discount", "decimal(15,2)", default=0),
                Column("price", "decimal(15,2)"),
                Column("discount_rate", "int", default=0),
                Column("quantity_sold", "int", default=0),
                Column("rating_average", "decimal(2,1)", default=0.0),
                Column("review_count", "int", default=0),
                Column("day_ago_created", "int"),
                Column("product_url", "string"),
                Column("is_authentic", "boolean", default=False),
                Column("is_freeship_xtra", "boolean", default=False),
                Column("is_top_deal", "boolean", default=False),
                Column("return_reason", "string", 32, default="no_return"),
                Column("inventory_type", "string", 32),
                Column("warranty_period", "int", default=0),
                Column("warranty_type", "string", 100, default=NO_WARRANTY),
                Column("warranty_location", "string", 100, default=NO_WARRANTY),
            ),
            ("product_id", "seller_id"),
            (
                ForeignKey(("category_id",), "categories", ("category_id",)),
                ForeignKey(("seller_id",), "sellers", ("seller_id",)),
                ForeignKey(("brand_id",), "brands", ("brand_id",)),
            ),
        ),
        TableSpec(
            "products_authors",
            (_id("product_id", True), _id("seller_id", True), _id("author_id", True)),
            ("product_id", "seller_id", "author_id"),
            (
                ForeignKey(("product_id", "seller_id"), "products", ("product_id", "seller_id")),
                ForeignKey(("author_id",), "authors", ("author_id",)),
            ),
        ),
        TableSpec(
            "images_url",
            (_id("product_id", True), _id("seller_id", True), Column("image_url", "string", required=True)),
            ("product_id", "seller_id", "image_url"),
            (ForeignKey(("product_id", "seller_id"), "products", ("product_id", "seller_id")),),
        ),
        TableSpec(
            "reviews",
            (
                _id("review_id"),
                _id("product_id", True),
                _id("seller_id", True),
                _id("customer_id", True),
                Column("title", "string"),
                Column("content", "string"),
                Column("thank_count", "int", default=0),
                Column("rating", "decimal(2,1)"),
                Column("created_at", "timestamp"),
                Column("purchased_at", "timestamp"),
            ),
            ("review_id",),
            (
                ForeignKey(("product_id", "seller_id"), "products", ("product_id", "seller_id")),
                ForeignKey(("customer_id",), "users", ("user_id",)),
            ),
        ),
    )
}

# Parents come before children, so foreign keys hold after every step.
LOAD_ORDER = tuple(WAREHOUSE)
