"""Null defaults, label mapping, durations in days and epoch conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlens.schemas import NO_WARRANTY

# Labels the catalogue shows for each return policy.
RETURN_LABELS = {
    "any_reason": "Bất cứ lý do gì",
    "defective_product": "Sản phẩm hư hỏng",
    "no_return": "Không đổi trả",
}
# What stands for no brand, and the days of a lifetime warranty.
NO_BRAND_ID = 0
NO_BRAND_NAME = "No Brand"
LIFETIME_DAYS = 36500


def strip(text: Column) -> Column:
    """Trim every Unicode space, not just the ASCII blank."""
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def number_or(value: Column, default: int) -> Column:
    return F.coalesce(value, F.lit(default))


def text_or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def return_label(reason: Column) -> Column:
    label = F.when(reason.isNull(), RETURN_LABELS["no_return"])
    for code, text in RETURN_LABELS.items():
        label = label.when(reason == code, text)
    return label.otherwise(reason)


def warranty_text(value: Column) -> Column:
    return text_or(value, NO_WARRANTY)


def _days(text: Column, units: str, factor: int, gap: str = r"\s*") -> Column:
    """Days of the first ``<number><gap><unit>``; null when the text has none or the days exceed an int."""
    return F.try_multiply(F.regexp_extract(text, rf"(\d+){gap}({units})", 1).try_cast("int"), F.lit(factor))


def warranty_days(text: Column, strict_zero: bool = True) -> Column:
    """Length of a warranty phrase in days; 0 when it names none.

    With ``strict_zero`` any digit 0 in the phrase means "no warranty", so "10 tháng" is 0.
    """
    phrase = F.lower(strip(text))
    refused = "không|no warranty|0" if strict_zero else r"không|no warranty|(?<!\d)0(?!\d)"
    return (
        F.when(phrase.contains("trọn đời"), F.lit(LIFETIME_DAYS))
        .when(phrase.rlike(refused), F.lit(0))
        .otherwise(
            F.coalesce(
                _days(phrase, "năm|year", 365),
                _days(phrase, "tháng|month", 30),
                _days(phrase, "ngày|day", 1),
                F.lit(0),
            )
        )
    )


def joined_days(text: Column) -> Column:
    """Days of the first "<number> năm|tháng|ngày"; the blank is needed and case matters."""
    unit = F.regexp_extract(text, r"(\d+)\s+(năm|tháng|ngày)", 2)
    factor = F.when(unit == "năm", 365).when(unit == "tháng", 30).when(unit == "ngày", 1)
    return F.coalesce(
        F.try_multiply(F.regexp_extract(text, r"(\d+)\s+(năm|tháng|ngày)", 1).try_cast("int"), factor), F.lit(0)
    )


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds to timestamp; null stays null."""
    return F.timestamp_seconds(seconds)


def flag(text: Column) -> Column:
    """Boolean out of true/false or 1/0 text."""
    return F.lower(text).isin("true", "1")
