"""Text rules of the catalogue and of order statuses."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import EXPORTED_TAGS, NO_PRICE, UPLOADS_PATH

STATUS_PREFIX = "wc-"


def clean_text(text: Column) -> Column:
    """Line feeds, carriage returns and tabs become spaces. Quotes are the CSV writer's task."""
    return F.translate(text, "\n\r\t", "   ")


def strip_status_all(status: Column) -> Column:
    """Every occurrence of the prefix goes."""
    return F.replace(status, F.lit(STATUS_PREFIX), F.lit(""))


def strip_status_prefix(status: Column) -> Column:
    """Only a leading prefix goes."""
    return F.regexp_replace(status, f"^{STATUS_PREFIX}", "")


def strip_status_substr(status: Column) -> Column:
    """The first three characters go, whatever they are."""
    return F.substr(status, F.lit(4))


def image_url(domain: str, path: Column) -> Column:
    """Null where there is no path."""
    return F.concat(F.lit(f"https://{domain}{UPLOADS_PATH}"), path)


def price_fallback(price: Column, regular_price: Column) -> Column:
    """Text, as stored."""
    return F.coalesce(price, regular_price, F.lit(NO_PRICE))


def product_type(has_buynow: Column, has_30days: Column) -> Column:
    buynow, thirty = EXPORTED_TAGS
    return F.when(has_30days, thirty).when(has_buynow, buynow).otherwise(thirty)


def now_stamp(now: datetime) -> Column:
    """The moment of a run, passed in so that a rerun gives the same rows."""
    return F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
