"""Cleaning jobs for the three raw tables (listings, calendar, reviews)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions import text as T
from ..operators.clean import dedup, drop_columns, filter_not_null
from ..sources.schemas import LISTINGS_DROPPED

LISTING_TEXT_COLUMNS = ["name", "description", "neighborhood_overview", "amenities"]


def clean_listings(raw: DataFrame, *, thousands: bool = False) -> DataFrame:
    """42 columns dropped, id/host_id required, one row per (id, host_id),
    price parsed to float, availability flag to boolean, break tags removed."""
    df = drop_columns(raw, LISTINGS_DROPPED)
    df = filter_not_null(df, ["id", "host_id"])
    df = dedup(df, ["id", "host_id"])
    money = P.parse_money_thousands if thousands else P.parse_money
    return df.withColumns({
        "price": money("price"),
        "has_availability": P.parse_flag("has_availability"),
        **{c: P.strip_breaks(c) for c in LISTING_TEXT_COLUMNS},
    })


def clean_calendar(raw: DataFrame, *, thousands: bool = False) -> DataFrame:
    """Key columns required, availability to boolean, price to float, one row
    per (listing_id, date)."""
    df = drop_columns(raw, ["adjusted_price"])
    df = filter_not_null(df, ["listing_id", "date"])
    money = P.parse_money_thousands if thousands else P.parse_money
    df = df.withColumns({"available": P.parse_flag("available"), "price": money("price")})
    return dedup(df, ["listing_id", "date"])


def _price_counts(thousands: bool):
    money = P.parse_money_thousands if thousands else P.parse_money
    return [F.count("price").alias("prices"),
            F.count(F.when(F.col("price").isNotNull() & money("price").isNull(), 1)).alias("rejected")]


def rejected_prices(raw: DataFrame, *, thousands: bool = False) -> DataFrame:
    """One row: how many price texts there are and how many do not parse.

    Without ``thousands`` a price with a thousands comma does not parse, its
    night has no price and the panel drops it, so jobs report this number.
    """
    return raw.agg(*_price_counts(thousands))


def observed_prices(raw: DataFrame, *, thousands: bool = False) -> tuple[DataFrame, Observation]:
    """``raw``, and the numbers of :func:`rejected_prices`, which are counted while something
    made of it is written (``get`` has them then): no pass of their own over the file. To be done
    in a session of its own (see :mod:`hostlens.jobs`)."""
    seen = Observation("prices")
    return raw.observe(seen, *_price_counts(thousands)), seen


def english_reviews(raw: DataFrame, marker_pattern: str = T.DEFAULT_MARKER_PATTERN,
                    accent_class: str = T.ACCENT_CLASS) -> DataFrame:
    """Reviews with ids and an English comment (see :func:`text.is_english`)."""
    return raw.where(F.col("listing_id").isNotNull() & F.col("id").isNotNull()
                     & T.is_english(F.col("comments"), marker_pattern, accent_class))


def clean_reviews(raw: DataFrame) -> DataFrame:
    """English reviews only, one row per review id, break tags removed."""
    df = dedup(english_reviews(raw), ["id"])
    return df.withColumn("comments", P.strip_breaks("comments"))
