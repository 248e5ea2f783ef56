"""Bind the driver's TPC-H-style tables to the three rental roles.

The jobs were written for raw listings / calendar / reviews CSV dumps.  The
test tables play those roles through fixed projections (the oracle SQL in
``checks/ctes.py`` repeats them); everything is integer arithmetic or
plain text so that Spark and DuckDB build identical values.

calendar <- lineitem   listings <- part   reviews <- documents
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import CALENDAR_RAW, LISTINGS_RAW, REVIEWS_RAW

HOSTS_MODULUS = 400       # host_id = partkey % 400
REVIEW_LISTINGS = 97      # listing_id of a review = doc_id % 97
# Date window of the occupancy panel on the driver data (shipdates 1995-2001).
PANEL_START = "1996-01-01"
PANEL_END = "1999-12-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _conform(df: DataFrame, schema) -> DataFrame:
    """Select the declared columns in order; unbound ones are typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def _thousands(n) -> F.Column:
    return F.format_number(n, 0)


def calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> calendar rows (listing_id, date, 't'/'f'/NULL, '$1,234.56', ...)."""
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 2).cast("long")
    price = F.concat(F.lit("$"), _thousands(F.floor(cents / 100).cast("long")), F.lit("."),
                     F.lpad((cents % 100).cast("string"), 2, "0"))
    return _conform(li.select(
        F.col("l_partkey").cast("string").alias("listing_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_returnflag") == "A", "t").when(F.col("l_returnflag") == "R", "f").alias("available"),
        price.alias("price"),
        F.col("l_linenumber").alias("minimum_nights"),
        F.col("l_quantity").cast("int").alias("maximum_nights"),
    ), CALENDAR_RAW)


def _score(p, null_mod: int, mult: int, span: int, base: int) -> F.Column:
    """Review score in [base/100, (base+span-1)/100], NULL when p % null_mod == 0."""
    return (F.when(p % null_mod == 0, F.lit(None).cast("double"))
            .otherwise(((p * mult) % span + base).cast("double") / 100))


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> listings rows with the 75 declared columns."""
    p = F.col("p_partkey")
    w1 = F.split(F.col("p_name"), " ").getItem(0)
    w2 = F.split(F.col("p_name"), " ").getItem(1)
    cents = F.round(F.col("p_retailprice") * 100).cast("long")
    bath = (F.when(p % 6 == 0, "1 bath").when(p % 6 == 1, "1.5 shared baths")
            .when(p % 6 == 2, "2 private baths").when(p % 6 == 3, "Half-bath")
            .when(p % 6 == 4, "Private half-bath"))
    amen = (F.when(p % 5 == 0, "[]")
            .when(p % 5 == 2, F.concat(F.lit('["'), w1, F.lit('", "'), w2, F.lit('"]')))
            .when(p % 5 == 3, F.concat(F.lit('["'), F.col("p_name"), F.lit('", "Wifi"]')))
            .when(p % 5 == 4, F.concat(F.lit('["'), w1, F.lit(", "), w2, F.lit('", "TV"]'))))
    part = table(spark, sf_dir, "part")
    return _conform(part.select(
        p.cast("string").alias("id"),
        F.concat(F.lit("listing/"), p.cast("string")).alias("listing_url"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_type"), F.lit("<br/>"), F.col("p_name")).alias("description"),
        F.concat(F.col("p_brand"), F.lit("<br />"), F.col("p_type")).alias("neighborhood_overview"),
        (p % HOSTS_MODULUS).cast("string").alias("host_id"),
        F.concat(F.lit("host "), (p % HOSTS_MODULUS).cast("string")).alias("host_name"),
        F.col("p_brand").alias("neighbourhood_cleansed"),
        ((p % 100 + 49200).cast("double") / 1000).cast("float").alias("latitude"),
        ((p % 173 - 123200).cast("double") / 1000).cast("float").alias("longitude"),
        F.col("p_type").alias("property_type"),
        w1.alias("room_type"),
        F.col("p_size").alias("accommodates"),
        ((p % 3) + 1).cast("double").alias("bathrooms"),
        bath.alias("bathrooms_text"),
        F.when(p % 9 == 0, None).otherwise(p % 5 + 1).cast("int").alias("bedrooms"),
        F.when(p % 13 == 0, None).otherwise(p % 4 + 1).cast("int").alias("beds"),
        amen.alias("amenities"),
        F.concat(F.lit("$"), F.floor(cents / 100).cast("long").cast("string"), F.lit("."),
                 F.lpad((cents % 100).cast("string"), 2, "0")).alias("price"),
        (p % 7 + 1).cast("int").alias("minimum_nights"),
        (p % 60 + 30).cast("int").alias("maximum_nights"),
        (p % 3 + 1).cast("int").alias("minimum_minimum_nights"),
        F.lit(365).alias("maximum_maximum_nights"),
        F.when(p % 3 == 0, "t").when(p % 3 == 1, "f").otherwise("x").alias("has_availability"),
        (p % 366).cast("int").alias("availability_365"),
        (p % 50).cast("int").alias("number_of_reviews"),
        _score(p, 11, 7, 201, 300).alias("review_scores_rating"),
        _score(p, 13, 11, 251, 250).alias("review_scores_accuracy"),
        _score(p, 17, 13, 231, 270).alias("review_scores_cleanliness"),
        _score(p, 19, 17, 211, 290).alias("review_scores_checkin"),
        _score(p, 23, 19, 241, 260).alias("review_scores_communication"),
        _score(p, 29, 23, 221, 280).alias("review_scores_location"),
        _score(p, 31, 29, 251, 250).alias("review_scores_value"),
        F.when(p % 7 == 0, F.lit(None).cast("double"))
         .otherwise(((p * 37) % 500).cast("double") / 100).alias("reviews_per_month"),
    ), LISTINGS_RAW)


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> reviews (several per listing, break tags in front of some)."""
    d = F.col("doc_id")
    prefix = (F.when(d % 4 == 1, "<br/>").when(d % 4 == 2, "<br>")
              .when(d % 4 == 3, "<br />").otherwise(""))
    docs = table(spark, sf_dir, "documents")
    return _conform(docs.select(
        (d % REVIEW_LISTINGS).cast("string").alias("listing_id"),
        d.cast("string").alias("id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (d % 300).cast("int")).alias("date"),
        (d % 50).cast("int").alias("reviewer_id"),
        F.concat(F.lit("guest "), (d % 50).cast("string")).alias("reviewer_name"),
        F.concat(prefix, F.col("text")).alias("comments"),
    ), REVIEWS_RAW)


# Lexicon for the driver texts (their prose is synthetic: the words below are
# frequent tokens of the English documents, given polarities so that every
# sentiment category and the strongly negative cut are populated).
FIXTURE_LEXICON = {
    "ble": 0.8, "thing": 0.9, "ing": 0.6, "ly": 0.5, "tion": 0.4, "rewh": 0.7,
    "ed": -0.7, "ha": -0.9, "he": -0.6, "than": -0.8, "then": -1.0, "orre": -0.9,
}
FIXTURE_NEGATORS = ["it"]
FIXTURE_PHRASES = {
    "the and": 0.3, "the the": -0.4, "of the": 0.5, "it was": -0.6, "the and attion": 0.9, "anea eriner thanea": -0.7, "is the is": 0.2,
}
FIXTURE_INTENSIFIERS = {"for": 1.5, "is": 0.5, "the": 1.1, "was": 1.2}
# Stop words for keyword statistics on the driver texts: the most frequent
# function words plus two-letter fragments.
FIXTURE_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is",
    "it", "of", "on", "that", "the", "this", "to", "was", "with",
]
