"""Declared input schemas of the three raw CSV tables.

Fixed values: column names, types and order must equal the CSV headers the
jobs were written for (positional CSV with a header row).
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, FloatType,
                               IntegerType, StringType, StructField, StructType)

_TYPES = {"STRING": StringType(), "INT": IntegerType(), "DATE": DateType(),
          "FLOAT": FloatType(), "DOUBLE": DoubleType(), "BOOLEAN": BooleanType()}


def _struct(ddl: str) -> StructType:
    """``"a STRING, b INT"`` -> StructType (all fields nullable)."""
    fields = []
    for item in ddl.split(","):
        name, typ = item.split()
        fields.append(StructField(name, _TYPES[typ], True))
    return StructType(fields)

# --- fixed values: raw listings schema (75 columns, file order) -------------
LISTINGS_RAW_DDL = """
id STRING, listing_url STRING, scrape_id INT, last_scraped DATE, source STRING,
name STRING, description STRING, neighborhood_overview STRING, picture_url STRING,
host_id STRING, host_url STRING, host_name STRING, host_since DATE,
host_location STRING, host_about STRING, host_response_time STRING,
host_response_rate STRING, host_acceptance_rate STRING, host_is_superhost STRING,
host_thumbnail_url STRING, host_picture_url STRING, host_neighbourhood STRING,
host_listings_count INT, host_total_listings_count INT, host_verifications STRING,
host_has_profile_pic STRING, host_identity_verified STRING, neighbourhood STRING,
neighbourhood_cleansed STRING, neighbourhood_group_cleansed STRING,
latitude FLOAT, longitude FLOAT, property_type STRING, room_type STRING,
accommodates INT, bathrooms DOUBLE, bathrooms_text STRING, bedrooms INT, beds INT,
amenities STRING, price STRING, minimum_nights INT, maximum_nights INT,
minimum_minimum_nights INT, maximum_minimum_nights INT, minimum_maximum_nights INT,
maximum_maximum_nights INT, minimum_nights_avg_ntm INT, maximum_nights_avg_ntm INT,
calendar_updated STRING, has_availability STRING, availability_30 INT,
availability_60 INT, availability_90 INT, availability_365 INT,
calendar_last_scraped DATE, number_of_reviews INT, number_of_reviews_ltm INT,
number_of_reviews_l30d INT, first_review DATE, last_review DATE,
review_scores_rating DOUBLE, review_scores_accuracy DOUBLE,
review_scores_cleanliness DOUBLE, review_scores_checkin DOUBLE,
review_scores_communication DOUBLE, review_scores_location DOUBLE,
review_scores_value DOUBLE, license STRING, instant_bookable STRING,
calculated_host_listings_count INT, calculated_host_listings_count_entire_homes INT,
calculated_host_listings_count_private_rooms INT,
calculated_host_listings_count_shared_rooms INT, reviews_per_month DOUBLE
"""

# --- fixed values: columns the listings cleaning drops (42) -----------------
LISTINGS_DROPPED = [
    "scrape_id", "last_scraped", "source", "host_url", "host_since",
    "host_location", "host_about", "host_response_time", "host_response_rate",
    "host_acceptance_rate", "host_is_superhost", "host_thumbnail_url",
    "host_picture_url", "host_neighbourhood", "host_listings_count",
    "host_total_listings_count", "host_verifications", "host_has_profile_pic",
    "host_identity_verified", "neighbourhood", "neighbourhood_group_cleansed",
    "minimum_nights", "maximum_nights", "maximum_minimum_nights",
    "minimum_maximum_nights", "minimum_nights_avg_ntm", "maximum_nights_avg_ntm",
    "calendar_updated", "availability_30", "availability_60", "availability_90",
    "calendar_last_scraped", "number_of_reviews_ltm", "number_of_reviews_l30d",
    "first_review", "last_review", "license", "instant_bookable",
    "calculated_host_listings_count",
    "calculated_host_listings_count_entire_homes",
    "calculated_host_listings_count_private_rooms",
    "calculated_host_listings_count_shared_rooms",
]

# --- fixed values: raw calendar and reviews schemas --------------------------
CALENDAR_RAW_DDL = (
    "listing_id STRING, date DATE, available STRING, price STRING, "
    "adjusted_price BOOLEAN, minimum_nights INT, maximum_nights INT"
)
REVIEWS_RAW_DDL = (
    "listing_id STRING, id STRING, date DATE, reviewer_id INT, "
    "reviewer_name STRING, comments STRING"
)

LISTINGS_RAW: StructType = _struct(LISTINGS_RAW_DDL)
CALENDAR_RAW: StructType = _struct(CALENDAR_RAW_DDL)
REVIEWS_RAW: StructType = _struct(REVIEWS_RAW_DDL)
