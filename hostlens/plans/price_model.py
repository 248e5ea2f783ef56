"""Listing price model: features per listing, mean log price target,
random-forest regression, R^2 / RMSE, feature importances."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import parsing as P
from ..operators import ml as ML
from ..operators.clean import dedup
from ..operators.sampling import key_split
from ..session import materialize
from ..sources import io

# fixed values: the model's features and label
NUMERIC = ["accommodates", "num_bedrooms", "num_beds", "num_bathrooms", "number_of_reviews",
           "review_scores_rating", "reviews_per_month", "distance_to_center_km", "amenities_count",
           "minimum_nights"]
CATEGORICAL = ["neighbourhood", "property_type", "is_private_bath", "is_shared_bath", "room_type"]
LABEL = "average_log_price"


def listing_features(listings: DataFrame) -> DataFrame:
    """One row per listing with the model's listing-side features."""
    return listings.select(
        F.col("id"),
        F.col("accommodates"),
        F.col("bedrooms").alias("num_bedrooms"),
        F.col("beds").alias("num_beds"),
        P.bathroom_count("bathrooms_text").alias("num_bathrooms"),
        F.col("number_of_reviews"),
        F.col("review_scores_rating"),
        F.col("reviews_per_month"),
        N.haversine_km("latitude", "longitude").alias("distance_to_center_km"),
        P.amenity_count("amenities").alias("amenities_count"),
        F.col("neighbourhood_cleansed").alias("neighbourhood"),
        F.col("property_type"),
        P.contains_flag("bathrooms_text", "private").alias("is_private_bath"),
        P.contains_flag("bathrooms_text", "shared").alias("is_shared_bath"),
        F.col("room_type"),
    )


def calendar_target(calendar: DataFrame) -> DataFrame:
    """Per listing: mean log price (NULL prices skipped) and the minimum
    nights of its earliest calendar day.

    Aggregated before any join (partial aggregation map-side), so the
    calendar never meets the listing table row by row.
    """
    return calendar.groupBy("listing_id").agg(
        F.avg(N.log_price("price")).alias(LABEL),
        F.min_by(F.col("minimum_nights"), F.struct("date", "minimum_nights")).alias("minimum_nights"))


def training_table(listings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Listing features x per-listing target, listings with a target only.

    One row per listing id: of several hosts' rows the smallest (by the
    features in order, NULL first) stays.
    """
    feats = dedup(listing_features(listings), ["id"])
    target = calendar_target(calendar)
    df = feats.join(target, feats["id"] == target["listing_id"], "inner").drop("listing_id")
    return df.where(F.col(LABEL).isNotNull())


def split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42,
          bucket=None) -> tuple[DataFrame, DataFrame]:
    """Deterministic 80/20 split by listing id hash (or a given bucket column)."""
    s = key_split(df, train_fraction, ["id"], seed, bucket=bucket)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def fit_price_model(train: DataFrame, trees: int = 15, depth: int = 20, seed: int = 42):
    train = ML.spread_rows(ML.as_double(train, NUMERIC))
    return ML.price_regression_stages(NUMERIC, CATEGORICAL, LABEL, trees, depth, seed).fit(train)


def stored_table(listings: DataFrame, calendar: DataFrame, seed: int = 42, bucket=None) -> DataFrame:
    """The training table with its split, stored: fit, metrics and importances all read this one."""
    return materialize(key_split(training_table(listings, calendar), 0.8, ["id"], seed, bucket=bucket), "price-train")


def train_and_evaluate(listings: DataFrame, calendar: DataFrame, partitions: int | None = None,
                       trees: int = 15, depth: int = 20, seed: int = 42, bucket=None, table: DataFrame | None = None):
    """Fit on the 80 % split and report (split, r2, rmse, n).

    The listing-level table (``table``, or that of the listings and the calendar) is spread over the
    cluster's default parallelism if it was stored in fewer partitions (the forest otherwise trains on a
    few cores) and persisted only around the fit + evaluation block that reads it several times.
    """
    spark = listings.sparkSession
    table = stored_table(listings, calendar, seed, bucket) if table is None else table
    table = io.spread(table, partitions).persist()
    try:
        model = fit_price_model(table.where(F.col("split") == "train").drop("split"), trees, depth, seed)
        # one scoring pass over both parts, metrics grouped by part
        scored = model.transform(ML.as_double(table, NUMERIC))
        rows = ML.regression_metrics_frame(scored, LABEL, "prediction", by=["split"]).collect()
    finally:
        table.unpersist()
    return model, spark.createDataFrame([(r["r2"], r["rmse"], r["n"], r["split"]) for r in rows],
                                        "r2 double, rmse double, n long, split string")
