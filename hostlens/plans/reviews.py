"""Review analysis: listing x review rows with sentiment, per-listing
roll-up, correlation matrix, category means, keywords, geo grid."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from ..functions import text as T
from ..operators import aggregates as A
from ..operators.joins import salted_join
from ..session import materialize
from ..operators.text import tfidf_keywords, with_sentiment
from ..operators.topk import smallest

# fixed values: columns of the review tables
LISTING_COLUMNS = [
    "id", "review_scores_rating", "review_scores_communication", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_location", "review_scores_value",
    "review_scores_checkin", "reviews_per_month", "latitude", "longitude", "room_type"]
ROLLUP_ATTRIBUTES = LISTING_COLUMNS[1:] + ["review_count"]
CORRELATION_COLUMNS = [
    "sentiment_score_mean", "review_scores_rating", "review_scores_communication",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_location",
    "review_scores_value", "review_scores_checkin", "reviews_per_month", "review_count"]
CATEGORY_MEANS = {
    "avg_communication": "review_scores_communication", "avg_location": "review_scores_location",
    "avg_value": "review_scores_value", "avg_rating": "review_scores_rating",
    "avg_checkin": "review_scores_checkin", "avg_cleanliness": "review_scores_cleanliness"}
CATEGORIES = ["positive", "neutral", "negative"]
NEGATIVE_CUT = -0.6


def comment_rows(listings: DataFrame, reviews: DataFrame,
                 lexicon: Mapping[str, float] | DataFrame = T.DEFAULT_LEXICON,
                 negators: Iterable[str] = T.DEFAULT_NEGATORS, keep_review_id: bool = False,
                 hot_listing_reviews: int = 5_000_000) -> DataFrame:
    """One row per review of a known listing, with the listing's scores, the
    listing's review count, cleaned text, sentiment score and category.

    The per-listing count is combined map-side and attached to the listing
    rows (listing-sized join) before the single listing x review join, which
    equals a left join of the counts onto the joined rows.  The same counts
    mark listings with at least ``hot_listing_reviews`` reviews, whose
    reviews are salted over several tasks in that join.
    """
    # listing-sized; stored once, read by the hot-key test and the count join
    counts = materialize(A.count_per_key(reviews, "listing_id", "review_count"), "review-counts")
    lst = listings.select(*LISTING_COLUMNS).join(
        counts.withColumnRenamed("listing_id", "id"), on="id", how="left")
    rev = reviews.select("listing_id", "comments", "date", F.col("id").alias("review_id"))
    df = salted_join(rev, lst, "listing_id", "id", "review_id", counts=counts,
                     hot_rows=hot_listing_reviews).drop("listing_id")
    if not keep_review_id:
        df = df.drop("review_id")
    df = df.withColumns({"cleaned_comments": T.clean_comments("comments"),
                         "comments": F.coalesce(F.col("comments"), F.lit(""))})
    df = with_sentiment(df, "comments", lexicon, negators)
    return df.withColumn("sentiment_category", T.sentiment_category("sentiment_score"))


def listing_rollup(comments: DataFrame) -> DataFrame:
    return A.rollup_per_key(comments, "id", ROLLUP_ATTRIBUTES, "sentiment_score",
                            "sentiment_score_mean", "sentiment_score_variance")


def score_correlations(comments: DataFrame) -> DataFrame:
    return A.correlation_matrix(listing_rollup(comments), CORRELATION_COLUMNS)


def category_score_means(comments: DataFrame) -> DataFrame:
    return A.grouped_means(comments, "sentiment_category", CATEGORY_MEANS,
                           count_col="sentiment_score", count_name="comment_count", decimals=2)


def negative_comments(comments: DataFrame, cut: float = NEGATIVE_CUT) -> DataFrame:
    return comments.where(F.col("sentiment_score") < cut)


def lowest_sentiment(comments: DataFrame, k: int = 5) -> DataFrame:
    return smallest(comments, [F.col("sentiment_score").asc(), F.col("id").asc(),
                               F.col("date").asc(), F.col("comments").asc()], k)


def keywords_by_category(comments: DataFrame, doc_col: str = "review_id", k: int = 20,
                         stop_words: Iterable[str] = ()) -> DataFrame:
    return tfidf_keywords(comments, doc_col, "cleaned_comments", "sentiment_category", k, stop_words)


def negative_keywords(comments: DataFrame, doc_col: str = "review_id", k: int = 20,
                      stop_words: Iterable[str] = ()) -> DataFrame:
    return tfidf_keywords(negative_comments(comments), doc_col, "comments", None, k, stop_words)


def with_plot_weights(comments: DataFrame) -> DataFrame:
    return comments.withColumns({
        "size": N.category_weight("sentiment_category", "negative", 200, 50),
        "alpha": N.category_weight("sentiment_category", "negative", 0.8, 0.5)})


def geo_sentiment_grid(comments: DataFrame, digits: int = 2) -> DataFrame:
    """Review counts per rounded (lat, lon) cell and category."""
    keys = [F.round(F.col("latitude").cast("double"), digits).alias("lat_cell"),
            F.round(F.col("longitude").cast("double"), digits).alias("lon_cell")]
    return A.pivot_counts(comments, keys, "sentiment_category", CATEGORIES)
