"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the driver tables through :mod:`hostlens.sources.bindings` and
run the library operators over the whole tables.  Double outputs are
rounded to 6 places (the oracle does the same) so the comparison does not
depend on the order in which partial sums were added.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import etl
from . import occupancy as occ
from . import occupancy_append as OA
from . import occupancy_models as OM
from . import price_model as PM
from . import recommend as RC
from . import reviews as RV
from ..functions import numeric as N
from ..functions import parsing as P
from ..functions import text as T
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import joins as J
from ..operators import label_index as LI
from ..operators import ml as ML
from ..operators import pricing as PR
from ..operators import sampling as S
from ..operators import selection as SEL
from ..operators import text as TX
from ..operators import windows as W
from ..session import materialize, scratch_path
from ..sources import bindings as B
from ..sources import csv_split, io, layout
from ..sources.schemas import CALENDAR_RAW, LISTINGS_RAW, REVIEWS_RAW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


# ---- role tables ------------------------------------------------------------

def listings_clean(spark, sf):
    return etl.clean_listings(B.listings_raw(spark, sf))


def calendar_clean(spark, sf, thousands=False):
    return etl.clean_calendar(B.calendar_raw(spark, sf), thousands=thousands)


def reviews_clean(spark, sf):
    return etl.clean_reviews(io.spread(B.reviews_raw(spark, sf)))


def panel(spark, sf, hot_cut=None):
    return occ.occupancy_panel(listings_clean(spark, sf), calendar_clean(spark, sf),
                               start=B.PANEL_START, end=B.PANEL_END, hot_cut=hot_cut)


# ---- flagship ---------------------------------------------------------------

@query("region_occupancy")
def q_region_occupancy(spark, sf):
    """Mean running occupancy per neighbourhood (A7)."""
    days = occ.with_running_occupancy(occ.rental_days(
        listings_clean(spark, sf), calendar_clean(spark, sf), B.PANEL_START, B.PANEL_END))
    return rounded(occ.region_occupancy(days))


@query("occupancy_panel")
def q_occupancy_panel(spark, sf):
    return rounded(panel(spark, sf))


@query("occupancy_panel_thousands")
def q_occupancy_panel_thousands(spark, sf):
    """The panel with prices of 1,000 and more read as numbers: no night is lost to a comma."""
    return rounded(occ.occupancy_panel(listings_clean(spark, sf), calendar_clean(spark, sf, thousands=True),
                                       start=B.PANEL_START, end=B.PANEL_END, hot_cut=None))


@query("occupancy_appended")
def q_occupancy_appended(spark, sf):
    """The panel of three drops of days, each continued from the listings' state behind the last one."""
    listings, calendar, root = listings_clean(spark, sf), calendar_clean(spark, sf), scratch_path(spark, "panel-drops")
    dates = F.col("date").between
    for a, b in (("0001-01-01", "1996-12-31"), ("1997-01-01", "1998-03-31"), ("1998-04-01", "9999-12-31")):
        OA.append(spark, root, listings, calendar.where(dates(F.lit(a).cast("date"), F.lit(b).cast("date"))), B.PANEL_START, B.PANEL_END)
    return rounded(OA.read_panel(spark, root, hot_cut=None))


@query("occupancy_bucketed")
def q_occupancy_bucketed(spark, sf):
    """The panel from listings and calendar stored in buckets of the listing id (no exchange on it)."""
    root = scratch_path(spark, "bucketed")
    layout.write_bucketed(listings_clean(spark, sf), f"{root}/listings", "id", 16)
    layout.write_bucketed(calendar_clean(spark, sf), f"{root}/calendar", "listing_id", 16, ["date"])
    listings, calendar = (layout.open_table(spark, f"{root}/{t}") for t in ("listings", "calendar"))
    return rounded(occ.occupancy_panel(listings, calendar, start=B.PANEL_START, end=B.PANEL_END, hot_cut=None))


@query("rejected_prices")
def q_rejected_prices(spark, sf):
    """Calendar prices that do not parse, without and with the thousands option."""
    raw = B.calendar_raw(spark, sf)
    parts = [etl.rejected_prices(raw, thousands=t).withColumn("thousands", F.lit(t)) for t in (False, True)]
    return parts[0].unionByName(parts[1])


# ---- 2.1 scans, sources, sinks ---------------------------------------------


@query("csv_scan_quoted")
def q_csv_scan_quoted(spark, sf):
    """Listings written as CSV and read back with quote + doubled-quote escape."""
    return io.csv_roundtrip(B.listings_raw(spark, sf), "listings-csv", LISTINGS_RAW)


@query("csv_scan_plain")
def q_csv_scan_plain(spark, sf):
    """Multi-line review texts (some holding quotes) through CSV and back."""
    return io.csv_roundtrip(B.reviews_raw(spark, sf), "reviews-csv", REVIEWS_RAW)


LARGEST_SPLIT = 32 << 20


def _csv_in_splits(df, name):
    """``df`` as CSV files (their folder) and a split size that cuts them into at least 12 splits, the largest one into
    at least 4. The files are of the advisory partition size: a single one would have to pass through one task."""
    path = scratch_path(df.sparkSession, name)
    io.write_csv(df.hint("rebalance"), path)
    total, largest = df.sparkSession.read.format("binaryFile").load(path).agg(F.sum("length"), F.max("length")).first()
    return path, max(1, min((total or 0) // 12, (largest or 0) // 4, LARGEST_SPLIT))


@query("csv_split_quoted")
def q_csv_split_quoted(spark, sf):
    """Listings in CSV files, read in splits that cut through quoted fields."""
    path, split = _csv_in_splits(B.listings_raw(spark, sf), "listings-split-csv")
    return csv_split.read_csv_split(spark, path, LISTINGS_RAW, split_bytes=split)


@query("csv_split_multiline")
def q_csv_split_multiline(spark, sf):
    """Multi-line review texts in CSV files, read in splits."""
    path, split = _csv_in_splits(B.reviews_raw(spark, sf), "reviews-split-csv")
    return csv_split.read_csv_split(spark, path, REVIEWS_RAW, split_bytes=split)


def _calendar_text_with_bad_fields(spark, sf):
    cal = B.calendar_raw(spark, sf)
    return cal.select(
        "listing_id",
        F.when(F.col("minimum_nights") == 7, F.lit("bad-date")).otherwise(F.col("date").cast("string")).alias("date"),
        "available", "price",
        F.when(F.col("minimum_nights") == 3, F.lit("maybe")).alias("adjusted_price"),
        "minimum_nights",
        F.when(F.col("maximum_nights") >= 49, F.lit("9999999999"))
         .when(F.col("maximum_nights") == 1, F.lit("2.5"))
         .otherwise(F.col("maximum_nights").cast("string")).alias("maximum_nights"),
    )


@query("csv_scan_spread")
def q_csv_scan_spread(spark, sf):
    """Multi-line CSV read in one task a file and dealt out round robin to 24 partitions."""
    return io.csv_roundtrip(B.reviews_raw(spark, sf), "reviews-csv", REVIEWS_RAW, partitions=24)


@query("csv_permissive")
def q_csv_permissive(spark, sf):
    """Fields that do not fit the declared type become NULL; rows stay."""
    return io.csv_roundtrip(_calendar_text_with_bad_fields(spark, sf), "calendar-bad-csv", CALENDAR_RAW)


@query("parquet_scan")
def q_parquet_scan(spark, sf):
    """Pruned, filtered parquet read (ReadSchema 3 columns, PushedFilters)."""
    li = B.table(spark, sf, "lineitem")
    return (li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
              .select("l_partkey", F.col("l_shipdate").cast("date").alias("ship_date"), "l_extendedprice"))


@query("parquet_sink_roundtrip")
def q_parquet_sink(spark, sf):
    return io.parquet_roundtrip(calendar_clean(spark, sf), "calendar-clean", compression="lz4")


def _written_panel(spark, sf):
    path = scratch_path(spark, "panel")
    occ.write_panel(panel(spark, sf), path)
    return path


@query("partitioned_sink_roundtrip")
def q_partitioned_sink(spark, sf):
    return rounded(spark.read.parquet(_written_panel(spark, sf)))


@query("segment_scan")
def q_segment_scan(spark, sf):
    """One segment read from the partitioned panel by folder pruning."""
    root = _written_panel(spark, sf)
    return rounded(io.read_segment(spark, root, high_demand=1, is_weekend=0, hot_region=1))


# ---- 2.2 projections ---------------------------------------------------------

@query("project_drop")
def q_project_drop(spark, sf):
    return C.drop_columns(B.listings_raw(spark, sf), etl.LISTINGS_DROPPED)


@query("join_disambiguate")
def q_join_disambiguate(spark, sf):
    l = listings_clean(spark, sf).select("id", "room_type")
    c = calendar_clean(spark, sf).select(F.col("listing_id").alias("id"), "date", "price")
    return J.join_on_key(l, c, "id")


@query("project_rename")
def q_project_rename(spark, sf):
    df = listings_clean(spark, sf).select("id", "price", "neighbourhood_cleansed", "bedrooms", "beds")
    return C.rename_columns(df, {"price": "listing_price", "neighbourhood_cleansed": "neighbourhood",
                                 "bedrooms": "num_bedrooms", "beds": "num_beds"})


REVIEW_LISTING_COLUMNS = [
    "id", "review_scores_rating", "review_scores_communication", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_location", "review_scores_value",
    "review_scores_checkin", "reviews_per_month", "latitude", "longitude", "room_type"]


@query("project_select")
def q_project_select(spark, sf):
    return C.select_columns(listings_clean(spark, sf), REVIEW_LISTING_COLUMNS)


@query("parse_flag")
def q_parse_flag(spark, sf):
    return B.calendar_raw(spark, sf).select(
        "listing_id", "date", F.col("available").alias("raw"), P.parse_flag("available").alias("flag"))


@query("parse_money")
def q_parse_money(spark, sf):
    return B.calendar_raw(spark, sf).select(
        "listing_id", "date", F.col("price").alias("raw"), P.parse_money("price").alias("price_value"))


@query("parse_money_thousands")
def q_parse_money_thousands(spark, sf):
    return B.calendar_raw(spark, sf).select(
        "listing_id", "date", F.col("price").alias("raw"), P.parse_money_thousands("price").alias("price_value"))


@query("rental_label")
def q_rental_label(spark, sf):
    return calendar_clean(spark, sf).select("listing_id", "date", "available",
                                            N.rental_label("available").alias("label"))


@query("threshold_flag")
def q_threshold_flag(spark, sf):
    days = occ.with_running_occupancy(occ.rental_days(
        listings_clean(spark, sf), calendar_clean(spark, sf), B.PANEL_START, B.PANEL_END))
    return rounded(days.select("id", "date", "occupancy_rate", "high_demand"))


@query("weekend_flag")
def q_weekend_flag(spark, sf):
    return calendar_clean(spark, sf).select("listing_id", "date", N.weekend_flag("date").alias("is_weekend"))


@query("null_normalise")
def q_null_normalise(spark, sf):
    return B.listings_raw(spark, sf).select(
        "id", P.empty_list_to_null("amenities").alias("amenities"),
        P.null_to_empty("bathrooms_text").alias("bathrooms_text"))


# ---- 2.3 filters --------------------------------------------------------------

@query("filter_not_null_keys")
def q_filter_not_null_keys(spark, sf):
    return C.filter_not_null(B.reviews_raw(spark, sf).select("listing_id", "id", "date"), ["listing_id", "id"])


@query("filter_date_range")
def q_filter_date_range(spark, sf):
    return calendar_clean(spark, sf).where(
        F.col("date").between(F.lit(B.PANEL_START).cast("date"), F.lit(B.PANEL_END).cast("date")))


@query("filter_dropna")
def q_filter_dropna(spark, sf):
    return occ.rental_days(listings_clean(spark, sf), calendar_clean(spark, sf), B.PANEL_START, B.PANEL_END)


@query("filter_ascii")
def q_filter_ascii(spark, sf):
    return B.reviews_raw(spark, sf).where(T.is_ascii_text("comments")).select("id", "listing_id")


@query("filter_stopword_lang")
def q_filter_stopword_lang(spark, sf):
    """Marker-word test, on ASCII texts (word boundaries are engine-specific
    next to accented letters)."""
    r = B.reviews_raw(spark, sf)
    return r.where(T.is_ascii_text("comments") & ~T.has_marker_words("comments")).select("id", "listing_id")


@query("filter_accents")
def q_filter_accents(spark, sf):
    r = B.reviews_raw(spark, sf)
    return r.where(F.col("comments").isNotNull() & ~T.has_accents("comments")).select("id", "listing_id")


@query("english_filter")
def q_english_filter(spark, sf):
    return etl.english_reviews(B.reviews_raw(spark, sf)).select("id", "listing_id", "date")


@query("bath_flags")
def q_bath_flags(spark, sf):
    return B.listings_raw(spark, sf).select(
        "id", "bathrooms_text",
        P.contains_flag("bathrooms_text", "private").alias("is_private_bath"),
        P.contains_flag("bathrooms_text", "shared").alias("is_shared_bath"))


def _sample_bucket():
    """Integer-arithmetic bucket of the (listing, day) key in [0, 10000)."""
    days = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return F.pmod(F.col("listing_id").cast("long") * 2654435761 + days * 40503 + 17, F.lit(10000))


@query("key_sample")
def q_key_sample(spark, sf):
    return S.key_sample(calendar_clean(spark, sf), 0.1, bucket=_sample_bucket())


@query("key_split")
def q_key_split(spark, sf):
    return S.key_split(calendar_clean(spark, sf), 0.8, bucket=_sample_bucket()).select(
        "listing_id", "date", "split")


@query("bernoulli_sample")
def q_bernoulli_sample(spark, sf):
    """Facts of a 1 % sample: rows of the table, none twice, and as many as six standard deviations allow."""
    rows = materialize(calendar_clean(spark, sf), "sample-source")
    drawn = materialize(S.bernoulli_sample(rows, 0.01, seed=7), "sample")
    n = rows.agg(F.count("*").alias("n_rows"))
    keys = drawn.join(rows.select("listing_id", "date"), ["listing_id", "date"], "left_semi").groupBy("listing_id", "date").count()
    facts = keys.agg(F.count("*").alias("found"), F.coalesce(F.max("count"), F.lit(1)).alias("most"))
    size = drawn.agg(F.count("*").alias("drawn"))
    one = n.join(facts, F.lit(True)).join(size, F.lit(True))
    return one.select("n_rows", ((F.col("found") == F.col("drawn")) & (F.col("most") == 1)).alias("is_subset"),
                      (F.abs(F.col("drawn") - 0.01 * F.col("n_rows")) <= 6 * F.sqrt(0.01 * 0.99 * F.col("n_rows")) + 1).alias("size_fits"))


@query("random_split")
def q_random_split(spark, sf):
    """Every row lies in exactly one part."""
    train, test = S.random_split(materialize(calendar_clean(spark, sf), "split-source"), [0.8, 0.2], seed=42)
    both = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    return both.groupBy("listing_id", "date").agg(F.count("*").alias("n_parts"))


# ---- 2.9 scalar functions ------------------------------------------------------

@query("strip_breaks")
def q_strip_breaks(spark, sf):
    return B.reviews_raw(spark, sf).select("id", P.strip_breaks("comments").alias("comments"))


@query("bathroom_count")
def q_bathroom_count(spark, sf):
    return B.listings_raw(spark, sf).select("id", "bathrooms_text",
                                            P.bathroom_count("bathrooms_text").alias("num_bathrooms"))


@query("amenity_list")
def q_amenity_list(spark, sf):
    return listings_clean(spark, sf).select("id", P.amenity_list("amenities").alias("amenities_list"))


@query("amenity_list_json")
def q_amenity_list_json(spark, sf):
    return listings_clean(spark, sf).select("id", P.amenity_list_json("amenities").alias("amenities_list"))


@query("amenity_count")
def q_amenity_count(spark, sf):
    return listings_clean(spark, sf).select(
        "id", P.amenity_count("amenities").alias("amenities_count"),
        P.amenity_count("amenities", json=True).alias("amenities_count_json"))


@query("clean_comments")
def q_clean_comments(spark, sf):
    return reviews_clean(spark, sf).select("id", T.clean_comments("comments").alias("cleaned_comments"))


@query("clean_comments_compat")
def q_clean_comments_compat(spark, sf):
    return reviews_clean(spark, sf).select("id", T.clean_comments_compat("comments").alias("cleaned_comments"))


@query("log_price")
def q_log_price(spark, sf):
    return rounded(calendar_clean(spark, sf).select(
        "listing_id", "date", "price", N.log_price("price").alias("log_price")))


@query("haversine")
def q_haversine(spark, sf):
    return rounded(listings_clean(spark, sf).select(
        "id", N.haversine_km("latitude", "longitude").alias("distance_to_center_km")))


# ---- 2.4 joins -----------------------------------------------------------------


def comments(spark, sf):
    """Review analysis reads the cleaned reviews as stored by the cleaning
    step (as the batch jobs hand over through Parquet), so the text filters
    run once however many passes the analysis makes."""
    stored = io.parquet_roundtrip(reviews_clean(spark, sf), "reviews-clean")
    return RV.comment_rows(listings_clean(spark, sf), stored,
                           B.FIXTURE_LEXICON, B.FIXTURE_NEGATORS, keep_review_id=True)


def rental_days(spark, sf):
    return occ.rental_days(listings_clean(spark, sf), calendar_clean(spark, sf), B.PANEL_START, B.PANEL_END)


@query("join_listing_calendar")
def q_join_listing_calendar(spark, sf):
    return J.join_listing_calendar(listings_clean(spark, sf), calendar_clean(spark, sf),
                                   ["id", "room_type", "accommodates"], ["listing_id", "date", "price", "available"])


@query("join_listing_reviews")
def q_join_listing_reviews(spark, sf):
    l = listings_clean(spark, sf).select(*RV.LISTING_COLUMNS)
    r = reviews_clean(spark, sf).select("listing_id", "comments", "date", F.col("id").alias("review_id"))
    return J.salted_join(r, l, "listing_id", "id", "review_id").drop("listing_id", "review_id")


@query("join_left_count")
def q_join_left_count(spark, sf):
    return comments(spark, sf).select("review_id", "id", "date", "review_count")


def _log_prices(spark, sf):
    return calendar_clean(spark, sf).select("listing_id", "date", N.log_price("price").alias("log_price"))


@query("agg_join_back")
def q_agg_join_back(spark, sf):
    df = J.attach_group_stat(_log_prices(spark, sf), ["listing_id"], F.avg("log_price"), "average_log_price")
    return rounded(df)


@query("agg_over_partition")
def q_agg_over_partition(spark, sf):
    df = J.attach_group_stat_window(_log_prices(spark, sf), ["listing_id"], F.avg("log_price"), "average_log_price")
    return rounded(df)


# ---- 2.5 aggregations --------------------------------------------------------------

@query("dedup_keys")
def q_dedup_keys(spark, sf):
    return calendar_clean(spark, sf)


@query("distinct_rows")
def q_distinct_rows(spark, sf):
    raw = B.calendar_raw(spark, sf)
    return C.distinct_rows(raw.unionByName(raw))  # every row at least twice


@query("count_per_key")
def q_count_per_key(spark, sf):
    return A.count_per_key(reviews_clean(spark, sf), "listing_id", "review_count")


@query("avg_log_price")
def q_avg_log_price(spark, sf):
    return rounded(A.mean_per_key(_log_prices(spark, sf), "listing_id", "log_price", "average_log_price"))


@query("listing_sentiment_rollup")
def q_listing_sentiment_rollup(spark, sf):
    return rounded(RV.listing_rollup(comments(spark, sf)))


@query("category_score_means")
def q_category_score_means(spark, sf):
    return rounded(RV.category_score_means(comments(spark, sf)))


@query("global_avg")
def q_global_avg(spark, sf):
    return rounded(A.global_mean(calendar_clean(spark, sf), "price", "avg_price"))


def _regions_with_cut(spark, sf, cut):
    days = occ.with_running_occupancy(rental_days(spark, sf))
    regions = materialize(occ.region_occupancy(days), "regions")  # one run for the median and the rows
    c = A.median_of(regions, "avg_occupancy_rate") if cut is None else cut
    return rounded(regions.withColumn("hot_region", N.threshold_flag("avg_occupancy_rate", c)))


@query("median_price")
def q_median_price(spark, sf):
    """Exact median calendar price of each neighbourhood and availability, by distributed selection."""
    rows = J.join_listing_calendar(listings_clean(spark, sf), calendar_clean(spark, sf), ["id", "neighbourhood_cleansed"], ["listing_id", "available", "price"])
    return rounded(SEL.exact_median(rows, "price", ["neighbourhood_cleansed", "available"], name="median_price"))


@query("hot_region_median")
def q_hot_region_median(spark, sf):
    return _regions_with_cut(spark, sf, None)


@query("hot_region_fixed")
def q_hot_region_fixed(spark, sf):
    return _regions_with_cut(spark, sf, occ.HOT_REGION_CUT)


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return rounded(RV.score_correlations(comments(spark, sf)))


@query("tfidf_terms")
def q_tfidf_terms(spark, sf):
    return rounded(TX.tfidf_keywords(comments(spark, sf), "review_id", "cleaned_comments", None, 20,
                                     B.FIXTURE_STOP_WORDS))


@query("keywords_by_category")
def q_keywords_by_category(spark, sf):
    return rounded(RV.keywords_by_category(comments(spark, sf), stop_words=B.FIXTURE_STOP_WORDS))


@query("keywords_negative")
def q_keywords_negative(spark, sf):
    return rounded(RV.negative_keywords(comments(spark, sf), stop_words=B.FIXTURE_STOP_WORDS))


@query("geo_sentiment_grid")
def q_geo_sentiment_grid(spark, sf):
    return RV.geo_sentiment_grid(comments(spark, sf))


# ---- 2.6 windows -------------------------------------------------------------------

def _occupancy_days(spark, sf):
    return W.cumulative_occupancy(rental_days(spark, sf), tiebreak=["host_id"])


@query("running_rentals")
def q_running_rentals(spark, sf):
    return _occupancy_days(spark, sf).select("id", "date", "label", "cumulative_rentout")


@query("day_ordinal")
def q_day_ordinal(spark, sf):
    return _occupancy_days(spark, sf).select("id", "date", "total_days")


@query("cumulative_occupancy")
def q_cumulative_occupancy(spark, sf):
    return rounded(_occupancy_days(spark, sf).select("id", "date", "occupancy_rate"))


# ---- 2.7 ordering ------------------------------------------------------------------

@query("lowest_sentiment")
def q_lowest_sentiment(spark, sf):
    return rounded(RV.lowest_sentiment(comments(spark, sf)).select("id", "date", "comments", "sentiment_score"))


@query("region_rank")
def q_region_rank(spark, sf):
    regions = occ.region_occupancy(occ.with_running_occupancy(rental_days(spark, sf)))
    w = Window.orderBy(F.col("avg_occupancy_rate").desc(), F.col("neighbourhood_cleansed"))
    return rounded(regions.withColumn("rank", F.row_number().over(w)))


# ---- 2.9 / 2.10 text ------------------------------------------------------------------

@query("tokenize")
def q_tokenize(spark, sf):
    return TX.token_counts(reviews_clean(spark, sf), "id", "comments", B.FIXTURE_STOP_WORDS)


@query("sentiment_score")
def q_sentiment_score(spark, sf):
    return rounded(comments(spark, sf).select("review_id", "id", "sentiment_score"))


def _phrase_sentiment(spark, sf, join):
    rows = TX.with_phrase_sentiment(reviews_clean(spark, sf), "comments", B.FIXTURE_LEXICON | B.FIXTURE_PHRASES, B.FIXTURE_NEGATORS,
                                    B.FIXTURE_INTENSIFIERS, join=join)
    return rounded(rows.select(F.col("id").alias("review_id"), "sentiment_score"))


@query("sentiment_phrases")
def q_sentiment_phrases(spark, sf):
    """Polarity by words and phrases of up to three words, with negators and intensifiers, inside the row."""
    return _phrase_sentiment(spark, sf, join=False)


@query("sentiment_phrases_join")
def q_sentiment_phrases_join(spark, sf):
    """The same with the lexicon joined in as a table."""
    return _phrase_sentiment(spark, sf, join=True)


@query("sentiment_join")
def q_sentiment_join(spark, sf):
    """``sentiment_score`` with the lexicon joined in as a table."""
    lexicon = spark.createDataFrame(list(B.FIXTURE_LEXICON.items()), "word string, polarity double")
    rows = RV.comment_rows(listings_clean(spark, sf), reviews_clean(spark, sf), lexicon, B.FIXTURE_NEGATORS, keep_review_id=True)
    return rounded(rows.select("review_id", "id", "sentiment_score"))


@query("sentiment_category")
def q_sentiment_category(spark, sf):
    return comments(spark, sf).select("review_id", "sentiment_category")


@query("filter_threshold")
def q_filter_threshold(spark, sf):
    return rounded(RV.negative_comments(comments(spark, sf)).select("review_id", "sentiment_score"))


@query("category_weight")
def q_category_weight(spark, sf):
    return RV.with_plot_weights(comments(spark, sf)).select("review_id", "sentiment_category", "size", "alpha")


# ---- 2.12 price recommendation (rule predictor) -------------------------------------


def rule_scored(spark, sf):
    return RC.rule_scored(panel(spark, sf))


@query("segment_key")
def q_segment_key(spark, sf):
    return RC.with_segment(panel(spark, sf)).select("id", "date", "segment")


@query("action_grid")
def q_action_grid(spark, sf):
    return rounded(PR.with_actions(panel(spark, sf)).select("id", "date", "action", "new_price"))


@query("segment_transition")
def q_segment_transition(spark, sf):
    segs = RC.with_segment(panel(spark, sf)).select("segment").distinct()
    return PR.with_actions(segs.withColumn("price", F.lit(0.0))).select(
        "segment", "action", PR.next_segment(F.col("segment"), F.col("action")).alias("next_segment"))


@query("reward_rows")
def q_reward_rows(spark, sf):
    return rounded(rule_scored(spark, sf).select("id", "date", "segment", "action", "prediction", "reward"))


@query("reward_grid")
def q_reward_grid(spark, sf):
    return rounded(PR.reward_grid(rule_scored(spark, sf)))


@query("lookahead_value")
def q_lookahead_value(spark, sf):
    return rounded(PR.lookahead_value(PR.reward_grid(rule_scored(spark, sf))))


@query("best_action")
def q_best_action(spark, sf):
    return RC.recommend(rule_scored(spark, sf))


@query("median_best_action")
def q_median_best_action(spark, sf):
    return rounded(RC.recommend_median(rule_scored(spark, sf)))


@query("csv_sink_roundtrip")
def q_csv_sink_roundtrip(spark, sf):
    """The recommendation table written as CSV with a header and read back."""
    return io.csv_roundtrip(RC.recommend(rule_scored(spark, sf)), "recommendation-csv",
                            "state STRING, best_action DOUBLE")


# ---- 2.11 features and ML -------------------------------------------------------------


def training_table(spark, sf):
    """Listing-sized and read by every estimator of a pipeline: stored once."""
    return materialize(PM.training_table(listings_clean(spark, sf), calendar_clean(spark, sf)), "price-features")


def _id_bucket():
    return F.pmod(F.col("id").cast("long") * 2654435761 + 17, F.lit(10000))


@query("impute_mean")
def q_impute_mean(spark, sf):
    df = ML.as_double(training_table(spark, sf), PM.NUMERIC)
    out = ML.imputer(PM.NUMERIC).fit(df).transform(df)
    return rounded(out.select("id", *[c + "_imputed" for c in PM.NUMERIC]))


@query("scale_std")
def q_scale_std(spark, sf):
    df = ML.as_double(training_table(spark, sf), PM.NUMERIC)
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    stages = [ML.imputer(PM.NUMERIC),
              VectorAssembler(inputCols=[c + "_imputed" for c in PM.NUMERIC], outputCol="numeric_features"),
              ML.scaler("numeric_features", "scaled")]
    out = Pipeline(stages=stages).fit(df).transform(df).withColumn("arr", vector_to_array("scaled"))
    return rounded(out.select("id", *[F.col("arr")[i].alias(c + "_scaled") for i, c in enumerate(PM.NUMERIC)]))


@query("index_keep")
def q_index_keep(spark, sf):
    df = training_table(spark, sf)
    train, _ = PM.split(df, 0.8, bucket=_id_bucket())
    model = ML.indexers(PM.CATEGORICAL).fit(train)
    return model.transform(df).select("id", *[c + "_index" for c in PM.CATEGORICAL])


@query("index_keep_table")
def q_index_keep_table(spark, sf):
    """``index_keep`` through label tables: no label passes the driver."""
    df = materialize(training_table(spark, sf), "training-table")
    train, _ = PM.split(df, 0.8, bucket=_id_bucket())
    tables = {c: LI.label_table(train, c) for c in PM.CATEGORICAL}
    return LI.index_by_table(df, PM.CATEGORICAL, tables=tables).select("id", *[c + "_index" for c in PM.CATEGORICAL])


@query("one_hot")
def q_one_hot(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = training_table(spark, sf)
    model = Pipeline(stages=[ML.indexers(PM.CATEGORICAL), ML.one_hot(PM.CATEGORICAL)]).fit(df)
    out = model.transform(df)
    return out.select("id", *[vector_to_array(c + "_ohe").alias(c + "_ohe") for c in PM.CATEGORICAL])


@query("price_model")
def q_price_model(spark, sf):
    """Facts of the fitted forest: rows per split, and an error below 0.7 of the mean predictor's on the rows it has
    learnt from and below 1.3 of it on the others (the price of a listing here is all but random)."""
    _, metrics = PM.train_and_evaluate(listings_clean(spark, sf), calendar_clean(spark, sf), bucket=_id_bucket())
    # 1 - r2 is the squared error as a share of that of the split's own mean
    share = F.sqrt(1 - F.col("r2"))
    return metrics.select("split", "n", (F.col("r2") <= 1).alias("r2_defined"), (F.col("rmse") >= 0).alias("rmse_defined"),
                          (F.when(F.col("split") == "train", F.col("r2")).otherwise(F.lit(1.0)) > 0).alias("beats_mean"),
                          (share < F.when(F.col("split") == "train", 0.7).otherwise(1.3)).alias("error_fits"))


# features with few values, so that one split can be told in SQL
STUMP_PRICE = ["accommodates", "number_of_reviews", "amenities_count", "minimum_nights"]
STUMP_OCCUPANCY = ["accommodates", "minimum_nights", "maximum_nights"]


@query("price_model_one_split")
def q_price_model_one_split(spark, sf):
    """The price forest with one tree and one split: its exact predictions for all listings."""
    df = materialize(ML.as_double(training_table(spark, sf), STUMP_PRICE), "training-table")
    train, _ = PM.split(df, 0.8, bucket=_id_bucket())
    return rounded(ML.one_split(STUMP_PRICE, PM.LABEL, classes=False).fit(ML.spread_rows(train)).transform(df).select("id", "prediction"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    """The features by name; importances lie in [0, 1] and add up to 1."""
    train, _ = PM.split(training_table(spark, sf))
    model = PM.fit_price_model(train)
    scored = model.transform(ML.as_double(train, PM.NUMERIC))
    found = ML.feature_importances(spark, model, scored, PM.NUMERIC + PM.CATEGORICAL,
                                   vector_sources={"numeric_features_scaled": PM.NUMERIC})
    total = F.sum("importance").over(Window.partitionBy(F.lit(1)))  # 15 rows
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.round(total, 6).alias("total"))


@query("regression_metrics")
def q_regression_metrics(spark, sf):
    """Metrics of a fixed predictor (neighbourhood mean of the training rows)."""
    df = training_table(spark, sf)
    train, test = PM.split(df, 0.8, bucket=_id_bucket())
    base = train.groupBy("neighbourhood").agg(F.avg(PM.LABEL).alias("prediction"))
    parts = [ML.regression_metrics_frame(d.join(base, "neighbourhood"), PM.LABEL, "prediction")
               .withColumn("split", F.lit(n)) for n, d in (("train", train), ("test", test))]
    return rounded(parts[0].unionByName(parts[1]))


@query("accuracy_metric")
def q_accuracy_metric(spark, sf):
    """Accuracy of the rule predictor at the unchanged price, per segment."""
    rows = RC.rule_scored(panel(spark, sf), actions=[1.0])
    return rounded(ML.accuracy_frame(rows, "label", "prediction", by=["segment"]))


def _panel_root(spark, sf):
    return _written_panel(spark, sf)


def _each_segment(spark, sf, of_segment, root=None, named=False):
    """``of_segment(rows)`` of all eight segments, put together; segments without rows, or for which that is None,
    have none. ``named``: the rows have the segment's name already."""
    root, out = root or _panel_root(spark, sf), None
    for seg in OM.SEGMENTS:
        rows, name = OM.segment_rows(spark, root, seg), F.lit(OM.segment_name(*seg))
        if not rows.isEmpty():
            rows = materialize(rows, "segment")
            part = of_segment(rows.withColumn("segment", name) if named else rows)
            if part is not None:
                part = part.withColumn("segment", name)
                out = part if out is None else out.unionByName(part)
    return out


def _day_bucket():
    """Integer-arithmetic bucket of a panel row in [0, 10000)."""
    days = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return F.pmod(F.col("id").cast("long") * 2654435761 + days * 40503 + 17, F.lit(10000))


def _beats_constant(scored):
    """id, date, segment, is_label, and whether the training rows' labels are met more often than by each segment's
    more frequent label, all segments taken together. ``scored``: label, prediction and split beside the keys."""
    scored = materialize(scored, "scored")
    train = scored.where("split = 'train'").groupBy("segment").agg(
        F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("hits"), F.sum("label").alias("ones"), F.count(F.lit(1)).alias("n"))
    r = train.agg(F.sum("hits").alias("hits"), F.sum(F.greatest("ones", F.col("n") - F.col("ones"))).alias("constant")).first()
    return scored.select("id", "date", "segment", "split", F.col("prediction").isin(0.0, 1.0).alias("is_label"),
                         F.lit((r["hits"] or 0) > (r["constant"] or 0)).alias("beats_constant"))


def _split_days(rows):
    return S.key_split(rows, 0.75, ["id", "date"], 42, bucket=_day_bucket())


_SCORED = ["id", "date", "label", "split", "prediction"]


@query("index_error")
def q_index_error(spark, sf):
    """Indexing that fails on unseen labels: fitted and applied on each segment."""
    def index(rows):
        model = ML.indexers(OM.CATEGORICAL, "_indexed", handle_invalid="error").fit(rows)
        return model.transform(rows).select("id", "date", *[c + "_indexed" for c in OM.CATEGORICAL])
    return _each_segment(spark, sf, index)


@query("index_error_table")
def q_index_error_table(spark, sf):
    """``index_error`` through label tables."""
    return _each_segment(spark, sf, lambda rows: LI.index_by_table(rows, OM.CATEGORICAL, "_indexed", handle_invalid="error")
                         .select("id", "date", *[c + "_indexed" for c in OM.CATEGORICAL]))


@query("occupancy_model")
def q_occupancy_model(spark, sf):
    """Each segment's forest on its test rows; segments without training rows have no model."""
    def score(rows):
        rows = _split_days(rows)
        train = rows.where("split = 'train'").drop("split")
        return None if train.isEmpty() else OM.fit_segment(train).transform(rows).select(*_SCORED)
    return _beats_constant(_each_segment(spark, sf, score)).where("split = 'test'").drop("split")


def _one_split_models(spark, root):
    models = {}
    for seg in OM.SEGMENTS:
        train, _ = OM.split_rows(OM.segment_rows(spark, root, seg), 0.75, bucket=_day_bucket())
        if not train.isEmpty():
            models[OM.segment_name(*seg)] = ML.one_split(STUMP_OCCUPANCY, "label", classes=True).fit(ML.spread_rows(train))
    return models


@query("occupancy_model_one_split")
def q_occupancy_model_one_split(spark, sf):
    """The segments' forests with one tree and one split: exact predictions and probabilities of all rows."""
    from pyspark.ml.functions import vector_to_array
    root = _panel_root(spark, sf)
    models = _one_split_models(spark, root)

    def score(rows):
        model = models.get(rows.select("segment").first()["segment"])
        return None if model is None else model.transform(rows).select(
            "id", "date", "prediction", vector_to_array("probability")[1].alias("p_rented"))
    return rounded(_each_segment(spark, sf, score, root, named=True))


@query("reward_grid_one_split")
def q_reward_grid_one_split(spark, sf):
    """Mean rewards per segment and action under those models: exact."""
    root = _panel_root(spark, sf)
    return rounded(OM.model_reward_grid(spark.read.parquet(root), _one_split_models(spark, root)))


@query("segment_models")
def q_segment_models(spark, sf):
    """The status of the eight fits; on the rows it has learnt from none is worse than a constant, and together they
    are better."""
    _, summary = OM.fit_segment_models(spark, _panel_root(spark, sf), bucket=_day_bucket())
    gain = F.col("train_accuracy") - F.col("train_majority")
    total = summary.agg(F.sum(gain)).first()[0]
    return summary.select("segment", "status", F.coalesce(F.col("accuracy").between(0, 1), F.lit(True)).alias("accuracy_fits"),
                          F.coalesce(gain > -1e-9, F.lit(True)).alias("not_below_constant"), F.lit((total or 0) > 1e-9).alias("beats_constant"))


@query("model_save_load")
def q_model_save_load(spark, sf):
    """Fit, save, load, on all segments: the loaded models reproduce every prediction."""
    def both(rows):
        model = OM.fit_segment(rows)
        again = ML.load_model(ML.save_model(model, scratch_path(spark, "model")))
        a = model.transform(rows).select("id", "date", F.col("prediction").alias("p1"))
        b = again.transform(rows).select("id", "date", F.col("prediction").alias("p2"))
        return a.join(b, ["id", "date"]).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("p1") == F.col("p2")).cast("int")).alias("n_equal"))
    return _each_segment(spark, sf, both)


@query("score_batch")
def q_score_batch(spark, sf):
    """A saved model per segment scores all rows of its segment, three quarters of which it has seen."""
    def score(rows):
        rows = _split_days(rows)
        train = rows.where("split = 'train'").drop("split")
        if train.isEmpty():
            return None
        return ML.load_model(ML.save_model(OM.fit_segment(train), scratch_path(spark, "model"))).transform(rows).select(*_SCORED)
    return _beats_constant(_each_segment(spark, sf, score)).drop("split")


@query("reward_grid_model")
def q_reward_grid_model(spark, sf):
    """Mean rewards under the models, between what the worst and the best prediction of every row would give."""
    root = _panel_root(spark, sf)
    models, _ = OM.fit_segment_models(spark, root)
    rows = spark.read.parquet(root)
    either = [PR.with_actions(RC.with_segment(rows)).withColumn("prediction", F.lit(p)).withColumn("reward", PR.reward()) for p in (0, 1)]
    ends = either[0].unionByName(either[1]).groupBy("id", "date", "segment", "action").agg(F.min("reward").alias("low"), F.max("reward").alias("high"))
    ends = ends.groupBy("segment", "action").agg(F.avg("low").alias("low"), F.avg("high").alias("high"))
    inside = F.col("avg_reward").between(F.col("low") - 1e-6, F.col("high") + 1e-6)
    grid = OM.model_reward_grid(rows, models).join(ends, ["segment", "action"])  # an inner join: no model, no reward
    return rounded(grid.select("segment", "action", "low", "high", inside.alias("inside")))


# ---- streaming ingest of the same cleaning -------------------------------------------------

DROPS, ROWS_PER_FILE = 4, 500_000


@query("calendar_stream_ingest")
def q_calendar_stream_ingest(spark, sf):
    """Calendar CSV files streamed through the incremental cleaning (several
    micro-batches), read back as the current table. More rows make more files,
    not larger ones."""
    from ..streaming import current_calendar, ingest_calendar
    src, raw = scratch_path(spark, "calendar-drops"), B.calendar_raw(spark, sf)
    files = max(1, -(-raw.count() // (DROPS * ROWS_PER_FILE)))  # of each micro-batch
    io.write_csv(raw.repartition(DROPS * files), src)
    sink = scratch_path(spark, "calendar-stream")
    ingest_calendar(spark, src, sink, scratch_path(spark, "calendar-ckpt"), max_files_per_trigger=files).awaitTermination()
    return current_calendar(spark, sink)


# ---- end-to-end cleaning outputs and the model's feature table ---------------------------

@query("etl_listings")
def q_etl_listings(spark, sf):
    """Cleaned listings (33 columns; price float, availability boolean, tags removed)."""
    return listings_clean(spark, sf)


@query("etl_calendar")
def q_etl_calendar(spark, sf):
    return calendar_clean(spark, sf)


@query("etl_reviews")
def q_etl_reviews(spark, sf):
    return reviews_clean(spark, sf)


@query("price_features")
def q_price_features(spark, sf):
    """One row per listing: model features and the mean log price target."""
    return rounded(training_table(spark, sf))
