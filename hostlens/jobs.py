"""Command-line jobs, one per batch step, with input and output paths.

    python -m hostlens.jobs listings-etl   <listings.csv>  <out_dir>
    python -m hostlens.jobs calendar-etl   <calendar.csv>  <out_dir>
    python -m hostlens.jobs reviews-etl    <reviews.csv>   <out_dir>
    python -m hostlens.jobs price-model    <listings_parquet> <calendar_parquet> <out_dir>
    python -m hostlens.jobs review-analysis <listings_parquet> <reviews_parquet> <out_dir>
    python -m hostlens.jobs occupancy-etl  <etl_dir> <panel_dir> [--start D --end D --hot-cut X|median]
    python -m hostlens.jobs occupancy-append <etl_dir> <root>            (continues a panel by the days of a drop)
    python -m hostlens.jobs occupancy-export <root> <panel_dir> [--hot-cut X|median]
    python -m hostlens.jobs occupancy-models <panel_dir> <model_dir>
    python -m hostlens.jobs recommend      <panel_dir> <model_dir> <out_csv_dir>

Every job is a composition of the library's plans; the session comes from
``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .functions import text as T
from .operators import ml as ML
from .operators import pricing as PR
from .plans import etl, occupancy, occupancy_append, occupancy_models, price_model, reviews
from .sources import csv_split, io, layout, versions
from .sources.schemas import CALENDAR_RAW, LISTINGS_RAW, REVIEWS_RAW


def report_prices(counts: dict, thousands: bool) -> None:
    """Prints how many price texts the cleaning has turned into NULL."""
    print(f"{counts['rejected']} of {counts['prices']} prices do not parse" + ("" if thousands else " (--thousands reads '$1,200.00')"))


def table(spark: SparkSession, path: str) -> DataFrame:
    """A table that a job has written: the newest version, if it has any, with its buckets, if it has any."""
    return layout.open_table(spark, versions.resolved(spark, path))


def write(df: DataFrame, out: str, keep: bool = False, buckets: int | None = None, key: str = "", sort: Sequence[str] = ()) -> str:
    """``df`` as a table at ``out``; ``keep``: as the next version of it, beside the earlier ones."""
    def to(path: str) -> str:
        return layout.write_bucketed(df, path, key, buckets, sort) if buckets else io.write_parquet(df, path)

    if keep:
        versions.publish_with(df.sparkSession, out, to)
    else:
        to(out)
    return out


# The two jobs that observe what they clean do so in a session of their own: a session that has observed anything
# can't run the models' functions any more (they take the session along, and its observations can't be sent).


def listings_etl(spark: SparkSession, csv_path: str, out: str, partitions: int | None = None,
                 thousands: bool = False, keep: bool = False, buckets: int | None = None) -> str:
    spark = io.own_session(spark)
    raw, seen = etl.observed_prices(csv_split.read_csv_split(spark, csv_path, LISTINGS_RAW, tasks=partitions), thousands=thousands)
    write(etl.clean_listings(raw, thousands=thousands), out, keep, buckets, "id")
    report_prices(seen.get, thousands)
    return out


def calendar_etl(spark: SparkSession, csv_path: str, out: str, partitions: int | None = None,
                 thousands: bool = False, keep: bool = False, buckets: int | None = None) -> str:
    # no free text: rows are lines, so Spark's own reader splits the file
    spark = io.own_session(spark)
    raw = io.read_csv_table(spark, csv_path, CALENDAR_RAW, multiline=False, partitions=partitions)
    raw, seen = etl.observed_prices(raw, thousands=thousands)
    write(etl.clean_calendar(raw, thousands=thousands), out, keep, buckets, "listing_id", ["date"])
    report_prices(seen.get, thousands)
    return out


def reviews_etl(spark: SparkSession, csv_path: str, out: str, partitions: int | None = None, keep: bool = False) -> str:
    raw = csv_split.read_csv_split(spark, csv_path, REVIEWS_RAW, tasks=partitions)
    return write(etl.clean_reviews(raw), out, keep)


def price_model_job(spark: SparkSession, listings_path: str, calendar_path: str, out: str, keep: bool = False) -> str:
    listings, calendar = table(spark, listings_path), table(spark, calendar_path)
    rows = price_model.stored_table(listings, calendar)
    model, metrics = price_model.train_and_evaluate(listings, calendar, table=rows)
    scored = model.transform(ML.as_double(rows.where("split = 'train'").drop("split"), price_model.NUMERIC))
    importance = ML.feature_importances(spark, model, scored, price_model.NUMERIC + price_model.CATEGORICAL,
                                        vector_sources={"numeric_features_scaled": price_model.NUMERIC})

    def to(path: str) -> None:
        metrics.write.mode("overwrite").option("header", True).csv(os.path.join(path, "metrics"))
        importance.write.mode("overwrite").option("header", True).csv(os.path.join(path, "feature_importance"))
        ML.save_model(model, os.path.join(path, "model"))

    if keep:
        versions.publish_with(spark, out, to)
    else:
        to(out)
    return out


def review_analysis_job(spark: SparkSession, listings_path: str, reviews_path: str, out: str,
                        stop_words: str | None = None, lexicon: str | None = None) -> str:
    """``stop_words``: a text file of one word per line (default: the English list; an empty file means none).
    ``lexicon``: a Parquet table (word, polarity), joined in (default: the small built-in one)."""
    stop_words = T.english_stop_words() if stop_words is None else [r.value.strip() for r in spark.read.text(stop_words).collect() if r.value.strip()]
    words = spark.read.parquet(lexicon) if lexicon else T.DEFAULT_LEXICON
    comments = reviews.comment_rows(table(spark, listings_path), table(spark, reviews_path), words,
                                    keep_review_id=True)
    comments = io.parquet_roundtrip(comments, "comment-rows")  # one scoring pass feeds every report
    reports = {
        "correlations": reviews.score_correlations(comments),
        "category_means": reviews.category_score_means(comments),
        "keywords_by_category": reviews.keywords_by_category(comments, stop_words=stop_words),
        "keywords_negative": reviews.negative_keywords(comments, stop_words=stop_words),
        "lowest_sentiment": reviews.lowest_sentiment(comments).select("id", "date", "comments", "sentiment_score"),
        "geo_grid": reviews.geo_sentiment_grid(comments),
    }
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(os.path.join(out, name))
    return out


def occupancy_etl(spark: SparkSession, etl_dir: str, out: str, start: str = occupancy.DEFAULT_START,
                  end: str = occupancy.DEFAULT_END, hot_cut: float | None = occupancy.HOT_REGION_CUT, keep: bool = False) -> str:
    listings = table(spark, os.path.join(etl_dir, "listings_parquet"))
    calendar = table(spark, os.path.join(etl_dir, "calendar_parquet"))
    panel = occupancy.occupancy_panel(listings, calendar, start, end, hot_cut)
    if keep:
        versions.publish_with(spark, out, lambda path: occupancy.write_panel(panel, path))
        return out
    return occupancy.write_panel(panel, out)


def occupancy_append_job(spark: SparkSession, etl_dir: str, root: str, start: str = occupancy.DEFAULT_START,
                         end: str = occupancy.DEFAULT_END) -> str:
    """Continues the panel at ``root`` by the days of the calendar in ``etl_dir``."""
    late = occupancy_append.append(spark, root, table(spark, os.path.join(etl_dir, "listings_parquet")),
                                   table(spark, os.path.join(etl_dir, "calendar_parquet")), start, end)
    print(f"{late} rows were not later than their listing's last day and are left out")
    return root


def occupancy_export_job(spark: SparkSession, root: str, out: str, hot_cut: float | None = occupancy.HOT_REGION_CUT, keep: bool = False) -> str:
    """Writes the continued panel at ``root`` as the partitioned panel that the models read."""
    panel = occupancy_append.read_panel(spark, root, hot_cut)
    if keep:
        versions.publish_with(spark, out, lambda path: occupancy.write_panel(panel, path))
        return out
    return occupancy.write_panel(panel, out)


def occupancy_models_job(spark: SparkSession, panel_dir: str, model_dir: str, keep: bool = False) -> str:
    panel = versions.resolved(spark, panel_dir)

    def to(path: str) -> None:
        _, summary = occupancy_models.fit_segment_models(spark, panel, path)
        summary.write.mode("overwrite").option("header", True).csv(os.path.join(path, "summary"))

    if keep:
        versions.publish_with(spark, model_dir, to)
    else:
        to(model_dir)
    return model_dir


def recommend_job(spark: SparkSession, panel_dir: str, model_dir: str, out: str) -> str:
    models = occupancy_models.load_segment_models(spark, versions.resolved(spark, model_dir))
    grid = occupancy_models.model_reward_grid(table(spark, panel_dir), models)
    best = PR.best_action(PR.lookahead_value(grid))
    best.coalesce(1).write.mode("overwrite").option("header", True).csv(out)
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="hostlens.jobs")
    ap.add_argument("job")
    ap.add_argument("paths", nargs="+")
    ap.add_argument("--start", default=occupancy.DEFAULT_START)
    ap.add_argument("--end", default=occupancy.DEFAULT_END)
    ap.add_argument("--hot-cut", default=str(occupancy.HOT_REGION_CUT))
    ap.add_argument("--partitions", type=int, default=None)
    ap.add_argument("--thousands", action="store_true", help="read '$1,200.00' as 1200; otherwise it is NULL")
    ap.add_argument("--stop-words", default=None, help="text file, one word per line")
    ap.add_argument("--lexicon", default=None, help="Parquet table (word, polarity)")
    ap.add_argument("--versions", action="store_true", help="publish the output as a new version beside the earlier ones")
    ap.add_argument("--buckets", type=int, default=None, help="store listings and calendar in this many buckets of the listing id")
    ap.add_argument("--checkpoint-dir", default=None, help="shared scratch folder, if spark.checkpoint.dir is unset")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"hostlens {a.job}").getOrCreate()
    if a.checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", a.checkpoint_dir)
    p, cut = a.paths, None if a.hot_cut == "median" else float(a.hot_cut)
    if a.job == "listings-etl":
        listings_etl(spark, p[0], p[1], a.partitions, a.thousands, a.versions, a.buckets)
    elif a.job == "calendar-etl":
        calendar_etl(spark, p[0], p[1], a.partitions, a.thousands, a.versions, a.buckets)
    elif a.job == "reviews-etl":
        reviews_etl(spark, p[0], p[1], a.partitions, a.versions)
    elif a.job == "price-model":
        price_model_job(spark, p[0], p[1], p[2], a.versions)
    elif a.job == "review-analysis":
        review_analysis_job(spark, p[0], p[1], p[2], a.stop_words, a.lexicon)
    elif a.job == "occupancy-etl":
        occupancy_etl(spark, p[0], p[1], a.start, a.end, cut, a.versions)
    elif a.job == "occupancy-append":
        occupancy_append_job(spark, p[0], p[1], a.start, a.end)
    elif a.job == "occupancy-export":
        occupancy_export_job(spark, p[0], p[1], cut, a.versions)
    elif a.job == "occupancy-models":
        occupancy_models_job(spark, p[0], p[1], a.versions)
    elif a.job == "recommend":
        recommend_job(spark, p[0], p[1], p[2])
    else:
        raise SystemExit(f"unknown job {a.job}")


if __name__ == "__main__":
    main()
