"""The command-line jobs end to end on CSV dumps of the bound tables: the
cleaned tables and the panel equal the registered queries' results."""

import os

from pyspark.sql import functions as F

from hostlens import jobs
from hostlens.operators.pricing import ACTIONS
from hostlens.plans import catalog as CT
from hostlens.sources import bindings as B
from hostlens.sources import io

SF = "/root/testdata/sf0.001"


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_jobs_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    etl_dir = tmp_path / "etl"
    io.write_csv(B.listings_raw(spark, SF), str(raw / "listings"))
    io.write_csv(B.calendar_raw(spark, SF), str(raw / "calendar"))
    io.write_csv(B.reviews_raw(spark, SF), str(raw / "reviews"))
    jobs.main(["listings-etl", str(raw / "listings"), str(etl_dir / "listings_parquet")])
    jobs.main(["calendar-etl", str(raw / "calendar"), str(etl_dir / "calendar_parquet")])
    jobs.main(["reviews-etl", str(raw / "reviews"), str(etl_dir / "reviews_parquet")])
    assert same_rows(spark.read.parquet(str(etl_dir / "listings_parquet")), CT.listings_clean(spark, SF))
    assert same_rows(spark.read.parquet(str(etl_dir / "calendar_parquet")), CT.calendar_clean(spark, SF))
    assert same_rows(spark.read.parquet(str(etl_dir / "reviews_parquet")), CT.reviews_clean(spark, SF))

    panel_dir = str(tmp_path / "panel")
    jobs.main(["occupancy-etl", str(etl_dir), panel_dir, "--start", B.PANEL_START, "--end", B.PANEL_END,
               "--hot-cut", "median"])
    written = spark.read.parquet(panel_dir)
    expected = CT.panel(spark, SF).select(*written.columns)
    # region means are sums of doubles in partition order: compare at 6 places
    assert same_rows(CT.rounded(written), CT.rounded(expected))
    folders = [n for n in os.listdir(panel_dir) if not n.startswith((".", "_"))]
    assert folders and all(n.startswith("high_demand=") for n in folders)

    model_dir = str(tmp_path / "models")
    jobs.main(["occupancy-models", panel_dir, model_dir])
    out_csv = str(tmp_path / "recommendation")
    jobs.main(["recommend", panel_dir, model_dir, out_csv])
    best = spark.read.option("header", True).csv(out_csv).collect()
    assert 0 < len(best) <= 8 and all(float(r["best_action"]) in ACTIONS for r in best)

    out = str(tmp_path / "price")
    jobs.main(["price-model", str(etl_dir / "listings_parquet"), str(etl_dir / "calendar_parquet"), out])
    assert spark.read.option("header", True).csv(os.path.join(out, "metrics")).count() == 2

    rep = str(tmp_path / "reviews_report")
    (tmp_path / "stop.txt").write_text("\n".join(B.FIXTURE_STOP_WORDS) + "\n")
    spark.createDataFrame(list(B.FIXTURE_LEXICON.items()), "word string, polarity double").write.parquet(str(tmp_path / "lexicon"))
    jobs.main(["review-analysis", str(etl_dir / "listings_parquet"), str(etl_dir / "reviews_parquet"), rep,
               "--stop-words", str(tmp_path / "stop.txt"), "--lexicon", str(tmp_path / "lexicon")])
    assert spark.read.parquet(os.path.join(rep, "correlations")).count() == 100
    assert spark.read.parquet(os.path.join(rep, "lowest_sentiment")).count() <= 5
    words = {r["term"] for r in spark.read.parquet(os.path.join(rep, "keywords_by_category")).collect()}
    assert words and not words & set(B.FIXTURE_STOP_WORDS)
    plain = str(tmp_path / "plain_report")
    jobs.main(["review-analysis", str(etl_dir / "listings_parquet"), str(etl_dir / "reviews_parquet"), plain])
    words = {r["term"] for r in spark.read.parquet(os.path.join(plain, "keywords_by_category")).collect()}
    assert words and not words & {"the", "of", "and", "to", "in", "is", "that"}


def test_versions_buckets_and_appended_panel(spark, tmp_path, capsys):
    """The same panel from published, bucketed tables, in one go and by drops; one scan of the CSV a job."""
    raw, etl_dir = tmp_path / "raw", tmp_path / "etl"
    io.write_csv(B.listings_raw(spark, SF), str(raw / "listings"))
    io.write_csv(B.calendar_raw(spark, SF), str(raw / "calendar"))
    window = ["--start", B.PANEL_START, "--end", B.PANEL_END]
    for name in ("listings", "calendar"):
        jobs.main([f"{name}-etl", str(raw / name), str(etl_dir / f"{name}_parquet"), "--versions", "--buckets", "4"])
    said = capsys.readouterr().out.splitlines()
    want = CT.QUERIES["rejected_prices"](spark, SF).where("not thousands").first()
    assert said[-1].startswith(f"{want['rejected']} of {want['prices']} prices do not parse")
    per_listing = jobs.table(spark, str(etl_dir / "calendar_parquet")).groupBy("listing_id").count()
    assert "Exchange" not in per_listing._jdf.queryExecution().executedPlan().toString()
    jobs.main(["occupancy-etl", str(etl_dir), str(tmp_path / "panel"), "--versions", "--hot-cut", "median", *window])
    jobs.main(["occupancy-append", str(etl_dir), str(tmp_path / "drops"), "--start", B.PANEL_START, "--end", "1998-02-03"])
    jobs.main(["occupancy-append", str(etl_dir), str(tmp_path / "drops"), "--start", "1998-02-04", "--end", B.PANEL_END])
    jobs.main(["occupancy-export", str(tmp_path / "drops"), str(tmp_path / "exported"), "--hot-cut", "median"])
    expected = CT.rounded(CT.panel(spark, SF))
    for got in (jobs.table(spark, str(tmp_path / "panel")), spark.read.parquet(str(tmp_path / "exported"))):
        assert same_rows(CT.rounded(got.select(*expected.columns)), expected)


def test_reject_counts_come_from_the_pass_that_cleans(spark, tmp_path):
    from hostlens.plans import etl

    io.write_csv(B.calendar_raw(spark, SF), str(tmp_path / "calendar"))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    raw = io.read_csv_table(io.own_session(spark), str(tmp_path / "calendar"), jobs.CALENDAR_RAW, multiline=False)
    raw = raw.mapInArrow(counted, raw.schema)
    df, seen = etl.observed_prices(raw)
    io.write_parquet(etl.clean_calendar(df), str(tmp_path / "out"))
    n = B.calendar_raw(spark, SF).count()
    assert reads.value == n
    assert seen.get == etl.rejected_prices(raw).first().asDict()
