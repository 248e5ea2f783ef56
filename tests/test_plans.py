"""The plan shapes the scale design relies on (guards against regressions)."""

import contextlib
import io as _io
import re

from pyspark.sql import functions as F

from hostlens.operators import clean as C
from hostlens.operators import pricing as PR
from hostlens.operators import text as TX
from hostlens.operators import windows as W


def plan(df) -> str:
    buf = _io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchanges(text):
    return re.findall(r"^Arguments: (hashpartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|SinglePartition)",
                      text, re.M)


def table(spark, tmp_path, df, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_sentiment_is_row_local(spark, tmp_path):
    t = table(spark, tmp_path, spark.createDataFrame([(1, "good not bad")], "i int, s string"), "t")
    p = plan(TX.with_sentiment(t, "s"))
    assert exchanges(p) == [] and "Python" not in p


def test_occupancy_windows_share_one_shuffle(spark, tmp_path):
    rows = [(str(i % 5), f"2024-01-{1 + i % 28:02d}", i % 2) for i in range(100)]
    t = table(spark, tmp_path, spark.createDataFrame(rows, "id string, date string, label int")
              .withColumn("date", F.col("date").cast("date")), "w")
    p = plan(W.cumulative_occupancy(t))
    ex = exchanges(p)
    assert len(ex) == 1 and ex[0].startswith("hashpartitioning(id")
    assert len(re.findall(r"^\(\d+\) Sort\b", p, re.M)) == 1


def test_dedup_combines_before_the_shuffle(spark, tmp_path):
    t = table(spark, tmp_path, spark.createDataFrame([("a", 1, "x")], "k string, a int, b string"), "d")
    p = plan(C.dedup(t, ["k"]))
    assert len(exchanges(p)) == 1
    assert p.index("partial_min") > p.index("Exchange")  # listed below it: runs before it


def test_action_grid_aggregates_map_side(spark, tmp_path):
    rows = [(10.0, 1, 0, 1, 0, 0, "lowdemand_weekday_nothotregion")]
    t = table(spark, tmp_path, spark.createDataFrame(
        rows, "price double, label int, prediction int, high_demand int, is_weekend int, hot_region int, "
              "segment string"), "g")
    grid = PR.reward_grid(PR.with_actions(t).withColumn("reward", PR.reward()))
    p = plan(grid)
    assert "Generate" in p and "partial_avg" in p and len(exchanges(p)) == 1
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_tfidf_never_shuffles_by_document(spark, tmp_path):
    t = table(spark, tmp_path, spark.createDataFrame([(i, "alpha beta gamma alpha") for i in range(20)],
                                                     "doc int, text string"), "x")
    p = plan(TX.tfidf_keywords(t, "doc", "text", None, 2))
    assert all("doc" not in e for e in exchanges(p))
