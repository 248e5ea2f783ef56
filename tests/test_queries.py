"""Every registered query on the smallest driver tables: the SQL-expressible
ones must equal their DuckDB oracle, the others must run; plus invariants."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks.compare import compare, duck
from hostlens.operators.pricing import ACTIONS
from hostlens.plans import catalog as CT

SF = "/root/testdata/sf0.001"
QUERIES = CT.QUERIES
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["neighbourhood_cleansed", "avg_occupancy_rate"]
    assert df.count() > 0


def test_every_key_has_a_check():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 70


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = compare(QUERIES[key](spark, SF), con, ORACLE[key])
    assert r["match"], r


def test_only_the_optional_operators_have_no_sql():
    assert set(CT.QUERIES) <= set(ORACLE)


def test_invariants(spark):
    cal = CT.calendar_clean(spark, SF)
    assert cal.groupBy("listing_id", "date").count().where("count > 1").count() == 0
    panel = CT.panel(spark, SF)
    bad = panel.where((F.col("occupancy_rate") < 0) | (F.col("occupancy_rate") > 1)).count()
    assert bad == 0
    seg_rows = panel.groupBy("high_demand", "is_weekend", "hot_region").count().agg(F.sum("count")).first()[0]
    assert seg_rows == panel.count()
    best = CT.QUERIES["best_action"](spark, SF).collect()
    assert best and all(r["best_action"] in ACTIONS for r in best)


def test_forced_salting_keeps_results(spark, con):
    """Every listing with >= 2 reviews treated as hot: same rows as the oracle."""
    from hostlens.plans import reviews as RV
    from hostlens.sources import bindings as B
    c = RV.comment_rows(CT.listings_clean(spark, SF), CT.reviews_clean(spark, SF), B.FIXTURE_LEXICON,
                        B.FIXTURE_NEGATORS, keep_review_id=True, hot_listing_reviews=2)
    r = compare(CT.rounded(c.select("review_id", "id", "sentiment_score")), con, ORACLE["sentiment_score"])
    assert r["match"], r
    r = compare(c.select("review_id", "id", "date", "review_count"), con, ORACLE["join_left_count"])
    assert r["match"], r
