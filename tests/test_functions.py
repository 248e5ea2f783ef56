"""Edge rows for the column functions (see FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hostlens.functions import numeric as N
from hostlens.functions import parsing as P
from hostlens.functions import text as T


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def collect(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_parse_flag(spark):
    df = one_col(spark, ["t", "f", "x", None])
    assert collect(df, P.parse_flag("v")) == [True, False, None, None]


def test_parse_money(spark):
    df = one_col(spark, ["$80.00", "$1,200.00", "", None])
    assert collect(df, P.parse_money("v")) == [80.0, None, None, None]
    assert collect(df, P.parse_money_thousands("v")) == [80.0, 1200.0, None, None]


def test_strip_breaks(spark):
    df = one_col(spark, ["a<br/>b<br>c<br/ >d", "x<br />y", "x<BR>y"])
    assert collect(df, P.strip_breaks("v")) == ["abcd", "x<br />y", "x<BR>y"]


def test_bathrooms_and_flags(spark):
    df = one_col(spark, ["1.5 shared baths", "Half-bath", "Private half-bath", "2 private baths", None])
    assert collect(df, P.bathroom_count("v")) == [1.5, None, None, 2.0, None]
    assert collect(df, P.contains_flag("v", "private")) == [0, 0, 0, 1, 0]
    assert collect(df, P.contains_flag("v", "shared")) == [1, 0, 0, 0, 0]


def test_amenity_count(spark):
    df = one_col(spark, ["[]", None, '["Wifi", "TV"]', '["Pots, pans", "TV"]'])
    assert collect(df, P.amenity_count("v")) == [-1, -1, 2, 3]
    assert collect(df, P.amenity_count("v", json=True)) == [-1, -1, 2, 2]


def test_log_price(spark):
    df = one_col(spark, [0.0, -3.0, 1.0], "double")
    assert collect(df, N.log_price("v")) == [None, None, 0.0]


def test_haversine_centre_is_zero(spark):
    df = spark.createDataFrame([(N.CENTRE_LAT, N.CENTRE_LON)], "lat double, lon double")
    assert collect(df, N.haversine_km("lat", "lon")) == [pytest.approx(0.0, abs=1e-9)]


def test_haversine_known_distance(spark):
    # one degree of latitude on a 6371 km sphere
    df = spark.createDataFrame([(0.0, 0.0)], "lat double, lon double")
    km = collect(df, N.haversine_km("lat", "lon", centre_lat=1.0, centre_lon=0.0))[0]
    assert km == pytest.approx(6371.0 * 3.141592653589793 / 180, rel=1e-9)


def test_weekend_flag(spark):
    df = one_col(spark, [dt.date(2024, 9, 6), dt.date(2024, 9, 7), dt.date(2024, 9, 8)], "date")
    assert collect(df, N.weekend_flag("v")) == [1, 1, 0]


def test_rental_label(spark):
    df = one_col(spark, [True, False, None], "boolean")
    assert collect(df, N.rental_label("v")) == [0, 1, 1]


def test_clean_comments(spark):
    text = "\n bring <br/>snacks<br /> "
    df = one_col(spark, [text, None])
    assert collect(df, T.clean_comments("v")) == ["bring snacks", None]
    # the old cleaner: str.replace("br", "").strip()
    assert collect(df, T.clean_comments_compat("v")) == [text.replace("br", "").strip(), None]


def test_english_filter(spark):
    texts = [None, "café", "great \U0001F600", "we love la", "die hard", "we love LA",
             '<p title="é">ok</p>', "<b>plain</b> text"]
    df = one_col(spark, texts)
    assert collect(df, T.is_english("v")) == [False, False, False, False, False, True, False, True]
    assert collect(df, T.is_ascii_text("v")) == [False, False, False, True, True, True, True, True]


def test_tokens(spark):
    df = one_col(spark, ["Hello, WORLD! a b2 x_y 42"])
    assert collect(df, T.tokens("v")) == [["hello", "world", "b2", "x_y", "42"]]


def test_sentiment_with_negation(spark):
    lex = {"good": 0.5, "bad": -1.0}
    df = one_col(spark, ["good good bad", "not good", "nothing here", "not"])
    scores = collect(df, T.sentiment_from_tokens(T.tokens(F.col("v")), lex, ["not"]))
    assert scores == [pytest.approx(0.0), pytest.approx(-0.5), 0.0, 0.0]


def test_sentiment_category(spark):
    df = one_col(spark, [0.2, -0.2, 0.21, -0.21], "double")
    assert collect(df, T.sentiment_category("v")) == ["neutral", "neutral", "positive", "negative"]
