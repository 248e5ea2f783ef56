"""ML stages on a small learnable fixture: a seeded fit beats the mean
predictor, importances follow the signal, save/load reproduces predictions."""

import pytest
from pyspark.sql import functions as F

from hostlens.operators import ml as ML
from hostlens.plans import price_model as PM


@pytest.fixture(scope="module")
def listings_like(spark):
    df = spark.range(1500).select(
        F.col("id").cast("string").alias("id"),
        ((F.col("id") % 10) + 1).cast("double").alias("accommodates"),
        (F.col("id") % 3).cast("double").alias("num_bedrooms"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 4).cast("double").alias("num_beds"),
        F.lit(1.0).alias("num_bathrooms"), (F.col("id") % 50).cast("double").alias("number_of_reviews"),
        F.lit(4.5).alias("review_scores_rating"), F.lit(1.0).alias("reviews_per_month"),
        ((F.col("id") % 17) / 3.0).alias("distance_to_center_km"), F.lit(5.0).alias("amenities_count"),
        F.lit(2.0).alias("minimum_nights"),
        F.concat(F.lit("n"), (F.col("id") % 5).cast("string")).alias("neighbourhood"),
        F.lit("house").alias("property_type"), F.lit(0).alias("is_private_bath"),
        F.lit(0).alias("is_shared_bath"), F.lit("entire").alias("room_type"))
    # price grows with accommodates and by neighbourhood
    return df.withColumn(PM.LABEL, F.log(F.col("accommodates") * 40 + (F.col("id") % 5) * 15 + 20))


def test_forest_beats_mean(spark, listings_like):
    train, test = PM.split(listings_like)
    model = PM.fit_price_model(train, trees=10, depth=8)
    pred = model.transform(ML.as_double(test, PM.NUMERIC))
    rmse = ML.regression_metrics(pred, PM.LABEL)["rmse"]
    mean = train.agg(F.avg(PM.LABEL)).first()[0]
    base = test.select(F.sqrt(F.avg(F.pow(F.col(PM.LABEL) - F.lit(mean), 2)))).first()[0]
    assert rmse < 0.5 * base
    frame = ML.regression_metrics_frame(pred, PM.LABEL, "prediction").first()
    assert frame["rmse"] == pytest.approx(rmse, rel=1e-9)
    imp = {r["feature"]: r["importance"] for r in ML.feature_importances(
        spark, model, pred, PM.NUMERIC + PM.CATEGORICAL,
        vector_sources={"numeric_features_scaled": PM.NUMERIC}).collect()}
    assert sum(imp.values()) == pytest.approx(1.0)
    assert imp["accommodates"] == max(imp.values())


def test_save_load_identical(spark, listings_like, tmp_path):
    train, _ = PM.split(listings_like)
    model = PM.fit_price_model(train, trees=5, depth=5)
    path = ML.save_model(model, str(tmp_path / "m"))
    again = ML.load_model(path)
    x = ML.as_double(listings_like, PM.NUMERIC)
    a = model.transform(x).select("id", F.col("prediction").alias("a"))
    b = again.transform(x).select("id", F.col("prediction").alias("b"))
    assert a.join(b, "id").where(F.col("a") != F.col("b")).count() == 0


def test_imputer_keeps_fraction_after_cast(spark):
    df = spark.createDataFrame([(1,), (4,), (None,)], "x int")
    out = ML.imputer(["x"]).fit(ML.as_double(df, ["x"])).transform(ML.as_double(df, ["x"]))
    assert sorted(r["x_imputed"] for r in out.collect()) == [1.0, 2.5, 4.0]


def _panel(spark, path, label_of):
    rows = [(str(i), "h", "n", "p", "r", 2, 1, 30, 100.0 + i, label_of(d), 0.5, d, w, h, f"2024-01-{1 + i % 28:02d}")
            for d in (0, 1) for w in (0, 1) for h in (0, 1) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, host_id string, neighbourhood_cleansed string, property_type string, room_type string, "
                               "accommodates int, minimum_nights int, maximum_nights int, price float, label int, occupancy_rate double, "
                               "high_demand int, is_weekend int, hot_region int, date string").withColumn("date", F.col("date").cast("date"))
    df.write.partitionBy("high_demand", "is_weekend", "hot_region").parquet(path)
    return spark.read.parquet(path)


def test_one_label_segments_predict_their_label(spark, tmp_path):
    from hostlens.plans import occupancy_models as OM
    panel = _panel(spark, str(tmp_path / "panel"), lambda d: d)  # low demand all 0, high demand all 1
    models, summary = OM.fit_segment_models(spark, str(tmp_path / "panel"), str(tmp_path / "models"))
    assert {r["status"] for r in summary.collect()} == {"fitted"} and len(models) == 8
    scored = OM.model_predictor(models)(OM.RC.PR.with_actions(OM.RC.with_segment(panel)))
    assert scored.where(F.col("prediction") != F.col("high_demand")).count() == 0


def test_models_load_strictly(spark, tmp_path):
    from hostlens.plans import occupancy_models as OM
    root = tmp_path / "models"
    _panel(spark, str(tmp_path / "panel"), lambda d: d)
    _, summary = OM.fit_segment_models(spark, str(tmp_path / "panel"), str(root))
    summary.coalesce(1).write.option("header", True).csv(str(root / "summary"))
    assert len(OM.load_segment_models(spark, str(root))) == 8
    (root / "model_lowdemand_weekday_hotregion").rename(root / "elsewhere")
    with pytest.raises(Exception):
        OM.load_segment_models(spark, str(root))


def test_too_few_bins_say_so(spark):
    from hostlens.plans import occupancy_models as OM
    rows = spark.range(200).selectExpr("cast(id % 75 as string) neighbourhood_cleansed", "'h' property_type", "'r' room_type", "2 accommodates",
                                       "1 minimum_nights", "30 maximum_nights", "cast(id as float) price", "cast(id % 2 as int) label")
    with pytest.raises(Exception, match="maxBins"):
        OM.fit_segment(rows)
    OM.fit_segment(rows, max_bins=80)


def test_one_training_row_per_listing(spark):
    from hostlens.plans import price_model
    from hostlens.sources.schemas import LISTINGS_DROPPED, LISTINGS_RAW
    names = [f.name for f in LISTINGS_RAW.fields if f.name not in LISTINGS_DROPPED]
    types = {f.name: f.dataType.simpleString() for f in LISTINGS_RAW.fields}
    df = spark.createDataFrame([tuple(v.get(n) for n in names) for v in ({"id": "1", "host_id": "a", "accommodates": 3}, {"id": "1", "host_id": "b", "accommodates": 2})],
                               ", ".join(f"`{n}` {types[n]}" for n in names))
    cal = spark.createDataFrame([("1", "2024-01-01", 100.0, 1)], "listing_id string, date string, price double, minimum_nights int")
    got = price_model.training_table(df, cal).collect()
    assert len(got) == 1 and got[0]["accommodates"] == 2
