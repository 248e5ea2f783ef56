"""One occupancy classifier per market segment, and model-based rewards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ml as ML
from ..operators import pricing as PR
from ..operators.label_index import bounded_indexers
from ..operators.sampling import key_split
from ..sources import io
from . import recommend as RC

# fixed values: the classifier's columns and its bins
CATEGORICAL = ["neighbourhood_cleansed", "property_type", "room_type"]
NUMERIC = ["accommodates", "minimum_nights", "maximum_nights", "price"]
MAX_BINS = 60
SEGMENTS = [(d, w, h) for d in (0, 1) for w in (0, 1) for h in (0, 1)]


def segment_name(high_demand: int, is_weekend: int, hot_region: int) -> str:
    return "_".join(["highdemand" if high_demand else "lowdemand",
                     "weekend" if is_weekend else "weekday",
                     "hotregion" if hot_region else "nothotregion"])


def segment_rows(spark: SparkSession, panel_root: str, seg: tuple[int, int, int]) -> DataFrame:
    d, w, h = seg
    return io.read_segment(spark, panel_root, high_demand=d, is_weekend=w, hot_region=h)


def split_rows(df: DataFrame, train_fraction: float = 0.75, seed: int = 42, bucket: Column | None = None):
    s = key_split(df, train_fraction, ["id", "date"], seed, bucket=bucket)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "test").drop("split")


def fit_segment(train: DataFrame, handle_invalid: str = "keep", seed: int = 42, max_bins: int = MAX_BINS):
    """The forest of one segment, also where all its rows have one label (it then predicts that label).

    ``max_bins`` must reach the number of labels of every categorical column plus the bucket of unseen ones,
    which is checked before any label comes to the driver.  It is not raised by itself, because the splits of the numeric columns,
    and so the model, depend on it.
    """
    indexers = bounded_indexers(train, CATEGORICAL, max_bins, "_indexed", handle_invalid)
    return ML.occupancy_classifier_stages(CATEGORICAL, NUMERIC, handle_invalid=handle_invalid, seed=seed,
                                          max_bins=max_bins, indexers=indexers).fit(ML.spread_rows(train))


def fit_segment_models(spark: SparkSession, panel_root: str, model_root: str | None = None,
                       train_fraction: float = 0.75, seed: int = 42, handle_invalid: str = "keep",
                       concurrency: int = len(SEGMENTS), max_bins: int = MAX_BINS, bucket: Column | None = None):
    """Fit one pipeline per segment that has training rows.  The segment set is
    fixed (8), each fit is a distributed job, and up to ``concurrency`` fits
    (default: all 8) run at once so small segments do not leave the cluster
    idle.  Returns ``({segment: model}, summary rows)``: status (``fitted``,
    ``no rows``, or ``no training rows`` where all rows fell in the test
    part), accuracy on the test part (NULL without one), accuracy on the
    training part and the share of that part's more frequent label."""
    from concurrent.futures import ThreadPoolExecutor

    def fit_one(seg):
        name = segment_name(*seg)
        rows = key_split(segment_rows(spark, panel_root, seg), train_fraction, ["id", "date"], seed, bucket=bucket)
        train = rows.where("split = 'train'").drop("split")
        if train.isEmpty():
            return name, None, ("no rows" if rows.isEmpty() else "no training rows", None, None, None)
        model = fit_segment(train, handle_invalid, seed, max_bins)
        if model_root:
            ML.save_model(model, f"{model_root}/model_{name}")
        hit = (F.col("prediction") == F.col("label")).cast("int")
        of = {r["split"]: r for r in model.transform(rows).groupBy("split").agg(F.avg(hit).alias("hits"), F.avg("label").alias("ones")).collect()}
        ones = of["train"]["ones"]
        return name, model, ("fitted", of["test"]["hits"] if "test" in of else None, of["train"]["hits"], max(ones, 1 - ones))

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        results = list(pool.map(fit_one, SEGMENTS))
    models = {name: m for name, m, _ in results if m is not None}
    return models, spark.createDataFrame([(name, *found) for name, _, found in results],
                                         "segment string, status string, accuracy double, train_accuracy double, train_majority double")


def load_segment_models(spark: SparkSession, model_root: str) -> dict:
    """The models that the saved summary calls fitted; a missing or unreadable one is an error."""
    summary = spark.read.option("header", True).csv(f"{model_root}/summary").collect()
    return {r["segment"]: ML.load_model(f"{model_root}/model_{r['segment']}") for r in summary if r["status"] == "fitted"}


def _segment_filter(name: str):
    flags = {segment_name(*seg): seg for seg in SEGMENTS}[name]
    return ((F.col("high_demand") == flags[0]) & (F.col("is_weekend") == flags[1])
            & (F.col("hot_region") == flags[2]))


def model_predictor(models: dict):
    """``predict(df)``: each segment's rows scored by its own model at the
    new price.  Rows of segments without a model are left out: nothing is
    known of them, so they have neither a reward nor a recommendation.

    Segments are selected on the three flag columns, so when ``df`` comes
    from the partitioned panel each branch reads only its own folder.
    """
    def predict(df: DataFrame) -> DataFrame:
        base = df.withColumn("__orig_price", F.col("price"))
        out = base.where(F.lit(False)).withColumn("prediction", F.lit(0))
        for name, model in models.items():
            part = base.where(_segment_filter(name)).withColumn("price", F.col("new_price").cast("float"))
            scored = model.transform(part).select(*base.columns, F.col("prediction").cast("int").alias("prediction"))
            out = out.unionByName(scored)
        return out.withColumn("price", F.col("__orig_price")).drop("__orig_price")
    return predict


def model_reward_grid(panel: DataFrame, models: dict) -> DataFrame:
    scored = RC.model_scored(panel, model_predictor(models))
    return PR.reward_grid(scored)
