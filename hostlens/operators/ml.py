"""Spark ML stages: imputation, scaling, indexing, encoding, random forests,
evaluation, feature importances, persistence and batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Training-speed settings (same trees): keep each row's node id cached between
# levels instead of re-walking the trees (checkpointed to the shared
# checkpoint folder every 10 levels). Each task of an executor holds the
# statistics of the nodes that share a pass, beside the cached rows: a level
# of more nodes takes several passes.
FOREST_TRAINING = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 64}


# A forest keeps its training rows in memory, some hundred bytes each, and reads them all at every level.
ROWS_PER_TASK = 200_000


def spread_rows(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` as it is if no partition has more than ``most`` rows, else dealt out evenly to partitions of no more.

    Stored rows of few distinct values take a few bytes each, so a scan puts millions of them into one partition.
    One pass counts the rows; ``df`` should be stored.
    """
    most = most or ROWS_PER_TASK
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count()
    largest, rows = sizes.agg(F.max("count"), F.sum("count")).first()
    if (largest or 0) <= most:
        return df
    return df.repartition(max(-(-rows // most), df.sparkSession.sparkContext.defaultParallelism))


def as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Imputer keeps an integer input integer (mean 2.5 -> 2); cast first."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def imputer(columns: Sequence[str], suffix: str = "_imputed", strategy: str = "mean") -> Imputer:
    return Imputer(inputCols=list(columns), outputCols=[c + suffix for c in columns], strategy=strategy)


def scaler(input_col: str, output_col: str) -> StandardScaler:
    """Divide by the sample standard deviation, no centring."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=False)


def indexers(columns: Sequence[str], suffix: str = "_index", handle_invalid: str = "keep") -> StringIndexer:
    """Most frequent label -> 0 (ties alphabetical); ``keep`` gives unseen
    labels and NULLs one extra index instead of failing."""
    return StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def one_hot(columns: Sequence[str], in_suffix: str = "_index", out_suffix: str = "_ohe") -> OneHotEncoder:
    return OneHotEncoder(inputCols=[c + in_suffix for c in columns], outputCols=[c + out_suffix for c in columns])


def price_regression_stages(numeric: Sequence[str], categorical: Sequence[str], label: str,
                            trees: int = 15, depth: int = 20, seed: int = 42) -> Pipeline:
    """Impute -> assemble -> scale numerics; index -> one-hot categoricals;
    assemble all; random-forest regression."""
    imputed = [c + "_imputed" for c in numeric]
    return Pipeline(stages=[
        imputer(numeric),
        VectorAssembler(inputCols=imputed, outputCol="numeric_features"),
        scaler("numeric_features", "numeric_features_scaled"),
        indexers(categorical),
        one_hot(categorical),
        VectorAssembler(inputCols=["numeric_features_scaled"] + [c + "_ohe" for c in categorical],
                        outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed,
                              **FOREST_TRAINING),
    ])


def occupancy_classifier_stages(categorical: Sequence[str], numeric: Sequence[str], label: str = "label",
                                max_bins: int = 60, handle_invalid: str = "keep", seed: int = 42,
                                trees: int = 20, depth: int = 5, indexers: Sequence = ()) -> Pipeline:
    """Index categoricals (with ``indexers``, if they are fitted already), assemble with numerics, random-forest
    classifier."""
    idx = [c + "_indexed" for c in categorical]
    return Pipeline(stages=[
        *(indexers or [StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid=handle_invalid)]),
        VectorAssembler(inputCols=idx + list(numeric), outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol=label, maxBins=max_bins, seed=seed,
                               numTrees=trees, maxDepth=depth, **FOREST_TRAINING),
    ])


def one_split(features: Sequence[str], label: str, classes: bool, max_bins: int = 128) -> Pipeline:
    """A forest of one tree with one split, grown on all rows and features: as long as no feature has more than
    ``max_bins`` values, its split is the best there is, so its predictions can be told without Spark."""
    forest = RandomForestClassifier if classes else RandomForestRegressor
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        forest(featuresCol="features", labelCol=label, numTrees=1, maxDepth=1, maxBins=max_bins, bootstrap=False,
               featureSubsetStrategy="all", subsamplingRate=1.0, seed=1),
    ])


def regression_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> dict:
    """R^2 and RMSE with Spark's evaluator."""
    ev = RegressionEvaluator(labelCol=label, predictionCol=prediction)
    return {"r2": ev.setMetricName("r2").evaluate(predictions),
            "rmse": ev.setMetricName("rmse").evaluate(predictions)}


def regression_metrics_frame(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """R^2 and RMSE as one aggregate per group (same formulas as the evaluator:
    ``1 - SSE/SST`` and ``sqrt(SSE/n)``)."""
    err = F.pow(F.col(label) - F.col(prediction), 2)
    return df.groupBy(*by).agg(
        (1 - F.sum(err) / (F.count(F.col(label)) * F.var_pop(label))).alias("r2"),
        F.sqrt(F.avg(err)).alias("rmse"),
        F.count(F.lit(1)).alias("n"))


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName="accuracy")
    return ev.evaluate(predictions)


def accuracy_frame(df: DataFrame, label: str = "label", prediction: str = "prediction",
                   by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def slot_names(df: DataFrame, features: str = "features") -> list[str]:
    """Vector slot names from the ``ml_attr`` metadata of a features column."""
    meta = df.schema[features].metadata.get("ml_attr", {})
    names = [None] * int(meta.get("num_attrs", 0))
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"slot_{a['idx']}")
    return [n if n is not None else f"slot_{i}" for i, n in enumerate(names)]


def feature_importances(spark: SparkSession, model: PipelineModel, scored: DataFrame,
                        sources: Sequence[str], features: str = "features",
                        vector_sources: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(feature, importance) per source column, sorted by absolute importance
    (descending).

    Slots are attributed through the ``ml_attr`` names of the features
    column: ``<source>_ohe_<label>`` / ``<source>_imputed`` style names map to
    their source; slots of an unnamed inner vector (``<vec>_<i>``, e.g. the
    scaled numeric block) map by position through ``vector_sources``.
    One-hot slots of a column are summed.
    """
    imp = model.stages[-1].featureImportances.toArray().tolist()
    names = slot_names(scored, features)
    vector_sources = dict(vector_sources or {})
    totals = {s: 0.0 for s in sources}
    by_length = sorted(sources, key=len, reverse=True)
    for name, value in zip(names, imp):
        owner = None
        for vec, members in vector_sources.items():
            if name.startswith(vec + "_") and name[len(vec) + 1:].isdigit():
                i = int(name[len(vec) + 1:])
                owner = members[i] if i < len(members) else None
                break
        if owner is None:
            owner = next((s for s in by_length if name == s or name.startswith(s + "_")), None)
        if owner is not None:
            totals[owner] += value
    df = spark.createDataFrame([(k, float(v)) for k, v in totals.items()], "feature string, importance double")
    return df.orderBy(F.abs(F.col("importance")).desc(), F.col("feature"))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
