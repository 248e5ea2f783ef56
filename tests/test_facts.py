"""The model keys turn red when a constant takes the place of the model."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

import __spark_entry__ as entry
from checks.compare import compare, duck
from hostlens.operators import ml as ML
from hostlens.plans import occupancy_models as OM
from hostlens.plans import price_model as PM

SF = "/root/testdata/sf0.001"


def constant(value):
    extra = ", array(1.0D, 0.0D) AS probability" if value in (0, 1) else ""
    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, CAST({value} AS DOUBLE) AS prediction{extra} FROM __THIS__")])


@pytest.mark.parametrize("key", ["price_model", "occupancy_model", "segment_models", "score_batch", "price_model_one_split", "reward_grid_one_split"])
def test_a_constant_predictor_is_caught(spark, monkeypatch, key):
    monkeypatch.setattr(OM, "fit_segment", lambda train, *a, **k: constant(0).fit(train))
    monkeypatch.setattr(PM, "fit_price_model", lambda train, *a, **k: constant(train.agg({PM.LABEL: "avg"}).first()[0]).fit(train))
    monkeypatch.setattr(ML, "one_split", lambda *a, **k: constant(0))
    assert not compare(entry.queries()[key](spark, SF), duck(SF), entry.oracle_sql()[key])["match"]
