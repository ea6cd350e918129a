"""Churn model training, evaluation, scoring (batch and stream) and registry."""
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from respawn.operators import gold, ml
from respawn.plans.lakehouse import Lakehouse
from respawn.streaming import silver_stream as sp


@pytest.fixture(scope="module")
def features(spark):
    h = Lakehouse(spark, SF_ORACLE)
    # churn_days=3 gives both label classes at this scale (7 days: 6 of 150 churned)
    return gold.churn_features(h.cleaned, h.sessions, h.purchases, h.as_of, churn_days=3).persist()


def test_split_is_deterministic(features):
    a, b = ml.hash_split(ml.prepare_features(features))
    ids_a = {r[0] for r in a.select("player_id").collect()}
    again, _ = ml.hash_split(ml.prepare_features(features.repartition(7)))
    assert ids_a == {r[0] for r in again.select("player_id").collect()}
    assert a.count() + b.count() == features.count()


@pytest.mark.parametrize("algo,params", [("random_forest", {"num_trees": 10, "max_depth": 5}),
                                         ("logistic_regression", {})])
def test_train_and_score(features, algo, params):
    model, metrics, preds = ml.train_churn_model(features, algo, **params)
    assert 0.0 <= metrics["auc"] <= 1.0 and not math.isnan(metrics["accuracy"])
    assert metrics["tp"] + metrics["fp"] + metrics["tn"] + metrics["fn"] == preds.count()
    review = ml.prediction_review(preds).collect()
    assert all(0.0 <= r["churn_probability"] <= 1.0 for r in review)
    scores = ml.score(model, features, scored_at=F.lit("2024-01-30 03:00:00").cast("timestamp"))
    rows = scores.collect()
    assert len(rows) == features.count() and len(scores.columns) == 10
    assert {r["risk_tier"] for r in rows} <= {"low", "medium", "high"}


def test_one_class_training_is_refused(features):
    with pytest.raises(ValueError, match="single churn_label"):
        ml.train_churn_model(features.withColumn("churn_label", F.lit(0)), "logistic_regression")


def test_registry_and_stream_scoring(spark, features, tmp):
    model, metrics, _ = ml.train_churn_model(features, "logistic_regression")
    run = ml.register_model(spark, model, metrics, {"algorithm": "logistic_regression"}, f"{tmp}/reg")
    ml.promote(spark, f"{tmp}/reg", run["run_id"])
    loaded = ml.load_stage(spark, f"{tmp}/reg", "Production")
    batch = {r["player_id"]: r["churn_probability"] for r in ml.score(loaded, features).collect()}
    features.write.parquet(f"{tmp}/feat")
    stream = spark.readStream.schema(features.schema).parquet(f"{tmp}/feat")
    sp.run_available(sp.score_stream(loaded, stream), f"{tmp}/scored", f"{tmp}/ck")
    streamed = {r["player_id"]: r["churn_probability"] for r in spark.read.parquet(f"{tmp}/scored").collect()}
    assert streamed == batch
    grid = ml.sweep(features, [{"algorithm": "logistic_regression"},
                               {"algorithm": "random_forest", "num_trees": 5, "max_depth": 3}])
    assert len(grid) == 2 and all("auc" in g for g in grid)


def test_confusion_metrics_equal_spark_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.linalg import Vectors
    rows = [(lab, float(pred), Vectors.dense([-s, s])) for lab, pred, s in
            [(1, 1, 0.9), (1, 0, 0.2), (0, 0, -0.5), (0, 1, 0.3), (0, 0, -0.1), (1, 1, 0.4), (0, 0, -0.9)]]
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    schema = StructType([StructField("churn_label", IntegerType()), StructField("prediction", DoubleType()),
                         StructField("rawPrediction", VectorUDT())])
    preds = spark.createDataFrame(rows, schema)
    m = ml.evaluate(preds)
    for name in ("accuracy", "f1"):
        ref = MulticlassClassificationEvaluator(labelCol="churn_label", metricName=name).evaluate(preds)
        assert abs(m[name] - ref) < 1e-12, (name, m[name], ref)
