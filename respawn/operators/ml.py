"""Churn model: features, split, training, evaluation, registry, scoring.

Spark ML does the distributed work (StringIndexer, VectorAssembler,
RandomForestClassifier / LogisticRegression are all distributed estimators;
tree statistics are aggregated per partition and merged). Training and
scoring share one ``prepare_features`` so NULL handling cannot drift between
them. The split is a hash of the player id (stable under any partitioning).
Probability extraction uses the built-in ``vector_to_array`` -- no Python UDF.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from respawn.constants import (CATEGORICAL_COLUMNS, FEATURE_COLUMNS, LR_MAX_ITER, RF_MAX_DEPTH,
                               RF_NUM_TREES, SPLIT_SEED, TRAIN_FRACTION)
from respawn.functions.exact import exact_div
from respawn.functions.quantiles import auc
from respawn.operators.bi import SCORE_COLUMNS, risk_tier

LABEL = "churn_label"


def prepare_features(features: DataFrame, with_label: bool = True) -> DataFrame:
    """L1: the model's input columns, numeric NULLs -> 0, categorical NULLs -> 'Unknown'."""
    cols = ["player_id"] + ([LABEL] if with_label else []) + CATEGORICAL_COLUMNS + FEATURE_COLUMNS
    extra = [c for c in ("compute_date",) if c in features.columns]
    return (features.select(*cols, *extra)
            .fillna(0, subset=FEATURE_COLUMNS)
            .fillna({c: "Unknown" for c in CATEGORICAL_COLUMNS}))


def split_flag(seed: int = SPLIT_SEED, train_fraction: float = TRAIN_FRACTION):
    """L2: True for training rows: first 32 bits of md5(player_id:seed) mod 100 < 70.

    Unlike ``randomSplit`` it depends neither on partitioning nor on row order,
    and any SQL engine with md5 reproduces it.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.col("player_id"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(100)) < F.lit(int(train_fraction * 100))


def hash_split(df: DataFrame, seed: int = SPLIT_SEED, train_fraction: float = TRAIN_FRACTION):
    flag = split_flag(seed, train_fraction)
    return df.where(flag), df.where(~flag)


def build_pipeline(algorithm: str = "random_forest", max_depth: int = RF_MAX_DEPTH,
                   num_trees: int = RF_NUM_TREES, seed: int = SPLIT_SEED) -> Pipeline:
    """Index categoricals (unseen kept), assemble 13 features, estimator."""
    index_cols = [c.replace("_primary", "_index") for c in CATEGORICAL_COLUMNS]
    # one multi-column indexer: both vocabularies in a single pass
    indexer = StringIndexer(inputCols=CATEGORICAL_COLUMNS, outputCols=index_cols, handleInvalid="keep")
    assembler = VectorAssembler(inputCols=FEATURE_COLUMNS + index_cols, outputCol="features",
                                handleInvalid="keep")
    if algorithm == "logistic_regression":
        est = LogisticRegression(featuresCol="features", labelCol=LABEL, maxIter=LR_MAX_ITER)
    elif algorithm == "random_forest":
        # cacheNodeIds keeps each row's node assignment instead of re-deriving it
        # every level (same model; faster for deep trees); its lineage is cut by
        # periodic checkpoints in spark.checkpoint.dir.
        est = RandomForestClassifier(featuresCol="features", labelCol=LABEL, maxDepth=max_depth,
                                     numTrees=num_trees, seed=seed, cacheNodeIds=True,
                                     checkpointInterval=10)
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    return Pipeline(stages=[indexer, assembler, est])


def evaluate(predictions: DataFrame) -> dict:
    """AUC, accuracy and (label-weighted) F1, plus the confusion counts.

    AUC needs the ranking evaluator; accuracy and F1 follow from the 2x2
    confusion counts, taken with one grouped aggregate.
    """
    auc = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction",
                                        metricName="areaUnderROC", numBins=0).evaluate(predictions)  # every score is a point
    cm = {(int(r[0]), int(r[1])): int(r[2]) for r in
          predictions.groupBy(LABEL, F.col("prediction").cast("int")).count().collect()}
    tp, fp, tn, fn = cm.get((1, 1), 0), cm.get((0, 1), 0), cm.get((0, 0), 0), cm.get((1, 0), 0)
    n = tp + fp + tn + fn

    def f1(hit, pred, actual):
        p = hit / pred if pred else 0.0
        r = hit / actual if actual else 0.0
        return 2 * p * r / (p + r) if p + r else 0.0

    weighted_f1 = ((tp + fn) * f1(tp, tp + fp, tp + fn) + (tn + fp) * f1(tn, tn + fn, tn + fp)) / n if n else 0.0
    return {"auc": auc, "accuracy": (tp + tn) / n if n else 0.0, "f1": weighted_f1,
            "tp": tp, "fp": fp, "tn": tn, "fn": fn}


def check_label_classes(train: DataFrame) -> None:
    """Both label values must be present; a one-class set cannot train a classifier."""
    n = train.agg(F.count_distinct(LABEL).alias("n")).first()["n"]
    if n < 2:
        raise ValueError("training data has a single churn_label value; "
                         "pick another cut-off or churn_days so both classes occur")


def detach_summaries(model: PipelineModel) -> PipelineModel:
    """Drop the training summaries of fitted stages.

    A summary references the SparkSession, which stops being serializable once
    an Observation (used by the data-quality engine) exists in the session;
    every ``transform`` closure captures the model, so keeping it breaks
    scoring. Metrics are computed from predictions instead (:func:`evaluate`).
    """
    from pyspark import SparkContext
    none = SparkContext._active_spark_context._jvm.scala.Option.apply(None)
    for stage in model.stages:
        jm = getattr(stage, "_java_obj", None)
        if jm is not None and getattr(stage, "hasSummary", False):
            jm.setSummary(none)
    return model


def _fit(data: DataFrame, algorithm: str, **params):
    """Fit and evaluate on prepared (persisted) features; the predictions are released again."""
    from pyspark import StorageLevel

    train, test = hash_split(data)
    check_label_classes(train)
    model = detach_summaries(build_pipeline(algorithm, **params).fit(train))
    preds = model.transform(test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return model, evaluate(preds)
    finally:
        preds.unpersist()


def _prepared(features: DataFrame) -> DataFrame:
    from pyspark import StorageLevel

    from respawn.session import checkpoint_dir
    checkpoint_dir(features.sparkSession)
    return prepare_features(features).persist(StorageLevel.MEMORY_AND_DISK)


def train_churn_model(features: DataFrame, algorithm: str = "random_forest", **params):
    """Fit on the hash split's training side; returns (model, metrics, test predictions).

    Indexers, the forest and the evaluators each make several passes over the
    data; the prepared features (one row per player) are persisted for the
    duration (memory, spilling to disk) so the upstream feature plan runs once.
    Nothing stays persisted; the predictions are a lazy frame.
    """
    data = _prepared(features)
    try:
        model, metrics = _fit(data, algorithm, **params)
    finally:
        data.unpersist()
    return model, metrics, model.transform(hash_split(prepare_features(features))[1])


def assembled(features: DataFrame) -> DataFrame:
    """L3/L4: category indexes and the assembled vector's slots (f0, f1, ...) per player."""
    data = prepare_features(features)
    stages = build_pipeline("logistic_regression").getStages()[:-1]
    out = Pipeline(stages=stages).fit(data).transform(data)
    slots = vector_to_array("features")
    n = len(FEATURE_COLUMNS) + len(CATEGORICAL_COLUMNS)
    return out.select("player_id", *[slots[i].alias(f"f{i}") for i in range(n)])


def confusion(predictions: DataFrame) -> DataFrame:
    """L6 as one row: confusion counts, accuracy and F1 of the positive class, and the AUC where there is a churn_probability."""
    label, said = F.col(LABEL) == 1, F.col("prediction") == 1.0
    one = predictions.agg(F.count_if(label & said).alias("tp"), F.count_if(~label & said).alias("fp"),
                          F.count_if(~label & ~said).alias("tn"), F.count_if(label & ~said).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    ranked = [auc(predictions, "churn_probability", LABEL).alias("auc")] if "churn_probability" in predictions.columns else []
    return one.select("tp", "fp", "tn", "fn", exact_div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                      exact_div(tp * 2, tp * 2 + fp + fn).alias("f1"), *ranked)


def prediction_review(predictions: DataFrame) -> DataFrame:
    """Label, prediction and churn probability side by side."""
    return predictions.select("player_id", LABEL, "prediction",
                              vector_to_array("probability")[1].alias("churn_probability"))


def score(model: PipelineModel, features: DataFrame, scored_at=None) -> DataFrame:
    """P(churn) and risk tier for every feature row (10 output columns).

    The model sees the same filled features as in training; the published
    columns keep the raw (unfilled) values. A narrow per-row pipeline with no
    shuffle, so it also runs unchanged on a streaming DataFrame.
    """
    shown = ["days_since_login", "login_count_7d", "total_spend_30d", "platform_primary", "region_primary"]
    base = features.select("player_id", "compute_date", *FEATURE_COLUMNS,
                           *[c for c in CATEGORICAL_COLUMNS if c not in shown],
                           *[F.col(c).alias(f"_raw_{c}") for c in shown],
                           *[c for c in shown if c not in FEATURE_COLUMNS])
    filled = (base.fillna(0, subset=FEATURE_COLUMNS)
              .fillna({c: "Unknown" for c in CATEGORICAL_COLUMNS}))
    scored = model.transform(filled)
    return scored.select(
        "player_id", "compute_date",
        (scored_at if scored_at is not None else F.current_timestamp()).alias("scored_at"),
        vector_to_array("probability")[1].alias("churn_probability"),
        *[F.col(f"_raw_{c}").alias(c) for c in shown],
    ).withColumn("risk_tier", risk_tier()).select(*SCORE_COLUMNS)


# --------------------------------------------------------------------------- L7 registry
def register_model(spark: SparkSession, model: PipelineModel, metrics: dict, params: dict,
                   root: str, stage: str = "None") -> dict:
    """Save the fitted pipeline and append a row to ``<root>/ml_runs`` (parquet).

    ``root`` must be a shared filesystem path on a cluster. Returns the run row.
    """
    run_id = uuid.uuid4().hex[:12]
    path = f"{root.rstrip('/')}/models/{run_id}"
    model.write().overwrite().save(path)
    row = {"run_id": run_id, "created_at": dt.datetime.now(dt.timezone.utc).isoformat(),
           "model_path": path, "params": json.dumps(params, sort_keys=True),
           **{k: float(v) for k, v in metrics.items()}}
    spark.createDataFrame([row]).write.mode("append").parquet(f"{root.rstrip('/')}/ml_runs")
    _append_stage(spark, root, [(run_id, stage)])
    return row


def _append_stage(spark: SparkSession, root: str, changes: list[tuple[str, str]]) -> None:
    at = dt.datetime.now(dt.timezone.utc).isoformat()
    rows = [(run_id, stage, at) for run_id, stage in changes]
    spark.createDataFrame(rows, "run_id string, stage string, changed_at string").write.mode("append").parquet(f"{root.rstrip('/')}/ml_stages")


def models(spark: SparkSession, root: str) -> DataFrame:
    """The model versions: (version, run_id, stage, model_path, created_at), a row per training run.

    Runs and stage changes are only ever appended; a run's stage is the last one given to it.
    """
    runs = spark.read.parquet(f"{root.rstrip('/')}/ml_runs")
    stages = spark.read.parquet(f"{root.rstrip('/')}/ml_stages")
    now = stages.groupBy("run_id").agg(F.max_by("stage", "changed_at").alias("stage"))
    version = F.row_number().over(Window.orderBy("created_at", "run_id"))  # a row per training run
    return runs.join(now, "run_id").select(version.alias("version"), "run_id", "stage", "model_path", "created_at")


def promote(spark: SparkSession, root: str, run_id: str, stage: str = "Production") -> None:
    """Make one run the ``stage`` model (others in that stage are archived) by appending the changes."""
    known = {r["run_id"]: r["stage"] for r in models(spark, root).collect()}  # a row per training run
    if run_id not in known:
        raise LookupError(f"no run {run_id!r}")
    _append_stage(spark, root, [(run_id, stage), *((r, "Archived") for r, s in known.items() if s == stage and r != run_id)])


def load_stage(spark: SparkSession, root: str, stage: str = "Production") -> PipelineModel:
    best = models(spark, root).where(F.col("stage") == stage).orderBy(F.desc("version")).select("model_path").first()
    if best is None:
        raise LookupError(f"no model in stage {stage!r}")
    return PipelineModel.load(best["model_path"])


def folds(seed: int, k: int):
    """The fold (0 to k - 1) of a player: a hash of the id, so the same on any partitioning."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", "player_id", F.lit(f"fold{seed}"))), 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int")


def sweep(features: DataFrame, grid: list[dict], k: int = 3, seed: int = SPLIT_SEED, parallel: int = 4) -> list[dict]:
    """One model per parameter set on the same prepared features.

    Per configuration the metrics on the test split, as ``train_churn_model`` has them, and auc_mean and auc_std over
    ``k`` folds of the training split: folds are hashes of the player, fits of a configuration's folds run side by side.
    """
    data, out = _prepared(features), []
    try:
        train = hash_split(data)[0].withColumn("fold", folds(seed, k)).cache()
        for params in grid:
            p = dict(params)
            algo = p.pop("algorithm", "random_forest")
            ranked = BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
            cv = CrossValidator(estimator=build_pipeline(algo, **p), estimatorParamMaps=[{}], evaluator=ranked, numFolds=k, foldCol="fold",
                                parallelism=parallel)
            fitted = cv.fit(train)
            out.append({"algorithm": algo, **p, **_fit(data, algo, **p)[1], "auc_mean": fitted.avgMetrics[0], "auc_std": fitted.stdMetrics[0]})
        train.unpersist()
    finally:
        data.unpersist()
    return out
