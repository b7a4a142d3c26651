"""Models over the gold feature tables, with Spark MLlib."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
)
from pyspark.ml.feature import (
    Imputer,
    IndexToString,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.dedup import last_per_key
from skyledger.operators.numbering import dense_number
from skyledger.operators.quality import Check, value_range
from skyledger.plans.analysis import latest_snapshots, with_regime
from skyledger.session import literal_rows, staged

# Features of the hazard model, seed, test share and quality threshold.
HAZARD_FEATURES = (
    "rel_velocity_km_s", "miss_distance_km", "miss_distance_lunar", "absolute_magnitude_h",
)
HAZARD_MODEL = "neo_hazard_classifier"
ORBIT_FEATURES = ("period_minutes", "inclination_deg", "apogee_km", "perigee_km")
SEED = 42
TEST_SHARE = 0.25
MIN_ROC_AUC = 0.70


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE) -> DataFrame:
    """Add `split`: exactly round(share * n) rows of each label are 'test', the others 'train'.

    Rows are numbered within their label in the order of a digest of `key`. So a row's side does
    not depend on partitioning, and no label is sorted in one task.
    """
    numbered = dense_number(df, [key], "_number", within=label)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))  # one row per label
    test = F.col("_number") <= F.round(F.col("_size") * F.lit(test_share))
    return (
        numbered.join(F.broadcast(sizes), label, "inner")
        .withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))
        .select(*df.columns, "split")
    )


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add `weight` = n / (classes * n of the class)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))  # one row per label
    totals = sizes.agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("classes")).first()
    weight = F.lit(float(totals["n"] or 0)) / (F.lit(float(totals["classes"])) * F.col("_size"))
    return df.join(F.broadcast(sizes.withColumn("weight", weight).drop("_size")), label, "inner")


def train_hazard(features: DataFrame, trees: int = 20, depth: int = 5) -> tuple[PipelineModel, DataFrame]:
    """Train the hazard model on the training split; returns it with its test metrics.

    A missing feature is replaced by its median over the training split, in training, test and
    scoring alike.
    """
    rows = features.select("approach_sk", "is_hazardous_label", *HAZARD_FEATURES)
    split = stratified_split(rows, "approach_sk", "is_hazardous_label").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        train = balanced_weights(split.filter("split = 'train'"), "is_hazardous_label")
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="is_hazardous_label", weightCol="weight",
            numTrees=trees, maxDepth=depth, seed=SEED,
        )
        filled = [f"_filled_{c}" for c in HAZARD_FEATURES]
        stages = [
            Imputer(strategy="median", inputCols=list(HAZARD_FEATURES), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="features"),
            forest,
        ]
        # The copy leaves out the training summary, which drags the session into each task; a session
        # that has an `Observation` (see `staged_with`) cannot be serialized.
        model = Pipeline(stages=stages).fit(train).copy()
        return model, binary_metrics(model.transform(split.filter("split = 'test'")))
    finally:
        split.unpersist()


def binary_metrics(scored: DataFrame, label: str = "is_hazardous_label") -> DataFrame:
    """roc_auc, f1, accuracy, precision and recall as rows (metric_name, metric_value)."""
    scored = scored.select(label, "rawPrediction", "prediction").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        values = [
            ("roc_auc", BinaryClassificationEvaluator(labelCol=label).evaluate(scored))
        ]
        for name, metric in (
            ("f1", "fMeasureByLabel"), ("accuracy", "accuracy"),
            ("precision", "precisionByLabel"), ("recall", "recallByLabel"),
        ):
            evaluator = MulticlassClassificationEvaluator(
                labelCol=label, metricName=metric, metricLabel=1.0
            )
            values.append((name, evaluator.evaluate(scored)))
    finally:
        scored.unpersist()
    schema = T.StructType().add("metric_name", "string").add("metric_value", "double")
    return literal_rows(scored.sparkSession, schema, values)


def metric_gate(metrics: DataFrame, threshold: float = MIN_ROC_AUC) -> tuple[DataFrame, list[Check]]:
    """Frame and check for the quality gate that a model must pass before activation."""
    return (
        metrics.filter("metric_name = 'roc_auc'"),
        [value_range("ml.roc_auc_threshold", "metric_value", low=threshold)],
    )


def score_hazard(model: PipelineModel, features: DataFrame) -> DataFrame:
    """A hazard score for every approach; `is_imputed` marks those with a missing feature."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in HAZARD_FEATURES])
    return model.transform(features).select(
        F.lit("neo").alias("entity_type"),
        F.col("neo_id").alias("entity_key"),
        F.col("approach_sk").cast("string").alias("snapshot_ref"),
        F.col("prediction").cast("int").cast("string").alias("predicted_label"),
        vector_to_array("probability").getItem(1).alias("predicted_score"),
        missing.alias("is_imputed"),
    )


def prediction_rows(scores: DataFrame, model_id: str, run_id: str) -> DataFrame:
    """Scores as rows of the prediction table. The id follows from model, entity and snapshot, so a
    repeated run gives the same rows."""
    named = F.concat_ws("|", F.lit(model_id), "entity_type", "entity_key", "snapshot_ref")
    return scores.select(
        F.md5(named.cast("binary")).alias("prediction_id"),
        F.lit(model_id).alias("model_id"),
        "entity_type",
        "entity_key",
        "snapshot_ref",
        "predicted_label",
        "predicted_score",
        F.lit(run_id).alias("inference_run_id"),
        F.current_timestamp().alias("created_at"),
    )


# --- registry ---------------------------------------------------------------


def next_version(registry: DataFrame, name: str) -> int:
    """Version number for a new model of this name."""
    top = registry.filter(F.col("model_name") == name).agg(F.max("model_version")).first()[0]
    return (top or 0) + 1


def registry_row(
    registry: DataFrame,
    name: str,
    algorithm: str,
    feature_set: str,
    artifact_root: str,
    trained_at: datetime,
    training_run_id: str,
    gate_passed: bool,
    params: dict,
) -> DataFrame:
    """Registry entry of a newly trained model, ready to append."""
    version = next_version(registry, name)
    row = (
        str(uuid.uuid4()), name, version, algorithm, feature_set,
        f"{artifact_root}/{name}/{version}", trained_at, training_run_id, gate_passed,
        json.dumps(params),
    )
    return literal_rows(registry.sparkSession, registry.schema, [row])


def active_models(registry: DataFrame) -> DataFrame:
    """The active version per model name: the highest that passed its gate."""
    return last_per_key(
        registry.filter("gate_passed"), ["model_name"], ["model_version"]
    )


def top_predictions(
    predictions: DataFrame, registry: DataFrame, name: str, limit: int = 20
) -> DataFrame:
    """Highest scores given by the active model of this name."""
    active = active_models(registry.filter(F.col("model_name") == name)).select("model_id")
    return (
        predictions.join(F.broadcast(active), "model_id", "inner")  # one row
        .select("entity_key", "snapshot_ref", "predicted_label", "predicted_score")
        .orderBy(F.desc_nulls_last("predicted_score"), "snapshot_ref", "entity_key")
        .limit(limit)
    )


# --- orbits -----------------------------------------------------------------


def _latest_orbits(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Latest orbit of every satellite, and those of them without a missing feature.

    Staged, as split, fit and scores each read it again.
    """
    columns = ["norad_cat_id", "snapshot_date", *ORBIT_FEATURES]
    latest = staged(latest_snapshots(snapshots.select(*columns)))
    return latest, latest.dropna(subset=list(ORBIT_FEATURES))


def train_regime(snapshots: DataFrame, trees: int = 20, depth: int = 8) -> tuple[PipelineModel, DataFrame]:
    """Train a classifier of the orbit regime on latest snapshots; returns it with the scored
    test rows (`orbit_regime`, `predicted_regime`). Satellites whose latest orbit lacks a feature
    take no part in training and test."""
    labelled = with_regime(_latest_orbits(snapshots)[1])
    split = stratified_split(labelled, "norad_cat_id", "orbit_regime").persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        indexer = StringIndexer(
            inputCol="orbit_regime", outputCol="label", handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ).fit(split)
        stages = [
            indexer,
            VectorAssembler(inputCols=list(ORBIT_FEATURES), outputCol="features"),
            RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED),
            IndexToString(
                inputCol="prediction", outputCol="predicted_regime", labels=indexer.labels
            ),
        ]
        model = Pipeline(stages=stages).fit(split.filter("split = 'train'")).copy()  # no summary
    finally:
        split.unpersist()
    return model, model.transform(split.filter("split = 'test'"))


def predicted_regimes(model: PipelineModel, snapshots: DataFrame) -> DataFrame:
    """(norad_cat_id, orbit_regime, predicted_regime) of every satellite by its latest orbit; the
    prediction is NULL where a feature is missing."""
    latest, complete = _latest_orbits(snapshots)
    predicted = model.transform(complete).select("norad_cat_id", "predicted_regime")
    return with_regime(latest).join(predicted, "norad_cat_id", "left").select(
        "norad_cat_id", "orbit_regime", "predicted_regime"
    )


def class_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """accuracy and macro_f1 (mean F1 of the classes of `label`) as rows (metric_name,
    metric_value). A NULL prediction is wrong; no rows give no metric."""
    pairs = scored.groupBy(F.col(label).alias("a"), F.col(prediction).alias("b")).agg(
        F.count(F.lit(1)).alias("n")
    )  # one row per pair of classes
    hit = F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)
    actual = pairs.groupBy("a").agg(F.sum("n").alias("actual"), F.sum(hit).alias("hits"))
    guessed = pairs.groupBy("b").agg(F.sum("n").alias("guessed"))
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.coalesce("guessed", F.lit(0)))
    totals = actual.filter("a IS NOT NULL").join(guessed, F.col("a") == F.col("b"), "left").agg(
        (F.sum("hits") / F.sum("actual")).alias("accuracy"), F.avg(f1).alias("macro_f1")
    )
    rows = [F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("metric_value"))
            for m in ("accuracy", "macro_f1")]
    return totals.select(F.inline(F.array(*rows))).filter("metric_value IS NOT NULL")


def regime_agreement(scored: DataFrame) -> DataFrame:
    """Confusion counts of rule and model."""
    return scored.groupBy("orbit_regime", "predicted_regime").agg(
        F.count(F.lit(1)).alias("satellites")
    )


def cluster_orbits(snapshots: DataFrame, k: int = 4) -> tuple[DataFrame, float]:
    """Cluster satellites by their standardized latest orbit; returns assignments and silhouette.

    Every satellite has a row; its cluster is NULL where a feature is missing.
    """
    every, complete = _latest_orbits(snapshots)
    latest = complete.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stages = [
            VectorAssembler(inputCols=list(ORBIT_FEATURES), outputCol="raw"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            KMeans(k=k, seed=SEED, predictionCol="cluster"),
        ]
        model = Pipeline(stages=stages).fit(latest)
        assigned = model.transform(latest)
        silhouette = ClusteringEvaluator(predictionCol="cluster").evaluate(assigned)
    finally:
        latest.unpersist()
    clusters = assigned.select("norad_cat_id", "cluster")
    return every.select("norad_cat_id").join(clusters, "norad_cat_id", "left"), silhouette


def within_share(rows: DataFrame, group: str, features: Sequence[str] = ORBIT_FEATURES) -> float | None:
    """Share of the variance of `features` that is left inside the groups, 0 to 1: the inertia of a
    grouping over that of one single group, each feature standardized.

    A feature that does not vary counts as 0; rows without any feature give None. Few groups: their
    counts and variances are what leaves the one pass over the rows.
    """
    spread = [(F.count(c) * F.coalesce(F.var_pop(c), F.lit(0.0))).alias(f"_s{k}")
              for k, c in enumerate(features)]
    sums = rows.rollup(group).agg(F.grouping(group).alias("_all"), *spread, F.count(F.lit(1)).alias("_n"))
    parts = []
    for k in range(len(features)):
        inside = F.sum(F.when(F.col("_all") == 0, F.col(f"_s{k}")))
        whole = F.sum(F.when(F.col("_all") == 1, F.col(f"_s{k}")))
        parts.append(F.when(whole > 0, inside / whole).otherwise(0.0))
    n = F.sum(F.when(F.col("_all") == 1, F.col("_n")))
    return sums.agg(F.when(n > 0, sum(parts, F.lit(0.0)) / len(features)).alias("share")).first()["share"]


def anomaly_scores(anomalies: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Orbit anomalies as scores of the prediction table."""
    score = F.col("anomaly_score")
    return anomalies.select(
        F.lit("satellite").alias("entity_type"),
        F.col("norad_cat_id").cast("string").alias("entity_key"),
        F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_ref"),
        F.when(score > threshold, F.lit("anomaly")).otherwise(F.lit("normal")).alias(
            "predicted_label"
        ),
        score.alias("predicted_score"),
    )

