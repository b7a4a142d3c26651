import random
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from skyledger.operators.quality import QualityGateError, evaluate, raise_on_failure
from skyledger.plans import ml
from skyledger.schemas import MODEL_REGISTRY
from skyledger.session import staged_with


@pytest.fixture(scope="module")
def features(spark):
    random.seed(7)
    rows = []
    for i in range(400):
        hazardous = i % 8 == 0
        magnitude = random.uniform(17, 21) if hazardous else random.uniform(21, 28)
        distance = random.uniform(1e5, 5e6)
        rows.append((i, f"n{i}", random.uniform(2, 40), distance, distance / 384400, magnitude, int(hazardous)))
    rows.append((400, "gap", None, 1e6, 2.6, 22.0, 0))
    return spark.createDataFrame(
        rows,
        "approach_sk LONG, neo_id STRING, rel_velocity_km_s DOUBLE, miss_distance_km DOUBLE, "
        "miss_distance_lunar DOUBLE, absolute_magnitude_h DOUBLE, is_hazardous_label INT",
    )


def test_split_is_stratified_exact_and_independent_of_partitioning(features):
    def split(df):
        return {
            r["approach_sk"]: r["split"]
            for r in ml.stratified_split(df, "approach_sk", "is_hazardous_label").collect()
        }

    sides = split(features)
    assert sides == split(features.repartition(7))
    labels = {r["approach_sk"]: r["is_hazardous_label"] for r in features.collect()}
    for label, size in ((1, 50), (0, 351)):
        test = sum(1 for k, s in sides.items() if s == "test" and labels[k] == label)
        assert test == int(size * 0.25 + 0.5)


def test_weights_balance_the_labels(features):
    weights = ml.balanced_weights(features, "is_hazardous_label").groupBy("is_hazardous_label").agg(
        F.sum("weight").alias("w")
    )
    assert {round(r["w"], 6) for r in weights.collect()} == {200.5}


def test_train_score_and_gate(features):
    model, metrics = ml.train_hazard(features, trees=5, depth=4)
    values = {r["metric_name"]: r["metric_value"] for r in metrics.collect()}
    assert set(values) == {"roc_auc", "f1", "accuracy", "precision", "recall"}
    assert values["roc_auc"] > 0.9
    scores = ml.score_hazard(model, features)
    assert scores.count() == features.count()
    assert [r["entity_key"] for r in scores.filter("is_imputed").collect()] == ["gap"]
    harmless = features.filter("approach_sk = 1").select(
        "*", *[F.lit(None).cast("double").alias(f"_{c}") for c in ("d",)]
    ).drop("_d")
    missing = harmless.withColumn("miss_distance_km", F.lit(None).cast("double"))
    known, unknown = (ml.score_hazard(model, x).first()["predicted_score"] for x in (harmless, missing))
    assert unknown < 0.5 and known < 0.5  # a missing distance is not a distance of 0
    assert scores.filter("predicted_score < 0 OR predicted_score > 1").isEmpty()
    rows = ml.prediction_rows(scores, "m1", "run")
    assert rows.select("prediction_id").distinct().count() == rows.count()

    raise_on_failure(evaluate(*ml.metric_gate(metrics)))
    with pytest.raises(QualityGateError, match="roc_auc"):
        raise_on_failure(evaluate(*ml.metric_gate(metrics, threshold=1.01)))


def test_training_after_an_observation_in_the_session(spark, features):
    """An `Observation` makes the session unserializable; no task may carry the session."""
    staged_with(spark.range(10), rows=F.count(F.lit(1)))
    model, metrics = ml.train_hazard(features, trees=2, depth=2)
    assert metrics.count() == 5
    assert ml.score_hazard(model, features).count() == features.count()


def test_registry_keeps_one_active_version(spark):
    registry = spark.createDataFrame([], MODEL_REGISTRY)
    moment = datetime(2025, 1, 1, tzinfo=timezone.utc)
    for passed in (True, True, False):
        row = ml.registry_row(
            registry, "m", "random_forest", "gold.ai_neo_features", "/models", moment, "run", passed, {"trees": 5}
        )
        registry = registry.unionByName(row)
    assert [r["model_version"] for r in registry.orderBy("model_version").collect()] == [1, 2, 3]
    active = ml.active_models(registry).collect()
    assert [(r["model_name"], r["model_version"], r["artifact_uri"]) for r in active] == [("m", 2, "/models/m/2")]
    predictions = registry.select(
        "model_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("id")
    ).select(
        "model_id", F.col("id").cast("string").alias("entity_key"),
        F.col("id").cast("string").alias("snapshot_ref"), F.lit("1").alias("predicted_label"),
        (F.col("id") / 10).alias("predicted_score"),
    )
    top = ml.top_predictions(predictions, registry, "m", 2).collect()
    assert [r["entity_key"] for r in top] == ["2", "1"]


@pytest.fixture(scope="module")
def orbits(spark):
    random.seed(3)
    rows = []
    for i in range(200):
        if i % 2:
            rows.append((i, date(2025, 1, 1), 92.0, 51.0, 400.0 + random.random() * 100, 390.0))
        else:
            rows.append((i, date(2025, 1, 1), 718.0, 55.0, 20200.0 + random.random() * 100, 20100.0))
        rows.append((i, date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0))  # an older snapshot
    rows.append((999, date(2025, 1, 1), None, None, None, None))
    return spark.createDataFrame(
        rows,
        "norad_cat_id INT, snapshot_date DATE, period_minutes DOUBLE, inclination_deg DOUBLE, "
        "apogee_km DOUBLE, perigee_km DOUBLE",
    )


def test_regime_model_agrees_with_the_rule(orbits):
    model, scored = ml.train_regime(orbits, trees=5, depth=3)
    metrics = {r["metric_name"]: r["metric_value"] for r in
               ml.class_metrics(scored, "orbit_regime", "predicted_regime").collect()}
    assert metrics == {"accuracy": 1.0, "macro_f1": 1.0}
    every = ml.predicted_regimes(model, orbits)
    assert every.count() == 201 and every.filter("predicted_regime IS NULL").count() == 1
    agreement = ml.regime_agreement(scored).collect()
    assert sum(r["satellites"] for r in agreement) == 50
    assert all(r["orbit_regime"] == r["predicted_regime"] for r in agreement)


def test_clusters_separate_the_two_orbits(orbits):
    assigned, silhouette = ml.cluster_orbits(orbits, k=2)
    clusters = {r["norad_cat_id"]: r["cluster"] for r in assigned.collect()}
    assert len(clusters) == 201 and clusters.pop(999) is None
    sides = {k % 2: v for k, v in clusters.items()}
    assert sides[0] != sides[1] and set(clusters.values()) == {0, 1}
    assert silhouette > 0.8


def test_latest_orbits_are_chosen_once(orbits):
    for frame in ml._latest_orbits(orbits):
        assert "Window" not in frame._jdf.queryExecution().executedPlan().toString()


def test_class_metrics(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] + [("c", None)]
    frame = spark.createDataFrame(pairs, "x STRING, y STRING")
    found = {r["metric_name"]: r["metric_value"] for r in ml.class_metrics(frame, "x", "y").collect()}
    assert found["accuracy"] == pytest.approx(4 / 6)
    assert found["macro_f1"] == pytest.approx((6 / 7 + 2 / 3 + 0) / 3)


def test_train_and_score_jobs(warehouse, features, tmp_path):
    from skyledger.plans import model_jobs

    warehouse.overwrite(features, "gold.ai_neo_features", "g")
    with pytest.raises(ValueError, match="no active model"):
        model_jobs.score_hazard(warehouse, "s0")
    first = model_jobs.train_hazard(warehouse, "t1", str(tmp_path / "models"), trees=5, depth=4)
    assert model_jobs.score_hazard(warehouse, "s1") == features.count()
    metrics = model_jobs.active_model_metrics(warehouse).collect()
    assert {r["metric_name"] for r in metrics} == {"roc_auc", "f1", "accuracy", "precision", "recall"}
    assert {(r["model_name"], r["model_version"]) for r in metrics} == {(ml.HAZARD_MODEL, 1)}
    top = model_jobs.hazard_top_risk(warehouse, 5).collect()
    assert len(top) == 5 and top[0]["predicted_score"] >= top[-1]["predicted_score"] > 0.5
    assert warehouse.read("ml.model_registry").first()["model_id"] == first
    assert warehouse.read("meta.data_quality_run").count() == 1


def test_anomaly_scores_as_predictions(spark):
    frame = spark.createDataFrame(
        [(5, date(2025, 1, 1), 3.5), (6, date(2025, 1, 1), 0.2)],
        "norad_cat_id INT, snapshot_date DATE, anomaly_score DOUBLE",
    )
    rows = [tuple(r) for r in ml.anomaly_scores(frame).orderBy("entity_key").collect()]
    assert rows == [
        ("satellite", "5", "2025-01-01", "anomaly", 3.5), ("satellite", "6", "2025-01-01", "normal", 0.2),
    ]


def test_share_of_variance_inside_groups(spark):
    rows = [("a", 1.0, 5.0), ("a", 3.0, 5.0), (None, 10.0, 5.0), (None, 14.0, 5.0)]
    frame = spark.createDataFrame(rows, "g STRING, x DOUBLE, y DOUBLE").repartition(3)
    values = [r[1] for r in rows]
    mean = sum(values) / 4
    inside = 2 * 1.0**2 + 2 * 2.0**2  # around the means 2 and 12
    share = inside / sum((v - mean) ** 2 for v in values)
    assert ml.within_share(frame, "g", ["x"]) == pytest.approx(share)
    assert ml.within_share(frame, "g", ["x", "y"]) == pytest.approx(share / 2)
    assert ml.within_share(frame.withColumn("g", F.lit("one")), "g", ["x"]) == pytest.approx(1)
    assert ml.within_share(frame.limit(0), "g", ["x"]) is None


def test_prediction_ids_are_one_per_entity_and_snapshot(spark):
    scores = spark.range(6).select(
        F.lit("satellite").alias("entity_type"),
        (F.col("id") % 3).cast("string").alias("entity_key"),
        F.when(F.col("id") < 3, "2024-01-01").otherwise("2024-01-02").alias("snapshot_ref"),
        F.lit("normal").alias("predicted_label"),
        F.lit(0.5).alias("predicted_score"),
    )
    first, again = (
        {r["prediction_id"] for r in ml.prediction_rows(scores, "m", run).collect()} for run in "ab"
    )
    assert len(first) == 6 and first == again
