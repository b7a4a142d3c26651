"""Train and score jobs: gate, registry, metrics and predictions in the warehouse."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.quality import failures
from skyledger.plans import ml
from skyledger.plans.jobs import gate
from skyledger.session import literal_rows
from skyledger.sources.tables import Warehouse


def train_hazard(warehouse: Warehouse, run: str, artifact_root: str, **params: int) -> str:
    """Train the hazard model on the feature mart and register it; returns the model id.

    A model that misses the quality threshold is registered too, but never becomes the active one.
    """
    model, metrics = ml.train_hazard(warehouse.read("gold.ai_neo_features"), **params)
    frame, checks = ml.metric_gate(metrics)
    gate(warehouse, frame, checks, run, "hazard-model", fail_on_error=False)
    outcome = warehouse.read("meta.data_quality_run").filter(F.col("run_id") == run)
    return register(
        warehouse, run, model, metrics, ml.HAZARD_MODEL, "random_forest", "gold.ai_neo_features",
        artifact_root, not failures(outcome.filter("check_name LIKE 'ml.%'")), params,
    )


def register(
    warehouse: Warehouse, run: str, model: PipelineModel, metrics: DataFrame, name: str,
    algorithm: str, feature_set: str, artifact_root: str, gate_passed: bool, params: dict,
) -> str:
    """Save a model, then write its metrics, then its registry row, which makes it visible."""
    entry = ml.registry_row(
        warehouse.read("ml.model_registry"), name, algorithm, feature_set, artifact_root,
        datetime.now(timezone.utc), run, gate_passed, params,
    )
    row = entry.first()
    entry = literal_rows(warehouse.spark, entry.schema, [row])
    model.write().overwrite().save(row["artifact_uri"])
    values = [
        (str(uuid.uuid4()), row["model_id"], m["metric_name"], m["metric_value"], "test")
        for m in metrics.collect()  # one row per metric
    ]
    measured = literal_rows(warehouse.spark, warehouse.read("ml.model_metric").drop("created_at").schema, values)
    warehouse.append(
        measured.withColumn("created_at", F.current_timestamp()), "ml.model_metric", run
    )
    warehouse.append(entry, "ml.model_registry", run)
    return row["model_id"]


def score_hazard(warehouse: Warehouse, run: str) -> int:
    """Score every approach of the feature mart with the active hazard model."""
    registry = warehouse.read("ml.model_registry").filter(F.col("model_name") == ml.HAZARD_MODEL)
    active = ml.active_models(registry).first()
    if active is None:
        raise ValueError(f"no active model {ml.HAZARD_MODEL}")
    model = PipelineModel.load(active["artifact_uri"])
    scores = ml.score_hazard(model, warehouse.read("gold.ai_neo_features"))
    warehouse.append(ml.prediction_rows(scores, active["model_id"], run), "ml.prediction", run)
    return warehouse.read("ml.prediction", [run]).count()


def active_model_metrics(warehouse: Warehouse) -> DataFrame:
    """Metrics of the active version of every model."""
    active = ml.active_models(warehouse.read("ml.model_registry")).select(
        "model_id", "model_name", "model_version"
    )
    metrics = warehouse.read("ml.model_metric").select(
        "model_id", "metric_name", "metric_value", "dataset_split"
    )
    return metrics.join(active, "model_id").select(
        "model_name", "model_version", "metric_name", "metric_value", "dataset_split"
    )


def hazard_top_risk(warehouse: Warehouse, limit: int = 20) -> DataFrame:
    """Approaches with the highest hazard score by the active model."""
    return ml.top_predictions(
        warehouse.read("ml.prediction"), warehouse.read("ml.model_registry"), ml.HAZARD_MODEL, limit
    )
