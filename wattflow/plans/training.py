"""Batch entry point: features -> two candidate models -> compare -> tune -> gate -> persist.

Every step is a Spark job over the whole input; the driver only holds the
metric rows and the fitted model handles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ml import pipelines as ML
from ..operators.clean import hash_split
from ..operators.season import month_labels
from ..runtime import hand_off, scratch_dir
from .features import clean_weather, feature_frame, model_base
from .metrics import choose_model


@dataclass
class TrainingResult:
    model_path: str
    labels_path: str
    chosen: str
    metrics: DataFrame  # model, rmsle, rmse, mae, r2, n_used, chosen


def train_and_select(
    meters: DataFrame,
    buildings: DataFrame,
    weather: DataFrame,
    out_dir: str | None = None,
    candidates: dict[str, dict] | None = None,
    tune_grid_max_iter: int | None = 40,
    tune: bool = True,
) -> TrainingResult:
    """Fit the candidates on an 80/20 key-hash split, choose by RMSLE (RMSE on ties),
    optionally tune the boosted model and ship it only if it beats the baseline;
    persist the winning ``PipelineModel`` and the per-site season-label table."""
    spark = meters.sparkSession
    out_dir = out_dir or scratch_dir(spark, "training")
    base = hand_off(model_base(feature_frame(meters, buildings, weather), buildings), "training-base")
    train, test = hash_split(base, ["building_id", "ts"], (0.8, 0.2))
    candidates = candidates if candidates is not None else {"rf": {}, "gbt": {}}
    models: dict[str, PipelineModel] = {}
    reports = []
    for name, overrides in candidates.items():
        model, _, report = ML.fit_and_score(ML.pipeline_for(name, **overrides), train, test)
        models[name] = model
        reports.append(report.withColumn("model", F.lit(name)))
    if tune and "gbt" in candidates:
        points = ML.search_points("gbt", **({"maxIter": tune_grid_max_iter} if tune_grid_max_iter else {}))
        best, _ = ML.tune("gbt", points, train, **candidates["gbt"])
        models["tuned"] = best
        reports.append(ML.regression_report_frame(best.transform(test)).withColumn("model", F.lit("tuned")))
    metrics = reports[0]
    for r in reports[1:]:
        metrics = metrics.unionByName(r)
    metrics = choose_model(metrics)
    chosen = metrics.where("chosen").select("model").first()["model"]
    model_path = ML.save_model(models[chosen], f"{out_dir}/best_pipeline")
    labels_path = f"{out_dir}/season_labels"
    month_labels(clean_weather(weather)).write.mode("overwrite").parquet(labels_path)
    return TrainingResult(model_path, labels_path, chosen, metrics)
