"""Model studies on a feature matrix: fit, evaluate, cross-validate, compare."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import filter_positive_target
from wardgrid.operators import models
from wardgrid.operators.evaluate import (
    auroc,
    average_precision,
    classification_report,
    confusion_matrix,
    model_comparison,
    regression_metrics,
    roc_points,
)
from wardgrid.operators.impute import residual_impute
from wardgrid.operators.ranking import best_model
from wardgrid.operators.splits import random_split, stratified_split
from wardgrid.session import staged
from wardgrid.sources.scan import feature_columns

CLASSIFIERS = {
    "logistic": models.fit_logistic,
    "random_forest": models.fit_random_forest,
    "boosted": models.fit_gbt_classifier,
}
REGRESSORS = {
    "boosted_a": models.fit_gbt_regressor,
    "boosted_b": models.fit_gbt_regressor_alt,
}
BASELINE = "baseline"


def _filled(
    marked: DataFrame, features: list[str], fit_on_train: bool, name: str
) -> DataFrame:
    train_only = marked.where(F.col("is_test") == 0) if fit_on_train else None
    return staged(residual_impute(marked, features, fit_on=train_only), name)


def mortality_study(
    matrix: DataFrame,
    label: str,
    drop: list[str],
    id_col: str,
    classifiers: Mapping[str, Callable[..., PipelineModel]] = CLASSIFIERS,
    k: int = 5,
    fit_on_train: bool = False,
) -> dict:
    """Classify the label with every model; returns metrics, predictions, curves and the pipelines.

    ``fit_on_train`` takes the residual medians from the training rows only; the published study
    takes them from all rows.
    """
    features = feature_columns(matrix, label, drop)
    marked = staged(stratified_split(matrix, id_col, label, classes=(0, 1)), "split")
    data = _filled(marked, features, fit_on_train, "mortality")
    train, test = data.where(F.col("is_test") == 0), data.where(F.col("is_test") == 1)
    out: dict = {"models": {}, "importance": {}}
    metrics, predictions, curves, cells, reports = [], [], [], [], []
    for name, fit in classifiers.items():
        model = fit(train, features, label)
        named = F.lit(name).alias("model")
        scored = staged(
            models.score_classifier(model, test).select(named, id_col, label, "score", "predicted"),
            "scored",
        )
        report = classification_report(scored, label, "predicted").where(F.col("class") == "1")
        row = (
            auroc(scored, "score", label)
            .select(named, "auroc")
            .withColumn(
                "average_precision",
                average_precision(scored, "score", label).select("average_precision").scalar(),
            )
            .withColumn("recall", report.select("recall").scalar())
            .withColumn("f1", report.select("f1").scalar())
        )
        if k:
            cv = models.cv_summary(
                models.cv_classification(data, fit, features, label, id_col, k=k), "auroc"
            )
            row = row.withColumn("_cv", cv.select(F.struct("*").alias("_cv")).scalar()).select(
                "*", "_cv.*"
            ).drop("_cv")
        metrics.append(staged(row, "metrics"))
        predictions.append(scored)
        curves.append(roc_points(scored, "score", label).select(named, "*"))
        cells.append(confusion_matrix(scored, label, "predicted").select(named, "*"))
        reports.append(classification_report(scored, label, "predicted").select(named, "*"))
        out["models"][name] = model
        out["importance"][name] = models.feature_importance(model, features)
    out["metrics"] = model_comparison(metrics)
    out["predictions"] = model_comparison(predictions)
    out["roc_points"] = model_comparison(curves)
    out["confusion"] = model_comparison(cells)
    out["report"] = model_comparison(reports)
    out["best"] = best_model(out["metrics"], "auroc")
    return out


def stay_study(
    matrix: DataFrame,
    target: str,
    drop: list[str],
    id_col: str,
    regressors: Mapping[str, Callable[..., PipelineModel]] = REGRESSORS,
    k: int = 5,
    fit_on_train: bool = False,
) -> dict:
    """Predict a positive, right-skewed target with every model and with the mean baseline."""
    positive = filter_positive_target(matrix, target)
    features = feature_columns(matrix, target, drop)
    marked = staged(random_split(positive, id_col), "split")
    data = _filled(marked, features, fit_on_train, "stay")
    train, test = data.where(F.col("is_test") == 0), data.where(F.col("is_test") == 1)
    out: dict = {"models": {}, "importance": {}}
    baseline = models.fit_mean_baseline(train, test, target).withColumnRenamed(
        "prediction", "predicted"
    )
    scored_by = {BASELINE: baseline}
    cv_rows = {}
    for name, fit in regressors.items():
        model = fit(train, features, target)
        scored_by[name] = models.score_regressor(model, test)
        out["models"][name] = model
        out["importance"][name] = models.feature_importance(model, features)
        if k:
            folds = staged(models.cv_regression(data, fit, features, target, id_col, k=k), "cv")
            cv_rows[name] = folds.agg(
                F.avg("mae_log").alias("cv_mae_log"),
                F.stddev_pop("mae_log").alias("cv_mae_log_sd"),
                F.avg("mae").alias("cv_mae_days"),
                F.stddev_pop("mae").alias("cv_mae_days_sd"),
            )
    metrics, predictions = [], []
    for name, scored in scored_by.items():
        named = F.lit(name).alias("model")
        kept = staged(scored.select(named, id_col, F.col(target).alias("actual"), "predicted"), "scored")
        row = regression_metrics(kept, "actual", "predicted").select(named, "*")
        if name in cv_rows:
            row = row.withColumn("_cv", cv_rows[name].select(F.struct("*").alias("_cv")).scalar())
            row = row.select("*", "_cv.*").drop("_cv")
        metrics.append(row)
        predictions.append(kept)
    out["metrics"] = model_comparison(metrics)
    out["predictions"] = model_comparison(predictions)
    out["best"] = best_model(out["metrics"], "mae", maximise=False, exclude=[BASELINE])
    return out
