"""Model pipelines on ``pyspark.ml`` and their cross-validation.

Hyper-parameters default to the published configuration.  Gradient boosting and linear models come
from Spark's own library, so fits agree with other libraries in kind, not to the digit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from fractions import Fraction
from multiprocessing.pool import ThreadPool
from threading import Condition

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.sqltext import literal
from wardgrid.operators.evaluate import auroc
from wardgrid.operators.splits import folds
from wardgrid.session import staged, storage_memory

Fit = Callable[[DataFrame, list[str], str], PipelineModel]

# Bytes a fit keeps for every training row besides one bin per feature; a forest also keeps one number per tree.
# With 28 features 288 bytes in all were measured for boosted trees and 1,011 for a forest of 200 trees.
ROW_BYTES = 180
FOREST_TREES = 200


def _assembler(features: Iterable[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")


def _class_totals(train: DataFrame, label: str) -> tuple[int, int]:
    row = train.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def _weighted(train: DataFrame, label: str, weight_0: float, weight_1: float) -> DataFrame:
    return train.withColumn(
        "_weight", F.when(F.col(label) == 1, F.lit(float(weight_1))).otherwise(F.lit(float(weight_0)))
    )


def _balanced(train: DataFrame, label: str) -> tuple[DataFrame, int]:
    neg, pos = _class_totals(train, label)
    n = neg + pos
    return _weighted(train, label, n / (2 * max(neg, 1)), n / (2 * max(pos, 1))), n


def standard_scale(inputs: str = "_features", output: str = "_scaled") -> StandardScaler:
    """Pipeline stage: centre and divide by the standard deviation."""
    return StandardScaler(inputCol=inputs, outputCol=output, withMean=True, withStd=True)


def fit_logistic(
    train: DataFrame, features: list[str], label: str, C: float = 0.1, max_iter: int = 1000,
    tol: float = 1e-4,
) -> PipelineModel:
    """Scaled, class-balanced L2 logistic regression; Spark averages the loss, hence 1 / (C n).

    The assembled vectors are written once; the scaler and the two passes in front of the iterations read them.
    """
    data, n = _balanced(train, label)
    assembler = _assembler(features)
    rows = staged(assembler.transform(data).select("_features", label, "_weight"), "assembled")
    scaler = standard_scale().fit(rows)
    model = LogisticRegression(
        featuresCol="_scaled", labelCol=label, weightCol="_weight", maxIter=max_iter,
        tol=tol, regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0, standardization=False,
    ).fit(scaler.transform(rows))
    return PipelineModel([assembler, scaler, model])


def fit_random_forest(
    train: DataFrame, features: list[str], label: str, trees: int = FOREST_TREES, depth: int = 6,
    min_leaf: int = 3, seed: int = 42,
) -> PipelineModel:
    """Class-balanced random forest."""
    data, _ = _balanced(train, label)
    return Pipeline(
        stages=[
            _assembler(features),
            RandomForestClassifier(
                featuresCol="_features", labelCol=label, weightCol="_weight", numTrees=trees,
                maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed,
            ),
        ]
    ).fit(data)


def fit_gbt_classifier(
    train: DataFrame, features: list[str], label: str, rounds: int = 200, depth: int = 4,
    rate: float = 0.05, rows: float = 0.8, columns: float = 0.8, seed: int = 42,
) -> PipelineModel:
    """Boosted trees with the positive class weighted by negatives per positive."""
    neg, pos = _class_totals(train, label)
    return Pipeline(
        stages=[
            _assembler(features),
            GBTClassifier(
                featuresCol="_features", labelCol=label, weightCol="_weight", maxIter=rounds,
                maxDepth=depth, stepSize=rate, subsamplingRate=rows,
                featureSubsetStrategy=str(columns), seed=seed,
            ),
        ]
    ).fit(_weighted(train, label, 1.0, neg / max(pos, 1)))


def fit_gbt_regressor(
    train: DataFrame, features: list[str], label: str, rounds: int = 300, depth: int = 4,
    rate: float = 0.05, rows: float = 0.8, columns: float = 0.8, min_leaf: int = 3, seed: int = 42,
) -> PipelineModel:
    """Boosted regression trees on log(1 + target); predictions are on the log scale."""
    return Pipeline(
        stages=[
            _assembler(features),
            GBTRegressor(
                featuresCol="_features", labelCol="_log_target", maxIter=rounds, maxDepth=depth,
                stepSize=rate, subsamplingRate=rows, featureSubsetStrategy=str(columns),
                minInstancesPerNode=min_leaf, seed=seed,
            ),
        ]
    ).fit(train.withColumn("_log_target", F.log1p(label)))


def fit_gbt_regressor_alt(
    train: DataFrame, features: list[str], label: str, min_leaf: int = 5, **params
) -> PipelineModel:
    """The second boosted configuration: larger leaves."""
    return fit_gbt_regressor(train, features, label, min_leaf=min_leaf, **params)


def fit_mean_baseline(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows with the constant prediction expm1(mean of log1p(target)) of the training rows."""
    mean = train.agg(F.expm1(F.avg(F.log1p(label))).alias("m")).scalar()
    return test.withColumn("prediction", mean)


def fit_log_mean(train: DataFrame, features: list[str], label: str) -> PipelineModel:
    """The mean baseline as a model: the average of log(1 + target) for every row."""
    mean = train.agg(F.avg(F.log1p(label))).first()[0]
    return PipelineModel([SQLTransformer(statement=f"select *, {literal(mean)} as prediction from __THIS__")])


def fit_share(train: DataFrame, features: list[str], label: str) -> PipelineModel:
    """The share of class 1 as the score of every row."""
    share = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    statement = f"select *, {literal(share)} as _share, {literal(float(share > 0.5))} as prediction from __THIS__"
    assembler = VectorAssembler(inputCols=["_share", "_share"], outputCol="probability")
    return PipelineModel([SQLTransformer(statement=statement), assembler])


def score_classifier(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the probability of class 1 (``score``) and the predicted class (``predicted``)."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("predicted"),
    )


def score_regressor(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the log-scale prediction and the prediction in the target's own unit."""
    scored = model.transform(df)
    return scored.select(
        *df.columns,
        F.col("prediction").alias("predicted_log"),
        F.expm1("prediction").alias("predicted"),
    )


def feature_importance(model: PipelineModel, features: list[str]) -> DataFrame:
    """Absolute coefficients or tree importances per feature, largest first."""
    last = model.stages[-1]
    vector = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(name, abs(float(value))) for name, value in zip(features, vector.toArray())]
    return (
        SparkSession.active()
        .createDataFrame(rows, "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature")
    )


def _fitting(marked: DataFrame, fits: dict[str, Fit], features: list[str], k: int, parallelism: int) -> int:
    """How many of the folds' fits run side by side: at most ``parallelism``, and as many as half the memory keeps.

    A fit reads its kept rows several times a round.  Rows beyond the memory are written to disk and read from there
    every time, so more fits at once than it keeps take longer than one after another.  The scores are the same.
    """
    trees = FOREST_TREES if fit_random_forest in fits.values() else 0
    held = marked.count() * (k - 1) // k * (ROW_BYTES + 4 * (len(features) + trees))
    return max(1, min(parallelism, storage_memory(marked.sparkSession) // 2 // max(held, 1)))


def _at_once(work: Callable[..., tuple], jobs: list[tuple], together: list[int]) -> list[tuple]:
    """``work`` of every job side by side; boosting rounds alone leave cores idle.

    ``together`` says of each job how many of its kind memory keeps.  A job takes that share of it and starts as soon as
    so much is free, so many light fits run next to each other where only one heavy fit would.
    """
    freed, taken = Condition(), []

    def run(share: Fraction, *job) -> tuple:
        with freed:
            freed.wait_for(lambda: not taken or sum(taken) + share <= 1)
            taken.append(share)
        try:
            return work(*job)
        finally:
            with freed:
                taken.remove(share)
                freed.notify_all()

    with ThreadPool(max(1, min(len(jobs), max(together)))) as pool:
        return pool.starmap(inheritable_thread_target(run), [(Fraction(1, n), *job) for n, job in zip(together, jobs)], chunksize=1)


def cv_classifiers(
    df: DataFrame, fits: dict[str, Fit], features: list[str], label: str, id_col: str, k: int = 5, seed: int = 42,
    parallelism: int = 10,
) -> DataFrame:
    """AUROC per model and stratified fold, refitting on the other folds.

    The marked rows are written once, and models and folds run side by side as far as memory keeps their rows.
    """
    marked = staged(folds(df, id_col, label, k, seed, classes=(0, 1)), "folds")

    def work(name: str, fold: int) -> tuple:
        model = fits[name](marked.where(F.col("fold") != fold), features, label)
        scored = score_classifier(model, marked.where(F.col("fold") == fold))
        return name, fold, auroc(scored, "score", label).first()["auroc"]

    jobs = [(name, fold) for name in fits for fold in range(k)]
    together = {name: _fitting(marked, {name: fit}, features, k, parallelism) for name, fit in fits.items()}
    rows = _at_once(work, jobs, [together[name] for name, _ in jobs])
    return df.sparkSession.createDataFrame(rows, "model string, fold int, auroc double")


def cv_regressors(
    df: DataFrame, fits: dict[str, Fit], features: list[str], label: str, id_col: str, k: int = 5, seed: int = 42,
    parallelism: int = 10,
) -> DataFrame:
    """Mean absolute error per model and fold, on the log scale and in the target's own unit.

    The marked rows are written once, and models and folds run side by side as far as memory keeps their rows.
    """
    marked = staged(folds(df, id_col, None, k, seed), "folds")

    def work(name: str, fold: int) -> tuple:
        model = fits[name](marked.where(F.col("fold") != fold), features, label)
        scored = score_regressor(model, marked.where(F.col("fold") == fold))
        errors = scored.agg(
            F.avg(F.abs(F.col("predicted_log") - F.log1p(label))).alias("mae_log"),
            F.avg(F.abs(F.col("predicted") - F.col(label))).alias("mae"),
        ).first()
        return name, fold, errors["mae_log"], errors["mae"]

    jobs = [(name, fold) for name in fits for fold in range(k)]
    together = {name: _fitting(marked, {name: fit}, features, k, parallelism) for name, fit in fits.items()}
    rows = _at_once(work, jobs, [together[name] for name, _ in jobs])
    return df.sparkSession.createDataFrame(rows, "model string, fold int, mae_log double, mae double")


def cv_classification(df: DataFrame, fit: Fit, features: list[str], label: str, id_col: str, **settings) -> DataFrame:
    """AUROC per fold of one model."""
    return cv_classifiers(df, {"model": fit}, features, label, id_col, **settings).drop("model")


def cv_regression(df: DataFrame, fit: Fit, features: list[str], label: str, id_col: str, **settings) -> DataFrame:
    """Mean absolute error per fold of one model."""
    return cv_regressors(df, {"model": fit}, features, label, id_col, **settings).drop("model")


def cv_summary(scores: DataFrame, metric: str) -> DataFrame:
    """Mean and population standard deviation of a fold metric."""
    return scores.agg(
        F.avg(metric).alias(f"cv_{metric}"), F.stddev_pop(metric).alias(f"cv_{metric}_sd")
    )
