"""The registered model queries fit with the published configuration."""

import threading
import time

import pytest
from test_clusters_intervals import study

from __spark_entry__ import queries
from driver_queries import modelling
from wardgrid.operators import models
from wardgrid.session import staged


class Stopped(Exception):
    pass


@pytest.mark.parametrize("name", ["cv_regression", "cv_regression_models", "fit_gbt_penalised", "fit_gbt_regressor"])
def test_boosted_regression_takes_all_rounds(spark, monkeypatch, name):
    df, *_ = study(spark, 60)
    data = df.selectExpr("id as hadm_id", "a", "b", "t as los", "int(id % 5 = 0) as is_test")
    seen = []

    def regressor(maxIter, minInstancesPerNode, **_):
        seen.append((maxIter, minInstancesPerNode))
        raise Stopped

    monkeypatch.setattr(modelling, "_regression_study", lambda *_: (data, ["a", "b"]))
    monkeypatch.setattr(models, "GBTRegressor", regressor)
    with pytest.raises(Stopped):
        queries()[name](spark, "").count()
    assert seen and {rounds for rounds, _ in seen} == {300}


def test_cross_validated_regressors_fit_every_model_fold_and_row(spark, monkeypatch):
    df, *_ = study(spark, 60)
    data = df.selectExpr("id as hadm_id", "a", "b", "t as los", "int(id % 5 = 0) as is_test")
    asked, trained, tested = [], [], []
    boosted, score = models.GBTRegressor, models.score_regressor

    def regressor(**params):
        asked.append((params["maxIter"], params["minInstancesPerNode"]))
        return boosted(**{**params, "maxIter": 1})

    def scored(model, rows):
        tested.append(rows.count())
        return score(model, rows)

    for name, fit in list(modelling.REGRESSORS.items()):
        monkeypatch.setitem(
            modelling.REGRESSORS, name, lambda train, *rest, name=name, fit=fit: trained.append((name, train.count())) or fit(train, *rest)
        )
    monkeypatch.setattr(modelling, "_regression_study", lambda *_: (data, ["a", "b"]))
    monkeypatch.setattr(models, "GBTRegressor", regressor)
    monkeypatch.setattr(models, "score_regressor", scored)
    out = queries()["cv_regression_models"](spark, "").collect()
    assert sorted((r.model, r.fold) for r in out) == [(m, f) for m in ("gbt", "gbt_alt") for f in range(5)]
    assert all(r.mae > 0 and r.mae_log > 0 for r in out)
    # 300 rounds for all ten; rows marked as tested take part, and every row is held out once per model.
    assert sorted(asked) == [(300, 3)] * 5 + [(300, 5)] * 5
    assert sorted(trained) == [("gbt", 48)] * 5 + [("gbt_alt", 48)] * 5 and tested == [12] * 10


def test_regression_study_writes_the_marked_matrix_once(spark, monkeypatch):
    rows = [(i, i % 7, "2024-01-01", int(i % 3 == 0), float(i % 11), float(i) if i % 4 else None) for i in range(200)]
    matrix = spark.createDataFrame(rows, "hadm_id long, subject_id long, admittime string, flag int, age double, lab1_min double")
    # An order without a target, one with two, and a target without an order.
    target = spark.createDataFrame([(i, i / 10.0) for i in [*range(1, 200), 5, 777]], "hadm_id long, los double")
    monkeypatch.setattr(modelling, "order_matrix", lambda *_: matrix)
    monkeypatch.setattr(modelling, "_target", lambda *_: target)
    study, _ = modelling._study(spark, "")
    wanted = study.join(target, "hadm_id")
    written = []

    def counted(df, name):
        written.append(name)
        return staged(df, name)

    monkeypatch.setattr(modelling, "staged", counted)
    found, features = modelling._regression_study(spark, "")
    assert written == ["matrix", "regression"]
    assert features == ["age", "lab1_min"] and found.columns == wanted.columns
    assert found.count() == 200 and sorted(found.collect()) == sorted(wanted.collect())


@pytest.mark.parametrize("classes", [False, True])
def test_folds_run_side_by_side_as_far_as_memory_keeps_their_rows(spark, monkeypatch, classes):
    df, *_ = study(spark, 90)
    lock = threading.Lock()
    running, most = 0, 0
    met = threading.Event()
    plain = models.fit_share if classes else models.fit_log_mean

    def fit(train, features, label):
        nonlocal running, most
        with lock:
            running, most = running + 1, max(most, running + 1)
            if running > 1:
                met.set()
        met.wait(2)  # so fits that may run side by side do
        model = plain(train, features, label)
        with lock:
            running -= 1
        return model

    def scores(rows_kept):
        nonlocal most
        most = 0
        met.clear()
        # Sixty training rows a fold, three features; half of the memory is taken.
        monkeypatch.setattr(models, "storage_memory", lambda _: 2 * rows_kept * (180 + 4 * 3), raising=False)
        run, label = (models.cv_classification, "y") if classes else (models.cv_regression, "t")
        out = [tuple(r) for r in run(df, fit, ["a", "b", "c"], label, "id", k=3).orderBy("fold").collect()]
        return out, most

    one, alone = scores(100)
    two, pair = scores(120)
    none, fewest = scores(0)
    assert (alone, pair, fewest) == (1, 2, 1)
    assert one == two == none and len(one) == 3


def test_a_forest_counts_its_trees(spark, monkeypatch):
    df, *_ = study(spark, 60)
    monkeypatch.setattr(models, "storage_memory", lambda _: 2 * 5 * 40 * (180 + 4 * 3), raising=False)
    boosted, forest = {"m": models.fit_gbt_classifier}, {"m": models.fit_gbt_classifier, "f": models.fit_random_forest}
    assert models._fitting(df, boosted, ["a", "b", "c"], 3, 10) == 5
    assert models._fitting(df, forest, ["a", "b", "c"], 3, 10) == 1
    assert models._fitting(df, boosted, ["a", "b", "c"], 3, 2) == 2


def test_light_fits_run_side_by_side_beside_a_heavy_model(spark, monkeypatch):
    df, *_ = study(spark, 60)
    lock, running, beside = threading.Lock(), [], []

    def fit_as(kind):
        def fit(train, features, label):
            with lock:
                running.append(kind)
                beside.append(sorted(running))
            time.sleep(1)
            model = models.fit_share(train, features, label)
            with lock:
                running.remove(kind)
            return model

        return fit

    light, heavy = fit_as("light"), fit_as("heavy")
    monkeypatch.setattr(models, "fit_random_forest", heavy)
    # Memory for one forest of 200 trees, or five light fits: 40 training rows a fold, three features.
    monkeypatch.setattr(models, "storage_memory", lambda _: 2 * 40 * (180 + 4 * 203))
    out = models.cv_classifiers(df, {"a": light, "b": heavy, "c": light}, ["a", "b", "c"], "y", "id", k=3)
    assert ["heavy"] in beside and not any("heavy" in x and len(x) > 1 for x in beside)
    assert 1 < max(len(x) for x in beside) <= 5
    assert [(r.model, r.fold) for r in out.collect()] == [(m, f) for m in "abc" for f in range(3)]


def test_a_failing_fit_is_told(spark):
    def fails(train, features, label):
        raise Stopped

    df, *_ = study(spark, 60)
    with pytest.raises(Stopped):
        models.cv_regressors(df, {"a": fails, "b": models.fit_log_mean}, ["a"], "t", "id", k=3)


def test_storage_memory_is_known(spark):
    from wardgrid.session import storage_memory

    assert 2**30 < storage_memory(spark) < 8 * 2**30
