"""k-means, prediction intervals, co-moments, reduced ROC points, exclusion of cholestasis, penalised leaves and model fits."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgrid.operators import clusters, evaluate, models, penalised, prediction_intervals, scoring, statistics
from wardgrid.operators.ranking import first_row_per_key


def test_kmeans_against_plain_steps(spark):
    r = np.random.default_rng(1)
    points = np.concatenate([r.normal(c, 0.6, (60, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    df = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(points)] + [(900, None, 1.0), (901, float("nan"), 1.0)], "id int, x double, y double")
    start = clusters.start_centres(df, "id", ["x", "y"], 3)
    centres = np.array(start)
    for _ in range(20):
        near = ((points[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.array([points[near == k].mean(0) if (near == k).any() else centres[k] for k in range(3)])
    got = clusters.kmeans(df, "id", ["x", "y"], 3, start=start)
    assert np.allclose(got, centres)
    found = {r.cluster: r for r in clusters.cluster_representatives(clusters.assign_clusters(df, "id", ["x", "y"], got), "id").collect()}
    distance = np.sqrt(((points[:, None] - centres) ** 2).sum(2))
    near = distance.argmin(1)
    for k in range(3):
        members = np.flatnonzero(near == k)
        best = members[distance[members, k].argmin()]
        assert (found[k].id, found[k].n) == (best, len(members))
        assert found[k].distance == pytest.approx(distance[best, k]) and found[k].mean_distance == pytest.approx(distance[members, k].mean())


def test_kmeans_of_few_points(spark):
    df = spark.createDataFrame([(k, 1.0) for k in range(50)] + [(77, 3.0)], "id int, x double")
    assert sorted(clusters.kmeans(df, "id", ["x"], 5)) == [[1.0], [3.0]]
    assert clusters.kmeans(df.limit(0), "id", ["x"], 3) == []
    assert clusters.cluster_representatives(clusters.assign_clusters(df, "id", ["x"], []), "id").count() == 0


def test_intervals_cover_held_out_rows(spark):
    r = np.random.default_rng(2)
    predicted = r.uniform(0, 10, 4000)
    actual = predicted + r.normal(0, 0.2 + predicted / 5)
    df = spark.createDataFrame([(k, float(a), float(p)) for k, (a, p) in enumerate(zip(actual, predicted))] + [(9001, None, 1.0)], "id int, actual double, predicted double")
    out = prediction_intervals.quantile_intervals(df, "id", "actual", "predicted").persist()
    assert out.count() == 4001 and out.where("p10 > p50 or p50 > p90").count() == 0
    cover = {x.bin: x for x in prediction_intervals.interval_coverage(out, "actual").collect()}
    assert sum(x.n for x in cover.values()) == 4000
    assert sum(x.n * x.coverage for x in cover.values()) / 4000 == pytest.approx(0.8, abs=0.03)
    # Errors grow with the prediction, and so do the intervals.
    assert cover[9].mean_width > 3 * cover[0].mean_width
    out.unpersist()


def test_comoments_add_up(spark):
    r = random.Random(3)
    rows = [(r.choice("abc"), r.choice([1, 2]), 1e6 + r.gauss(0, 1), r.choice([None, r.gauss(0, 1)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, t int, x double, y double")
    parts = statistics.comoments(df, ["s", "t"], "x", "y")
    merged = {x.s: x for x in statistics.comoment_correlation(statistics.merge_comoments(parts, "s")).collect()}
    for s in "abc":
        pairs = np.array([(x, y) for k, _, x, y in rows if k == s and y is not None])
        assert merged[s].n == len(pairs) and merged[s].r == pytest.approx(np.corrcoef(pairs.T)[0, 1], rel=1e-6)
    constant = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0)], "s string, x double, y double")
    assert statistics.comoment_correlation(statistics.comoments(constant, "s", "x", "y")).first().r is None


def test_hours_segments(spark):
    hours = [-1.0, 0.0, 23.9, 24.0, 71.9, 72.0, 1e4, None]
    df = spark.createDataFrame([(h,) for h in hours], "h double").select("h", statistics.hours_segment(F.col("h")).alias("s"))
    assert [r.s for r in df.collect()] == [None, "0-24", "0-24", "24-72", "24-72", "72+", "72+", None]


@pytest.mark.parametrize("per_octave", [None, 1, 64])
def test_reduced_roc_points_keep_the_area(spark, per_octave):
    r = random.Random(4)
    rows = [(float(k), int(k > 100 and k % 3 > 0 or r.random() < 0.2)) for k in range(300) for _ in range(r.choice([1, 1, 2]))]
    df = spark.createDataFrame(rows, "score double, label int")
    full = sorted((x.fpr, x.tpr) for x in evaluate.roc_points(df, "score", "label").collect())
    some = sorted((x.fpr, x.tpr) for x in evaluate.roc_points_reduced(df, "score", "label", per_octave).collect())
    area = lambda points: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    steps = {}
    for s, y in rows:
        steps.setdefault(s, [0, 0])[1 - y] += 1
    order = sorted(steps, reverse=True)
    kept = [s for k, s in enumerate(order) if k in (0, len(order) - 1) or steps[s] != steps[order[k + 1]]]
    assert len(some) == len(kept) + 1 < len(full) and set(some) <= set(full) and area(some) == pytest.approx(area(full))


def test_cholestasis_exclusion(spark):
    peaks = spark.createDataFrame([(1, 500.0, 9.0), (2, 500.0, 9.0), (3, 500.0, 9.0), (4, 1.0, 9.0)], "s int, a double, b double")
    third = spark.createDataFrame([(1, 239.9), (2, 240.0), (4, 900.0)], "s int, alp double")
    out = scoring.cholestasis_exclusion(scoring.edish_quadrant(peaks, "a", "b"), third, "s", "alp")
    assert {r.s: (r.hys_law, r.cholestatic, r.hys_law_confirmed) for r in out.collect()} == {
        1: (True, False, True), 2: (True, True, False), 3: (True, False, True), 4: (False, True, False),
    }


def test_first_row_takes_one_shuffle(spark):
    df = spark.createDataFrame([(1, None, 5, "c"), (1, 2, 9, "b"), (1, 2, 9, "a"), (2, None, 1, "z"), (None, 0, 0, "n")], "k int, t int, n int, `v.w` string")
    out = first_row_per_key(df, "k", ["t", "n"])
    got = {r.k: (r.t, r.n) for r in out.collect()}
    assert got == {1: (2, 9), 2: (None, 1)} and out.columns == df.columns
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def study(spark, n=400):
    r = np.random.default_rng(5)
    x = r.normal(0, 1, (n, 3))
    y = (r.random(n) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1])))).astype(int)
    target = np.exp(1 + 0.5 * x[:, 0] + r.normal(0, 0.1, n))
    rows = [(k, *map(float, x[k]), int(y[k]), float(target[k])) for k in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, t double"), x, y, target


def test_logistic_scores_equal_a_plain_fit(spark):
    df, x, y, _ = study(spark)
    model = models.fit_logistic(df, ["a", "b", "c"], "y", tol=1e-10)
    got = {r.id: r.score for r in models.score_classifier(model, df).collect()}
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    design, penalty, beta = np.c_[z, np.ones(len(y))], np.diag([10.0, 10.0, 10.0, 0.0]), np.zeros(4)  # C = 0.1
    for _ in range(50):  # Newton
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + penalty, design.T @ (weight * (y - p)) - penalty @ beta)
        beta += step
    want = 1 / (1 + np.exp(-design @ beta))
    assert max(abs(got[k] - want[k]) for k in range(len(y))) < 1e-4
    ranked = [r.feature for r in models.feature_importance(model, ["a", "b", "c"]).collect()]
    assert ranked == ["a", "b", "c"]


def test_cross_validation_returns_real_errors(spark):
    df, *_ = study(spark)
    fits = {"logistic": models.fit_logistic, "share": models.fit_share}
    scores = {(r.model, r.fold): r.auroc for r in models.cv_classifiers(df, fits, ["a", "b", "c"], "y", "id", k=3).collect()}
    assert all(scores["logistic", f] > 0.75 and scores["share", f] == 0.5 for f in range(3))
    boosted = lambda train, features, label: models.fit_gbt_regressor(train, features, label, rounds=15, rate=0.3)
    errors = {(r.model, r.fold): r for r in models.cv_regressors(df, {"gbt": boosted, "mean": models.fit_log_mean}, ["a", "b", "c"], "t", "id", k=3).collect()}
    assert all(errors["gbt", f].mae_log < 0.6 * errors["mean", f].mae_log and errors["gbt", f].mae < errors["mean", f].mae for f in range(3))


def test_penalised_leaves_equal_a_plain_computation(spark, monkeypatch):
    monkeypatch.setattr(penalised, "KEEP", 3)
    df, _, _, target = study(spark)
    model = models.fit_gbt_regressor(df, ["a", "b", "c"], "t", rounds=8)
    trees = penalised.refit_leaves(model, df, "t", rate=0.05, l1=0.1, l2=1.0)
    leaf = {r.id: r["_leaf"] for r in penalised._with_leaves(model, df).select("id", "_leaf").collect()}
    y = np.log1p(target)
    f = np.full(len(y), y.mean())
    for k, values in enumerate(trees.leaves):
        member = np.array([leaf[i][k] for i in range(len(y))])
        for j in range(len(values)):
            own = member == j
            g = (y - f)[own].sum()
            want = 0.05 * math.copysign(max(abs(g) - 0.1, 0), g) / (own.sum() + 1.0) if own.any() else 0.0
            assert values[j] == pytest.approx(want, abs=1e-12)
        f = f + np.array([values[j] for j in member])
    scored = {r.id: r for r in penalised.score_penalised(trees, df).collect()}
    assert all(scored[i].predicted_log == pytest.approx(f[i]) and scored[i].predicted == pytest.approx(np.expm1(f[i])) for i in range(len(y)))
    assert np.abs(y - f).mean() < np.abs(y - y.mean()).mean()


def test_intervals_hash_ids_and_find_quantiles_once(spark):
    df = spark.createDataFrame([(k, k * 1.5, float(k % 40)) for k in range(400)], "id int, actual double, predicted double")
    out = prediction_intervals.quantile_intervals(df, "id", "actual", "predicted")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 400 and "md5" not in plan and "_coarse" not in plan


def test_logistic_fit_assembles_the_vectors_once(spark, monkeypatch):
    df, *_ = study(spark)
    written = []

    def staged(rows, name):
        written.append((name, rows.columns))
        return models_staged(rows, name)

    models_staged = models.staged
    monkeypatch.setattr(models, "staged", staged)
    model = models.fit_logistic(df, ["a", "b", "c"], "y")
    assert written == [("assembled", ["_features", "y", "_weight"])]
    assert [type(s).__name__ for s in model.stages] == ["VectorAssembler", "StandardScalerModel", "LogisticRegressionModel"]
