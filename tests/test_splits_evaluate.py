import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wardgrid.operators import evaluate as E
from wardgrid.operators import splits as S


def labelled(spark, n0=89, n1=40):
    data = [(i, 0) for i in range(n0)] + [(1000 + i, 1) for i in range(n1)]
    return spark.createDataFrame(data, "id long, y int")


@pytest.mark.parametrize("classes", [(0, 1), None])
def test_stratified_split_is_exact_and_repeatable(spark, classes):
    df = labelled(spark)
    out = S.stratified_split(df, "id", "y", classes=classes)
    got = {r.y: (r.n, r.t) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    assert got == {0: (89, 18), 1: (40, 8)}
    again = S.stratified_split(df.repartition(3), "id", "y", classes=classes)
    assert rows(out, "id") == rows(again, "id")
    other = S.stratified_split(df, "id", "y", classes=classes, seed=7)
    assert rows(out, "id") != rows(other, "id")


def test_split_keeps_rows_with_a_missing_label(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 0)], "id long, y int")
    assert S.stratified_split(df, "id", "y").count() == 3


def test_random_split_size(spark):
    out = S.random_split(spark.range(1003).withColumnRenamed("id", "k"), "k")
    assert out.agg(F.sum("is_test")).first()[0] == 201


def test_folds_differ_by_at_most_one(spark):
    sizes = S.folds(labelled(spark), "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r.y == y]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    plain = [r["count"] for r in S.folds(spark.range(103), "id", k=5).groupBy("fold").count().collect()]
    assert sorted(plain) == [20, 20, 21, 21, 21]


def test_folds_of_a_tiny_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, y int")
    out = S.folds(df, "id", "y", 5).collect()
    assert sorted((r.y, r.fold) for r in out) == [(0, 2), (0, 4), (1, 4)]


def test_class_weights(spark):
    out = {r.y: (r.n, round(r.weight, 6), r.scale_pos_weight) for r in S.class_weights(labelled(spark), "y").collect()}
    assert out == {0: (89, round(129 / 178, 6), 89 / 40), 1: (40, round(129 / 80, 6), 89 / 40)}


def scored(spark, pairs):
    return spark.createDataFrame([(float(s), y) for s, y in pairs], "s double, y int")


@pytest.mark.parametrize(
    "pairs, want",
    [([(1, 0), (1, 1), (1, 0)], 0.5), ([(1, 0), (2, 1)], 1.0), ([(2, 0), (1, 1)], 0.0), ([(1, 1)], None)],
)
def test_auroc_corner_cases(spark, pairs, want):
    assert E.auroc(scored(spark, pairs), "s", "y").first().auroc == want


def brute_auroc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("per_octave", [None, 2, 64])
@pytest.mark.parametrize("digits", [0, 1, 6])
def test_auroc_matches_brute_force_for_any_number_of_cells(spark, per_octave, digits):
    rng = random.Random(digits)
    pairs = [(round(rng.gauss(0, 2), digits), int(rng.random() < 0.3)) for _ in range(400)]
    df = scored(spark, pairs)
    got = E.auroc(df, "s", "y", per_octave).first().auroc
    assert got == pytest.approx(brute_auroc(pairs))
    mirrored = E.auroc(df.withColumn("s", -F.col("s")), "s", "y", per_octave).first().auroc
    assert got + mirrored == pytest.approx(1.0)


def test_average_precision(spark):
    df = scored(spark, [(0.9, 1), (0.8, 0), (0.7, 1)])
    assert E.average_precision(df, "s", "y").first()[0] == pytest.approx(1 / 2 + 1 / 2 * 2 / 3)


def test_roc_points_are_monotone_and_complete(spark):
    rng = random.Random(1)
    df = scored(spark, [(rng.randint(0, 30), rng.randint(0, 1)) for _ in range(300)])
    points = E.roc_points(df, "s", "y", 8).orderBy(F.col("threshold").desc_nulls_first()).collect()
    assert (points[0].fpr, points[0].tpr) == (0, 0) and (points[-1].fpr, points[-1].tpr) == (1, 1)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(points, points[1:]))


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "y int, p int")
    assert rows(E.confusion_matrix(df, "y", "p"), "actual", "predicted") == [(0, 0, 1), (0, 1, 0), (1, 0, 2), (1, 1, 0)]


def test_report_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    out = {r["class"]: r for r in E.classification_report(df, "y", "p").collect()}
    assert out["1"].precision == 0 and out["1"].f1 == 0 and out["accuracy"].f1 == 0.5
    assert out["macro avg"].recall == 0.5 and out["weighted avg"].support == 2


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 1.0)], "y double, p double")
    row = E.regression_metrics(df, "y", "p").first()
    assert (row.n, row.mae) == (3, 1.0)
    assert row.rmse == pytest.approx((5 / 3) ** 0.5) and row.r2 == pytest.approx(1 - 5 / 8)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert E.regression_metrics(flat, "y", "p").first().r2 == 1.0


def test_missing_ids_and_other_classes_keep_their_rows(spark):
    data = [(k, k % 2) for k in range(40)] + [(None, 1), (100, None), (101, 7)]
    df = spark.createDataFrame(data, "id int, y int")
    hinted = S.stratified_split(df, "id", "y", classes=(0, 1))
    plain = S.stratified_split(df, "id", "y")
    assert hinted.count() == plain.count() == len(data)
    known = F.col("y").isin(0, 1)
    assert rows(hinted.where(known), "id") == rows(plain.where(known), "id")
    missing = [S.random_split(df, "id", seed=s).where("id is null").first().is_test for s in range(12)]
    assert sum(missing) < 12


def test_repeated_ids_raise_where_they_break_the_sizes(spark):
    df = spark.createDataFrame([(1 if k < 400 else k, k) for k in range(1000)], "id int, line int")
    out = S.random_split(df, ["id", "line"])
    assert out.where("is_test = 1").count() == 200
    clean = 0
    for seed in range(4):
        try:
            clean += S.random_split(df, "id", seed=seed).where("is_test = 1").count() == 200
        except Exception as error:
            assert "ids repeat" in str(error)
            clean += 1
    assert clean == 4


@pytest.mark.parametrize("label", [None, "y"])
def test_folds_hash_an_id_once_for_all_cuts(spark, label):
    df = spark.range(200).selectExpr("id", "id % 2 as y")
    out = S.folds(df, "id", label, k=5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan.splitlines()[0]
    assert sorted(r["count"] for r in out.groupBy("fold").count().collect()) == [40] * 5
