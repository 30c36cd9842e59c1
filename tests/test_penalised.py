"""Penalised leaf values: few passes, any size of tree, and scoring without one term per tree."""

import math

import numpy as np
import pytest
from test_clusters_intervals import study

from wardgrid.operators import models, penalised


def plain(leaf, y, sizes, rate=0.05, l1=0.1, l2=1.0):
    """Leaf values one tree after another, a pass for each."""
    f, out = np.full(len(y), y.mean()), []
    for k, size in enumerate(sizes):
        values = [0.0] * size
        for j in set(leaf[:, k]):
            own = leaf[:, k] == j
            g = (y - f)[own].sum()
            values[j] = rate * math.copysign(max(abs(g) - l1, 0.0), g) / (own.sum() + l2)
        f = f + np.array([values[j] for j in leaf[:, k]])
        out.append(values)
    return out, f


@pytest.mark.parametrize(("depth", "keep", "cells"), [(4, 20, 4096), (4, 3, 200), (7, 20, 4096), (7, 4, 1), (1, 20, 4096)])
def test_values_equal_a_pass_per_tree(spark, monkeypatch, depth, keep, cells):
    df, *_, target = study(spark)
    model = models.fit_gbt_regressor(df, ["a", "b", "c"], "t", rounds=9, depth=depth)
    monkeypatch.setattr(penalised, "KEEP", keep)
    monkeypatch.setattr(penalised, "CELLS", cells, raising=False)
    # Rows without a target take no part.
    more = df.unionByName(df.selectExpr(*[f"cast(null as double) as {c}" if c == "t" else c for c in df.columns]))
    trees = penalised.refit_leaves(model, more, "t")
    kept = penalised._with_leaves(model, df).select("id", "_leaf").orderBy("id").collect()
    want, f = plain(np.array([r["_leaf"] for r in kept]), np.log1p(target), [len(v) for v in trees.leaves])
    assert [v for values in trees.leaves for v in values] == pytest.approx([v for values in want for v in values], abs=1e-12)
    scored = penalised.score_penalised(trees, df).orderBy("id").collect()
    assert [r.predicted_log for r in scored] == pytest.approx(f.tolist())


def test_one_pass_values_several_trees(spark, monkeypatch):
    df, *_ = study(spark)
    model = models.fit_gbt_regressor(df, ["a", "b", "c"], "t", rounds=9)
    passes = []
    grouped = type(df).groupBy

    def counted(self, *keys):
        passes.append(keys)
        return grouped(self, *keys)

    monkeypatch.setattr(type(df), "groupBy", counted)
    trees = penalised.refit_leaves(model, df, "t")
    assert len(trees.leaves) == 9 and 1 <= len(passes) <= 5
    plan = penalised.score_penalised(trees, df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("element_at") <= 2


def test_no_rows_and_far_numbers(spark):
    df, *_ = study(spark, 60)
    model = models.fit_gbt_regressor(df, ["a", "b", "c"], "t", rounds=3)
    none = penalised.refit_leaves(model, df.where("id < 0"), "t")
    assert none.start == 0.0 and {v for values in none.leaves for v in values} == {0.0}
    # A target that isn't a number reaches every row of its leaves, and the sum it starts from.
    odd = penalised.refit_leaves(model, df.selectExpr("id", "a", "b", "c", "if(id = 0, double('nan'), t) as t"), "t")
    assert math.isnan(odd.start) and math.isnan(penalised.score_penalised(odd, df).first().predicted)
