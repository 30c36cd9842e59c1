"""Splits, evaluation and models."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from driver_queries.features import IDS, TYPES, order_matrix
from driver_queries.registry import ENCOUNTERS, LAB_WIDE, STAYS, encounters, query, rounded, stays, table
from driver_queries.statistics import PREDICTIONS, _predictions
from wardgrid.operators import evaluate as E
from wardgrid.operators import models as M
from wardgrid.operators import splits as S
from wardgrid.operators import prediction_intervals as P
from wardgrid.operators.impute import residual_impute
from wardgrid.operators.penalised import refit_leaves, score_penalised
from wardgrid.operators.ranking import feature_top_n
from wardgrid.session import staged, staging_path
from wardgrid.sources.scan import feature_columns
from wardgrid.sources.sinks import write_model_results

# -- splits -----------------------------------------------------------------------------------

_KEYED = f"""(select hadm_id, flag, row_number() over (partition by flag order by
    md5('42:' || hadm_id) || ':' || hadm_id) as rk, count(*) over (partition by flag) as n
    from (select hadm_id, coalesce(flag, 0) as flag from {ENCOUNTERS} e) f)"""
_ALL = f"""(select hadm_id, row_number() over (order by md5('42:' || hadm_id) || ':' || hadm_id) as rk,
    count(*) over () as n from {ENCOUNTERS} e)"""


def _labelled(spark, sf):
    return encounters(spark, sf).select("hadm_id", F.coalesce("flag", F.lit(0)).alias("flag"))


@query(
    "stratified_split",
    f"select hadm_id, flag, case when rk <= floor(n * 0.2::double + 0.5) then 1 else 0 end as is_test "
    f"from {_KEYED} k",
)
def _(spark, sf):
    return S.stratified_split(_labelled(spark, sf), "hadm_id", "flag", classes=(0, 1))


@query(
    "random_split",
    f"select hadm_id, case when rk <= floor(n * 0.2::double + 0.5) then 1 else 0 end as is_test "
    f"from {_ALL} k",
)
def _(spark, sf):
    return S.random_split(encounters(spark, sf).select("hadm_id"), "hadm_id")


_FOLD = "cast(" + " + ".join(f"(rk > floor(n * {i} / 5.0))::int" for i in range(1, 5)) + " as integer)"


@query("stratified_folds", f"select hadm_id, flag, {_FOLD} as fold from {_KEYED} k")
def _(spark, sf):
    return S.folds(_labelled(spark, sf), "hadm_id", "flag", 5)


@query("random_folds", f"select hadm_id, {_FOLD} as fold from {_ALL} k")
def _(spark, sf):
    return S.folds(encounters(spark, sf).select("hadm_id"), "hadm_id", k=5)


@query(
    "class_weights",
    f"""with f as (select coalesce(flag, 0) as flag from {ENCOUNTERS} e),
    t as (select count(*) as n, count(distinct flag) as k, count(*) filter (where flag = 1) as pos,
      count(*) filter (where flag = 0) as neg from f)
    select f.flag, count(*) as n, round(any_value(t.n) / (any_value(t.k) * count(*))::double, 6) as weight,
      round(any_value(t.neg) / any_value(t.pos)::double, 6) as scale_pos_weight
    from f cross join t group by f.flag""",
)
def _(spark, sf):
    return rounded(S.class_weights(_labelled(spark, sf), "flag"))


# -- evaluation -------------------------------------------------------------------------------

SCORED = """(select d.doc_id, n_chars::double as score, quality as label, toxic,
    case when n_chars > 500 then 1 else 0 end as pred from labels l join documents d
    on l.doc_id = d.doc_id)"""


def _scored(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return table(spark, sf, "labels").join(documents, "doc_id").select(
        "doc_id", "score", F.col("quality").alias("label"), "toxic",
        (F.col("score") > 500).cast("int").alias("pred"),
    )


def _auroc_sql(rows: str, label: str) -> str:
    return f"""with c as (select score, count(*) filter (where {label} = 1) as pos,
      count(*) filter (where {label} = 0) as neg from {rows} s group by score),
    t as (select *, coalesce(sum(neg) over (order by score rows between unbounded preceding
      and 1 preceding), 0) as below from c)
    select round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6)::double as auroc,
      sum(pos)::bigint as n_pos, sum(neg)::bigint as n_neg from t"""


@query("auroc", _auroc_sql(SCORED, "label"))
def _(spark, sf):
    return rounded(E.auroc(_scored(spark, sf), "score", "label"))


LINES_SCORED = """(select l_extendedprice as score, case when l_returnflag = 'R' then 1 else 0 end as label
    from lineitem)"""


def lines_scored(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


@query("auroc_large", _auroc_sql(LINES_SCORED, "label"))
def _(spark, sf):
    return rounded(E.auroc(lines_scored(spark, sf), "score", "label"))


def _descending(rows: str, label: str) -> str:
    return f"""c as (select score, count(*) filter (where {label} = 1) as pos,
      count(*) filter (where {label} = 0) as neg from {rows} s group by score),
    d as (select score, pos, neg, sum(pos) over w as tp, sum(neg) over w as fp,
      sum(pos) over () as n_pos, sum(neg) over () as n_neg from c
      window w as (order by score desc rows unbounded preceding))"""


@query(
    "average_precision",
    f"with {_descending(SCORED, 'toxic')} "
    "select round(sum(pos::double / n_pos * tp / (tp + fp)), 6) as average_precision from d",
)
def _(spark, sf):
    return rounded(E.average_precision(_scored(spark, sf), "score", "toxic"))


@query(
    "roc_points",
    f"with {_descending(SCORED, 'label')} select score as threshold, round(fp::double / n_neg, 6) as fpr, "
    "round(tp::double / n_pos, 6) as tpr from d union all select null, 0.0, 0.0",
)
def _(spark, sf):
    return rounded(E.roc_points(_scored(spark, sf), "score", "label"))


_STEPS = f"with {_descending(LINES_SCORED, 'label')}, s as (select *, lead(pos) over (order by score desc) as next_pos, "
_STEPS += "lead(neg) over (order by score desc) as next_neg, row_number() over (order by score desc) as k from d)"


@query(
    "roc_points_reduced",
    f"{_STEPS} select score as threshold, round(fp::double / n_neg, 6) as fpr, round(tp::double / n_pos, 6) as tpr from s "
    "where k = 1 or next_pos is null or next_pos <> pos or next_neg <> neg union all select null, 0.0, 0.0",
)
def _(spark, sf):
    return rounded(E.roc_points_reduced(lines_scored(spark, sf), "score", "label"))


@query(
    "pr_curve",
    f"with {_descending(SCORED, 'label')} select score as threshold, round(tp::double / (tp + fp), 6) as precision, "
    "round(tp::double / n_pos, 6) as recall from d",
)
def _(spark, sf):
    return rounded(E.pr_curve(_scored(spark, sf), "score", "label"))


@query(
    "confusion_matrix",
    f"""select g.actual, g.predicted, count(s.doc_id) as n from (values (0, 0), (0, 1), (1, 0), (1, 1))
    g(actual, predicted) left join {SCORED} s on s.label = g.actual and s.pred = g.predicted
    group by g.actual, g.predicted""",
)
def _(spark, sf):
    return E.confusion_matrix(_scored(spark, sf), "label", "pred")


@query(
    "classification_report",
    f"""with c as (select count(*) filter (where label = 0 and pred = 0)::double as tn,
      count(*) filter (where label = 0 and pred = 1)::double as fp,
      count(*) filter (where label = 1 and pred = 0)::double as fn,
      count(*) filter (where label = 1 and pred = 1)::double as tp from {SCORED} s),
    m as (select *, coalesce(tn / nullif(tn + fn, 0), 0) as p0, coalesce(tn / nullif(tn + fp, 0), 0) as r0,
      coalesce(tp / nullif(tp + fp, 0), 0) as p1, coalesce(tp / nullif(tp + fn, 0), 0) as r1,
      tn + fp as s0, tp + fn as s1, tn + fp + tp + fn as n from c),
    f as (select *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) as f0,
      coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) as f1 from m),
    a as (select '0' as class, p0 as p, r0 as r, f0 as f, s0 as s from f
      union all select '1', p1, r1, f1, s1 from f
      union all select 'accuracy', (tn + tp) / n, (tn + tp) / n, (tn + tp) / n, n from f
      union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n from f
      union all select 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
        (f0 * s0 + f1 * s1) / n, n from f)
    select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1,
      s::bigint as support from a""",
)
def _(spark, sf):
    return rounded(E.classification_report(_scored(spark, sf), "label", "pred"))


def _metrics_sql(where: str = "") -> str:
    return f"""select count(*) as n, round(avg(abs(predicted - actual)), 4) as mae,
    round(sqrt(avg((predicted - actual) ** 2)), 4) as rmse,
    round(1 - avg((predicted - actual) ** 2) / var_pop(actual), 6) as r2 from {PREDICTIONS} p {where}"""


def _metrics(df):
    out = E.regression_metrics(df, "actual", "predicted")
    return out.select(
        "n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2")
    )


@query("regression_metrics", _metrics_sql())
def _(spark, sf):
    return _metrics(_predictions(spark, sf))


@query(
    "model_comparison",
    " union all ".join(
        f"select '{m}' as model, * from ({_metrics_sql(f'where model = {chr(39)}{m}{chr(39)}')}) x"
        for m in ("A", "N", "R")
    ),
)
def _(spark, sf):
    preds = _predictions(spark, sf)
    return E.model_comparison(
        [
            _metrics(preds.where(F.col("model") == m)).select(F.lit(m).alias("model"), "*")
            for m in ("A", "N", "R")
        ]
    )


@query(
    "fit_mean_baseline",
    f"""with k as (select hadm_id, unit, los, row_number() over (order by md5('42:' || key) || ':' || key)
      as rk, count(*) over () as n from (select hadm_id, unit, los, hadm_id as key from (
        select hadm_id, any_value(unit) as unit, max(los) as los from {STAYS} s where los > 0
        group by hadm_id) g) h),
    t as (select *, rk <= floor(n * 0.2::double + 0.5) as is_test from k)
    select hadm_id, los, round((select exp(avg(ln(1 + los))) - 1 from t where not is_test), 6) as prediction
    from t where is_test""",
)
def _(spark, sf):
    longest = stays(spark, sf).where(F.col("los") > 0).groupBy("hadm_id").agg(F.max("los").alias("los"))
    marked = S.random_split(longest, "hadm_id")
    train, test = marked.where(F.col("is_test") == 0), marked.where(F.col("is_test") == 1)
    out = M.fit_mean_baseline(train, test, "los").select("hadm_id", "los", "prediction")
    return rounded(out)


# -- prediction intervals -------------------------------------------------------------------------

_TOTALS = """(select o_orderkey as hadm_id, o_totalprice as actual, round(sum(l_extendedprice), 2) as predicted
    from orders join lineitem on o_orderkey = l_orderkey group by all)"""
_INTERVALS = f"""with k as (select *, row_number() over (order by md5('42:' || hadm_id) || ':' || hadm_id) as rk, count(*) over () as n from {_TOTALS} t),
    f as (select hadm_id, actual, predicted, {_FOLD} as fold from k),
    c as (select g.fold, actual, predicted from f join (select unnest(range(5))::int as fold) g on f.fold <> g.fold),
    e as (select fold, quantile_cont(predicted, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as edges from c group by fold),
    b as (select fold, len(list_filter(edges, lambda x: x < predicted)) as bin, actual - predicted as r from c join e using (fold)),
    q as (select fold, bin, quantile_cont(r, [0.1, 0.5, 0.9]) as q from b group by all),
    i as (select hadm_id, actual, predicted, f.fold, len(list_filter(edges, lambda x: x < predicted))::int as bin,
      predicted + q[1] as p10, predicted + q[2] as p50, predicted + q[3] as p90
      from f join e using (fold) left join q on q.fold = f.fold and q.bin = len(list_filter(edges, lambda x: x < predicted)))"""


def _intervals(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("hadm_id"), F.col("o_totalprice").alias("actual"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("hadm_id")).agg(F.round(F.sum("l_extendedprice"), 2).alias("predicted"))
    return P.quantile_intervals(staged(orders.join(lines, "hadm_id"), "totals"), "hadm_id", "actual", "predicted")


@query(
    "quantile_intervals",
    f"{_INTERVALS} select hadm_id, actual, predicted, fold, bin, round(p10, 4) as p10, round(p50, 4) as p50, round(p90, 4) as p90 from i",
)
def _(spark, sf):
    return rounded(_intervals(spark, sf), 4)


@query(
    "interval_coverage",
    f"{_INTERVALS} select bin, count(*) as n, round(avg((actual between p10 and p90)::int), 6) as coverage, "
    "round(avg(p90 - p10), 3) as mean_width from i group by bin",
)
def _(spark, sf):
    out = P.interval_coverage(_intervals(spark, sf), "actual")
    return out.select("bin", "n", F.round("coverage", 6).alias("coverage"), F.round("mean_width", 3).alias("mean_width"))


# -- models -----------------------------------------------------------------------------------
#
# SQL can't repeat a fit.  Queries named after an operator return its scores, errors and importances, and tests check them
# on small tables; those named ``*_invariants``, ``*_constant`` and ``*_mean`` return what SQL can say of any sound fit.

TESTED = f"(select hadm_id, flag from {_KEYED} k where rk <= floor(n * 0.2::double + 0.5))"


def _marked(spark, sf):
    """Order matrix with every residual gap filled and the test rows marked."""
    matrix = staged(order_matrix(spark, sf), "matrix")
    features = feature_columns(matrix, "flag", IDS)
    return S.stratified_split(residual_impute(matrix, features), "hadm_id", "flag", classes=(0, 1)), features


def _study(spark, sf):
    """The marked matrix, staged once."""
    marked, features = _marked(spark, sf)
    return staged(marked, "study"), features


def _parts(data):
    return data.where(F.col("is_test") == 0), data.where(F.col("is_test") == 1)


def _scores(spark, sf, fit):
    """Score and predicted class of the tested rows."""
    data, features = _study(spark, sf)
    train, test = _parts(data)
    return M.score_classifier(fit(train, features, "flag"), test).select("hadm_id", "flag", "score", "predicted")


def _classify(spark, sf, fit):
    """The tested rows, whether scores are probabilities, and whether classes follow from them."""
    data, features = _study(spark, sf)
    train, test = _parts(data)
    scored = M.score_classifier(fit(train, features, "flag"), test)
    return scored.select(
        "hadm_id", "flag",
        F.col("score").between(0, 1).alias("is_probability"),
        (F.col("predicted") == (F.col("score") > 0.5).cast("int")).alias("class_follows"),
    )


_CLASSIFIED = f"select hadm_id, flag, true as is_probability, true as class_follows from {TESTED} t"


@query(
    "standard_scale",
    f"""with k as (select hadm_id, rk, n from {_ALL} k), v as (select hadm_id, rk <= floor(n * 0.2::double + 0.5) as is_test,
      feature, x from k join (select o_orderkey, unnest(['amount', 'customer']) as feature,
        unnest([o_totalprice, o_custkey::double]) as x from orders) o on hadm_id = o_orderkey),
    m as (select feature, avg(x) as mean, stddev_samp(x) as sd from v where not is_test group by feature)
    select hadm_id, v.feature, round((x - mean) / sd, 6) as z from v join m on v.feature = m.feature where is_test""",
)
def _(spark, sf):
    names = ["amount", "customer"]
    numbers = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), F.col("o_totalprice").alias("amount"), F.col("o_custkey").cast("double").alias("customer")
    )
    train, test = _parts(staged(S.random_split(numbers, "hadm_id"), "scaled"))
    model = Pipeline(stages=[M._assembler(names), M.standard_scale()]).fit(train)
    scaled = model.transform(test).withColumn("_z", vector_to_array("_scaled"))
    return rounded(scaled.select("hadm_id", *[F.col("_z")[k].alias(n) for k, n in enumerate(names)]).unpivot("hadm_id", names, "feature", "z"))


@query("fit_logistic")
def _(spark, sf):
    return _scores(spark, sf, M.fit_logistic)


@query("fit_logistic_invariants", _CLASSIFIED)
def _(spark, sf):
    return _classify(spark, sf, M.fit_logistic)


@query(
    "fit_logistic_balance",
    f"""select count(*) filter (where rk > floor(n * 0.2::double + 0.5)) as n_train, 0.5::double as weighted_score
    from {_KEYED} k""",
)
def _(spark, sf):
    """A free intercept makes the weighted scores average to the weighted share of class 1, here one half."""
    data, features = _study(spark, sf)
    train, _ = _parts(data)
    scored = M.score_classifier(M.fit_logistic(train, features, "flag"), train)
    per_class = scored.groupBy("flag").agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))
    return per_class.agg(F.sum("n").alias("n_train"), F.round(F.avg("mean"), 3).alias("weighted_score"))


@query("fit_random_forest")
def _(spark, sf):
    return _scores(spark, sf, M.fit_random_forest)


@query("fit_random_forest_invariants", _CLASSIFIED)
def _(spark, sf):
    return _classify(spark, sf, M.fit_random_forest)


@query("fit_gbt_classifier")
def _(spark, sf):
    return _scores(spark, sf, M.fit_gbt_classifier)


@query("fit_gbt_classifier_invariants", _CLASSIFIED)
def _(spark, sf):
    return _classify(spark, sf, M.fit_gbt_classifier)


def _target(spark, sf):
    # The order total is not part of the matrix, so it serves as a positive, skewed target.
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("hadm_id"), (F.col("o_totalprice") / F.lit(10000.0)).alias("los")
    ).where(F.col("los") > 0)


def _regression_study(spark, sf):
    """The marked matrix with its target, staged once, not before the join as well."""
    marked, features = _marked(spark, sf)
    return staged(marked.join(_target(spark, sf), "hadm_id"), "regression"), features


def _predictions_of(spark, sf, fit):
    """Predictions of the tested rows on both scales."""
    data, features = _regression_study(spark, sf)
    train, test = _parts(data)
    return M.score_regressor(fit(train, features, "los"), test).select("hadm_id", "los", "predicted_log", "predicted")


def _regress(spark, sf, fit):
    """The tested rows, whether predictions are above -1 and fit the log scale."""
    data, features = _regression_study(spark, sf)
    train, test = _parts(data)
    scored = M.score_regressor(fit(train, features, "los"), test)
    return scored.select(
        "hadm_id", F.round("los", 6).alias("los"),
        (F.col("predicted") > -1).alias("in_range"),
        (F.abs(F.log1p("predicted") - F.col("predicted_log")) < 1e-9).alias("scales_agree"),
    )


_REGRESSED = f"""select hadm_id, round(o_totalprice / 10000.0, 6) as los, true as in_range, true as scales_agree
    from {TESTED} t join orders on hadm_id = o_orderkey where o_totalprice > 0"""


@query("fit_gbt_regressor")
def _(spark, sf):
    return _predictions_of(spark, sf, M.fit_gbt_regressor)


@query("fit_gbt_regressor_invariants", _REGRESSED)
def _(spark, sf):
    return _regress(spark, sf, M.fit_gbt_regressor)


@query("fit_gbt_regressor_alt")
def _(spark, sf):
    return _predictions_of(spark, sf, M.fit_gbt_regressor_alt)


@query("fit_gbt_regressor_alt_invariants", _REGRESSED)
def _(spark, sf):
    return _regress(spark, sf, M.fit_gbt_regressor_alt)


@query("fit_gbt_penalised")
def _(spark, sf):
    """Boosted trees with L1 and L2 penalties on their leaves."""
    data, features = _regression_study(spark, sf)
    train, test = _parts(data)
    trees = refit_leaves(M.fit_gbt_regressor(train, features, "los"), train, "los")
    return score_penalised(trees, test).select("hadm_id", "los", "predicted_log", "predicted")


@query("cv_classification")
def _(spark, sf):
    data, features = _study(spark, sf)
    return M.cv_classification(data, M.fit_logistic, features, "flag", "hadm_id")


@query("cv_regression")
def _(spark, sf):
    data, features = _regression_study(spark, sf)
    return M.cv_regression(data, M.fit_gbt_regressor, features, "los", "hadm_id")


@query(
    "cv_classification_constant",
    "select fold, 0.5::double as auroc from (select distinct fold from "
    f"(select {_FOLD} as fold from {_KEYED} k) f) g",
)
def _(spark, sf):
    """A constant score, whose area is one half in every fold."""
    return M.cv_classification(_labelled(spark, sf), M.fit_share, [], "flag", "hadm_id")


@query(
    "cv_regression_mean",
    f"""with f as (select hadm_id, {_FOLD} as fold, los from {_ALL} k
      join (select o_orderkey, o_totalprice / 10000.0 as los from orders where o_totalprice > 0) o on hadm_id = o_orderkey),
    m as (select g.fold, avg(ln(1 + f.los)) as mean from f join (select distinct fold from f) g on f.fold <> g.fold group by g.fold)
    select f.fold, round(avg(abs(mean - ln(1 + los))), 6) as mae_log, round(avg(abs(exp(mean) - 1 - los)), 6) as mae
    from f join m on f.fold = m.fold group by f.fold""",
)
def _(spark, sf):
    """The errors of the mean model in every fold."""
    return rounded(M.cv_regression(_target(spark, sf), M.fit_log_mean, [], "los", "hadm_id"))


@query(
    "cv_summary",
    f"""with f as (select hadm_id, {_FOLD} as fold, los from {_ALL} k
      join (select o_orderkey, o_totalprice / 10000.0 as los from orders where o_totalprice > 0) o on hadm_id = o_orderkey),
    m as (select g.fold, avg(ln(1 + f.los)) as mean from f join (select distinct fold from f) g on f.fold <> g.fold group by g.fold),
    e as (select f.fold, avg(abs(exp(mean) - 1 - los)) as mae from f join m on f.fold = m.fold group by f.fold)
    select round(avg(mae), 6) as cv_mae, round(stddev_pop(mae), 6) as cv_mae_sd from e""",
)
def _(spark, sf):
    return rounded(M.cv_summary(M.cv_regression(_target(spark, sf), M.fit_log_mean, [], "los", "hadm_id"), "mae"))


CLASSIFIERS = {"logistic": M.fit_logistic, "random_forest": M.fit_random_forest, "gbt": M.fit_gbt_classifier}
REGRESSORS = {"gbt": M.fit_gbt_regressor, "gbt_alt": M.fit_gbt_regressor_alt}


@query("cv_classification_models")
def _(spark, sf):
    data, features = _study(spark, sf)
    return M.cv_classifiers(data, CLASSIFIERS, features, "flag", "hadm_id")


@query("cv_regression_models")
def _(spark, sf):
    data, features = _regression_study(spark, sf)
    return M.cv_regressors(data, REGRESSORS, features, "los", "hadm_id")


MATRIX_FEATURES = ["age", "age_imputed", *[f"type_{t}" for t in TYPES], "balance", "comorbidity", *LAB_WIDE]


@query("feature_importance")
def _(spark, sf):
    data, features = _study(spark, sf)
    return M.feature_importance(M.fit_random_forest(_parts(data)[0], features, "flag"), features)


@query("feature_top_n")
def _(spark, sf):
    data, features = _study(spark, sf)
    return feature_top_n(M.feature_importance(M.fit_random_forest(_parts(data)[0], features, "flag"), features), 15)


@query(
    "feature_importance_invariants",
    "select unnest([" + ", ".join(f"'{f}'" for f in MATRIX_FEATURES) + "]) as feature, "
    "true as not_negative, 1.0::double as total",
)
def _(spark, sf):
    """Names, signs and the sum of the forest's importances."""
    data, features = _study(spark, sf)
    found = M.feature_importance(M.fit_random_forest(_parts(data)[0], features, "flag"), features)
    total = found.agg(F.round(F.sum("importance"), 6)).scalar()
    return found.select("feature", (F.col("importance") >= 0).alias("not_negative"), total.alias("total"))


_CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "feature_top_n_correlations",
    "select feature, round(abs(r), 6) as importance from (" + " union all ".join(
        f"select '{c}' as feature, corr({c}, case when l_returnflag = 'R' then 1.0 else 0.0 end) as r from lineitem"
        for c in _CORRELATED
    ) + ") c order by abs(r) desc, feature limit 3",
)
def _(spark, sf):
    label = (F.col("l_returnflag") == "R").cast("double")
    row = table(spark, sf, "lineitem").agg(*[F.abs(F.corr(c, label)).alias(c) for c in _CORRELATED])
    return rounded(feature_top_n(row.unpivot([], _CORRELATED, "feature", "importance"), 3))


def _write_results(spark, sf):
    data, features = _study(spark, sf)
    train, test = _parts(data)
    model = M.fit_logistic(train, features, "flag")
    scored = M.score_classifier(model, test).select("hadm_id", "flag", "score", "predicted")
    results = {"model": model, "predictions": scored, "metrics": E.auroc(scored, "score", "flag")}
    return write_model_results(results, staging_path(spark, "results")), test


@query("write_model_results")
def _(spark, sf):
    """The written predictions with the written metric."""
    path, _ = _write_results(spark, sf)
    return spark.read.parquet(f"{path}/predictions").withColumn("auroc", spark.read.parquet(f"{path}/metrics").select("auroc").scalar())


@query(
    "write_model_results_invariants",
    f"select hadm_id, flag, true as same_score, true as same_auroc from {TESTED} t",
)
def _(spark, sf):
    """Written predictions next to those of the reloaded model, and the written metric computed anew."""
    path, test = _write_results(spark, sf)
    written = spark.read.parquet(f"{path}/predictions")
    again = M.score_classifier(PipelineModel.load(f"{path}/model"), test).select("hadm_id", F.col("score").alias("_again"))
    metric = spark.read.parquet(f"{path}/metrics").select("auroc").scalar()
    anew = E.auroc(written, "score", "flag").select("auroc").scalar()
    return written.join(again, "hadm_id").select(
        "hadm_id", "flag", (F.abs(F.col("score") - F.col("_again")) < 1e-9).alias("same_score"), (F.abs(metric - anew) < 1e-9).alias("same_auroc")
    )
