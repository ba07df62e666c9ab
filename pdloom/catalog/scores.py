"""Metrics, models, attributions and composite jobs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pdloom.catalog.base import (
    CTES,
    DATE,
    cleaned,
    engineered,
    part,
    query,
    rounded,
    scored,
    scored_split,
    split2,
    using,
)
from pdloom.catalog.model_sql import balanced, filled_inputs, flag_inputs, newton_steps
from pdloom.operators import attribution, metrics, models, preprocess, splits
from pdloom.plans.feature_matrix import align_features, fit_feature_matrix
from pdloom.plans.spec import build_spec, spec_table
from pdloom.plans.validate import importance_checks, validate_matrix
from pdloom.session import cached, materialize, scratch_path
from pdloom.sources.fixture import loans
from pdloom.sources.tables import load_bundle, save_bundle
from pdloom.streaming.scoring import BundleScorer, committed, score_stream

# ---------------------------------------------------------------- metrics

_RANKED = {
    "counts": """select split, prob, sum("default") as pos, sum(1 - "default") as neg
        from scored group by 1, 2""",
    "curve": """select *, sum(pos) over w as pos_upto, sum(neg) over w as neg_upto,
        sum(pos) over (partition by split) as p, sum(neg) over (partition by split) as n
        from counts window w as (partition by split order by prob)""",
    "auc": """select split, sum(pos * (neg_upto - neg + neg / 2)) / (max(p) * max(n))
        as roc_auc from curve group by 1""",
    "ap": """select split, sum(pos / p * (p - pos_upto + pos)
        / (p - pos_upto + pos + n - neg_upto + neg)) as avg_precision from curve group by 1""",
    "losses": """select split, avg((prob - "default") * (prob - "default")) as brier,
        -avg("default" * ln(prob) + (1 - "default") * ln(1 - prob)) as log_loss
        from scored group by 1""",
    "confusion": """select split,
        count(*) filter (where prob < 0.3 and "default" = 0) as tn,
        count(*) filter (where prob >= 0.3 and "default" = 0) as fp,
        count(*) filter (where prob < 0.3 and "default" = 1) as fn,
        count(*) filter (where prob >= 0.3 and "default" = 1) as tp from scored group by 1""",
    "prf": """select split, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
        coalesce(tp / nullif(tp + fn, 0), 0) as recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from confusion""",
}


def _metric(body: str) -> str:
    return using("scored", body, **_RANKED)


@query("roc_auc", _metric("select split, round(roc_auc, 9) as roc_auc from auc"))
def roc_auc(spark, sf):
    areas = metrics.roc_auc(scored_split(spark, sf), "default", "prob", ["split"])
    return rounded(areas, 9, "roc_auc")


@query(
    "avg_precision",
    _metric("select split, round(avg_precision, 9) as avg_precision from ap"),
)
def avg_precision(spark, sf):
    areas = metrics.avg_precision(scored_split(spark, sf), "default", "prob", ["split"])
    return rounded(areas, 9, "avg_precision")


@query("brier", _metric("select split, round(brier, 9) as brier from losses"))
def brier(spark, sf):
    return rounded(
        metrics.brier(scored_split(spark, sf), "default", "prob", ["split"]), 9, "brier"
    )


@query("log_loss", _metric("select split, round(log_loss, 9) as log_loss from losses"))
def log_loss(spark, sf):
    return rounded(
        metrics.log_loss(scored_split(spark, sf), "default", "prob", ["split"]), 9, "log_loss"
    )


@query("confusion", _metric("select * from confusion"))
def confusion(spark, sf):
    return metrics.confusion(scored_split(spark, sf), "default", "prob", 0.3, ["split"])


@query(
    "precision_recall_f1",
    _metric(
        """select split, round(precision, 9) as precision, round(recall, 9) as recall,
        round(f1, 9) as f1 from prf"""
    ),
)
def precision_recall_f1(spark, sf):
    result = metrics.precision_recall_f1(
        scored_split(spark, sf), "default", "prob", 0.3, ["split"]
    )
    return rounded(result, 9, "precision", "recall", "f1")


@query(
    "evaluate_binary",
    _metric(
        """select split, cast(0.3 as double) as threshold, round(roc_auc, 9) as roc_auc,
        round(avg_precision, 9) as pr_auc, round(brier, 9) as brier,
        round(log_loss, 9) as log_loss, tn, fp, fn, tp, round(precision, 9) as precision,
        round(recall, 9) as recall, round(f1, 9) as f1
        from auc join ap using (split) join losses using (split)
        join confusion using (split) join prf using (split)"""
    ),
)
def evaluate_binary(spark, sf):
    result = metrics.evaluate_binary(scored_split(spark, sf), "default", "prob", 0.3, ["split"])
    names = ["roc_auc", "pr_auc", "brier", "log_loss", "precision", "recall", "f1"]
    return rounded(result, 9, *names)


@query(
    "roc_curve",
    _metric(
        """select split, round(prob, 9) as threshold, round((n - neg_upto + neg) / n, 9) as fpr,
        round((p - pos_upto + pos) / p, 9) as tpr from curve"""
    ),
)
def roc_curve(spark, sf):
    curve = metrics.roc_curve(scored_split(spark, sf), "default", "prob", ["split"])
    return rounded(curve, 9, "threshold", "fpr", "tpr")


@query(
    "pr_curve",
    _metric(
        """select split, round(prob, 9) as threshold, round((p - pos_upto + pos)
        / (p - pos_upto + pos + n - neg_upto + neg), 9) as precision,
        round((p - pos_upto + pos) / p, 9) as recall from curve"""
    ),
)
def pr_curve(spark, sf):
    curve = metrics.pr_curve(scored_split(spark, sf), "default", "prob", ["split"])
    return rounded(curve, 9, "threshold", "precision", "recall")


@query(
    "calibration_curve",
    using(
        "scored",
        """select cast(len(list_filter(edges, lambda e: e < prob)) as integer) as bin,
        count(*) as n, round(avg("default"), 9) as prob_true, round(avg(prob), 9) as prob_pred
        from scored cross join edges group by 1""",
        edges="""select quantile_cont(prob, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
        as edges from scored""",
    ),
)
def calibration_curve(spark, sf):
    curve = metrics.calibration_curve(scored(spark, sf), "default", "prob")
    return rounded(curve, 9, "prob_true", "prob_pred")


@query(
    "auc_gate",
    using(
        "scored",
        """select round(a, 9) as roc_auc, cast(0.65 as double) as floor, a >= 0.65 as passed
        from (select sum(pos * (upto - neg + neg / 2)) / (sum(pos) * sum(neg)) as a from (
        select *, sum(neg) over (order by prob) as upto from (select prob,
        sum("default") as pos, sum(1 - "default") as neg from scored group by 1)))""",
    ),
)
def auc_gate(spark, sf):
    return rounded(metrics.auc_gate(scored(spark, sf), "default", "prob", 0.65), 9, "roc_auc")


# ---------------------------------------------------------------- preprocessing

_NUMERIC = ["loan_amnt", "annual_inc", "int_rate", "dti"]
_TERMS = [" 36 months", " 60 months"]
_YEARS = [*[f"{i} years" for i in range(1, 11)], "10+ years", "< 1 year"]
_HOLES = {
    "holes": """select loan_id, split, loan_amnt, annual_inc, int_rate,
        case when loan_id % 11 <> 0 then dti end as dti, term, grade, emp_length from split2""",
    "train": "select * from holes where split = 'train'",
}


def _holes(spark, sf):
    return split2(spark, sf).withColumn(
        "dti", F.when(F.expr("loan_id % 11 <> 0"), F.col("dti"))
    )


def _flags_sql(column: str, values, source: str) -> str:
    return ", ".join(
        f"cast(coalesce({source} = '{v}', false) as double) as \"cat__{column}_{v}\""
        for v in values
    )


_PRE_FILLED = (
    "select loan_id, "
    + ", ".join(
        f"""round((coalesce({c}, (select median({c}) from train)) - (select avg(coalesce({c},
        (select median({c}) from train))) from train)) / (select stddev_pop(coalesce({c},
        (select median({c}) from train))) from train), 6) + 0 as num__{c}"""
        for c in _NUMERIC
    )
    + ", "
    + _flags_sql("term", _TERMS, "term")
    + ", "
    + _flags_sql("grade", "ABCDEFG", "grade")
    + ", "
    + _flags_sql(
        "emp_length",
        _YEARS,
        "coalesce(emp_length, (select emp_length from train where emp_length is not null "
        "group by 1 order by count(*) desc, 1 limit 1))",
    )
    + " from holes"
)
_PRE_PLAIN = (
    "select loan_id, "
    + ", ".join(
        f"""round(({c} - (select avg({c}) from train)) / (select stddev_pop({c}) from train), 6) + 0
        as num__{c}"""
        for c in _NUMERIC
    )
    + ", "
    + _flags_sql("term", _TERMS, "term")
    + ", "
    + _flags_sql("grade", "ABCDEFG", "grade")
    + ", "
    + _flags_sql("emp_length", _YEARS, "emp_length")
    + ', cast(emp_length is null as double) as "cat__emp_length_nan" from holes'
)


def _preprocessed(spark, sf, impute):
    rows = _holes(spark, sf)
    pre = preprocess.fit_preprocess(
        part(rows, "train"), _NUMERIC, ["term", "grade", "emp_length"], impute=impute
    )
    return rounded(pre.transform(rows, ["loan_id"]), 6, *[f"num__{c}" for c in _NUMERIC])


@query("fit_preprocess", using("split2", _PRE_FILLED, **_HOLES))
def fit_preprocess(spark, sf):
    return _preprocessed(spark, sf, True)


@query("fit_preprocess_tune", using("split2", _PRE_PLAIN, **_HOLES))
def fit_preprocess_tune(spark, sf):
    return _preprocessed(spark, sf, False)


@query(
    "class_weights",
    using(
        "cleaned",
        """select "default", count(*) as n, round(sum(count(*)) over () / (2 * count(*)), 9)
        as weight from cleaned group by 1""",
    ),
)
def class_weights(spark, sf):
    return rounded(preprocess.class_weights(cleaned(spark, sf)), 9, "weight")


# ---------------------------------------------------------------- fitted models

_MODEL_NUMERIC = ["loan_amnt", "annual_inc", "int_rate", "dti", "term_months", "grade_numeric"]
_MODEL_TEXT = ["term", "home_ownership"]
_HOMES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _baseline(spark, sf):
    """Split rows with domain features, and the linear baseline fitted on the first part."""
    rows = splits.prepare_split(cleaned(spark, sf))
    with cached(part(rows, "train")) as train:
        pre = preprocess.fit_preprocess(train, _MODEL_NUMERIC, _MODEL_TEXT)
        return rows, pre, models.train_lr(train, pre)


_MODEL_INPUTS = [
    *filled_inputs("split2", "part1", _MODEL_NUMERIC),
    *flag_inputs("part1", {"term": _TERMS, "home_ownership": _HOMES}),
]
_BASELINE = {
    "part1": "select * from split2 where split = 'train'",
    "prepared": f"""select loan_id, split, "default", [{', '.join(f'({x})::double' for x in _MODEL_INPUTS)},
        1.0::double] as inputs, {balanced("part1")} as w from split2""",
    **newton_steps(
        "(select * from prepared where split = 'train')",
        [f"inputs[{i + 1}]" for i in range(len(_MODEL_INPUTS))],
        '"default"',
        "w",
    ),
    "margins": """select loan_id, split, "default", list_dot_product(inputs, beta) as margin
        from prepared, fitted_lr""",
    "scored": "select *, round(1 / (1 + exp(-margin)), 9) as prob from margins",
}
_AT_HALF = {name: body.replace("0.3", "0.5") for name, body in _RANKED.items()}
_EVALUATED = """select split, cast(0.5 as double) as threshold, round(roc_auc, 6) as roc_auc,
    round(avg_precision, 6) as pr_auc, round(brier, 6) as brier,
    round(log_loss, 6) as log_loss, tn, fp, fn, tp, round(precision, 6) as precision,
    round(recall, 6) as recall, round(f1, 6) as f1
    from auc join ap using (split) join losses using (split)
    join confusion using (split) join prf using (split)"""
_METRICS = ["roc_auc", "pr_auc", "brier", "log_loss", "precision", "recall", "f1"]


@query("train_lr", using("split2", _EVALUATED, **_BASELINE, **_AT_HALF))
def train_lr(spark, sf):
    rows, _, model = _baseline(spark, sf)
    scored_rows = rounded(models.score_loans(model, rows).select("split", "default", "pd"), 9, "pd")
    found = metrics.evaluate_binary(materialize(scored_rows), "default", "pd", by=["split"])
    return rounded(found, 6, *_METRICS)


@query(
    "score_loans",
    using(
        "split2",
        "select loan_id, split, round(1 / (1 + exp(-margin)), 6) as pd, round(margin, 6) + 0 as margin from margins",
        **_BASELINE,
    ),
)
def score_loans(spark, sf):
    rows, _, model = _baseline(spark, sf)
    found = models.score_loans(model, rows).select("loan_id", "split", "pd", "margin")
    return rounded(found, 6, "pd", "margin")


def _boosted(rows):
    with cached(part(rows, "train")) as train:
        pre = preprocess.fit_preprocess(train, _MODEL_NUMERIC, _MODEL_TEXT, center=False)
        return models.train_gbt(train, pre, id_col="loan_id")


@query("train_gbt")
def train_gbt(spark, sf):
    rows = splits.prepare_split(cleaned(spark, sf))
    boosted = models.score_loans(_boosted(rows), rows)
    scored_rows = materialize(boosted.select("split", "default", "pd"))
    return metrics.evaluate_binary(scored_rows, "default", "pd", by=["split"])


@query("calibrate_sigmoid")
def calibrate_sigmoid(spark, sf):
    dated = splits.time_split3(engineered(spark, sf), "issue_d", "loan_id")
    scored_rows = materialize(models.score_loans(_boosted(dated), dated))
    slope, intercept = models.calibrate_sigmoid(part(scored_rows, "val"))
    both = models.apply_sigmoid(part(scored_rows, "test"), slope, intercept)
    error = [
        F.avg(F.pow(F.col(p) - F.col("default"), F.lit(2))).alias(f"{p}_brier")
        for p in ("pd", "pd_calibrated")
    ]
    return both.agg(*error).withColumn(
        "keep_calibrated", F.col("pd_calibrated_brier") < F.col("pd_brier")
    )


@query("tune_grid")
def tune_grid(spark, sf):
    """All 32 points of the default grid, of 200 and 400 trees."""
    rows = splits.prepare_split(cleaned(spark, sf))
    return models.tune_grid(
        part(rows, "train"), part(rows, "holdout"), _MODEL_NUMERIC, _MODEL_TEXT, id_col="loan_id"
    )


def _split3_matrix(spark, sf):
    """Feature matrix fitted on the first of three parts, with its split."""
    dated = splits.time_split3(cleaned(spark, sf), "issue_d", "loan_id")
    plan = fit_feature_matrix(part(dated, "train"))
    return plan.transform(dated, ["loan_id", "split"]), plan


_WIDTH = len(_MODEL_INPUTS)
_FEATURE_NAMES = [
    *[f"num__{c}" for c in _MODEL_NUMERIC],
    *[f"cat__term_{t}" for t in _TERMS],
    *[f"cat__home_ownership_{h}" for h in _HOMES],
]
_IMPORTANCE = {
    **{k: v for k, v in _BASELINE.items() if k not in ("margins", "scored")},
    "held": """select loan_id, "default", inputs, beta, list_dot_product(inputs, beta) as margin,
        cast(ceil(count(*) over () / 5000.0) as bigint) as buckets
        from prepared, fitted_lr where split = 'holdout'""",
    "turns": """select *, md5(loan_id::varchar || ':' || repeat) as h
        from held, (select unnest(generate_series(1, 5)) as repeat)""",
    "dealt": "select *, ('0x' || substr(h, 1, 8))::bigint % buckets as bucket from turns",
    "donors": """select *, coalesce(lead(inputs) over w, first_value(inputs) over w) as donor
        from dealt window w as (partition by repeat, bucket order by h, loan_id)""",
    "swapped": f"""select repeat, j, "default", round(1 / (1 + exp(-(
        margin + beta[j] * (donor[j] - inputs[j])))), 9) as prob
        from donors, (select unnest(generate_series(1, {_WIDTH})) as j)
        union all select 0, 0, "default", round(1 / (1 + exp(-margin)), 9) from held""",
    "pairs": """select repeat, j, prob, sum("default") as pos, sum(1 - "default") as neg
        from swapped group by 1, 2, 3""",
    "upto": """select *, sum(neg) over (partition by repeat, j order by prob) as neg_upto
        from pairs""",
    "areas": """select repeat, j, sum(pos * (neg_upto - neg + neg / 2)) / (sum(pos) * sum(neg)) as area
        from upto group by 1, 2""",
    "lost": """select a.j, avg(b.area - a.area) as importance_mean,
        stddev_pop(b.area - a.area) as importance_std
        from areas a, areas b where b.j = 0 and a.j > 0 group by 1""",
    "named": f"""select ([{', '.join(f"'{n}'" for n in _FEATURE_NAMES)}])[j] as feature,
        importance_mean, importance_std from lost""",
}


def _importance(spark, sf):
    rows, pre, model = _baseline(spark, sf)
    vectors = PipelineModel(model.stages[:-1]).transform(part(rows, "holdout"))
    return models.permutation_importance(
        model.stages[-1], vectors.select("loan_id", "default", "features"), pre.outputs, "loan_id"
    )


@query(
    "permutation_importance",
    using(
        "split2",
        """select feature, round(importance_mean, 6) + 0 as importance_mean,
        round(importance_std, 6) + 0 as importance_std from named""",
        **_IMPORTANCE,
    ),
)
def permutation_importance(spark, sf):
    return rounded(_importance(spark, sf), 6, "importance_mean", "importance_std")


@query(
    "importance_checks",
    using(
        "split2",
        """select max_by(feature, importance_mean) as top_feature,
        round(max(importance_mean), 6) as top_importance,
        round(coalesce(sum(importance_mean) filter (where starts_with(feature, 'issue_d_')), 0.0), 6)
        as time_importance, count(*) as n_features, max(importance_mean) <= 0.3 as single_ok,
        coalesce(sum(importance_mean) filter (where starts_with(feature, 'issue_d_')), 0.0) <= 0.25
        as time_ok from named""",
        **_IMPORTANCE,
    ),
)
def importance_limits(spark, sf):
    found = importance_checks(_importance(spark, sf))
    return rounded(found, 6, "top_importance", "time_importance")


# ---------------------------------------------------------------- attributions

COEFFICIENTS = {
    "loan_amnt": 0.00002,
    "annual_inc": -0.000004,
    "int_rate": 0.11,
    "dti": 0.006,
    "term_months": 0.01,
    "grade_numeric": 0.05,
}
INTERCEPT = -3.2
_MEANS = {
    "means": "select "
    + ", ".join(f"avg({c}) as {c}" for c in COEFFICIENTS)
    + " from split2 where split = 'train'",
    "attributed": "select loan_id, split, "
    + ", ".join(f"h.{c} as v_{c}, {k!r}::double * (h.{c} - m.{c}) as a_{c}"
                for c, k in COEFFICIENTS.items())
    + f", 1 / (1 + exp(-({INTERCEPT!r}::double"
    + "".join(f" + {k!r}::double * h.{c}" for c, k in COEFFICIENTS.items())
    + "))) as pd from split2 h cross join means m",
    "long": " union all ".join(
        f"""select loan_id, {i} as i, '{c}' as feature, cast(v_{c} as double) as value,
        a_{c} as attribution, split from attributed"""
        for i, c in enumerate(COEFFICIENTS)
    ),
}


def _explained(spark, sf):
    """Split rows, and the means of the first part that attributions are measured from."""
    rows = splits.prepare_split(cleaned(spark, sf))
    return rows, attribution.background_means(part(rows, "train"), list(COEFFICIENTS))


@query(
    "linear_attribution",
    using(
        "split2",
        """select loan_id, feature, round(value, 6) as value,
        round(attribution, 9) + 0 as attribution from long where split = 'holdout'""",
        **_MEANS,
    ),
)
def linear_attribution(spark, sf):
    rows, means = _explained(spark, sf)
    explained = attribution.linear_attribution(part(rows, "holdout"), COEFFICIENTS, means)
    flat = explained.select("loan_id", F.inline("attributions"))
    return rounded(rounded(flat, 6, "value"), 9, "attribution")


@query(
    "top_k_abs",
    using(
        "split2",
        """select loan_id, feature, round(attribution, 9) + 0 as attribution from (select *,
        row_number() over (partition by loan_id order by abs(attribution) desc, i) as r
        from long) where r <= 3""",
        **_MEANS,
    ),
)
def top_k_abs(spark, sf):
    rows, means = _explained(spark, sf)
    explained = attribution.linear_attribution(rows, COEFFICIENTS, means)
    top = explained.select("loan_id", F.inline(attribution.top_k_abs("attributions", 3)))
    return rounded(top.drop("value"), 9, "attribution")


@query(
    "global_importance",
    using(
        "split2",
        """select feature, round(avg(abs(attribution)), 9) as mean_abs_attribution
        from long where split = 'holdout' group by 1 order by 2 desc, 1 limit 5""",
        **_MEANS,
    ),
)
def global_importance(spark, sf):
    rows, means = _explained(spark, sf)
    ranked = attribution.global_importance(part(rows, "holdout"), COEFFICIENTS, means, top=5)
    return rounded(ranked, 9, "mean_abs_attribution")


@query(
    "top_factors",
    using(
        "split2",
        f"""select loan_id, round(pd, 9) as pd, case when pd < 0.10 then 'Low'
        when pd < 0.25 then 'Medium' else 'High' end as risk_band, 'v1' as model_version,
        round(({INTERCEPT!r}::double"""
        + "".join(f" + {k!r}::double * (select {c} from means)" for c, k in COEFFICIENTS.items())
        + """), 9) as base_value, cast(r - 1 as integer) as place, feature,
        round(value, 6) as value, round(attribution, 9) + 0 as attribution
        from attributed join (select loan_id, feature, value, attribution,
        row_number() over (partition by loan_id order by abs(attribution) desc, i) as r
        from long) using (loan_id) where r <= 4""",
        **_MEANS,
    ),
)
def top_factors(spark, sf):
    rows, means = _explained(spark, sf)
    explained = attribution.top_factors(rows, COEFFICIENTS, INTERCEPT, means, 4, "v1")
    told = ["loan_id", "pd", "risk_band", "model_version", "base_value"]
    placed = explained.select(*told, F.posexplode("top_factors").alias("place", "factor"))
    flat = placed.select(*told, "place", "factor.feature", "factor.value", "factor.attribution")
    return rounded(rounded(flat, 6, "value"), 9, "pd", "base_value", "attribution")


# ---------------------------------------------------------------- composite jobs


def _one_hot_sql(column: str, values) -> str:
    parts = [
        f"cast(coalesce({column} = '{v}', false) as integer) as \"{column}_{v}\"" for v in values
    ]
    return ", ".join([*parts, f"cast({column} is null as integer) as \"{column}_<NA>\""])


_MATRIX_SQL = (
    """select loan_id, loan_amnt, annual_inc, int_rate, dti,
    round(ln(1 + greatest(annual_inc, 0)), 9) as annual_inc__log1p, loan_to_income,
    term_months, grade_numeric, sub_grade_numeric,
    cast(year(d) as integer) as issue_d_year, cast(month(d) as integer) as issue_d_month,
    cast(quarter(d) as integer) as issue_d_quarter, cast(case when d is not null then
    greatest((year(r) - year(d)) * 12 + month(r) - month(d), 0) end as integer)
    as loan_age_months, """
    + _one_hot_sql("grade", "ABCDEFG")
    + ", "
    + _one_hot_sql("term", ["36 months", "60 months"])
    + ", "
    + _one_hot_sql("home_ownership", _HOMES)
    + """, round(coalesce(em, prior), 9) as emp_length__target_mean,
    round(coalesce(sm, prior), 9) as sub_grade__target_mean"""
)
_MATRIX_STEPS = {
    "fitted": f"select avg(\"default\") as prior, max({DATE}) as r from split2 "
    "where split = 'train'",
    "emp": """select emp_length, avg("default") as em from split2 where split = 'train'
        and emp_length is not null group by 1""",
    "sub": """select sub_grade, avg("default") as sm from split2 where split = 'train'
        and sub_grade is not null group by 1""",
}
_MEAN_COLUMNS = ["annual_inc__log1p", "emp_length__target_mean", "sub_grade__target_mean"]


@query(
    "feature_matrix",
    using(
        "split2",
        _MATRIX_SQL
        + ', "default" from wide cross join fitted left join emp using (emp_length) '
        "left join sub using (sub_grade)",
        **_MATRIX_STEPS,
        wide=f"select * replace (trim(term) as term), {DATE} as d from split2",
    ),
)
def feature_matrix(spark, sf):
    rows = split2(spark, sf)
    plan = fit_feature_matrix(part(rows, "train"))
    return rounded(plan.transform(rows, ["loan_id"]), 9, *_MEAN_COLUMNS)


# Median-filled, scaled features of the matrix; a feature missing everywhere is left out.
_MATRIX3 = {
    "wide": f"""select * replace (trim(term) as term), {DATE} as d from split3""",
    **{k: v.replace("split2", "split3") for k, v in _MATRIX_STEPS.items()},
    "matrix": _MATRIX_SQL.replace("round(ln(1 + greatest(annual_inc, 0)), 9)", "ln(1 + greatest(annual_inc, 0))")
    .replace("round(coalesce(em, prior), 9)", "coalesce(em, prior)")
    .replace("round(coalesce(sm, prior), 9)", "coalesce(sm, prior)")
    + """, "default", split from wide cross join fitted left join emp using (emp_length)
    left join sub using (sub_grade)""",
    "part1": "select * from matrix where split = 'train'",
}
_MATRIX_FEATURES = [
    "loan_amnt", "annual_inc", "int_rate", "dti", "annual_inc__log1p", "loan_to_income", "term_months",
    "grade_numeric", "sub_grade_numeric", "issue_d_year", "issue_d_month", "issue_d_quarter",
    "loan_age_months", *[f"grade_{g}" for g in "ABCDEFG"], '"grade_<NA>"', '"term_36 months"',
    '"term_60 months"', '"term_<NA>"', *[f"home_ownership_{h}" for h in _HOMES],
    '"home_ownership_<NA>"', "emp_length__target_mean", "sub_grade__target_mean",
]
_CANARY = {
    **_MATRIX3,
    "prepared": f"""select split, "default",
        [{', '.join(f'({x})::double' for x in filled_inputs("matrix", "part1", _MATRIX_FEATURES, center=False))},
        1.0::double] as inputs, {balanced("part1")} as w from matrix where split <> 'test'""",
    **newton_steps(
        "(select * from prepared where split = 'train')",
        [f"inputs[{i + 1}]" for i in range(len(_MATRIX_FEATURES))],
        '"default"',
        "w",
    ),
    "scored": """select split, "default", round(1 / (1 + exp(-list_dot_product(inputs, beta))), 9)
        as prob from prepared, fitted_lr""",
    **{k: _RANKED[k] for k in ("counts", "curve", "auc")},
    "areas": """select max(roc_auc) filter (where split = 'train') as t,
        max(roc_auc) filter (where split = 'val') as v from auc""",
}


@query(
    "canary_lr",
    using(
        "split3",
        """select round(t, 6) as train_auc, round(v, 6) as val_auc, round(t - v, 6) + 0 as auc_gap,
        v <= 0.95 as auc_ok, t - v <= 0.1 as gap_ok from areas""",
        **_CANARY,
    ),
)
def canary_lr(spark, sf):
    dated = splits.time_split3(cleaned(spark, sf), "issue_d", "loan_id")
    with cached(dated):
        plan = fit_feature_matrix(part(dated, "train"))
        matrix = plan.transform(dated, ["loan_id", "split"])
        found = models.canary_lr(part(matrix, "train"), part(matrix, "val"), plan.feature_columns)
    return rounded(found, 6, "train_auc", "val_auc", "auc_gap")


@query(
    "align_features",
    using(
        "split2",
        _MATRIX_SQL
        + " from wide cross join fitted left join emp using (emp_length) "
        "left join sub using (sub_grade)",
        **_MATRIX_STEPS,
        wide="""select loan_id, loan_amnt, annual_inc, dti, trim(term) as term, grade, sub_grade,
        home_ownership, cast(null as double) as int_rate, cast(null as varchar) as emp_length,
        cast(null as date) as d, loan_to_income, term_months, grade_numeric, sub_grade_numeric
        from split2""",
    ),
)
def align(spark, sf):
    rows = split2(spark, sf)
    plan = fit_feature_matrix(part(rows, "train"))
    requests = rows.select(
        "loan_id",
        "loan_amnt",
        "annual_inc",
        "dti",
        "term",
        "grade",
        "sub_grade",
        "home_ownership",
    )
    matrix = plan.transform(align_features(requests), ["loan_id"])
    return rounded(matrix, 9, *_MEAN_COLUMNS)


_SPEC_NUMBERS = ["annual_inc", "dti", "int_rate", "loan_amnt"]
_SPEC_TEXTS = ["emp_length", "grade", "home_ownership", "sub_grade", "term"]


@query(
    "spec_from_data",
    using(
        "split2",
        """select 'numerical' as section, feature, case when abs(skew) > 1 then 'log' else 'none' end as plan,
        case when abs(skew) > 1 and low <= 0 then abs(low) + 1e-6 else 0.0 end as shift from numbers
        union all select 'categorical', feature, case when k <= 10 then 'one_hot'
        when k <= 100 then 'target_mean' else 'count_frequency' end, 0.0 from texts
        union all select 'datetime', 'issue_d', 'derived', 0.0
        union all select 'engineered', 'loan_age_months', 'derived', 0.0""",
        part1="select * from split2 where split = 'train'",
        numbers=" union all ".join(
            f"select '{c}' as feature, skewness({c}) as skew, min({c})::double as low from part1"
            for c in _SPEC_NUMBERS
        ),
        texts=" union all ".join(
            f"""select '{c}' as feature, count(distinct {c}) + max(cast({c} is null as integer)) as k
            from part1""" for c in _SPEC_TEXTS
        ),
    ),
)
def spec_from_data(spark, sf):
    """The spec of the training rows, and a matrix fitted with it, whose columns must be complete."""
    rows = split2(spark, sf)
    train = part(rows, "train").drop("split")
    spec = build_spec(train)
    plan = fit_feature_matrix(train, spec)
    missing = set(plan.feature_columns) - set(plan.transform(rows).columns)
    if missing:
        raise RuntimeError(f"columns missing from the matrix: {sorted(missing)}")
    return spec_table(train, spec)


@query(
    "validate_matrix",
    using(
        "split3",
        """select "check", passed, detail from (values ('spec_fingerprint', true, 'not frozen'),
        ('leakage_firewall', true, ''), ('feature_contract', true, ''), ('leakage_prefix', true, ''),
        ('target_present', true, '')) s("check", passed, detail) union all
        select 'target_not_null', count(*) filter (where "default" is null) = 0,
        cast(count(*) filter (where "default" is null) as varchar) from cleaned
        union all select 'target_allowed', count(*) filter (where "default" not in (0, 1)) = 0,
        cast(count(*) filter (where "default" not in (0, 1)) as varchar) from cleaned union all
        select 'no_overlap_' || a.split || '_' || b.split, a.hi <= b.lo,
        strftime(a.hi, '%Y-%m-%d') || ' ' || strftime(b.lo, '%Y-%m-%d') from ends a join ends b
        on (a.split, b.split) in (('train', 'val'), ('val', 'test'))""",
        ends=f"select split, min({DATE}) as lo, max({DATE}) as hi from split3 group by 1",
    ),
)
def validate(spark, sf):
    """Checks of a matrix whose encoders saw the first of the three parts only."""
    matrix, _ = _split3_matrix(spark, sf)
    checks = validate_matrix(matrix.drop("split"), "loan_id", cleaned_columns=cleaned(spark, sf).columns)
    return checks.select("check", "passed", "detail")


# The bundle: features and model fitted on the first of three parts, calibrated on the second.
_BUNDLE_INPUTS = filled_inputs("matrix", "part1", _MATRIX_FEATURES)
_BUNDLE_LIST = f"[{', '.join(f'({x})::double' for x in _BUNDLE_INPUTS)}, 1.0::double]"
_BUNDLE_FIT = {
    **_MATRIX3,
    "prepared": f"""select loan_id, split, "default", {_BUNDLE_LIST} as inputs, {balanced("part1")} as w
        from matrix""",
    **newton_steps(
        "(select * from prepared where split = 'train')",
        [f"inputs[{i + 1}]" for i in range(len(_MATRIX_FEATURES))],
        '"default"',
        "w",
    ),
}
_CALIBRATION = {
    "margins": """select loan_id, split, "default", list_dot_product(inputs, beta) as margin
        from prepared, fitted_lr""",
    "sides": """select margin, 1 as label, case when "default" = 1 then (pos + 1.0) / (pos + 2.0)
        else 1.0 / (neg + 2.0) end as share from margins, (select
        count(*) filter (where "default" = 1) as pos, count(*) filter (where "default" = 0) as neg
        from margins where split = 'val') where split = 'val'""",
    "two_sided": "select margin, 1 as label, share from sides union all select margin, 0, 1 - share from sides",
    **newton_steps("two_sided", ["margin"], "label", "share", 0.0, "sigmoid"),
}


def _saved_bundle(spark, sf):
    """Root of a folder of bundles with the calibrated linear model."""
    dated = splits.time_split3(cleaned(spark, sf), "issue_d", "loan_id")
    with cached(dated):
        plan = fit_feature_matrix(part(dated, "train"))
        with cached(plan.transform(part(dated, "train"), ["loan_id"])) as train:
            pre = preprocess.fit_preprocess(train, plan.feature_columns)
            model = models.train_lr(train, pre)
        val = models.score_loans(model, plan.transform(part(dated, "val"), ["loan_id"]))
        calibration = models.calibrate_sigmoid(val.select("default", "margin"))
    root = scratch_path(spark, "bundles")
    save_bundle(spark, root, "pd_lr_v1", model, plan, calibration=calibration)
    return root, dated


@query(
    "model_bundle",
    using(
        "split3",
        """select loan_id, round(1 / (1 + exp(-margin)), 6) as pd, round(1 / (1 + exp(-(
        beta[1] * margin + beta[2]))), 6) as pd_calibrated, 'pd_lr_v1' as model_version
        from margins, sigmoid""",
        **_BUNDLE_FIT,
        **_CALIBRATION,
    ),
)
def model_bundle(spark, sf):
    root, dated = _saved_bundle(spark, sf)
    found = load_bundle(spark, root).score(dated, ("loan_id",))
    return rounded(found.select("loan_id", "pd", "pd_calibrated", "model_version"), 6, "pd", "pd_calibrated")


_REQUEST_COLUMNS = "loan_id, loan_amnt, annual_inc, term, dti, grade, sub_grade, home_ownership"


@query(
    "score_stream",
    using(
        "split3",
        """select loan_id, round(pd, 6) as pd, case when pd < 0.10 then 'Low'
        when pd < 0.25 then 'Medium' else 'High' end as risk_band, 'pd_lr_v1' as model_version from (
        select loan_id, 1 / (1 + exp(-list_dot_product(inputs, beta))) as pd from asked, fitted_lr)""",
        **_BUNDLE_FIT,
        requests=f"""select {_REQUEST_COLUMNS} from loans
        where annual_inc > 0 and loan_amnt > 0 and dti >= 0""",
        enriched=CTES["engineered"].replace("from cleaned)", "from requests)"),
        raw="""select * replace (trim(term) as term), cast(null as double) as int_rate,
        cast(null as varchar) as emp_length, cast(null as date) as d from enriched""",
        request_matrix=_MATRIX3["matrix"]
        .replace(', "default", split from wide', " from raw"),
        asked=f"select loan_id, {_BUNDLE_LIST} as inputs from request_matrix",
    ),
)
def stream(spark, sf):
    """Requests that lack some raw columns, scored on a stream by the newest bundle."""
    bundles, _ = _saved_bundle(spark, sf)
    root = scratch_path(spark, "stream")
    requests = loans(spark, sf).drop("loan_status", "int_rate", "issue_d", "emp_length")
    requests.write.parquet(f"{root}/in")
    source = spark.readStream.schema(requests.schema).parquet(f"{root}/in")
    scorer = BundleScorer(spark, bundles, ["loan_id"])
    running = score_stream(
        source, scorer, f"{root}/out", f"{root}/bad", f"{root}/state", commits_path=f"{root}/commits"
    )
    running.awaitTermination()
    found = committed(spark, f"{root}/out", f"{root}/commits")
    return rounded(found.select("loan_id", "pd", "risk_band", "model_version"), 6, "pd")
