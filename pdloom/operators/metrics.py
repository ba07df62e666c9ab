"""Exact evaluation metrics of a 0/1 label against a score.

Rows are counted per distinct score before they move, which combines ties; curves and
areas come from running totals over those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pdloom.functions.columns import quoted
from pdloom.operators.ordering import exact_percentiles, running_totals, split_points

EPS = 2.220446049250313e-16


def _scores(df: DataFrame, label: str, prob: str, by: Sequence[str]) -> DataFrame:
    """Group, score and a one for a positive or a negative; unscored rows left out."""
    rows = df.where(quoted(label).isNotNull() & quoted(prob).isNotNull())
    positive = quoted(label) == 1
    return rows.select(
        *by,
        # Adding zero folds the two signed zeros into one score.
        (quoted(prob).cast("double") + F.lit(0.0)).alias("score"),
        positive.cast("long").alias("pos"),
        (~positive).cast("long").alias("neg"),
    )


def ranked_scores(
    df: DataFrame,
    label: str,
    prob: str,
    by: Sequence[str] = (),
    points: Sequence[float] | None = None,
) -> DataFrame:
    """Positives and negatives per group and distinct score, the counts below it and the
    group totals."""
    if points is None:
        points = split_points(df, prob)
    return running_totals(_scores(df, label, prob, by), "score", ["pos", "neg"], points, by)


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def _auc() -> Column:
    pairs = F.sum(_d("pos") * (_d("neg_below") + _d("neg") / 2))
    return F.try_divide(pairs, F.max(_d("pos_total")) * F.max(_d("neg_total")))


def _average_precision() -> Column:
    hits = _d("pos_total") - _d("pos_below")
    flagged = hits + _d("neg_total") - _d("neg_below")
    return F.try_divide(F.sum(_d("pos") * hits / flagged), F.max(_d("pos_total")))


def _brier() -> Column:
    s = F.col("score")
    loss = F.sum(_d("pos") * F.pow(1 - s, F.lit(2)) + _d("neg") * F.pow(s, F.lit(2)))
    return loss / F.sum(_d("pos") + _d("neg"))


def _log_loss() -> Column:
    s = F.least(F.greatest(F.col("score"), F.lit(EPS)), F.lit(1 - EPS))
    loss = -F.sum(_d("pos") * F.log(s) + _d("neg") * F.log(1 - s))
    return loss / F.sum(_d("pos") + _d("neg"))


def _confusion(threshold: float) -> dict[str, Column]:
    above = F.col("score") >= F.lit(float(threshold))

    def count(name: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(name)).otherwise(F.lit(0))).cast("long")

    return {
        "tn": count("neg", ~above),
        "fp": count("neg", above),
        "fn": count("pos", ~above),
        "tp": count("pos", above),
    }


def _or_nan(value: Column) -> Column:
    """NaN for a single class."""
    return F.coalesce(value, F.lit(float("nan")))


def _known(label: str, prob: str) -> Column:
    """Rows that have a label and a score."""
    score = quoted(prob)
    return quoted(label).isNotNull() & score.isNotNull() & ~F.isnan(score.cast("double"))


def roc_auc(df: DataFrame, label: str, prob: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """Area under the ROC curve, ties counted half; NaN for a single class."""
    ranked = ranked_scores(df, label, prob, by, **kw)
    return ranked.groupBy(*by).agg(_or_nan(_auc()).alias("roc_auc"))


def avg_precision(df: DataFrame, label: str, prob: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """Average precision as a step sum over distinct thresholds."""
    ranked = ranked_scores(df, label, prob, by, **kw)
    return ranked.groupBy(*by).agg(_or_nan(_average_precision()).alias("avg_precision"))


def brier(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.pow(quoted(prob) - quoted(label).cast("double"), F.lit(2))
    return df.groupBy(*by).agg(F.avg(error).alias("brier"))


def log_loss(df: DataFrame, label: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean negative log likelihood, scores kept off 0 and 1 by the double precision; rows
    without a label or score are left out."""
    p = F.least(F.greatest(quoted(prob), F.lit(EPS)), F.lit(1 - EPS))
    loss = F.when(quoted(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.groupBy(*by).agg(F.avg(F.when(_known(label, prob), loss)).alias("log_loss"))


def confusion(
    df: DataFrame, label: str, prob: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    above, positive = quoted(prob) >= F.lit(float(threshold)), quoted(label) == 1
    return df.groupBy(*by).agg(
        F.count_if(~above & ~positive).alias("tn"),
        F.count_if(above & ~positive).alias("fp"),
        F.count_if(~above & positive).alias("fn"),
        F.count_if(above & positive).alias("tp"),
    )


def with_precision_recall(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from confusion counts, zero when undefined."""

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def precision_recall_f1(
    df: DataFrame, label: str, prob: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    counted = confusion(df, label, prob, threshold, by)
    return with_precision_recall(counted).select(*by, "precision", "recall", "f1")


def evaluate_binary(
    df: DataFrame, label: str, prob: str, threshold: float = 0.5, by: Sequence[str] = (), **kw
) -> DataFrame:
    """Every metric in one row per group, from one set of score counts."""
    ranked = ranked_scores(df, label, prob, by, **kw)
    scored = ranked.groupBy(*by).agg(
        F.lit(float(threshold)).alias("threshold"),
        _or_nan(_auc()).alias("roc_auc"),
        _or_nan(_average_precision()).alias("pr_auc"),
        _brier().alias("brier"),
        _log_loss().alias("log_loss"),
        *[c.alias(n) for n, c in _confusion(threshold).items()],
    )
    return with_precision_recall(scored)


def roc_curve(df: DataFrame, label: str, prob: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """False and true positive rate at every distinct threshold."""
    ranked = ranked_scores(df, label, prob, by, **kw)
    return ranked.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(_d("neg_total") - _d("neg_below"), _d("neg_total")).alias("fpr"),
        F.try_divide(_d("pos_total") - _d("pos_below"), _d("pos_total")).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str, prob: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """Precision and recall at every distinct threshold."""
    ranked = ranked_scores(df, label, prob, by, **kw)
    hits = _d("pos_total") - _d("pos_below")
    flagged = hits + _d("neg_total") - _d("neg_below")
    return ranked.select(
        *by,
        F.col("score").alias("threshold"),
        (hits / flagged).alias("precision"),
        F.try_divide(hits, _d("pos_total")).alias("recall"),
    )


def calibration_curve(
    df: DataFrame, label: str, prob: str, bins: int = 10, strategy: str = "quantile"
) -> DataFrame:
    """Mean label and mean score per non-empty bin of equal count or equal width, over the rows
    that have both."""
    df = df.where(_known(label, prob))
    if strategy == "quantile":
        probs = [i / bins for i in range(1, bins)]
        edges = exact_percentiles(df, {prob: probs})[prob] or []
    elif strategy == "uniform":
        edges = [i / bins for i in range(1, bins)]
    else:
        raise ValueError(f"unknown strategy: {strategy}")
    number = F.lit(0)
    for edge in edges:
        number = number + (quoted(prob) > F.lit(edge)).cast("int")
    return df.groupBy(number.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(quoted(label).cast("double")).alias("prob_true"),
        F.avg(quoted(prob)).alias("prob_pred"),
    )


def auc_gate(df: DataFrame, label: str, prob: str, floor: float, **kw) -> DataFrame:
    """Whether the area reaches a floor."""
    area = roc_auc(df, label, prob, **kw)
    reached = ~F.isnan("roc_auc") & (F.col("roc_auc") >= F.lit(float(floor)))
    return area.select("roc_auc", F.lit(float(floor)).alias("floor"), reached.alias("passed"))
