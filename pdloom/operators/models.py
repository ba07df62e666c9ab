"""Classifiers on Spark ML: fitting, scoring, calibration, tuning and importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import product
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.constants import MAX_AUC_GAP, MAX_BASELINE_AUC, TARGET, TUNING_GRID
from pdloom.functions.columns import quoted
from pdloom.operators.boosting import BoostedScorer, BoostParams, fit_boosted, prefix_margins
from pdloom.operators.metrics import roc_auc
from pdloom.operators.newton import WIDEST, LinearScorer, fit_logistic
from pdloom.operators.ordering import split_points
from pdloom.operators.preprocess import (
    FeatureVectors,
    Preprocessor,
    balanced_weight,
    class_weights,
    fit_preprocess,
)
from pdloom.session import cached, materialize, small_table

#: Rows of one cycle of exchanged values, on average.
CYCLE_ROWS = 5_000


def assemble(pre: Preprocessor) -> PipelineModel:
    """Preprocessing into the feature vector as a pipeline saved with the model."""
    return PipelineModel([pre.stage()])


def train_lr(
    train: DataFrame,
    pre: Preprocessor,
    target: str = TARGET,
    c: float = 1.0,
    max_iter: int = 2000,
    balanced: bool = True,
) -> PipelineModel:
    """L2 logistic regression; ``c`` is the inverse penalty on the sum of losses.

    Newton steps while the products of the features fit a task (``newton.WIDEST`` features), else
    L-BFGS; both end at the one optimum.
    """
    counts = {r[target]: r["n"] for r in class_weights(train, target).collect()}
    n = sum(counts.values())
    # Balanced weights add up to the number of rows, so the penalty scale is the same.
    weight = balanced_weight(counts, target) if balanced else F.lit(1.0)
    stages = assemble(pre).stages
    rows = stages[0].transform(
        train.withColumns({"label": quoted(target).cast("double"), "weight": weight})
    )
    if pre.width <= WIDEST:
        numbers = rows.select(vector_to_array("features").alias("x"), "label", "weight")
        known = numbers.where("label is not null")
        terms, intercept = fit_logistic(known, pre.width, 1.0 / c, max_iter)
        scorer = LinearScorer(coefficients=terms.tolist(), intercept=intercept)
        return PipelineModel([*stages, scorer])
    model = LogisticRegression(
        weightCol="weight",
        regParam=1.0 / (c * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
    ).fit(rows.select("features", "label", "weight"))
    return PipelineModel([*stages, model])


def _boosting_rows(
    df: DataFrame,
    pre: Preprocessor,
    target: str,
    id_col: str | None,
    validation_share: float,
    seed: int,
) -> DataFrame:
    """Features as an array, the label, a key that draws samples and the rows kept for validation."""
    rows = assemble(pre).transform(df.where(quoted(target).isNotNull()))
    x = vector_to_array("features")
    if id_col is None:
        key, valid = F.xxhash64(x), F.lit(False)
    else:
        key = F.xxhash64(quoted(id_col))
        bucket = F.pmod(F.xxhash64(quoted(id_col), F.lit(seed)), F.lit(1000))
        valid = bucket < int(1000 * validation_share)
    label = quoted(target).cast("double").alias("label")
    return rows.select(x.alias("x"), label, key.alias("key"), valid.alias("valid"))


def train_gbt(
    train: DataFrame,
    pre: Preprocessor,
    target: str = TARGET,
    max_depth: int = 6,
    step: float = 0.05,
    rounds: int = 300,
    min_leaf: int = 30,
    id_col: str | None = None,
    validation_share: float = 0.1,
    subsample: float = 1.0,
    column_share: float = 1.0,
    seed: int = 42,
    leaves: int | None = 31,
) -> PipelineModel:
    """Histogram boosting; with ``id_col`` a fixed share of the rows stops the rounds early."""
    params = BoostParams(
        rounds, max_depth, step, min_leaf, leaves, 0.0, subsample, column_share, seed
    )
    with cached(_boosting_rows(train, pre, target, id_col, validation_share, seed)) as rows:
        boosted = fit_boosted(rows, pre.width, [params])[0]
    return PipelineModel([*assemble(pre).stages, BoostedScorer(model=boosted.to_json())])


def score_loans(model: Transformer, df: DataFrame, output: str = "pd") -> DataFrame:
    """Adds the probability of default and the raw margin; keeps the input columns."""
    names = df.columns
    scored = model.transform(df)
    return scored.select(
        *[quoted(c) for c in names],
        vector_to_array("probability")[1].alias(output),
        vector_to_array("rawPrediction")[1].alias("margin"),
    )


def linear_terms(model: PipelineModel) -> tuple[dict[str, float], float]:
    """Coefficient per feature name, and the intercept, of a fitted logistic pipeline."""
    names = next(s for s in model.stages if isinstance(s, FeatureVectors)).pre.outputs
    fitted = model.stages[-1]
    if isinstance(fitted, LinearScorer):
        terms, intercept = fitted.terms()
    else:
        terms, intercept = fitted.coefficients.toArray().tolist(), fitted.intercept
    return dict(zip(names, terms)), intercept


def calibrate_sigmoid(scored: DataFrame, target: str = TARGET, margin: str = "margin"):
    """Platt scaling fitted on held-out margins with smoothed targets.

    Each row enters twice, as a positive and a negative with the smoothed target as weight.
    """
    y = quoted(target)
    with cached(scored.select(target, margin)) as held:
        sides = held.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).first()
        high = (sides["pos"] + 1.0) / (sides["pos"] + 2.0)
        low = 1.0 / (sides["neg"] + 2.0)
        share = F.when(y == 1, F.lit(high)).otherwise(F.lit(low))
        both = F.array(
            F.struct(F.lit(1.0).alias("label"), share.alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - share).alias("weight")),
        )
        rows = held.select(F.array(quoted(margin).cast("double")).alias("x"), F.inline(both))
        slopes, intercept = fit_logistic(rows, 1)
    return float(slopes[0]), intercept


def apply_sigmoid(
    scored: DataFrame, slope: float, intercept: float, output: str = "pd_calibrated"
) -> DataFrame:
    z = F.col("margin") * F.lit(float(slope)) + F.lit(float(intercept))
    return scored.withColumn(output, 1 / (1 + F.exp(-z)))


def tune_grid(
    train: DataFrame,
    holdout: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    target: str = TARGET,
    grid: Mapping[str, Sequence[Any]] = TUNING_GRID,
    id_col: str | None = None,
    min_leaf: int = 1,
) -> DataFrame:
    """Area on the holdout of every grid point; ``is_best`` marks the first best one.

    Points that differ in ``n_estimators`` only are prefixes of one fit, all fits grow side by side,
    and one pass over the holdout scores every point.
    """
    sizes = list(grid.get("n_estimators", [200]))
    others = {k: v for k, v in grid.items() if k != "n_estimators"}
    fits = [dict(zip(others, values)) for values in product(*others.values())]
    params = [
        BoostParams(
            rounds=max(sizes),
            depth=p.get("max_depth", 6),
            step=p.get("learning_rate", 0.05),
            min_leaf=min_leaf,
            leaves=None,
            ridge=1.0,
            subsample=p.get("subsample", 1.0),
            column_share=p.get("colsample_bytree", 1.0),
            patience=None,
        )
        for p in fits
    ]
    pre = fit_preprocess(train, numeric, categorical, impute=False)
    with cached(_boosting_rows(train, pre, target, id_col, 0.0, 42)) as rows:
        fitted = fit_boosted(rows, pre.width, params)
    held = _boosting_rows(holdout, pre, target, id_col, 0.0, 42).select("x", "label")
    margins = prefix_margins(held, fitted, sizes)
    scored = materialize(margins.select("label", F.posexplode("margins").alias("point", "margin")))
    areas = {r["point"]: r["roc_auc"] for r in roc_auc(scored, "label", "margin", by=["point"]).collect()}
    at = {
        (*fit.values(), size): areas[i * len(sizes) + j]
        for i, fit in enumerate(fits)
        for j, size in enumerate(sizes)
    }
    results = []
    for values in product(*grid.values()):
        point = dict(zip(grid, values))
        size = point.pop("n_estimators", sizes[0])
        results.append((*[float(v) for v in values], at[(*point.values(), size)]))
    best = max(range(len(results)), key=lambda i: (results[i][-1], -i))
    schema = ", ".join([*[f"{k} double" for k in grid], "roc_auc double", "is_best boolean"])
    rows = [(*r, i == best) for i, r in enumerate(results)]
    return small_table(train.sparkSession, rows, schema)


def canary_lr(
    train: DataFrame,
    val: DataFrame,
    features: Sequence[str],
    target: str = TARGET,
    max_auc: float = MAX_BASELINE_AUC,
    max_gap: float = MAX_AUC_GAP,
) -> DataFrame:
    """Quick linear model: a suspiciously high area or gap points at leakage."""
    # The rows fitted on are kept until they are scored.
    with cached(train.select(*[quoted(c) for c in (*features, target)])) as train:
        pre = fit_preprocess(train, features, center=False)
        model = train_lr(train, pre, target, max_iter=400)
        sides = [
            score_loans(model, side.select(*[quoted(c) for c in (*features, target)])).select(
                F.lit(name).alias("part"), target, F.round("pd", 9).alias("pd")
            )
            for name, side in (("train", train), ("val", val))
        ]
        scored = materialize(sides[0].unionByName(sides[1]))
    areas = roc_auc(scored, target, "pd", by=["part"])
    wide = areas.agg(
        F.max(F.when(F.col("part") == "train", F.col("roc_auc"))).alias("train_auc"),
        F.max(F.when(F.col("part") == "val", F.col("roc_auc"))).alias("val_auc"),
    )
    gap = F.col("train_auc") - F.col("val_auc")
    return wide.withColumns(
        {
            "auc_gap": gap,
            "auc_ok": F.col("val_auc") <= F.lit(max_auc),
            "gap_ok": gap <= F.lit(max_gap),
        }
    )


def with_donors(rows: DataFrame, id_col: str, value: str, repeats: int, output: str) -> DataFrame:
    """Every row once per ``repeat``, with the value of another row chosen at random.

    Rows are put in the order of a hash of id and repeat and take the value of the next one, the last
    one that of the first: a random cycle. The hash also deals the rows to buckets, whose number
    follows the number of rows, and each bucket is a cycle of its own; one shuffle per repeat.
    """
    copies = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    h = F.md5(F.concat(quoted(id_col).cast("string"), F.lit(":"), F.col("repeat").cast("string")))
    buckets = max(1, -(-rows.count() // CYCLE_ROWS))
    place = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") % F.lit(buckets)
    order = Window.partitionBy("repeat", "_bucket").orderBy("_h", id_col)
    chosen = F.coalesce(F.lead(value).over(order), F.first(value).over(order))
    dealt = copies.withColumn("_h", h).withColumn("_bucket", place)
    return dealt.withColumn(output, chosen).drop("_h", "_bucket")


def permutation_importance(
    model: Transformer,
    vectors: DataFrame,
    names: Sequence[str],
    id_col: str,
    target: str = TARGET,
    repeats: int = 5,
) -> DataFrame:
    """Mean and deviation of the area lost when one feature is shuffled among the rows.

    ``vectors`` has the id, the target and ``features`` (a vector ordered like ``names``). All
    features and repeats are scored in one job. A linear model needs no new scoring: exchanging one
    value moves the margin by its coefficient times the difference.
    """
    scored = model.transform(vectors.select(id_col, F.col(target).alias("label"), "features"))
    base = materialize(
        scored.select(
            id_col,
            "label",
            vector_to_array("features").alias("x"),
            vector_to_array("rawPrediction")[1].alias("margin"),
            F.round(vector_to_array("probability")[1], 9).alias("pd"),
        )
    )
    points = split_points(base, "pd")
    base_auc = roc_auc(base, "label", "pd", points=points).first()["roc_auc"]
    paired = with_donors(base.drop("pd"), id_col, "x", repeats, "donor")
    spread = paired.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("j"))
    if isinstance(model, LinearScorer):
        terms = F.array(*[F.lit(float(c)) for c in model.terms()[0]])
        j = F.col("j")
        moved = F.col("margin") + terms[j] * (F.col("donor")[j] - F.col("x")[j])
        scored = spread.select("label", "repeat", "j", F.round(1 / (1 + F.exp(-moved)), 9).alias("pd"))
    else:
        swapped = spread.select(
            "label",
            "repeat",
            "j",
            array_to_vector(
                F.transform("x", lambda v, i: F.when(i == F.col("j"), F.col("donor")[i]).otherwise(v))
            ).alias("features"),
        )
        scored = model.transform(swapped).select(
            "label", "repeat", "j", F.round(vector_to_array("probability")[1], 9).alias("pd")
        )
    areas = roc_auc(scored, "label", "pd", by=["repeat", "j"], points=points)
    loss = F.lit(base_auc) - F.col("roc_auc")
    return areas.groupBy("j").agg(
        F.avg(loss).alias("importance_mean"), F.stddev_pop(loss).alias("importance_std")
    ).select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1).alias("feature"),
        "importance_mean",
        "importance_std",
    )
