"""End-to-end jobs: preprocess, features, train, evaluate, explain, tune and monitor."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.constants import DATE_COLUMN, FEATURE_SPEC, TARGET, TUNING_GRID
from pdloom.operators.attribution import background_means, global_importance
from pdloom.operators.cleaning import (
    clean_loans,
    clean_loans_counted,
    require_columns,
    target_if_missing,
)
from pdloom.operators.drift import drift_report, drift_summary
from pdloom.operators.features import domain_features
from pdloom.operators.metrics import calibration_curve, evaluate_binary, pr_curve, roc_curve
from pdloom.operators.models import (
    apply_sigmoid,
    calibrate_sigmoid,
    linear_terms,
    score_loans,
    train_gbt,
    train_lr,
    tune_grid,
)
from pdloom.operators.preprocess import fit_preprocess
from pdloom.operators.profiles import categorical_columns, numeric_columns
from pdloom.operators.splits import prepare_split, sample_rows, time_split, time_split3
from pdloom.plans.feature_matrix import fit_feature_matrix
from pdloom.plans.inputs import feature_manifest
from pdloom.session import cached, materialize
from pdloom.sources.loans import read_loans_union
from pdloom.sources.tables import save_bundle, write_report, write_table


def preprocess_job(
    spark: SparkSession,
    raw_dir: str,
    out_path: str,
    pattern: str = "_2007_to_2018Q4",
    overwrite: bool = False,
    keep: Sequence[str] = (),
    steps_path: str | None = None,
) -> str:
    """Raw CSV folder to a cleaned Parquet table; with ``steps_path`` the rows that each step left
    are counted by the job that writes, and reported there."""
    raw = read_loans_union(spark, raw_dir, pattern)
    if steps_path is None:
        return write_table(clean_loans(raw, keep, check=True), out_path, overwrite)
    cleaned, steps = clean_loans_counted(raw, keep)
    write_table(cleaned, out_path, overwrite)
    counted = steps()
    write_report(counted.coalesce(1), steps_path)
    if counted.where("name = 'require_rows'").first()["rows_after"] == 0:
        raise ValueError("no rows left in cleaned loans")
    return out_path


def build_features_job(
    cleaned: DataFrame, out_path: str, target: str = TARGET, date_col: str = DATE_COLUMN
) -> DataFrame:
    """Cleaned loans plus domain features as Parquet; returns the manifest row."""
    table = domain_features(target_if_missing(cleaned, target=target))
    require_columns(table, [target, date_col])
    write_table(table, out_path, overwrite=True)
    written = cleaned.sparkSession.read.parquet(out_path)
    return feature_manifest(written, target, date_col, paths={"features_path": out_path})


def model_columns(df: DataFrame, target: str, id_col: str) -> tuple[list[str], list[str]]:
    skip = {target, id_col, "split"}
    numeric = [c for c in numeric_columns(df) if c not in skip]
    return numeric, [c for c in categorical_columns(df) if c not in skip]


def train_job(
    features: DataFrame,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
    **model: Any,
) -> tuple[PipelineModel, DataFrame]:
    """Fit the baseline on the first part in time; metrics of both parts."""
    split = prepare_split(features, date_col, id_col, target, train_fraction)
    numeric, categorical = model_columns(split, target, id_col)
    with cached(split.where(F.col("split") == "train")) as train:
        pre = fit_preprocess(train, numeric, categorical)
        fitted = train_lr(train, pre, target, **model)
    # Metrics look at the scores several times: keep those, not the wide feature rows.
    scored = materialize(score_loans(fitted, split).select("split", target, "pd"))
    return fitted, evaluate_binary(scored, target, "pd", by=["split"])


def primary_job(
    cleaned: DataFrame,
    root: str,
    name: str,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    spec: Mapping[str, Any] = FEATURE_SPEC,
    **boosting: Any,
) -> tuple[str, DataFrame]:
    """The primary model from cleaned loans to a stored bundle; its folder and its metrics.

    Three parts in time; encoders fitted on the first, whose own target means leave out each row's
    fold; a linear baseline and boosted trees with early stopping; a sigmoid fitted on the second
    part and kept where it lowers the Brier score of the third. Metrics per model and part are
    returned and stored with the bundle.
    """
    dated = time_split3(cleaned, date_col, id_col)
    parts = {s: dated.where(F.col("split") == s) for s in ("train", "val", "test")}
    plan = fit_feature_matrix(parts["train"], spec, target)
    with cached(plan.transform_train(parts["train"], id_col, [id_col])) as train:
        features = plan.feature_columns
        linear = train_lr(train, fit_preprocess(train, features), target)
        pre = fit_preprocess(train, features, center=False)
        boosted = train_gbt(train, pre, target, id_col=id_col, **boosting)
        others = plan.transform(dated.where("split <> 'train'"), [id_col, "split"])
        rows = train.withColumn("split", F.lit("train")).unionByName(others)
        scored = materialize(
            score_loans(linear, rows)
            .select(id_col, "split", target, F.lit("linear").alias("model"), "pd", "margin")
            .unionByName(
                score_loans(boosted, rows).select(
                    id_col, "split", target, F.lit("boosted").alias("model"), "pd", "margin"
                )
            )
        )
    primary = scored.where("model = 'boosted'")
    calibration = calibrate_sigmoid(primary.where("split = 'val'"), target)
    refined = apply_sigmoid(primary, *calibration).withColumns(
        {"model": F.lit("calibrated"), "pd": F.col("pd_calibrated")}
    )
    every = scored.unionByName(refined.drop("pd_calibrated"))
    metrics = materialize(evaluate_binary(every, target, "pd", by=["model", "split"]))
    rows_of = {(r["model"], r["split"]): r.asDict() for r in metrics.collect()}
    better = rows_of["calibrated", "test"]["brier"] < rows_of["boosted", "test"]["brier"]
    told = {f"{m}/{s}": {k: v for k, v in r.items() if k not in ("model", "split")} for (m, s), r in rows_of.items()}
    folder = save_bundle(
        cleaned.sparkSession, root, name, boosted, plan, {"metrics": told, "calibrated": better},
        calibration if better else None,
    )
    return folder, metrics


def evaluate_job(
    fitted: PipelineModel,
    features: DataFrame,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
    threshold: float = 0.5,
    bins: int = 10,
    strategy: str = "quantile",
) -> Mapping[str, DataFrame]:
    """Metrics and curves of a fitted model on the held-out part."""
    split = prepare_split(features, date_col, id_col, target, train_fraction)
    holdout = split.where(F.col("split") == "holdout")
    scored = materialize(score_loans(fitted, holdout).select(target, "pd"))
    return {
        "metrics": evaluate_binary(scored, target, "pd", threshold),
        "roc_curve": roc_curve(scored, target, "pd"),
        "pr_curve": pr_curve(scored, target, "pd"),
        "calibration": calibration_curve(scored, target, "pd", bins, strategy),
    }


def explain_job(
    fitted: PipelineModel,
    features: DataFrame,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
    background: int | None = None,
    samples: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Mean size of each feature's attribution over the held-out part, or over samples of it."""
    split = prepare_split(features, date_col, id_col, target, train_fraction)
    holdout = split.where(F.col("split") == "holdout")
    coefficients, _ = linear_terms(fitted)
    prepared = fitted.stages[0].pre
    names = list(coefficients)
    base = holdout if background is None else sample_rows(holdout, background, id_col, seed)
    means = background_means(prepared.transform(base), names)
    rows = holdout if samples is None else sample_rows(holdout, samples, id_col, seed + 1)
    return global_importance(prepared.transform(rows), coefficients, means)


def tune_job(
    features: DataFrame,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
    grid: Mapping[str, Sequence[Any]] = TUNING_GRID,
) -> DataFrame:
    """Area on the held-out part for each grid point."""
    split = prepare_split(features, date_col, id_col, target, train_fraction)
    numeric, categorical = model_columns(split, target, id_col)
    train = split.where(F.col("split") == "train")
    holdout = split.where(F.col("split") == "holdout")
    return tune_grid(train, holdout, numeric, categorical, target, grid)


def periods(
    features: DataFrame, date_col: str, id_col: str, train_fraction: float = 0.8
) -> DataFrame:
    """Rows labelled ``train`` or ``recent`` by time, domain features in, date out."""
    split = time_split(features, date_col, id_col, train_fraction, ("train", "recent"))
    return domain_features(split.withColumnRenamed("split", "period")).drop(date_col)


def monitor_job(
    features: DataFrame,
    date_col: str = DATE_COLUMN,
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
) -> tuple[DataFrame, DataFrame]:
    """Tidy drift summary, and the per-feature drift table."""
    labelled = periods(features, date_col, id_col, train_fraction)
    columns = [c for c in numeric_columns(labelled) if c not in (target, id_col)]
    return (
        drift_summary(labelled, "period", columns, target=target),
        drift_report(labelled, "period", columns),
    )
