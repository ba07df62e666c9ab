"""Guardrails over a cleaned table and its feature matrix, as one table of checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.constants import (
    FEATURE_SPEC,
    FORBIDDEN_COLUMNS,
    LEAKAGE_PREFIX,
    MAX_SINGLE_IMPORTANCE,
    MAX_TIME_SHARE,
)
from pdloom.operators.features import anchor_month
from pdloom.operators.models import (
    assemble,
    canary_lr,
    permutation_importance,
    train_gbt,
)
from pdloom.operators.preprocess import fit_preprocess
from pdloom.operators.profiles import target_checks
from pdloom.operators.splits import split_meta, temporal_overlap, time_split3
from pdloom.plans.feature_matrix import encoder_outputs, section_outputs
from pdloom.plans.inputs import content_hash
from pdloom.session import small_table


class ValidationError(RuntimeError):
    """A guardrail did not hold."""


def contracted_columns(columns: Sequence[str], spec: Mapping[str, Any]) -> list[str]:
    """Columns a matrix must have by the spec: what the plan of the matrix says it writes, and
    those of ``columns`` that carry the prefix of a one-hot group."""
    lookups, prefixes = encoder_outputs(spec)
    grouped = [c for c in columns if prefixes and c.startswith(prefixes)]
    return sorted({*section_outputs(spec), *lookups, *grouped})


def schema_checks(
    matrix_columns: Sequence[str],
    spec: Mapping[str, Any],
    cleaned_columns: Sequence[str] | None = None,
    forbidden: Sequence[str] = FORBIDDEN_COLUMNS,
) -> list[tuple[str, bool, str]]:
    """Checks that need only column names: spec hash, firewall, contract, leak prefix."""
    frozen = (spec.get("freeze") or {}).get("content_md5")
    now = content_hash(spec)
    note = "not frozen" if not frozen else ("matches" if frozen == now else "differs (warning)")
    checks = [("spec_fingerprint", True, note)]
    if cleaned_columns is not None:
        leaked = sorted(set(forbidden) & set(cleaned_columns))
        checks.append(("leakage_firewall", not leaked, ",".join(leaked)))
    missing = [c for c in contracted_columns(matrix_columns, spec) if c not in matrix_columns]
    checks.append(("feature_contract", not missing, ",".join(missing)))
    leaked = sorted(c for c in matrix_columns if c.startswith(LEAKAGE_PREFIX))
    checks.append(("leakage_prefix", not leaked, ",".join(leaked)))
    return checks


def importance_checks(
    importance: DataFrame,
    max_single: float = MAX_SINGLE_IMPORTANCE,
    max_time_share: float = MAX_TIME_SHARE,
    prefix: str = "issue_d_",
) -> DataFrame:
    """Strongest feature and the summed importance of the date features against limits."""
    value = F.col("importance_mean")
    is_date = F.col("feature").startswith(prefix)
    return importance.agg(
        F.max_by("feature", value).alias("top_feature"),
        F.max(value).alias("top_importance"),
        F.coalesce(F.sum(F.when(is_date, value)), F.lit(0.0)).alias("time_importance"),
        F.count("*").alias("n_features"),
    ).withColumns(
        {
            "single_ok": F.col("top_importance") <= F.lit(max_single),
            "time_ok": F.col("time_importance") <= F.lit(max_time_share),
        }
    )



def validate_matrix(
    matrix: DataFrame,
    id_col: str,
    spec: Mapping[str, Any] = FEATURE_SPEC,
    cleaned_columns: Sequence[str] | None = None,
    forbidden: Sequence[str] = FORBIDDEN_COLUMNS,
    run_canary: bool = False,
    run_importance: bool = False,
    importance_rounds: int = 300,
) -> DataFrame:
    """Every guardrail as (check, passed, detail), the model checks only when asked for."""
    spark = matrix.sparkSession
    target = spec["target"]["name"]
    checks = schema_checks(matrix.columns, spec, cleaned_columns, forbidden)
    checks.append(("target_present", target in matrix.columns, ""))
    table = small_table(spark, checks, "check string, passed boolean, detail string")
    if target not in matrix.columns:
        return table
    allowed = spec["target"].get("allowed_values", [0, 1])
    verdict = target_checks(matrix, allowed, target)
    table = table.unionByName(
        verdict.select(
            F.inline(
                F.array(
                    F.struct(
                        F.lit("target_not_null").alias("check"),
                        (F.col("null_targets") == 0).alias("passed"),
                        F.col("null_targets").cast("string").alias("detail"),
                    ),
                    F.struct(
                        F.lit("target_allowed").alias("check"),
                        (F.col("foreign_targets") == 0).alias("passed"),
                        F.col("foreign_targets").cast("string").alias("detail"),
                    ),
                )
            )
        )
    )
    split = time_split3(anchor_month(matrix), "anchor", id_col)
    overlap = temporal_overlap(split_meta(split, "anchor", target))
    table = table.unionByName(
        overlap.select(
            F.concat(F.lit("no_overlap_"), "earlier", F.lit("_"), "later").alias("check"),
            (~F.col("overlaps")).alias("passed"),
            F.concat(
                F.date_format("earlier_max", "yyyy-MM-dd"),
                F.lit(" "),
                F.date_format("later_min", "yyyy-MM-dd"),
            ).alias("detail"),
        )
    )
    contracted = [c for c in contracted_columns(matrix.columns, spec) if c in matrix.columns]
    parts = {name: split.where(F.col("split") == name) for name in ("train", "val")}
    if run_canary:
        canary = canary_lr(parts["train"], parts["val"], contracted, target)
        table = table.unionByName(
            canary.select(
                F.inline(
                    F.array(
                        F.struct(
                            F.lit("canary_auc").alias("check"),
                            F.col("auc_ok").alias("passed"),
                            F.col("val_auc").cast("string").alias("detail"),
                        ),
                        F.struct(
                            F.lit("canary_gap").alias("check"),
                            F.col("gap_ok").alias("passed"),
                            F.col("auc_gap").cast("string").alias("detail"),
                        ),
                    )
                )
            )
        )
    if run_importance:
        pre = fit_preprocess(parts["train"], contracted, center=False)
        model = train_gbt(
            parts["train"], pre, target, step=0.1, rounds=importance_rounds, min_leaf=20
        )
        vectors = assemble(pre).transform(parts["val"]).select(id_col, target, "features")
        importance = permutation_importance(
            model.stages[-1], vectors, pre.outputs, id_col, target
        )
        limits = importance_checks(importance, prefix="num__issue_d_")
        table = table.unionByName(
            limits.select(
                F.inline(
                    F.array(
                        F.struct(
                            F.lit("single_importance").alias("check"),
                            F.col("single_ok").alias("passed"),
                            F.concat_ws(" ", "top_feature", "top_importance").alias("detail"),
                        ),
                        F.struct(
                            F.lit("time_importance").alias("check"),
                            F.col("time_ok").alias("passed"),
                            F.col("time_importance").cast("string").alias("detail"),
                        ),
                    )
                )
            )
        )
    return table


def require_valid(checks: DataFrame) -> None:
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        raise ValidationError("; ".join(f"{r['check']}: {r['detail']}" for r in failed))
