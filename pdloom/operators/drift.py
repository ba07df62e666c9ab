"""Drift between a baseline and a recent period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pdloom.constants import PSI_EPSILON, PSI_MODERATE, PSI_SIGNIFICANT, TARGET
from pdloom.functions.columns import finite, quoted
from pdloom.operators.ordering import exact_percentiles, with_bins
from pdloom.operators.profiles import numeric_columns, tidy
from pdloom.session import cached, materialize, small_table


def _finite_columns(df: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """Period and finite values, computed once for the many expressions over them."""
    values = [finite(quoted(c).cast("double")).alias(c) for c in columns]
    return df.select(period, *values)


def numeric_summary(df: DataFrame, period: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per period and numeric column.

    Nulls and infinities are left out; a column without values in a period has no row.
    """
    columns = columns or [c for c in numeric_columns(df) if c != period]
    return _summary_of(_finite_columns(df, period, columns), period, columns)


def _summary_of(rows: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """``numeric_summary`` of finite columns."""
    aggs = []
    for i, name in enumerate(columns):
        value = quoted(name)
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"std{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
    wide = rows.groupBy(period).agg(*aggs)
    structs = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"n{i}").alias("n"),
            F.col(f"mean{i}").alias("mean"),
            F.when(F.col(f"n{i}") > 1, F.col(f"std{i}")).otherwise(F.lit(0.0)).alias("std"),
            F.col(f"min{i}").alias("min"),
            F.col(f"max{i}").alias("max"),
        )
        for i, name in enumerate(columns)
    ]
    return wide.select(period, F.inline(F.array(*structs))).where(F.col("n") > 0)


def align_periods(
    summary: DataFrame, period: str, baseline: str = "train", recent: str = "recent"
) -> DataFrame:
    """Baseline and recent statistics side by side, for features present in both."""
    sides = {side: F.col(period) == side for side in (baseline, recent)}
    stats = [
        F.max(F.when(here, F.col(s))).alias(f"{side}_{s}")
        for side, here in sides.items()
        for s in ("mean", "std", "min", "max")
    ]
    both = F.max(sides[baseline]) & F.max(sides[recent])
    return summary.groupBy("feature").agg(*stats, both.alias("_both")).where("_both").drop("_both")


def default_rate_drift(
    df: DataFrame,
    period: str,
    baseline: str = "train",
    recent: str = "recent",
    target: str = TARGET,
) -> DataFrame:
    """Default rate of both periods and the change."""
    y = quoted(target).cast("double")
    rates = df.agg(
        F.avg(F.when(F.col(period) == baseline, y)).alias("train_rate"),
        F.avg(F.when(F.col(period) == recent, y)).alias("recent_rate"),
    )
    return rates.withColumn("delta", F.col("recent_rate") - F.col("train_rate"))


def psi(
    df: DataFrame,
    period: str,
    columns: Sequence[str],
    baseline: str = "train",
    recent: str = "recent",
    bins: int = 10,
) -> DataFrame:
    """Population stability index of each column, all columns in one pass.

    Bins lie between the distinct baseline quantiles; values outside the baseline range
    are left out; NaN when a side has no values or there are fewer than two bins.
    """
    return _psi_of(_finite_columns(df, period, columns), period, columns, baseline, recent, bins)


def _psi_of(
    df: DataFrame, period: str, columns: Sequence[str], baseline: str, recent: str, bins: int = 10
) -> DataFrame:
    """``psi`` of finite columns."""
    probs = [i / bins for i in range(bins + 1)]
    base = df.where(F.col(period) == baseline)
    cuts = {
        name: sorted(set(points))
        for name, points in exact_percentiles(base, {c: probs for c in columns}).items()
        if points is not None
    }
    parts = [
        F.struct(F.lit(name).alias("feature"), F.col(f"_bin{i}").alias("bin")) for i, name in enumerate(columns)
    ]
    is_base = (F.col(period) == baseline).alias("is_base")
    rows = (
        with_bins(df.where(F.col(period).isin(baseline, recent)), {c: cuts.get(c, []) for c in columns})
        .select(is_base, F.explode(F.array(*parts)).alias("p"))
        .select("is_base", "p.*")
        .where(F.col("bin").isNotNull())
    )
    counts = rows.groupBy("feature", "bin").agg(
        F.count_if(F.col("is_base")).alias("base_n"), F.count_if(~F.col("is_base")).alias("new_n")
    )
    feature = Window.partitionBy("feature")

    def share(name: str):
        inside = F.when(F.col("bin") >= 0, F.col(name)).otherwise(F.lit(0))
        total = F.sum(inside).over(feature)
        return F.greatest(F.coalesce(F.try_divide(inside, total), F.lit(0.0)), F.lit(PSI_EPSILON))

    # A bin no row falls into has both shares at the floor and adds nothing.
    shares = counts.select(
        "feature",
        "bin",
        share("base_n").alias("p"),
        share("new_n").alias("q"),
        F.sum("base_n").over(feature).alias("base_rows"),
        F.sum("new_n").over(feature).alias("new_rows"),
    )
    term = F.when(
        F.col("bin") >= 0, (F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))
    )
    scored = shares.groupBy("feature").agg(
        F.sum(term).alias("psi"),
        F.max("base_rows").alias("base_rows"),
        F.max("new_rows").alias("new_rows"),
    )
    usable = [c for c in columns if len(cuts.get(c, [])) > 2]
    known = F.col("feature").isin(usable) & (F.col("base_rows") > 0) & (F.col("new_rows") > 0)
    names = small_table(df.sparkSession, [(c,) for c in columns], "feature string")
    return names.join(scored, "feature", "left").select(
        "feature", F.when(known, F.col("psi")).otherwise(F.lit(float("nan"))).alias("psi")
    )


def psi_label(value):
    """Size of a shift in words."""
    return (
        F.when(F.isnan(value), "nan")
        .when(value < PSI_MODERATE, "no_or_negligible_shift")
        .when(value < PSI_SIGNIFICANT, "moderate_shift")
        .otherwise("significant_shift")
    )


def drift_report(
    df: DataFrame,
    period: str,
    columns: Sequence[str],
    baseline: str = "train",
    recent: str = "recent",
) -> DataFrame:
    """Stability index, its label and both summaries, for features present in both periods.

    The finite columns are kept while they are read: for the sketch, the ranks, the bins and the
    summary.
    """
    with cached(_finite_columns(df, period, columns)) as rows:
        return materialize(_report_of(rows, period, columns, baseline, recent))


def _report_of(
    rows: DataFrame, period: str, columns: Sequence[str], baseline: str, recent: str
) -> DataFrame:
    aligned = align_periods(_summary_of(rows, period, columns), period, baseline, recent)
    scores = _psi_of(rows, period, columns, baseline, recent)
    return scores.withColumn("psi_label", psi_label(F.col("psi"))).join(aligned, "feature")


def drift_summary(
    df: DataFrame,
    period: str,
    columns: Sequence[str],
    baseline: str = "train",
    recent: str = "recent",
    target: str = TARGET,
) -> DataFrame:
    """Default-rate and feature drift of a period as one tidy (metric, feature, value) table."""
    values = [finite(quoted(c).cast("double")).alias(c) for c in columns if c != target]
    label = finite(quoted(target).cast("double")) if target in columns else quoted(target)
    with cached(df.select(period, label.alias(target), *values)) as rows:
        rates = materialize(default_rate_drift(rows, period, baseline, recent, target))
        report = materialize(_report_of(rows, period, columns, baseline, recent))
    head = tidy(
        rates,
        [
            {"metric": F.lit(m), "feature": F.lit(target), "value": F.col(m)}
            for m in ("train_rate", "recent_rate", "delta")
        ],
    )
    stats = ["psi", *[f"{p}_{s}" for p in (baseline, recent) for s in ("mean", "std", "min", "max")]]
    body = report.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("metric"), F.col("feature"), F.col(s).alias("value")
                    )
                    for s in stats
                ]
            )
        )
    )
    return head.unionByName(body)
