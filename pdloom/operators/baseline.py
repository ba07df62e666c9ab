"""Drift against a kept baseline: cuts, bin counts and moments that add up, stored once.

A baseline is a small table, one line per feature and bin. New rows are counted by its cuts without
reading the baseline's rows again, counts of several files are added, and the report of a period
follows from the two tables alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.constants import PSI_EPSILON
from pdloom.functions.columns import finite, quoted
from pdloom.operators.drift import psi_label
from pdloom.operators.ordering import exact_percentiles, with_bins
from pdloom.session import small_table

#: The bin of a value outside the range of the cuts.
OUTSIDE = -1
_CUTS = "feature string, cuts array<double>, shift double"


def _counted(df: DataFrame, plan: dict[str, tuple[list[float], float]]) -> DataFrame:
    """Rows per feature and bin with their moments about the feature's shift and their range."""
    parts = []
    values = [finite(quoted(name).cast("double")).alias(name) for name in plan]
    binned = with_bins(df.select(*values), {name: points for name, (points, _) in plan.items()}, OUTSIDE)
    for i, (name, (_, shift)) in enumerate(plan.items()):
        value = quoted(name)
        parts.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.col(f"_bin{i}").alias("bin"),
                value.alias("value"),
                (value - F.lit(float(shift))).alias("off"),
            )
        )
    rows = binned.select(F.explode(F.array(*parts)).alias("p")).select("p.*").where("bin is not null")
    return rows.groupBy("feature", "bin").agg(
        F.count("*").alias("n"),
        F.sum("off").alias("s1"),
        F.sum(F.col("off") * F.col("off")).alias("s2"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )


def added(*counts: DataFrame) -> DataFrame:
    """Counts of several files as those of all their rows."""
    return (
        reduce(DataFrame.unionByName, counts)
        .groupBy("feature", "bin")
        .agg(
            F.sum("n").alias("n"),
            F.sum("s1").alias("s1"),
            F.sum("s2").alias("s2"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )


def fit_baseline(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Table (feature, cuts, shift, bin, n, s1, s2, low, high); a feature without values has one
    line without a bin. Cuts are the distinct exact quantiles of the rows."""
    probs = [i / bins for i in range(bins + 1)]
    found = exact_percentiles(df, {c: probs for c in columns})
    plan = {c: (sorted(set(p)), p[bins // 2]) if p else ([], 0.0) for c, p in found.items()}
    rows = [(c, points, float(shift)) for c, (points, shift) in plan.items()]
    cuts = small_table(df.sparkSession, rows, _CUTS)
    return cuts.join(_counted(df, plan), "feature", "left")


def period_counts(df: DataFrame, baseline: DataFrame) -> DataFrame:
    """Counts of new rows by the baseline's cuts; the driver gets the cuts, one list per feature."""
    lines = baseline.select("feature", "cuts", "shift").distinct().collect()
    return _counted(df, {r["feature"]: (r["cuts"], r["shift"]) for r in lines})


def _summary(table: DataFrame, prefix: str) -> DataFrame:
    """Mean, sample deviation and range per feature, from sums about the shift."""
    whole = table.groupBy("feature").agg(
        F.max("shift").alias("shift"),
        F.sum("n").alias("n"),
        F.sum("s1").alias("s1"),
        F.sum("s2").alias("s2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
    n, mean_off = F.col("n"), F.try_divide(F.col("s1"), F.col("n"))
    spread = F.try_divide(F.col("s2") - n * mean_off * mean_off, n - 1)
    return whole.where("n > 0").select(
        "feature",
        (F.col("shift") + mean_off).alias(f"{prefix}_mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias(f"{prefix}_std"),
        F.col("low").alias(f"{prefix}_min"),
        F.col("high").alias(f"{prefix}_max"),
        n.alias(f"{prefix}_n"),
    )


def report_from_counts(
    baseline: DataFrame, counts: DataFrame, base: str = "train", recent: str = "recent"
) -> DataFrame:
    """Stability index, label and both summaries per feature, from the kept and the new counts."""
    shifts = baseline.select("feature", F.size("cuts").alias("points"), "shift").distinct()
    new = counts.join(F.broadcast(shifts.select("feature", "shift")), "feature")
    pairs = (
        baseline.where("bin is not null")
        .select("feature", "bin", F.col("n").alias("base_n"))
        .join(counts.select("feature", "bin", F.col("n").alias("new_n")), ["feature", "bin"], "full")
        .na.fill(0, ["base_n", "new_n"])
    )
    feature = Window.partitionBy("feature")

    def share(name: str) -> Column:
        inside = F.when(F.col("bin") >= 0, F.col(name)).otherwise(F.lit(0))
        part = F.coalesce(F.try_divide(inside, F.sum(inside).over(feature)), F.lit(0.0))
        return F.greatest(part, F.lit(PSI_EPSILON))

    term = (F.col("p") - F.col("q")) * F.log(F.col("p") / F.col("q"))
    index = (
        pairs.select("feature", "bin", "base_n", "new_n", share("base_n").alias("p"), share("new_n").alias("q"))
        .groupBy("feature")
        .agg(
            F.sum(F.when(F.col("bin") >= 0, term)).alias("psi"),
            F.sum("base_n").alias("base_rows"),
            F.sum("new_n").alias("new_rows"),
        )
    )
    usable = (F.col("points") > 2) & (F.col("base_rows") > 0) & (F.col("new_rows") > 0)
    value = F.when(usable, F.col("psi")).otherwise(F.lit(float("nan")))
    return (
        shifts.join(index, "feature", "left")
        .select("feature", value.alias("psi"))
        .withColumn("psi_label", psi_label(F.col("psi")))
        .join(_summary(baseline, base), "feature")
        .join(_summary(new, recent), "feature")
    )
