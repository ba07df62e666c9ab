"""Additive attributions of a linear model, exact for independent features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pdloom.functions.columns import quoted, risk_band, sigmoid
from pdloom.operators.profiles import tidy


def background_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(
        *[F.avg(quoted(c).cast("double")).alias(str(i)) for i, c in enumerate(features)]
    ).first()
    return {c: row[i] for i, c in enumerate(features)}


def base_value(
    coefficients: Mapping[str, float], intercept: float, means: Mapping[str, float]
) -> float:
    """Margin of the background row every attribution is measured from."""
    return intercept + sum(c * means[name] for name, c in coefficients.items())


def _term(name: str, coefficients: Mapping[str, float], means: Mapping[str, float]) -> Column:
    return F.lit(float(coefficients[name])) * (
        quoted(name).cast("double") - F.lit(float(means[name]))
    )


def linear_attribution(
    df: DataFrame,
    coefficients: Mapping[str, float],
    means: Mapping[str, float],
    output: str = "attributions",
) -> DataFrame:
    """Adds an array of (feature, value, attribution): coefficient x distance from the mean."""
    parts = [
        F.struct(
            F.lit(name).alias("feature"),
            quoted(name).cast("double").alias("value"),
            _term(name, coefficients, means).alias("attribution"),
        )
        for name in coefficients
    ]
    return df.withColumn(output, F.array(*parts))


def top_k_abs(column: str, k: int = 10) -> Column:
    """The ``k`` (at least one) largest attributions by size; ties keep their order."""
    keyed = F.transform(
        F.col(column),
        lambda item, i: F.struct(
            (-F.abs(item["attribution"])).alias("size"), i.alias("i"), item.alias("item")
        ),
    )
    return F.transform(F.slice(F.array_sort(keyed), 1, max(1, int(k))), lambda s: s["item"])


def global_importance(
    df: DataFrame,
    coefficients: Mapping[str, float],
    means: Mapping[str, float],
    top: int | None = None,
) -> DataFrame:
    """Mean size of each feature's attribution, largest first."""
    names = list(coefficients)
    row = df.agg(
        *[F.avg(F.abs(_term(n, coefficients, means))).alias(f"a{i}") for i, n in enumerate(names)]
    )
    ranked = tidy(
        row,
        [
            {"feature": F.lit(n), "mean_abs_attribution": F.col(f"a{i}")}
            for i, n in enumerate(names)
        ],
    ).orderBy(F.desc("mean_abs_attribution"), "feature")
    return ranked.limit(top) if top else ranked


def top_factors(
    df: DataFrame,
    coefficients: Mapping[str, float],
    intercept: float,
    means: Mapping[str, float],
    k: int = 10,
    model_version: str | None = None,
    include_base_value: bool = True,
) -> DataFrame:
    """Adds the probability, its band, the model version and the strongest attributions."""
    if not 1 <= k <= 200:
        raise ValueError("k must be between 1 and 200")
    margin = F.lit(float(intercept))
    for name, value in coefficients.items():
        margin = margin + F.lit(float(value)) * quoted(name).cast("double")
    base = base_value(coefficients, intercept, means) if include_base_value else None
    scored = linear_attribution(df.withColumn("pd", sigmoid(margin)), coefficients, means)
    return scored.withColumns(
        {
            "risk_band": risk_band(F.col("pd")),
            "model_version": F.lit(model_version).cast("string"),
            "base_value": F.lit(base).cast("double"),
            "top_factors": top_k_abs("attributions", k),
        }
    ).drop("attributions")
