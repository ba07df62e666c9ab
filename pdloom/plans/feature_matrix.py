"""Spec-driven feature matrix: one feature path for training and for scoring.

Encoders are fitted on the training rows; numbers, logs, date parts and loan age need no
fitting beyond a reference date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.constants import FEATURE_SPEC, TARGET
from pdloom.functions.columns import normalize_term, quoted, to_number
from pdloom.operators.encoders import (
    LookupEncoder,
    OneHotEncoder,
    encode_strategy,
    fit_lookup_encoders,
    fit_one_hot,
    oof_target_mean,
)
from pdloom.operators.features import (
    datetime_parts,
    domain_features,
    latest_date,
    loan_age_months,
    numeric_log_plan,
)
from pdloom.operators.positions import VectorPlan

DOMAIN = ("loan_to_income", "term_months", "grade_numeric", "sub_grade_numeric")

# What an entry of a section of the spec adds to the matrix, by its name and rule.
_OUTPUTS = {
    "numerical": lambda name, rule: (
        [name, f"{name}__log1p"] if rule.get("planned_transformation") == "log" else [name]
    ),
    "datetime": lambda name, rule: list(rule.get("derived_features", ())),
    "engineered": lambda name, rule: [name],
}
_LOOKUP_SUFFIX = {"target_mean": "target_mean"}


def section_outputs(spec: Mapping[str, Any]) -> list[str]:
    """Columns of the matrix that follow from the spec alone, without fitted encoders."""
    return [
        output
        for section, outputs in _OUTPUTS.items()
        for name, rule in _section(spec, section).items()
        for output in outputs(name, rule)
    ]


def encoder_outputs(spec: Mapping[str, Any]) -> tuple[list[str], tuple[str, ...]]:
    """Columns of the lookup encoders, and the prefixes of the one-hot columns."""
    strategy = {
        name: rule.get("encoding_strategy") for name, rule in _section(spec, "categorical").items()
    }
    lookups = [
        f"{name}__{_LOOKUP_SUFFIX.get(kind, 'freq')}"
        for name, kind in strategy.items()
        if kind != "one_hot"
    ]
    return lookups, tuple(f"{name}_" for name, kind in strategy.items() if kind == "one_hot")


def _section(spec: Mapping[str, Any], name: str) -> Mapping[str, Any]:
    return spec.get("features", {}).get(name, {})


def align_features(df: DataFrame, spec: Mapping[str, Any] = FEATURE_SPEC) -> DataFrame:
    """Raw columns the spec names, missing ones as typed nulls, numbers as numbers."""
    types = {f.name: f.dataType for f in df.schema}
    new = {}
    for name in _section(spec, "numerical"):
        if name in types:
            new[name] = to_number(quoted(name), types[name])
        else:
            new[name] = F.lit(None).cast("double")
    for section in ("categorical", "datetime"):
        for name in _section(spec, section):
            if name not in types:
                new[name] = F.lit(None).cast("string")
    if "term" in types:
        new["term"] = normalize_term(F.col("term"))
    return df.withColumns(new) if new else df


@dataclass(frozen=True)
class FeatureMatrix:
    """Fitted feature plan."""

    spec: Mapping[str, Any]
    reference: dt.date | None
    one_hot: Mapping[str, OneHotEncoder]
    lookups: Mapping[str, LookupEncoder]
    target: str = TARGET
    domain: Sequence[str] = field(default=DOMAIN)

    @property
    def feature_columns(self) -> list[str]:
        names = [*section_outputs(self.spec), *self.domain]
        for encoder in self.one_hot.values():
            names += encoder.outputs
        names += list(self.lookups)
        return sorted(names)

    def transform(
        self, df: DataFrame, keep: Sequence[str] = (), reference: dt.date | None = None
    ) -> DataFrame:
        """``keep`` columns, the target if present, and every feature column."""
        return self._select(self._encoded(self._plain(df, reference)), keep)

    def transform_vectors(
        self, df: DataFrame, keep: Sequence[str] = (), reference: dt.date | None = None
    ) -> DataFrame:
        """``keep`` columns, the target if present, and one vector ``features`` in the order of
        ``vector_columns``: sparse, without a column per category."""
        rows = self._plain(df, reference)
        for encoder in self.lookups.values():
            rows = encoder.transform(rows)
        for i, encoder in enumerate(self.one_hot.values()):
            rows = encoder.index(rows, f"_index{i}")
        numbers = [*section_outputs(self.spec), *self.domain, *self.lookups]
        rows = rows.withColumns({f"_number{i}": quoted(c).cast("double") for i, c in enumerate(numbers)})
        widths = tuple(encoder.width for encoder in self.one_hot.values())
        names = [*keep, *([self.target] if self.target in df.columns else [])]
        return VectorPlan(len(numbers), widths).assemble(rows, "features").select(*names, "features")

    @property
    def vector_columns(self) -> list[str]:
        """Names of the entries of ``transform_vectors``."""
        names = [*section_outputs(self.spec), *self.domain, *self.lookups]
        return names + [o for encoder in self.one_hot.values() for o in encoder.outputs]

    def transform_train(
        self, df: DataFrame, id_col: str, keep: Sequence[str] = (), folds: int = 5
    ) -> DataFrame:
        """Like ``transform`` with out-of-fold target means, for the rows fitted on."""
        out = self._plain(df, None)
        for encoder in self.lookups.values():
            if encoder.match_null:
                out = encoder.transform(out)
            else:
                out = oof_target_mean(
                    out, encoder.column, id_col, self.target, folds, encoder.output
                )
        return self._select(self._one_hot(out), keep)

    def _plain(self, df: DataFrame, reference: dt.date | None) -> DataFrame:
        out = domain_features(align_features(df, self.spec))
        for column, rule in _section(self.spec, "datetime").items():
            out = datetime_parts(out, column, rule.get("derive", ("year", "month", "quarter")))
        for name, rule in _section(self.spec, "engineered").items():
            when = reference or self.reference
            if name == "loan_age_months" and when is not None:
                out = loan_age_months(out, rule["source"][0], when)
            else:
                out = out.withColumn(name, F.lit(None).cast("int"))
        for column, rule in _section(self.spec, "numerical").items():
            out = numeric_log_plan(
                out,
                column,
                rule.get("planned_transformation", "none"),
                rule.get("shift_for_transformation", 0.0),
            )
        return out

    def _one_hot(self, df: DataFrame) -> DataFrame:
        new = {}
        for encoder in self.one_hot.values():
            new |= encoder.expressions(df)
        return df.withColumns(new) if new else df

    def _encoded(self, df: DataFrame) -> DataFrame:
        out = df
        for encoder in self.lookups.values():
            out = encoder.transform(out)
        return self._one_hot(out)

    def _select(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        names = [*keep, *([self.target] if self.target in df.columns else [])]
        return df.select(*names, *[quoted(c) for c in self.feature_columns])


def fit_feature_matrix(
    train: DataFrame,
    spec: Mapping[str, Any] = FEATURE_SPEC,
    target: str = TARGET,
    reference: dt.date | None = None,
) -> FeatureMatrix:
    """Fit the encoders the spec asks for; ``auto`` picks one by cardinality."""
    aligned = align_features(train, spec)
    strategies = {
        c: rule.get("encoding_strategy", "auto") for c, rule in _section(spec, "categorical").items()
    }
    unknown = [c for c, s in strategies.items() if s == "auto"]
    if unknown:
        for row in encode_strategy(aligned, unknown).collect():
            strategies[row["feature"]] = row["strategy"]
    one_hot = [c for c, s in strategies.items() if s == "one_hot"]
    means = [c for c, s in strategies.items() if s == "target_mean"]
    shares = [c for c, s in strategies.items() if s not in ("one_hot", "target_mean")]
    ages = [rule["source"][0] for rule in _section(spec, "engineered").values()]
    if reference is None and ages:
        reference = latest_date(aligned, ages[0])
    return FeatureMatrix(
        spec,
        reference,
        fit_one_hot(aligned, one_hot, taken=[*section_outputs(spec), *DOMAIN]) if one_hot else {},
        fit_lookup_encoders(aligned, shares, means, target),
        target,
    )
