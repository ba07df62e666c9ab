"""The feature spec from data: roles, encodings and transformations of the training rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from pdloom.constants import DATE_COLUMN, ID_COLUMNS, TARGET
from pdloom.operators.encoders import encode_strategy
from pdloom.operators.profiles import column_role, is_id_like, numeric_profile
from pdloom.plans.inputs import content_hash
from pdloom.session import small_table

_PARTS = ("year", "month", "quarter")


def _finite(value: float | None) -> float | None:
    return value if value is not None and math.isfinite(value) else None


def build_spec(
    df: DataFrame,
    target: str = TARGET,
    date_cols: Sequence[str] = (DATE_COLUMN,),
    id_cols: Sequence[str] = ID_COLUMNS,
    drop: Sequence[str] = (),
    version: str = "v1",
) -> dict[str, Any]:
    """A frozen spec that ``fit_feature_matrix`` takes.

    Numbers get a log plan, with a shift where they reach zero, if they are skewed; categories an
    encoding by their number of values; dates their parts, and the first one the age of the loan.
    Ids, the target and ``drop`` are left out. One pass over the numbers and one over the
    categories; the driver gets one line per column.
    """
    skip = {target, *id_cols, *drop}
    dates = [c for c in date_cols if c in df.columns and c not in skip]
    others = [
        f for f in df.schema if f.name not in skip and f.name not in dates and not is_id_like(f.name)
    ]
    numeric = sorted(f.name for f in others if column_role(f.name, f.dataType) == "numeric")
    categorical = sorted(f.name for f in others if column_role(f.name, f.dataType) == "categorical")
    numbers = {r["feature"]: r for r in numeric_profile(df, numeric).collect()} if numeric else {}
    groups = {r["feature"]: r for r in encode_strategy(df, categorical).collect()} if categorical else {}
    features = {
        "datetime": {
            c: {"derive": list(_PARTS), "derived_features": [f"{c}_{p}" for p in _PARTS]} for c in dates
        },
        "engineered": {"loan_age_months": {"source": [dates[0]]}} if dates else {},
        "categorical": {
            c: {
                "encoding_strategy": groups[c]["strategy"],
                "cardinality": groups[c]["cardinality"],
                "missing_rate": groups[c]["missing_rate"],
            }
            for c in categorical
            if c in groups
        },
        "numerical": {
            c: {
                "planned_transformation": numbers[c]["planned_transformation"],
                "shift_for_transformation": numbers[c]["shift_for_transformation"],
                "missing_rate": numbers[c]["missing_rate"],
                "skewness": _finite(numbers[c]["skewness"]),
                "min_value": _finite(numbers[c]["min_value"]),
            }
            for c in numeric
        },
    }
    spec = {
        "version": version,
        "target": {"name": target, "allowed_values": [0, 1]},
        "features": features,
        "exclusions": {"target": target, "id_cols": list(id_cols)},
    }
    return {**spec, "freeze": {"content_md5": content_hash(spec)}}


def spec_table(df: DataFrame, spec: Mapping[str, Any]) -> DataFrame:
    """The plans of a spec as rows (section, feature, plan, shift)."""
    rows = []
    for section, key in (("categorical", "encoding_strategy"), ("numerical", "planned_transformation")):
        for name, rule in spec["features"][section].items():
            rows.append((section, name, rule[key], float(rule.get("shift_for_transformation", 0.0))))
    for section in ("datetime", "engineered"):
        rows += [(section, name, "derived", 0.0) for name in spec["features"][section]]
    return small_table(df.sparkSession, rows, "section string, feature string, plan string, shift double")
