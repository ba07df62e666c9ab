"""Model inputs by spec, schema contracts and the dataset manifest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.constants import DATE_COLUMN, ID_COLUMNS, TARGET
from pdloom.functions.columns import quoted


def infer_target(spec: Mapping[str, Any]) -> str:
    """Target name under any of the keys in use, or below ``exclusions``."""
    named = [spec.get(k) for k in ("target", "target_variable", "label", "y_col")]
    named.append((spec.get("exclusions") or {}).get("target"))
    for name in named:
        if isinstance(name, str) and name.strip():
            return name
    raise ValueError("the spec names no target column")


def _names(spec: Mapping[str, Any], key: str, section: str | None) -> list[str]:
    listed = spec.get(key) or []
    if not isinstance(listed, list) or any(
        not isinstance(x, str) or not x.strip() for x in listed
    ):
        raise ValueError(f"spec entry {key} must be a list of column names")
    features = spec.get("features")
    if not listed and section and isinstance(features, Mapping):
        return sorted(features.get(section, {}))
    return list(listed)


def modeling_inputs(
    df: DataFrame,
    spec: Mapping[str, Any],
    strict_extra: bool = False,
    drop_datetime: bool = True,
) -> DataFrame:
    """Feature columns the spec lists, then the target; raises on schema differences."""
    target = infer_target(spec)
    numeric = _names(spec, "numerical_cols", "numerical")
    categorical = _names(spec, "categorical_cols", "categorical")
    dates = _names(spec, "datetime_cols", "datetime")
    engineered = _names(spec, "engineered_cols", None)
    features = _names(spec, "feature_cols", None) or sorted(
        {*numeric, *categorical, *dates, *engineered}
    )
    needed, present = {*features, target}, set(df.columns)
    if needed - present:
        raise ValueError(f"missing columns: {sorted(needed - present)}")
    if strict_extra and present - needed:
        raise ValueError(f"unexpected columns: {sorted(present - needed)}")
    used = [c for c in features if not (drop_datetime and c in dates)]
    return df.select(*[quoted(c) for c in used], quoted(target))


def model_features(
    df: DataFrame,
    target: str = TARGET,
    date_col: str = DATE_COLUMN,
    id_cols: Sequence[str] = ID_COLUMNS,
) -> list[str]:
    """Columns that are neither target, date nor id."""
    return [c for c in df.columns if c not in {target, date_col, *id_cols}]


def feature_candidates(
    df: DataFrame,
    roles: Mapping[str, Sequence[str]],
    drop: Sequence[str],
    id_cols: Sequence[str],
    target: str = TARGET,
) -> list[str]:
    """Columns in any role family, without dropped, id and target columns."""
    families = {c for names in roles.values() for c in names}
    return sorted((families & set(df.columns)) - set(drop) - set(id_cols) - {target})


def content_hash(spec: Mapping[str, Any]) -> str:
    """Fingerprint of a spec without the fingerprint it carries."""
    body = {k: v for k, v in spec.items() if k != "freeze"}
    return hashlib.md5(json.dumps(body, sort_keys=True).encode()).hexdigest()


def feature_manifest(
    df: DataFrame,
    target: str = TARGET,
    date_col: str = DATE_COLUMN,
    id_cols: Sequence[str] = ID_COLUMNS,
    train_fraction: float = 0.8,
    paths: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row on a feature table: size, fingerprints, split parameters and paths.

    The content fingerprint is a sum of row hashes, so row order does not matter.
    """
    features = model_features(df, target, date_col, id_cols)
    schema = "|".join(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema)
    row_hash = F.xxhash64(*[quoted(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.sum(row_hash).alias("content_sum")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.lit(target).alias("target_col"),
        F.lit(date_col).alias("date_col"),
        F.lit(",".join(id_cols)).alias("id_cols"),
        F.lit("time_based").alias("split_strategy"),
        F.lit(float(train_fraction)).alias("train_fraction"),
        F.md5(F.lit(schema)).alias("schema_md5"),
        F.md5(F.lit("|".join(features))).alias("feature_list_md5"),
        F.lit("|".join(features[:25])).alias("first_features"),
        F.col("content_sum").cast("string").alias("content_fingerprint"),
        *[F.lit(v).alias(k) for k, v in sorted((paths or {}).items())],
    )
