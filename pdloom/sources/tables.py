"""Feature tables, report sinks and model bundles."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.constants import FEATURE_SPEC, TARGET
from pdloom.operators.cleaning import require_columns, require_rows
from pdloom.operators.encoders import LookupEncoder, OneHotEncoder
from pdloom.operators.lookup import fits_broadcast
from pdloom.operators.models import apply_sigmoid, score_loans
from pdloom.operators.positions import load_positions
from pdloom.operators.preprocess import FeatureVectors
from pdloom.plans.feature_matrix import FeatureMatrix
from pdloom.session import small_table


def read_features(
    spark: SparkSession, path: str, target: str = TARGET, date_col: str | None = None
) -> DataFrame:
    """Engineered Parquet table; raises when absent, empty or without target or date."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no feature table at {path}") from error
    require_rows(df, path)
    require_columns(df, [target, *([date_col] if date_col else [])])
    return df


def write_table(df: DataFrame, path: str, overwrite: bool = False) -> str:
    """Parquet sink; an existing table stays unless ``overwrite``."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)
    return path


def write_report(df: DataFrame, path: str, overwrite: bool = True) -> str:
    """JSON sink of a report table."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)
    return path


def write_drift_csv(report: DataFrame, path: str, overwrite: bool = True) -> str:
    """CSV sink (with header) of a drift report."""
    mode = "overwrite" if overwrite else "errorifexists"
    report.write.mode(mode).option("header", True).csv(path)
    return path


@dataclass(frozen=True)
class ModelBundle:
    """A fitted classifier with the feature plan that feeds it and, where it was kept, the slope
    and intercept that calibrate its probability."""

    name: str
    model: PipelineModel
    features: FeatureMatrix | None
    metadata: Mapping[str, Any]
    calibration: tuple[float, float] | None = None

    def score(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Features, probability and margin of raw loans, with the bundle's name; a calibrated
        bundle adds ``pd_calibrated``."""
        rows = self.features.transform(df, keep) if self.features else df
        scored = score_loans(self.model, rows).withColumn("model_version", F.lit(self.name))
        return apply_sigmoid(scored, *self.calibration) if self.calibration else scored


_CATEGORIES = "feature string, category string, n long, position long, stage string"
_ENCODERS = (
    "output string, column string, prior double, total long, match_null boolean, "
    "category string, n long, value double"
)


def save_bundle(
    spark: SparkSession,
    root: str,
    name: str,
    model: PipelineModel,
    features: FeatureMatrix | None = None,
    metadata: Mapping[str, Any] | None = None,
    calibration: tuple[float, float] | None = None,
) -> str:
    """Write model, encoder tables, metadata and calibration below ``root/name``."""
    folder = f"{root.rstrip('/')}/{name}"
    model.write().overwrite().save(f"{folder}/model")
    prepared = [s for s in model.stages if isinstance(s, FeatureVectors)]
    categories = small_table(spark, [], _CATEGORIES)
    for i, stage in enumerate(prepared):
        if stage.pre.positions is not None:
            table = stage.pre.positions.table.withColumn("stage", F.lit(f"model-{i}"))
            categories = categories.unionByName(table)
    if features is not None and features.one_hot:
        positions = next(iter(features.one_hot.values())).positions
        categories = categories.unionByName(positions.table.withColumn("stage", F.lit("one_hot")))
    write_table(categories, f"{folder}/categories", overwrite=True)
    plan: dict[str, Any] | None = None
    if features is not None:
        tables = small_table(spark, [], _ENCODERS)
        for encoder in features.lookups.values():
            tables = tables.unionByName(
                encoder.table.select(
                    F.lit(encoder.output).alias("output"),
                    F.lit(encoder.column).alias("column"),
                    F.lit(float(encoder.prior)).alias("prior"),
                    F.lit(encoder.total).cast("long").alias("total"),
                    F.lit(encoder.match_null).alias("match_null"),
                    "category",
                    "n",
                    F.col("_value").alias("value"),
                )
            )
        write_table(tables, f"{folder}/encoders", overwrite=True)
        plan = {
            "spec": features.spec,
            "reference": features.reference.isoformat() if features.reference else None,
            "target": features.target,
            "one_hot": {
                c: [e.null_column, e.others, e.taken] for c, e in features.one_hot.items()
            },
            "lookups": {
                o: [e.column, e.prior, e.total, e.match_null] for o, e in features.lookups.items()
            },
        }
    row = (name, json.dumps(plan), json.dumps(dict(metadata or {})), json.dumps(calibration))
    kinds = "name string, plan string, metadata string, calibration string"
    table = small_table(spark, [row], kinds)
    write_report(table.coalesce(1), f"{folder}/metadata")
    return folder


def pick_bundle(spark: SparkSession, root: str, name: str | None = None) -> str:
    """The named bundle, else the last one by name."""
    pattern = f"{root.rstrip('/')}/{name or '*'}/metadata"
    try:
        rows = spark.read.schema("name string").json(pattern)
        found = rows.agg(F.max("name").alias("name")).first()["name"]
    except AnalysisException as error:
        raise FileNotFoundError(f"no model bundle {name or ''} in {root}") from error
    if found is None:
        raise FileNotFoundError(f"no model bundle {name or ''} in {root}")
    return found


def load_bundle(spark: SparkSession, root: str, name: str | None = None) -> ModelBundle:
    name = pick_bundle(spark, root, name)
    folder = f"{root.rstrip('/')}/{name}"
    kinds = "plan string, metadata string, calibration string"
    row = spark.read.schema(kinds).json(f"{folder}/metadata").first()
    plan = json.loads(row["plan"])
    features = None
    categories = spark.read.parquet(f"{folder}/categories")

    def categories_of(stage: str) -> DataFrame:
        return categories.where(F.col("stage") == stage).drop("stage")

    if plan is not None:
        tables = spark.read.parquet(f"{folder}/encoders")
        lookups = {}
        for output, (column, prior, total, match_null) in plan["lookups"].items():
            table = tables.where(F.col("output") == output).select(
                "category", "n", F.col("value").alias("_value")
            )
            lookups[output] = LookupEncoder(
                column, output, table, prior, total, match_null, fits_broadcast(table, "category")
            )
        reference = plan["reference"]
        kept = plan["one_hot"]
        positions = load_positions(categories_of("one_hot"), list(kept)) if kept else None
        features = FeatureMatrix(
            plan["spec"] or FEATURE_SPEC,
            dt.date.fromisoformat(reference) if reference else None,
            {
                c: OneHotEncoder(c, positions, null_column, tuple(others), tuple(taken))
                for c, (null_column, others, taken) in kept.items()
            },
            lookups,
            plan["target"],
        )
    model = PipelineModel.load(f"{folder}/model")
    for i, stage in enumerate(s for s in model.stages if isinstance(s, FeatureVectors)):
        stage.attach_table(categories_of(f"model-{i}"))
    slope_intercept = json.loads(row["calibration"] or "null")
    calibration = tuple(slope_intercept) if slope_intercept else None
    return ModelBundle(name, model, features, json.loads(row["metadata"]), calibration)
