"""Deterministic loan features, the same for training and scoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pdloom.functions import columns as C


def _type(df: DataFrame, name: str):
    return df.schema[name].dataType


def domain_features(df: DataFrame) -> DataFrame:
    """Ratio, term, grade and sub-grade numbers, each where its inputs exist."""
    present, new = set(df.columns), {}
    if {"loan_amnt", "annual_inc"} <= present:
        new["loan_to_income"] = C.loan_to_income(F.col("loan_amnt"), F.col("annual_inc"))
    if "term" in present:
        new["term_months"] = C.first_integer(F.col("term").cast("string"))
    if "grade" in present:
        new["grade_numeric"] = C.grade_number(F.col("grade").cast("string"))
    if "sub_grade" in present:
        new["sub_grade_numeric"] = C.sub_grade_number(F.col("sub_grade").cast("string"))
    return df.withColumns(new) if new else df


def parsed_date(df: DataFrame, column: str) -> Column:
    return C.parse_date(F.col(column), _type(df, column))


def datetime_parts(
    df: DataFrame,
    column: str,
    parts: Iterable[str] = ("year", "month", "quarter"),
    drop_raw: bool = False,
) -> DataFrame:
    """``<column>_<part>`` of a date-like column; unreadable dates give nulls."""
    read = {"year": F.year, "month": F.month, "quarter": F.quarter}
    date = parsed_date(df, column)
    out = df.withColumns({f"{column}_{part}": read[part](date) for part in read if part in parts})
    return out.drop(column) if drop_raw else out


def months_since(
    df: DataFrame, column: str, reference: dt.date, name: str = "months_since"
) -> DataFrame:
    return df.withColumn(name, C.months_between_floor(parsed_date(df, column), F.lit(reference)))


def latest_date(df: DataFrame, column: str) -> dt.date:
    """Newest readable date of a column."""
    latest = df.agg(F.max(parsed_date(df, column)).alias("d")).first()["d"]
    if latest is None:
        raise ValueError(f"no readable date in {column}")
    return latest


def loan_age_months(
    df: DataFrame, column: str = "issue_d", reference: dt.date | None = None, floor: int = 0
) -> DataFrame:
    """Months from issue to the reference date (default: the newest date), at least ``floor``."""
    reference = reference or latest_date(df, column)
    age = C.months_between_floor(parsed_date(df, column), F.lit(reference))
    return df.withColumn(
        "loan_age_months", F.when(age.isNotNull(), F.greatest(age, F.lit(int(floor))))
    )


def numeric_log_plan(
    df: DataFrame, column: str, plan: str = "none", shift: float = 0.0
) -> DataFrame:
    """Adds ``<column>__log1p`` for the ``log`` plan; the column itself stays."""
    if plan != "log":
        return df
    number = C.to_number(F.col(column), _type(df, column))
    return df.withColumn(f"{column}__log1p", C.log1p_shifted(number, shift))


def anchor_month(df: DataFrame, prefix: str = "issue_d", name: str = "anchor") -> DataFrame:
    """First day of the month from year and month, else of the quarter."""
    year, month, quarter = (f"{prefix}_{part}" for part in ("year", "month", "quarter"))
    if {year, month} <= set(df.columns):
        return df.withColumn(name, C.month_start(F.col(year), F.col(month)))
    if {year, quarter} <= set(df.columns):
        return df.withColumn(name, C.quarter_start(F.col(year), F.col(quarter)))
    raise KeyError(f"no {year} with {month} or {quarter}")
