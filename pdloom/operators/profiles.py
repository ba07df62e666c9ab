"""Profiles and data-quality summaries: one wide aggregation per table, tidy results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.constants import SHIFT_EPSILON, SKEW_THRESHOLD, TARGET, VALID_GRADES
from pdloom.functions.columns import is_missing, parse_date, quoted


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def tidy(row: DataFrame, records: Sequence[dict[str, Column]]) -> DataFrame:
    """One output row per record of expressions over a one-row table."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in records]
    return row.select(F.inline(F.array(*structs)))


def column_role(name: str, dtype: T.DataType) -> str:
    """Role of a raw column from its type and name."""
    lower = name.lower()
    if is_numeric(dtype):
        return "numeric"
    if lower.endswith("rate"):
        return "percent"
    if lower.endswith("_d") or "date" in lower or isinstance(dtype, (T.DateType, T.TimestampType)):
        return "datetime"
    return "categorical"


def is_id_like(name: str) -> bool:
    lower = name.lower()
    return lower.endswith("_id") or lower in ("id", "member_id")


def missingness_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """Null share, type and role of every column, most missing first."""
    fields = list(df.schema)
    rates = df.agg(
        *[
            F.avg(is_missing(quoted(f.name), f.dataType).cast("double")).alias(f"m{i}")
            for i, f in enumerate(fields)
        ]
    )
    profile = tidy(
        rates,
        [
            {
                "column": F.lit(f.name),
                "missing_rate": F.col(f"m{i}"),
                "dtype": F.lit(f.dataType.simpleString()),
                "role": F.lit(column_role(f.name, f.dataType)),
                "id_like": F.lit(is_id_like(f.name)),
            }
            for i, f in enumerate(fields)
        ],
    ).orderBy(F.desc("missing_rate"), "column")
    return profile.limit(top) if top else profile


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null share, bias-corrected skew, minimum, and the log plan with its shift."""
    values = [F.when(~F.isnan(quoted(c)), quoted(c)).cast("double") for c in columns]
    aggs = [F.count("*").alias("rows")]
    for i, value in enumerate(values):
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.skewness(value).alias(f"g{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
    records = []
    for i, name in enumerate(columns):
        n, low = F.col(f"n{i}").cast("double"), F.col(f"lo{i}")
        # Spark gives the population skewness; the sample correction needs three values.
        corrected = F.col(f"g{i}") * F.sqrt(n * (n - 1)) / (n - 2)
        constant = F.col(f"hi{i}") == low
        skew = F.when(n >= 3, F.when(constant, F.lit(0.0)).otherwise(corrected))
        log = F.coalesce(
            (F.abs(skew) > SKEW_THRESHOLD) & (F.abs(skew) < float("inf")), F.lit(False)
        )
        needs_shift = log & (low <= 0) & (F.abs(low) < float("inf"))
        records.append(
            {
                "feature": F.lit(name),
                "missing_rate": 1 - n / F.col("rows"),
                "skewness": skew,
                "min_value": low,
                "planned_transformation": F.when(log, "log").otherwise("none"),
                "shift_for_transformation": F.when(
                    needs_shift, F.abs(low) + SHIFT_EPSILON
                ).otherwise(F.lit(0.0)),
            }
        )
    return tidy(df.agg(*aggs), records)


def value_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """Most frequent values of a column, null counted as one."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(top)


def date_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of unreadable dates, first and last date per column."""
    dates = df.select(
        *[parse_date(F.col(c), df.schema[c].dataType).alias(f"d{i}") for i, c in enumerate(columns)]
    )
    aggs = []
    for i in range(len(columns)):
        d = F.col(f"d{i}")
        aggs += [
            F.avg(d.isNull().cast("double")).alias(f"m{i}"),
            F.min(d).alias(f"lo{i}"),
            F.max(d).alias(f"hi{i}"),
        ]
    return tidy(
        dates.agg(*aggs),
        [
            {
                "feature": F.lit(c),
                "missing_rate": F.col(f"m{i}"),
                "min_date": F.col(f"lo{i}"),
                "max_date": F.col(f"hi{i}"),
            }
            for i, c in enumerate(columns)
        ],
    )


def positive_rate(df: DataFrame, by: Sequence[str] = (), target: str = TARGET) -> DataFrame:
    """Rows and mean label, overall or per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(quoted(target).cast("double")).alias("default_rate")
    )


def class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows of the smallest and largest class, and their ratio."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("classes"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
        (F.min("n") / F.max("n")).alias("ratio"),
    )


def target_checks(
    df: DataFrame, allowed: Sequence[int] = (0, 1), target: str = TARGET
) -> DataFrame:
    """Whether the target has nulls, values out of range, and every allowed value."""
    y = quoted(target)
    seen = [F.count_if(y == F.lit(value)) > 0 for value in allowed]
    every = seen[0]
    for flag in seen[1:]:
        every = every & flag
    nulls, foreign = F.count_if(y.isNull()), F.count_if(~y.isin(list(allowed)))
    return df.agg(
        nulls.alias("null_targets"),
        foreign.alias("foreign_targets"),
        ((nulls == 0) & (foreign == 0)).alias("is_valid"),
        every.alias("has_every_value"),
    )


def data_quality(
    df: DataFrame,
    id_col: str = "loan_id",
    date_col: str = "issue_d",
    target: str = TARGET,
    rate_col: str = "int_rate",
    amount_cols: Sequence[str] = ("loan_amnt", "annual_inc"),
    grade_col: str = "grade",
) -> DataFrame:
    """Counts of rows that break a data rule: one conditional scan, one count per id."""
    types = {f.name: f.dataType for f in df.schema}
    rules: dict[str, Column] = {}
    for name, dtype in types.items():
        rules[f"null_{name}"] = is_missing(quoted(name), dtype)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            rules[f"infinite_{name}"] = F.abs(quoted(name)) == float("inf")
    if rate_col in types:
        rate = F.col(rate_col)
        rules[f"{rate_col}_out_of_range"] = ~F.isnan(rate) & ((rate < 0) | (rate > 100))
    for name in amount_cols:
        if name in types:
            rules[f"negative_{name}"] = F.col(name) < 0
    if grade_col in types:
        rules[f"invalid_{grade_col}"] = ~F.col(grade_col).isin(VALID_GRADES)
    if date_col in types:
        parsed = parse_date(F.col(date_col), types[date_col])
        rules[f"unreadable_{date_col}"] = F.col(date_col).isNotNull() & parsed.isNull()
    names = list(rules)
    counts = df.agg(*[F.count_if(rules[n]).alias(f"r{i}") for i, n in enumerate(names)])
    checks = tidy(
        counts,
        [{"check": F.lit(n), "violations": F.col(f"r{i}")} for i, n in enumerate(names)],
    )
    if id_col in types:
        repeated = df.groupBy(id_col).agg(F.count("*").alias("n")).where(F.col("n") > 1)
        duplicates = repeated.agg(F.count("*").alias("violations"))
        checks = checks.unionByName(
            duplicates.select(F.lit(f"duplicate_{id_col}").alias("check"), "violations")
        )
    return checks
