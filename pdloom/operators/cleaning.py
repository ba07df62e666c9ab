"""Cleaning steps from a raw loan table to the canonical one.

Every step takes and returns a DataFrame and stays lazy; ``clean_loans`` chains them into
one plan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.constants import (
    CANONICAL_COLUMNS,
    LEAKAGE_COLUMNS,
    RENAME_COLUMNS,
    REQUIRED_COLUMNS,
    STATUS_COLUMN,
    STATUS_TO_DEFAULT,
    TARGET,
)
from pdloom.functions.columns import (
    is_missing,
    normalize_term,
    percent_number,
    quoted,
    status_label,
    to_number,
)
from pdloom.session import small_table


BOUNDED_COLUMNS = ("loan_amnt", "annual_inc", "int_rate", "dti")


class EmptyResultError(RuntimeError):
    """No rows where some are required."""


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"missing required columns: {missing}")


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """The same table; raises when it has no rows (reads only as far as the first row)."""
    if df.isEmpty():
        raise EmptyResultError(f"no rows in {what}")
    return df


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def has_any_value(df: DataFrame) -> Column:
    return _any([~is_missing(quoted(f.name), f.dataType) for f in df.schema])


def has_required(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    present = [f for f in df.schema if f.name in REQUIRED_COLUMNS and f.name not in skip]
    return _all([~is_missing(quoted(f.name), f.dataType) for f in present])


def is_plausible(columns: Sequence[str]) -> Column:
    """Value bounds of the columns that exist; a null fails its bound, and so does NaN
    (above infinity in Spark)."""
    rules = []
    for name in ("loan_amnt", "annual_inc"):
        if name in columns:
            rules += [F.col(name) > 0, F.col(name) <= float("inf")]
    if "int_rate" in columns:
        rules.append((F.col("int_rate") > 0) & (F.col("int_rate") <= 100))
    if "dti" in columns:
        rules.append((F.col("dti") >= 0) & (F.col("dti") <= 100))
    return _all(rules)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.where(has_any_value(df))


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(RENAME_COLUMNS)


def define_target(
    df: DataFrame, mapping: Mapping[str, int] = STATUS_TO_DEFAULT, target: str = TARGET
) -> DataFrame:
    """Label of each resolved loan; unresolved and unknown statuses are left out."""
    require_columns(df, [STATUS_COLUMN])
    # A plain list test reaches the scan.
    resolved = df.where(F.col(STATUS_COLUMN).isin(list(mapping)))
    return resolved.withColumn(target, status_label(F.col(STATUS_COLUMN), mapping))


def target_if_missing(
    df: DataFrame, mapping: Mapping[str, int] = STATUS_TO_DEFAULT, target: str = TARGET
) -> DataFrame:
    """``define_target`` unless there is a target, no status, or no status the map knows."""
    if target in df.columns or STATUS_COLUMN not in df.columns:
        return df
    known = F.col(STATUS_COLUMN).isin(list(mapping))
    if df.where(known).isEmpty():
        return df
    return define_target(df, mapping, target)


def status_lookup(
    df: DataFrame, mapping: Mapping[str, int] = STATUS_TO_DEFAULT, target: str = TARGET
) -> DataFrame:
    """``define_target`` as an inner join with the status table (one row per mapped status)."""
    require_columns(df, [STATUS_COLUMN])
    rows = sorted(mapping.items())
    table = small_table(df.sparkSession, rows, f"{STATUS_COLUMN} string, `{target}` int")
    return df.join(F.broadcast(table), STATUS_COLUMN)


def select_canonical(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns that exist, in canonical order, after any ``keep`` columns."""
    names = [c for c in CANONICAL_COLUMNS if c in df.columns]
    if not names:
        raise KeyError("no canonical columns found")
    return df.select(*keep, *names)


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Numbers from text; a rate loses its percent sign; bad text becomes null."""
    types = {f.name: f.dataType for f in df.schema}
    new = {
        name: to_number(F.col(name), types[name])
        for name in ("loan_amnt", "annual_inc", "dti")
        if name in types
    }
    if "int_rate" in types:
        new["int_rate"] = percent_number(F.col("int_rate"), types["int_rate"])
    return df.withColumns(new) if new else df


def drop_missing_critical(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    return df.where(has_required(df, skip))


def filter_impossible(df: DataFrame) -> DataFrame:
    return df.where(is_plausible(df.columns))


def clean_loans(df: DataFrame, keep: Sequence[str] = (), check: bool = False) -> DataFrame:
    """Raw loans to cleaned loans; ``keep`` carries id columns along.

    ``check`` raises when nothing is left, at the price of reading up to the first row.

    The same rows as the single steps in order, arranged so that the scan reads only the
    columns in use and gets the filters: a row with a known status is not empty, a bound
    fails on null, and bounds of number columns are tested before their coercion.
    """
    named = normalize_columns(df)
    numeric = [
        f.name
        for f in named.schema
        if f.name in BOUNDED_COLUMNS and isinstance(f.dataType, T.NumericType)
    ]
    parsed = [c for c in named.columns if c in BOUNDED_COLUMNS and c not in numeric]
    cleaned = (
        named.transform(define_target)
        .where(is_plausible(numeric))
        .transform(select_canonical, keep)
        .transform(coerce_numeric)
        .transform(drop_missing_critical, BOUNDED_COLUMNS)
        .where(is_plausible(parsed))
    )
    return require_rows(cleaned, "cleaned loans") if check else cleaned


def _step_flags(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Raw rows with a flag per filtering step, and the counts of the rows each step leaves."""
    named = normalize_columns(df)
    require_columns(named, [STATUS_COLUMN])
    labelled = named.withColumn(TARGET, status_label(F.col(STATUS_COLUMN)))
    canonical = [c for c in CANONICAL_COLUMNS if c in labelled.columns]
    numeric = coerce_numeric(labelled)
    flagged = numeric.withColumns(
        {
            "_s1": has_any_value(labelled.drop(TARGET)),
            "_s2": F.col(TARGET).isNotNull(),
            "_s3": has_required(numeric.select(*canonical)),
            "_s4": F.coalesce(is_plausible(canonical), F.lit(False)),
        }
    )
    s1, s12 = F.col("_s1"), F.col("_s1") & F.col("_s2")
    s123 = s12 & F.col("_s3")
    counts = [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(s1).alias("filled"),
        F.count_if(s12).alias("labelled"),
        F.count_if(s123).alias("complete"),
        F.count_if(s123 & F.col("_s4")).alias("plausible"),
    ]
    return flagged, counts


def _steps(df: DataFrame) -> list[tuple[str, str, str, int, int]]:
    """Each step with the counts and the numbers of columns before and after it."""
    raw = len(df.columns)
    labelled = [*normalize_columns(df).columns, TARGET]
    all_columns = len(set(labelled))
    canonical = len([c for c in CANONICAL_COLUMNS if c in labelled])
    return [
        ("drop_empty_rows", "raw", "filled", raw, raw),
        ("normalize_columns", "filled", "filled", raw, raw),
        ("define_target", "filled", "labelled", raw, all_columns),
        ("select_canonical", "labelled", "labelled", all_columns, canonical),
        ("coerce_numeric", "labelled", "labelled", canonical, canonical),
        ("drop_missing_critical", "labelled", "complete", canonical, canonical),
        ("filter_impossible", "complete", "plausible", canonical, canonical),
        ("require_rows", "plausible", "plausible", canonical, canonical),
    ]


def step_row_counts(df: DataFrame) -> DataFrame:
    """Rows and columns before and after every cleaning step, from one scan."""
    flagged, counts = _step_flags(df)
    rows = flagged.agg(*counts)
    return rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("step"),
                        F.lit(name).alias("name"),
                        F.col(before).alias("rows_before"),
                        F.col(after).alias("rows_after"),
                        F.lit(cols_before).alias("cols_before"),
                        F.lit(cols_after).alias("cols_after"),
                    )
                    for i, (name, before, after, cols_before, cols_after) in enumerate(_steps(df))
                ]
            )
        )
    )


def clean_loans_counted(
    df: DataFrame, keep: Sequence[str] = ()
) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows of ``clean_loans``, and the step counts, taken by the job that reads them.

    The counts are there after the first action on the rows, such as writing them; asking earlier
    waits for it. All raw rows pass the counter, so filters stop short of the scan.
    """
    flagged, counts = _step_flags(df)
    counter = Observation("cleaning steps")
    rows = (
        flagged.observe(counter, *counts)
        .where("_s1 and _s2 and _s3 and _s4")
        .drop("_s1", "_s2", "_s3", "_s4")
        .transform(select_canonical, keep)
    )

    def steps() -> DataFrame:
        seen = counter.get
        lines = [
            (i + 1, name, seen[before], seen[after], cols_before, cols_after)
            for i, (name, before, after, cols_before, cols_after) in enumerate(_steps(df))
        ]
        schema = "step int, name string, rows_before long, rows_after long, cols_before int, cols_after int"
        return small_table(df.sparkSession, lines, schema)

    return rows, steps


def request_constraints(df: DataFrame) -> DataFrame:
    """Adds the normalized term, the reasons a scoring request is refused, and ``valid``."""
    required = [
        "loan_amnt",
        "annual_inc",
        "term",
        "home_ownership",
        "grade",
        "sub_grade",
        "dti",
    ]
    require_columns(df, required)
    types = {f.name: f.dataType for f in df.schema}
    rules = {f"{c}_missing": is_missing(F.col(c), types[c]) for c in required}
    rules |= {
        "loan_amnt_not_positive": F.col("loan_amnt") <= 0,
        "annual_inc_not_positive": F.col("annual_inc") <= 0,
        "dti_negative": F.col("dti") < 0,
        "grade_length": ~F.length("grade").between(1, 2),
        "sub_grade_length": ~F.length("sub_grade").between(2, 3),
    }
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    return df.withColumns(
        {
            "term": normalize_term(F.col("term")),
            "reject_reasons": reasons,
            "valid": F.size(reasons) == 0,
        }
    )


def drop_leakage_columns(df: DataFrame, names: Sequence[str] = LEAKAGE_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def drop_date(df: DataFrame, date_col: str) -> DataFrame:
    return df.drop(date_col)


def drop_all_null_train(
    train: DataFrame, *others: DataFrame, keep: Sequence[str] = ()
) -> tuple[list[str], list[DataFrame]]:
    """Columns without any value in the training rows leave every table."""
    fields = [f for f in train.schema if f.name not in keep]
    counts = train.agg(
        *[
            F.count_if(~is_missing(quoted(f.name), f.dataType)).alias(str(i))
            for i, f in enumerate(fields)
        ]
    ).first()
    empty = [f.name for i, f in enumerate(fields) if counts[i] == 0]
    return empty, [part.drop(*empty) for part in (train, *others)]
