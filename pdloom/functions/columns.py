"""Column expressions: parsing, loan features, bands. All stay inside Catalyst."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.constants import BAND_LOW, BAND_MEDIUM, STATUS_TO_DEFAULT

# Texts accepted as a number; everything else becomes null.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# Date texts by shape, with the format that reads each of them.
DATE_FORMATS = {
    r"^[A-Za-z]{3}-\d{4}$": "MMM-yyyy",
    r"^[A-Za-z]{3} \d{4}$": "MMM yyyy",
    r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd",
    r"^\d{4}-\d{2}$": "yyyy-MM",
    r"^\d{4}/\d{2}/\d{2}$": "yyyy/MM/dd",
    r"^\d{2}/\d{2}/\d{4}$": "MM/dd/yyyy",
    r"^\d{2}-[A-Za-z]{3}-\d{4}$": "dd-MMM-yyyy",
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$": "yyyy-MM-dd HH:mm:ss",
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$": "yyyy-MM-dd'T'HH:mm:ss",
}


def quoted(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def not_nan(column: Column) -> Column:
    """NaN as null, infinities kept."""
    return F.when(~F.isnan(column), column)


def finite(column: Column) -> Column:
    """NaN and infinities as null (NaN compares above every number in Spark)."""
    return F.when(F.abs(column) < F.lit(float("inf")), column)


def to_number(column: Column, dtype: T.DataType) -> Column:
    """Number of a text or numeric column; bad text and NaN become null."""
    if isinstance(dtype, T.StringType):
        return F.when(column.rlike(NUMBER_PATTERN), F.trim(column).try_cast("double"))
    return not_nan(column.cast("double"))


def percent_number(column: Column, dtype: T.DataType) -> Column:
    """Like ``to_number`` after taking trailing percent signs off a text."""
    if isinstance(dtype, T.StringType):
        column = F.regexp_replace(column, "%+$", "")
    return to_number(column, dtype)


def is_missing(column: Column, dtype: T.DataType) -> Column:
    """Null, or NaN in a floating column."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def status_label(status: Column, mapping: Mapping[str, int] = STATUS_TO_DEFAULT) -> Column:
    """0/1 label of a loan status, null for statuses outside the map."""
    expr = F.lit(None).cast("int")
    for label in sorted(set(mapping.values())):
        names = [name for name, value in mapping.items() if value == label]
        expr = F.when(status.isin(names), F.lit(label)).otherwise(expr)
    return expr


def loan_to_income(loan_amnt: Column, annual_inc: Column) -> Column:
    """Loan as a percentage of income, four decimals half-to-even; null for zero income."""
    return F.bround(loan_amnt / F.nullif(annual_inc, F.lit(0.0)) * 100, 4)


def first_integer(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")


def grade_number(text: Column) -> Column:
    """First letter A to G as 1 to 7."""
    letter = F.nullif(F.regexp_extract(text, "([A-G])", 1), F.lit(""))
    return (F.ascii(letter) - F.ascii(F.lit("A")) + 1).cast("int")


def sub_grade_number(text: Column) -> Column:
    """Letter times ten plus the first number: A1 is 11, G5 is 75."""
    return (grade_number(text) * 10 + first_integer(text)).cast("int")


def parse_date(column: Column, dtype: T.DataType) -> Column:
    """Date of a date-like column in any of the known shapes, null when unreadable."""
    if not isinstance(dtype, T.StringType):
        return column.cast("date")
    text = F.trim(column)
    expr = F.lit(None).cast("date")
    for shape, fmt in reversed(DATE_FORMATS.items()):
        expr = F.when(text.rlike(shape), F.try_to_date(text, fmt)).otherwise(expr)
    return expr


def months_between_floor(date: Column, reference: Column) -> Column:
    """Month difference ignoring the day of month."""
    years = F.year(reference) - F.year(date)
    return (years * 12 + F.month(reference) - F.month(date)).cast("int")


def log1p_shifted(number: Column, shift: float) -> Column:
    """log(1 + x + shift), the sum floored at zero; null stays null."""
    moved = number + F.lit(float(shift))
    return F.when(moved.isNotNull(), F.log1p(F.greatest(moved, F.lit(0.0))))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def quarter_start(year: Column, quarter: Column) -> Column:
    return F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1))


def risk_band(pd: Column) -> Column:
    return (
        F.when(pd < BAND_LOW, "Low")
        .when(pd < BAND_MEDIUM, "Medium")
        .when(pd.isNotNull(), "High")
    )


def normalize_term(term: Column) -> Column:
    """Trimmed term; a bare number of months gets its unit."""
    text = F.trim(term)
    return F.when(text.rlike(r"^\d+$"), F.concat(text, F.lit(" months"))).otherwise(text)


def predicted_label(prob: Column, threshold: float = 0.5) -> Column:
    return (prob >= F.lit(float(threshold))).cast("int")


def factor_direction(attribution: Column) -> Column:
    return F.when(attribution > 0, "increased").otherwise("decreased")


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
