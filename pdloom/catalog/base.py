"""Registry of runnable queries, the frames they start from and the same frames as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.functions.columns import sigmoid
from pdloom.operators.cleaning import clean_loans
from pdloom.operators.features import domain_features
from pdloom.operators.splits import time_split
from pdloom.sources.fixture import loans, loans_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---------------------------------------------------------------- frames


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_loans(loans(spark, sf), ["loan_id"])


def engineered(spark: SparkSession, sf: str) -> DataFrame:
    return domain_features(cleaned(spark, sf))


def split2(spark: SparkSession, sf: str) -> DataFrame:
    return time_split(cleaned(spark, sf), "issue_d", "loan_id", 0.8)


def part(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("split") == name)


def with_score(df: DataFrame) -> DataFrame:
    """Closed-form score of the rate, the same in any engine."""
    return df.withColumn("prob", sigmoid(F.lit(-3.0) + F.lit(0.12) * F.col("int_rate")))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return with_score(cleaned(spark, sf)).select("loan_id", "default", "prob")


def scored_split(spark: SparkSession, sf: str) -> DataFrame:
    return with_score(split2(spark, sf)).select("loan_id", "split", "default", "prob")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Rounded columns; the SQL adds zero where a rounded value may be a negative zero."""
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------- the frames as SQL

LABEL = (
    "case when loan_status in ('Charged Off', 'Default', 'Late (31-120 days)', "
    "'Late (16-30 days)') then 1 when loan_status = 'Fully Paid' then 0 end"
)
RATE = "try_cast(regexp_replace(int_rate, '%+$', '') as double)"
DATE = "cast(try_strptime(issue_d, '%b-%Y') as date)"
LETTER = "case {c} when 'A' then 1 when 'B' then 2 when 'C' then 3 when 'D' then 4 " \
    "when 'E' then 5 when 'F' then 6 when 'G' then 7 end"
GRADE_NUMBER = LETTER.format(c="regexp_extract(grade, '([A-G])', 1)")
SUB_GRADE_NUMBER = (
    f"cast(({LETTER.format(c=chr(34) + 'sl' + chr(34))}) * 10 + sn as integer)"
)

CTES = {
    "loans": loans_sql(),
    "labelled": f'select *, {LABEL} as "default", {RATE} as rate from loans',
    "cleaned": """select loan_id, loan_amnt, annual_inc, rate as int_rate, term, dti, grade,
        sub_grade, emp_length, home_ownership, issue_d, "default" from labelled
        where "default" is not null and term is not null and issue_d is not null
        and loan_amnt > 0 and annual_inc > 0 and rate > 0 and rate <= 100
        and dti >= 0 and dti <= 100""",
    "engineered": f"""select * exclude (sl, sn), {SUB_GRADE_NUMBER} as sub_grade_numeric from (
        select *, round_even(loan_amnt / nullif(annual_inc, 0) * 100, 4) as loan_to_income,
        try_cast(nullif(regexp_extract(term, '([0-9]+)', 1), '') as integer) as term_months,
        cast({GRADE_NUMBER} as integer) as grade_numeric,
        regexp_extract(sub_grade, '([A-G])', 1) as sl,
        try_cast(nullif(regexp_extract(sub_grade, '([0-9]+)', 1), '') as integer) as sn
        from cleaned)""",
    "ranked": f"""select *, row_number() over (order by {DATE}, loan_id) as rn,
        count(*) over () as total from engineered""",
    "split2": """select *, case when rn <= floor(total * cast(0.8 as double)) then 'train'
        else 'holdout' end as split from ranked""",
    "split3": """select *, case when rn <= floor(total * cast(0.7 as double)) then 'train'
        when rn <= floor(total * cast(0.7 as double)) + floor(total * cast(0.15 as double))
        then 'val' else 'test' end as split from ranked""",
    "scored": """select *, 1 / (1 + exp(-(-3 + 0.12 * int_rate))) as prob from split2""",
}
NEEDS = {
    "loans": [],
    "labelled": ["loans"],
    "cleaned": ["labelled"],
    "engineered": ["cleaned"],
    "ranked": ["engineered"],
    "split2": ["ranked"],
    "split3": ["ranked"],
    "scored": ["split2"],
}


def using(name: str, body: str, **more: str) -> str:
    """A query over one of the frames; ``more`` adds further named steps in order."""
    order: list[str] = []

    def visit(step: str) -> None:
        for need in NEEDS[step]:
            visit(need)
        if step not in order:
            order.append(step)

    visit(name)
    steps = [f"{step} as ({CTES[step]})" for step in order]
    steps += [f"{step} as ({text})" for step, text in more.items()]
    return f"with {', '.join(steps)} {body}"
