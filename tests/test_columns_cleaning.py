import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.constants import CANONICAL_COLUMNS
from pdloom.functions import columns as C
from pdloom.operators import cleaning, features
from pdloom.sources.fixture import loans


def one(spark, expr_of, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr_of(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "text, number",
    [
        ("13.5%", 13.5),
        (" 7 ", 7.0),
        ("1e3", 1000.0),
        ("-.5", -0.5),
        ("1d", None),
        ("2f", None),
        ("0x1p3", None),
        ("nan", None),
        ("", None),
        ("about 3", None),
        ("inf", math.inf),
        (None, None),
    ],
)
def test_percent_number(spark, text, number):
    assert one(spark, lambda c: C.percent_number(c, T.StringType()), text) == number


@pytest.mark.parametrize(
    "text, date",
    [
        ("Jan-2015", dt.date(2015, 1, 1)),
        ("DEC-2018", dt.date(2018, 12, 1)),
        ("2020-02-29", dt.date(2020, 2, 29)),
        ("2020-02-30", None),
        ("03/15/2001", dt.date(2001, 3, 15)),
        ("2015-01-31 00:00:00", dt.date(2015, 1, 31)),
        ("invalid-date", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, date):
    assert one(spark, lambda c: C.parse_date(c, T.StringType()), text) == date


def test_grades(spark):
    assert one(spark, C.grade_number, "X") is None
    assert one(spark, C.grade_number, "A") == 1
    assert one(spark, C.grade_number, "B") == 2
    assert one(spark, C.sub_grade_number, "A1") == 11
    assert one(spark, C.sub_grade_number, "G5") == 75
    assert one(spark, C.sub_grade_number, "G") is None
    assert one(spark, C.sub_grade_number, None) is None


def test_ratio_rounds_half_even_and_survives_zero_income(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (None, 5.0), (5.0, None), (1.00005, 100.0)], "loan_amnt double, annual_inc double"
    )
    got = [r[0] for r in features.domain_features(df).select("loan_to_income").collect()]
    assert got == [None, None, None, 1.0]


def test_domain_features_only_where_inputs_exist(spark):
    df = spark.createDataFrame([(5.0,)], "loan_amnt double")
    assert features.domain_features(df).columns == ["loan_amnt"]


def test_domain_features_leave_target_and_repeat(spark, sf):
    cleaned = cleaning.clean_loans(loans(spark, sf), ["loan_id"])
    once = features.domain_features(cleaned)
    twice = features.domain_features(once)
    assert once.exceptAll(twice).isEmpty()
    assert once.select("loan_id", "default").exceptAll(
        cleaned.select("loan_id", "default")
    ).isEmpty()


def test_clean_columns_and_bounds(spark, sf):
    cleaned = cleaning.clean_loans(loans(spark, sf), check=True)
    assert cleaned.columns == CANONICAL_COLUMNS
    row = cleaned.agg(F.min("annual_inc"), F.max("dti"), F.max("int_rate")).first()
    assert row[0] > 0 and row[1] <= 100 and row[2] <= 100


def test_clean_handles_nan_and_late_status(spark):
    schema = (
        "loan_amount double, annual_income double, int_rate string, term string, "
        "issue_d string, dti double, loan_status string"
    )
    rows = [
        (1.0, 2.0, "5%", "36 months", "Jan-2015", 1.0, "Late (16-30 days)"),
        (1.0, float("nan"), "5%", "36 months", "Jan-2015", 1.0, "Fully Paid"),
        (1.0, 2.0, "5%", "36 months", "Jan-2015", float("nan"), "Fully Paid"),
        (1.0, 2.0, "500", "36 months", "Jan-2015", 1.0, "Fully Paid"),
        (1.0, 2.0, "5", "36 months", "Jan-2015", 1.0, "Current"),
        (None, None, None, None, None, float("nan"), None),
    ]
    got = cleaning.clean_loans(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 1 and got[0]["default"] == 1


def test_clean_equals_the_single_steps(spark, sf):
    raw = loans(spark, sf)
    blank = raw.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema]).limit(3)
    holes = raw.withColumns(
        {
            "dti": F.when(F.col("loan_id") % 7 == 0, float("nan")).otherwise(F.col("dti")),
            "loan_amnt": F.when(F.col("loan_id") % 9 == 0, float("nan")).otherwise(F.col("loan_amnt")),
            "annual_inc": F.when(F.col("loan_id") % 10 == 0, float("inf")).otherwise(F.col("annual_inc")),
        }
    ).unionByName(blank)
    steps = holes
    for step in (
        cleaning.drop_empty_rows, cleaning.normalize_columns, cleaning.define_target,
        cleaning.select_canonical, cleaning.coerce_numeric, cleaning.drop_missing_critical,
        cleaning.filter_impossible,
    ):
        steps = steps.transform(step)
    chained = cleaning.clean_loans(holes)
    assert chained.exceptAll(steps).isEmpty() and steps.exceptAll(chained).isEmpty()
    text = holes.withColumns({c: F.col(c).cast("string") for c in ("dti", "loan_amnt", "annual_inc")})
    again = cleaning.clean_loans(text)
    assert again.exceptAll(steps).isEmpty() and again.count() == steps.count()


def test_clean_reads_only_what_it_needs(spark, sf):
    wide = loans(spark, sf)
    plan = cleaning.clean_loans(wide).select("grade", "default")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    read = text[text.index("ReadSchema"):]
    assert "sub_grade" not in read and "loan_id" not in read and "emp_length" not in read
    pushed = text[text.index("PushedFilters"):text.index("ReadSchema")]
    assert "In(loan_status" in pushed and "IsNotNull(loan_amnt)" in pushed


def test_empty_result_raises(spark):
    df = spark.createDataFrame([("Current", 1.0)], "loan_status string, loan_amnt double")
    with pytest.raises(cleaning.EmptyResultError):
        cleaning.clean_loans(df, check=True)


def test_missing_status_raises(spark):
    with pytest.raises(KeyError):
        cleaning.define_target(spark.createDataFrame([(1.0,)], "loan_amnt double"))


def test_existing_target_is_kept(spark):
    df = spark.createDataFrame([("Charged Off", 0)], "loan_status string, `default` int")
    assert cleaning.target_if_missing(df).first()["default"] == 0
    unknown = spark.createDataFrame([("Current",)], "loan_status string")
    assert cleaning.target_if_missing(unknown).columns == ["loan_status"]


def test_lookup_and_map_agree(spark, sf):
    raw = loans(spark, sf)
    a = cleaning.define_target(raw).select("loan_id", "default")
    b = cleaning.status_lookup(raw).select("loan_id", "default")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_step_counts_match_the_steps(spark, sf):
    counts = {r["name"]: r["rows_after"] for r in cleaning.step_row_counts(loans(spark, sf)).collect()}
    assert counts["require_rows"] == cleaning.clean_loans(loans(spark, sf)).count()


def test_no_canonical_columns_raises(spark):
    with pytest.raises(KeyError):
        cleaning.select_canonical(spark.createDataFrame([(1,)], "other int"))


def test_request_reasons(spark):
    schema = (
        "loan_amnt double, annual_inc double, term string, home_ownership string, "
        "grade string, sub_grade string, dti double"
    )
    rows = [
        (3600.0, 1e5, "36", "MORTGAGE", "C", "C4", 5.91),
        (0.0, 1e5, "36 months", "OWN", "", "C", -1.0),
        (1.0, None, "36 months", "OWN", "C", "C4", float("nan")),
    ]
    got = cleaning.request_constraints(spark.createDataFrame(rows, schema)).collect()
    assert got[0]["valid"] and got[0]["term"] == "36 months"
    assert set(got[1]["reject_reasons"]) == {
        "loan_amnt_not_positive", "dti_negative", "grade_length", "sub_grade_length"
    }
    assert set(got[2]["reject_reasons"]) == {"annual_inc_missing", "dti_missing"}


def test_drop_all_null_uses_train_only(spark):
    train = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    other = spark.createDataFrame([(1, 3.0)], "a int, b double")
    dropped, (left, right) = cleaning.drop_all_null_train(train, other)
    assert dropped == ["b"] and left.columns == right.columns == ["a"]


def test_loan_age_needs_a_date(spark):
    df = spark.createDataFrame([("x",)], "issue_d string")
    with pytest.raises(ValueError):
        features.loan_age_months(df)
    aged = features.loan_age_months(
        spark.createDataFrame([("Jan-2020",), ("Mar-2021",), ("x",)], "issue_d string"),
        reference=dt.date(2021, 1, 31),
    )
    assert [r[0] for r in aged.select("loan_age_months").collect()] == [12, 0, None]


def test_anchor_from_quarter(spark):
    df = spark.createDataFrame([(2020, 1), (2020, 2), (2020, 4)], "issue_d_year int, issue_d_quarter int")
    months = [r["anchor"].month for r in features.anchor_month(df).collect()]
    assert months == [1, 4, 10]
    with pytest.raises(KeyError):
        features.anchor_month(df.select("issue_d_year"))


def test_log_plan_floors_and_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (1.0,), (None,)], "x double")
    got = [r[0] for r in features.numeric_log_plan(df, "x", "log", 1.0).select("x__log1p").collect()]
    assert got[0] == 0.0 and got[1] == pytest.approx(math.log(3)) and got[2] is None


def test_bands(spark):
    df = spark.createDataFrame([(0.09,), (0.10,), (0.25,), (None,)], "p double")
    got = [r[0] for r in df.select(C.risk_band(F.col("p"))).collect()]
    assert got == ["Low", "Medium", "High", None]


def test_counts_taken_while_writing(spark, sf, tmp_path):
    raw = loans(spark, sf)
    rows, steps = cleaning.clean_loans_counted(raw, ["loan_id"])
    rows.write.parquet(f"{tmp_path}/cleaned")
    written = spark.read.parquet(f"{tmp_path}/cleaned")
    plain = cleaning.clean_loans(raw, ["loan_id"])
    assert written.columns == plain.columns and written.exceptAll(plain).isEmpty()
    assert written.count() == plain.count()
    assert steps().collect() == cleaning.step_row_counts(raw).collect()


def test_sample_is_the_smallest_hashes(spark):
    import hashlib

    from pdloom.operators.splits import sample_rows

    df = spark.range(900).select(F.when(F.col("id") < 800, F.col("id")).otherwise(F.lit(7)).alias("loan_id"))
    for n in (0, 1, 450, 899, 900, 2_000):
        got = sorted(r[0] for r in sample_rows(df, n, "loan_id", 3).collect())
        every = [r[0] for r in df.collect()]
        wanted = sorted(sorted(every, key=lambda i: hashlib.md5(f"{i}:3".encode()).hexdigest())[:n])
        assert got == wanted
