"""The feature spec from data."""

from pyspark.sql import functions as F

from pdloom.operators.cleaning import clean_loans
from pdloom.plans import validate
from pdloom.plans.feature_matrix import fit_feature_matrix
from pdloom.plans.spec import build_spec, spec_table
from pdloom.sources.fixture import loans


def test_spec_drives_the_matrix(spark, sf):
    rows = clean_loans(loans(spark, sf), ["loan_id"]).withColumns(
        {
            "skewed": F.pow(F.col("loan_amnt") / 1000, 4) - 5,
            "many": F.concat(F.lit("m"), F.col("loan_id") % 500),
            "some": F.concat(F.lit("s"), F.col("loan_id") % 40),
            "empty": F.lit(None).cast("double"),
            "member_id": F.col("loan_id"),
        }
    )
    spec = build_spec(rows)
    numbers, texts = spec["features"]["numerical"], spec["features"]["categorical"]
    assert "loan_id" not in numbers and "member_id" not in numbers and "default" not in numbers
    low = rows.agg(F.min("skewed")).first()[0]
    assert numbers["skewed"]["planned_transformation"] == "log"
    wanted = abs(low) + 1e-6 if low <= 0 else 0.0
    assert numbers["skewed"]["shift_for_transformation"] == wanted
    assert numbers["empty"]["skewness"] is None and numbers["empty"]["missing_rate"] == 1.0
    assert texts["many"]["encoding_strategy"] == "count_frequency"
    assert texts["some"]["encoding_strategy"] == "target_mean"
    assert texts["grade"]["encoding_strategy"] == "one_hot"
    plan = fit_feature_matrix(rows, spec)
    matrix = plan.transform(rows, ["loan_id"])
    assert {"skewed__log1p", "many__freq", "some__target_mean", "grade_A", "issue_d_year"} <= set(matrix.columns)
    vectors = plan.transform_vectors(rows, ["loan_id"])
    first, wide = vectors.orderBy("loan_id").first(), matrix.orderBy("loan_id").first()
    for name, value in zip(plan.vector_columns, first["features"].toArray().tolist()):
        assert (wide[name] is None and value != value) or wide[name] == value
    frozen = {r["check"]: r for r in validate.validate_matrix(matrix, "loan_id", spec).collect()}
    assert frozen["spec_fingerprint"]["passed"]
    assert spec_table(rows, spec).count() == len(numbers) + len(texts) + 2
