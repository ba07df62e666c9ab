import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pdloom.constants import FEATURE_SPEC
from pdloom.functions.columns import sigmoid
from pdloom.operators import attribution, metrics, models, preprocess, splits
from pdloom.operators.cleaning import clean_loans
from pdloom.plans import inputs, jobs, validate
from pdloom.plans.feature_matrix import fit_feature_matrix
from pdloom.sources.fixture import loans
from pdloom.sources.tables import load_bundle, pick_bundle, save_bundle
from pdloom.streaming.scoring import (
    BundleScorer,
    committed,
    model_versions,
    once_per_application,
    rejected_requests,
    score_stream,
    scored_requests,
)

NUMERIC = ["loan_amnt", "annual_inc", "int_rate", "dti", "grade_numeric"]


@pytest.fixture(scope="module")
def cleaned(spark, sf):
    return clean_loans(loans(spark, sf), ["loan_id"]).persist()


@pytest.fixture(scope="module")
def prepared(cleaned):
    return splits.prepare_split(cleaned).persist()


@pytest.fixture(scope="module")
def baseline(prepared):
    train = prepared.where("split = 'train'")
    pre = preprocess.fit_preprocess(train, NUMERIC, ["term"])
    return pre, models.train_lr(train, pre)


def test_preprocess_matches_numpy(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (None, "a"), (float("nan"), "a"), (4.0, "b"), (9.0, None)], "x double, c string"
    ).withColumn("flat", F.lit(3.0)).withColumn("none", F.lit(None).cast("double"))
    pre = preprocess.fit_preprocess(df, ["x", "flat", "none"], ["c"])
    got = pre.transform(df).toPandas()
    x = np.array([1, 4, 4, 4, 9.0])
    assert np.allclose(sorted(got["num__x"]), sorted((x - x.mean()) / x.std()))
    assert list(got["num__flat"]) == [0.0] * 5 and "num__none" not in got
    # Mode tie between a and b goes to a.
    assert list(got["cat__c_a"]) == [0.0, 1.0, 1.0, 0.0, 1.0]
    other = spark.createDataFrame([(2.0, "it's new", 1.0, None)], "x double, c string, flat double, none double")
    flags = pre.transform(other).first()
    assert flags["cat__c_a"] == flags["cat__c_b"] == 0.0


def test_lr_reaches_the_optimum(baseline, prepared):
    """At the optimum the gradient of C x weighted loss + penalty is zero."""
    pre, model = baseline
    train = prepared.where("split = 'train'")
    pdf = pre.transform(train, ["default"]).toPandas()
    x, y = pdf[pre.outputs].to_numpy(), pdf["default"].to_numpy()
    beta, intercept = models.linear_terms(model)
    b = np.array([beta[c] for c in pre.outputs])
    w = len(y) / (2 * np.bincount(y))[y]
    p = 1 / (1 + np.exp(-(x @ b + intercept)))
    assert np.abs(x.T @ (w * (p - y)) + b).max() < 0.05
    assert abs((w * (p - y)).sum()) < 0.05


def test_baseline_is_better_than_chance(baseline, prepared):
    scored = models.score_loans(baseline[1], prepared)
    areas = {r["split"]: r["roc_auc"] for r in metrics.roc_auc(scored, "default", "pd", ["split"]).collect()}
    assert areas["train"] > 0.6 and areas["holdout"] > 0.55


def test_attributions_add_up(baseline, prepared):
    pre, model = baseline
    beta, intercept = models.linear_terms(model)
    rows = model.stages[0].pre.transform(prepared, prepared.columns)
    means = attribution.background_means(rows, list(beta))
    scored = attribution.top_factors(rows, beta, intercept, means, 10, "m")
    pds = models.score_loans(model, prepared).select("loan_id", F.col("pd").alias("p"))
    assert scored.join(pds, "loan_id").where(F.abs(F.col("p") - F.col("pd")) > 1e-9).isEmpty()
    full = attribution.top_factors(rows, beta, intercept, means, 200)
    total = F.aggregate("top_factors", F.lit(0.0), lambda a, f: a + f["attribution"])
    check = full.select("pd", sigmoid(F.col("base_value") + total).alias("q"))
    assert check.where(F.abs(F.col("pd") - F.col("q")) > 1e-9).isEmpty()
    one = attribution.top_factors(rows, beta, intercept, means, 1, include_base_value=False).first()
    assert len(one["top_factors"]) == 1 and one["base_value"] is None
    with pytest.raises(ValueError):
        attribution.top_factors(rows, beta, intercept, means, 0)


def test_permutation_importance_finds_the_signal(spark):
    df = spark.range(1200).select(
        F.col("id").alias("loan_id"), F.rand(1).alias("signal"), F.rand(2).alias("noise")
    ).withColumn("default", (F.col("signal") > 0.6).cast("int")).persist()
    pre = preprocess.fit_preprocess(df, ["signal", "noise"])
    model = models.train_lr(df, pre)
    vectors = PipelineModel(model.stages[:-1]).transform(df).select("loan_id", "default", "features")
    found = models.permutation_importance(model.stages[-1], vectors, pre.outputs, "loan_id", repeats=2)
    got = {r["feature"]: r for r in found.collect()}
    assert got["num__signal"]["importance_mean"] > 0.4
    assert abs(got["num__noise"]["importance_mean"]) < 0.02
    assert not validate.importance_checks(found).first()["single_ok"]


def test_donors_are_a_permutation_without_fixed_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "CYCLE_ROWS", 300)
    df = spark.range(2000).select(F.col("id").alias("loan_id"), F.col("id").alias("v"))
    paired = models.with_donors(df, "loan_id", "v", 3, "donor").collect()
    for repeat in (1, 2, 3):
        mine = [(r["loan_id"], r["donor"]) for r in paired if r["repeat"] == repeat]
        assert sorted(d for _, d in mine) == list(range(2000)) and all(a != d for a, d in mine)
    assert {r["donor"] for r in paired if r["loan_id"] == 5} != {5}


def test_linear_importance_equals_new_scoring(spark, baseline, prepared):
    pre, model = baseline
    vectors = models.assemble(pre).transform(prepared.where("split = 'holdout'"))
    vectors = vectors.select("loan_id", "default", "features")
    fast = models.permutation_importance(model.stages[-1], vectors, pre.outputs, "loan_id", repeats=2)

    class Plain:
        transform = model.stages[-1].transform

    slow = models.permutation_importance(Plain, vectors, pre.outputs, "loan_id", repeats=2)
    got, wanted = ({r["feature"]: r["importance_mean"] for r in x.collect()} for x in (fast, slow))
    assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-6 for k in got)


def test_canary_trips_on_a_leak(prepared):
    leaky = prepared.withColumn("leak", F.col("default") + F.rand(3) * 0.1)
    train, val = (leaky.where(F.col("split") == s) for s in ("train", "holdout"))
    row = models.canary_lr(train, val, ["leak", "dti"]).first()
    assert row["val_auc"] > 0.95 and not row["auc_ok"]


def test_boosting_calibration_and_bundle(spark, cleaned, tmp_path):
    dated = splits.time_split3(cleaned, "issue_d", "loan_id")
    parts = {s: dated.where(F.col("split") == s) for s in ("train", "val", "test")}
    plan = fit_feature_matrix(parts["train"])
    train = plan.transform(parts["train"], ["loan_id"]).persist()
    pre = preprocess.fit_preprocess(train, plan.feature_columns, center=False)
    model = models.train_gbt(train, pre, max_depth=3, step=0.1, rounds=5, min_leaf=5, id_col="loan_id")
    root = str(tmp_path)
    save_bundle(spark, root, "pd_a", model, plan, {"auc": 0.7})
    save_bundle(spark, root, "pd_b", model, plan)
    assert pick_bundle(spark, root) == "pd_b"
    bundle = load_bundle(spark, root, "pd_a")
    assert bundle.metadata == {"auc": 0.7}
    assert bundle.features.feature_columns == plan.feature_columns
    again = bundle.score(parts["val"], ("loan_id",))
    first = models.score_loans(model, plan.transform(parts["val"], ["loan_id"]))
    both = first.select("loan_id", "pd").join(again.select("loan_id", F.col("pd").alias("q")), "loan_id")
    assert both.count() == parts["val"].count() and both.where("pd <> q").isEmpty()
    slope, intercept = models.calibrate_sigmoid(first)
    fitted = models.apply_sigmoid(first, slope, intercept)
    row = fitted.agg(F.avg("pd_calibrated"), F.avg("default")).first()
    assert slope > 0 and row[0] == pytest.approx(row[1], abs=0.01)
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, root, "other")


def test_matrix_out_of_fold_and_reference(cleaned):
    plan = fit_feature_matrix(cleaned)
    plain = plan.transform(cleaned, ["loan_id"])
    oof = plan.transform_train(cleaned, "loan_id", ["loan_id"])
    assert plain.columns == oof.columns and plain.count() == oof.count()
    name = "sub_grade__target_mean"
    assert plain.select(name).distinct().count() < oof.select(name).distinct().count()


def test_auto_strategy_and_frequency(cleaned):
    spec = {**FEATURE_SPEC, "features": {"categorical": {"grade": {}, "sub_grade": {}, "loan_id": {}}}}
    plan = fit_feature_matrix(cleaned, spec)
    assert list(plan.one_hot) == ["grade"]
    assert set(plan.lookups) == {"sub_grade__target_mean", "loan_id__freq"}


def test_validate_reports_each_failure(cleaned):
    matrix = fit_feature_matrix(cleaned).transform(cleaned, ["loan_id"]).persist()
    checks = validate.validate_matrix(matrix, "loan_id", cleaned_columns=cleaned.columns)
    validate.require_valid(checks)

    def failed(df, **kw):
        rows = validate.validate_matrix(df, "loan_id", **kw).where("not passed").collect()
        return {r["check"]: r["detail"] for r in rows}

    assert failed(matrix.drop("sub_grade__target_mean")) == {"feature_contract": "sub_grade__target_mean"}
    assert "leakage_prefix" in failed(matrix.withColumn("loan_status_x", F.lit(1)))
    assert failed(matrix, cleaned_columns=["recoveries", "dti"]) == {"leakage_firewall": "recoveries"}
    assert failed(matrix, cleaned_columns=["x"], forbidden=["x"]) == {"leakage_firewall": "x"}
    assert failed(matrix.drop("default")) == {"target_present": ""}
    broken = matrix.withColumn("default", F.when(F.col("loan_id") % 2 == 0, F.col("default")))
    assert "target_not_null" in failed(broken)
    with pytest.raises(validate.ValidationError):
        validate.require_valid(validate.validate_matrix(broken, "loan_id"))


def test_validate_with_the_model_checks(cleaned):
    matrix = fit_feature_matrix(cleaned).transform(cleaned, ["loan_id"]).persist()
    checks = validate.validate_matrix(
        matrix, "loan_id", run_canary=True, run_importance=True, importance_rounds=2
    )
    got = {r["check"]: r["passed"] for r in checks.collect()}
    assert {"canary_auc", "canary_gap", "single_importance", "time_importance"} <= set(got)
    assert got["canary_auc"] and got["time_importance"]


def test_contract_takes_one_hot_by_prefix():
    columns = ["grade_A", "grade_numeric", "term_months", "x"]
    got = validate.contracted_columns(columns, FEATURE_SPEC)
    assert {"grade_A", "grade_numeric", "term_months", "annual_inc__log1p"} <= set(got)
    assert "x" not in got


def test_spec_fingerprint_ignores_itself():
    frozen = {**FEATURE_SPEC, "freeze": {"content_md5": inputs.content_hash(FEATURE_SPEC)}}
    assert dict((c, d) for c, _, d in validate.schema_checks([], frozen))["spec_fingerprint"] == "matches"
    edited = {**frozen, "version": "v2"}
    assert "differs" in validate.schema_checks([], edited)[0][2]


def test_target_and_inputs(cleaned):
    assert inputs.infer_target({"label": "y"}) == "y"
    assert inputs.infer_target({"target": {"name": "z"}, "exclusions": {"target": "t"}}) == "t"
    with pytest.raises(ValueError):
        inputs.infer_target({"target": " "})
    x = inputs.modeling_inputs(cleaned, FEATURE_SPEC)
    assert "issue_d" not in x.columns and x.columns[-1] == "default"
    with pytest.raises(ValueError):
        inputs.modeling_inputs(cleaned.drop("dti"), FEATURE_SPEC)
    with pytest.raises(ValueError):
        inputs.modeling_inputs(cleaned, FEATURE_SPEC, strict_extra=True)
    with pytest.raises(ValueError):
        inputs.modeling_inputs(cleaned, {**FEATURE_SPEC, "numerical_cols": [" "]})
    roles = {"numeric": ["dti", "loan_id"], "text": ["grade", "absent"]}
    assert inputs.feature_candidates(cleaned, roles, ["grade"], ["loan_id"]) == ["dti"]


def test_manifest_does_not_depend_on_row_order(cleaned):
    a = inputs.feature_manifest(cleaned).first()
    b = inputs.feature_manifest(cleaned.repartition(5)).first()
    assert a == b and a["n_cols"] == len(cleaned.columns)


def test_jobs_end_to_end(spark, cleaned, tmp_path):
    manifest = jobs.build_features_job(cleaned, str(tmp_path / "features")).first()
    features = spark.read.parquet(manifest["features_path"])
    assert manifest["n_rows"] == cleaned.count()
    model, scores = jobs.train_job(features, max_iter=30)
    assert {r["split"] for r in scores.collect()} == {"train", "holdout"}
    reports = jobs.evaluate_job(model, features)
    assert reports["metrics"].first()["roc_auc"] > 0.5
    assert reports["calibration"].count() == 10
    importance = jobs.explain_job(model, features, background=50, samples=100).collect()
    assert importance[0]["mean_abs_attribution"] >= importance[-1]["mean_abs_attribution"]
    summary, report = jobs.monitor_job(features)
    assert summary.where("metric = 'delta'").count() == 1 and report.count() > 4
    tuned = jobs.tune_job(features, grid={"n_estimators": [2], "max_depth": [2, 3]}).collect()
    best = [r for r in tuned if r["is_best"]]
    assert len(best) == 1 and best[0]["roc_auc"] == max(r["roc_auc"] for r in tuned)


def test_stream_equals_batch(spark, sf, tmp_path):
    requests = loans(spark, sf).drop("loan_status").repartition(3)
    folder = str(tmp_path)
    requests.write.parquet(f"{folder}/in")
    source = spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")

    def score(df):
        return df.withColumn("pd", sigmoid(F.col("dti") * 0.02 - 3))

    running = score_stream(source, score, f"{folder}/out", f"{folder}/bad", f"{folder}/state")
    running.awaitTermination()
    streamed = spark.read.parquet(f"{folder}/out")
    batch = scored_requests(requests, score)
    assert streamed.select("batch").distinct().count() == 3
    assert streamed.drop("batch").exceptAll(batch).isEmpty()
    assert streamed.count() == batch.count()
    assert spark.read.parquet(f"{folder}/bad").count() == rejected_requests(requests).count() > 0


def test_primary_job_stores_a_scoring_bundle(spark, cleaned, tmp_path):
    folder, found = jobs.primary_job(cleaned, str(tmp_path), "pd_1", rounds=6, step=0.2)
    rows = {(r["model"], r["split"]): r for r in found.collect()}
    assert len(rows) == 9 and folder.endswith("/pd_1")
    assert rows["boosted", "train"]["roc_auc"] > 0.6 and rows["linear", "val"]["roc_auc"] > 0.55
    bundle = load_bundle(spark, str(tmp_path))
    kept = rows["calibrated", "test"]["brier"] < rows["boosted", "test"]["brier"]
    assert (bundle.calibration is not None) == kept == bundle.metadata["calibrated"]
    assert bundle.metadata["metrics"]["boosted/test"]["brier"] == rows["boosted", "test"]["brier"]
    scored = bundle.score(cleaned, ("loan_id",))
    assert scored.where("pd is null").isEmpty() and scored.count() == cleaned.count()


def test_stream_switches_bundles_and_reads_committed_batches(spark, cleaned, tmp_path):
    plan = fit_feature_matrix(cleaned)
    matrix = plan.transform(cleaned)
    pre = preprocess.fit_preprocess(matrix, ["loan_amnt", "dti", "annual_inc"])
    model = models.train_lr(matrix, pre)
    root = str(tmp_path / "bundles")
    save_bundle(spark, root, "v1", model, plan)
    folder = str(tmp_path)
    asked = cleaned.drop("default").withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    some = asked.where("loan_id % 2 = 0").limit(40)
    some.unionByName(some).write.parquet(f"{folder}/in/a")
    source = once_per_application(
        spark.readStream.schema(asked.schema).parquet(f"{folder}/in/*"), "loan_id", "at", "1 hour"
    )
    scorer = BundleScorer(spark, root, ["loan_id"])

    def run():
        score_stream(
            source, scorer, f"{folder}/out", f"{folder}/bad", f"{folder}/state",
            commits_path=f"{folder}/commits",
        ).awaitTermination()
        return committed(spark, f"{folder}/out", f"{folder}/commits")

    first = run()
    assert first.count() == first.select("loan_id").distinct().count() == 40
    save_bundle(spark, root, "v2", model, plan)
    asked.where("loan_id % 2 = 1").limit(10).write.parquet(f"{folder}/in/b")
    both = run()
    assert {r["model_version"]: r["count"] for r in both.groupBy("model_version").count().collect()} == {"v1": 40, "v2": 10}
    used = {r["model_version"] for r in model_versions(spark, f"{folder}/commits").collect()}
    assert {"v1", "v2"} <= used
    # A batch without its commit is not read.
    both.select("loan_id").limit(3).write.parquet(f"{folder}/out/batch=99")
    assert committed(spark, f"{folder}/out", f"{folder}/commits").count() == 50
