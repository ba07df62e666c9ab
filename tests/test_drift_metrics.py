import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pdloom.operators import baseline, drift, metrics, ordering, profiles


@pytest.fixture(scope="module")
def two_periods(spark):
    return spark.range(4000).select(
        F.when(F.col("id") < 2500, "train").otherwise("recent").alias("period"),
        (F.randn(1) + F.when(F.col("id") < 2500, 0.0).otherwise(1.5)).alias("moved"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.randn(2)).alias("spiked"),
        F.when(F.col("id") % 50 == 0, float("inf")).otherwise(F.rand(3)).alias("steady"),
        F.lit(1.0).alias("constant"),
        F.when(F.col("id") < 2500, F.rand(4)).alias("gone"),
        (F.rand(5) < 0.3).cast("int").alias("default"),
    ).persist()


def numpy_psi(base, new, bins=10):
    base, new = (x[np.isfinite(x)] for x in (base, new))
    cuts = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))
    p, q = (np.histogram(x, cuts)[0] for x in (base, new))
    p, q = (np.clip(x / max(x.sum(), 1e-6), 1e-6, 1) for x in (p, q))
    return np.sum((p - q) * np.log(p / q))


def test_psi(two_periods):
    names = ["moved", "spiked", "steady", "constant", "gone"]
    got = {r["feature"]: r["psi"] for r in drift.psi(two_periods, "period", names).collect()}
    pdf = two_periods.toPandas()
    for name in ("moved", "spiked", "steady"):
        base, new = (pdf[pdf.period == p][name].to_numpy() for p in ("train", "recent"))
        assert got[name] == pytest.approx(numpy_psi(base, new), abs=1e-12)
    assert np.isnan(got["constant"]) and np.isnan(got["gone"])
    assert got["moved"] > 0.25 > 0.1 > got["steady"]


def test_psi_of_a_table_with_itself_is_zero(two_periods):
    train = two_periods.where("period = 'train'")
    both = train.unionByName(train.withColumn("period", F.lit("recent")))
    assert drift.psi(both, "period", ["moved"]).first()["psi"] == pytest.approx(0.0, abs=1e-15)


def test_report_labels_and_missing_feature(two_periods):
    rows = drift.drift_report(two_periods, "period", ["moved", "steady", "gone"]).collect()
    labels = {r["feature"]: r["psi_label"] for r in rows}
    assert labels == {"moved": "significant_shift", "steady": "no_or_negligible_shift"}


def test_summary_of_one_row_has_zero_deviation(spark):
    df = spark.createDataFrame([("train", 2.0, None), ("recent", float("inf"), 1.0)], "period string, a double, b double")
    rows = {(r["period"], r["feature"]): r for r in drift.numeric_summary(df, "period").collect()}
    assert set(rows) == {("train", "a"), ("recent", "b")}
    assert rows[("train", "a")]["std"] == 0.0


@pytest.fixture(scope="module")
def tied(spark):
    """Scores with a hot tie group holding a third of the rows."""
    p = F.when(F.col("id") % 3 == 0, 0.4).otherwise(F.round(F.rand(7), 2))
    df = spark.range(2000).select(p.alias("p"), F.rand(8).alias("u"))
    return df.select("p", (F.col("u") < F.col("p")).cast("int").alias("y")).persist()


def brute(pdf):
    pos, neg = pdf[pdf.y == 1].p.to_numpy(), pdf[pdf.y == 0].p.to_numpy()
    diff = pos[:, None] - neg[None, :]
    auc = ((diff > 0).sum() + (diff == 0).sum() / 2) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted(set(pdf.p)):
        flagged = pdf[pdf.p >= t]
        ap += (pdf[pdf.p == t].y.sum() / len(pos)) * flagged.y.mean()
    return auc, ap


def test_areas(tied):
    auc, ap = brute(tied.toPandas())
    for points in (None, [], [0.2, 0.4, 0.41]):
        assert metrics.roc_auc(tied, "y", "p", points=points).first()[0] == pytest.approx(auc)
        assert metrics.avg_precision(tied, "y", "p", points=points).first()[0] == pytest.approx(ap)
    flipped = tied.withColumn("p", 1 - F.col("p"))
    assert metrics.roc_auc(flipped, "y", "p").first()[0] == pytest.approx(1 - auc)


def test_single_class_is_nan(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    row = metrics.evaluate_binary(df, "y", "p").first()
    assert np.isnan(row["roc_auc"]) and row["recall"] == 0.5 and row["tn"] == 0
    low = metrics.precision_recall_f1(df, "y", "p", 0.9).first()
    assert (low["precision"], low["recall"], low["f1"]) == (0.0, 0.0, 0.0)


def test_evaluate_matches_parts(tied):
    row = metrics.evaluate_binary(tied, "y", "p", 0.4).first()
    assert row["brier"] == pytest.approx(metrics.brier(tied, "y", "p").first()[0])
    assert row["log_loss"] == pytest.approx(metrics.log_loss(tied, "y", "p").first()[0])
    parts = metrics.confusion(tied, "y", "p", 0.4).first()
    assert [row[k] for k in ("tn", "fp", "fn", "tp")] == list(parts)


def test_curves(tied):
    pdf = tied.toPandas()
    for r in metrics.roc_curve(tied, "y", "p").collect():
        flagged = pdf[pdf.p >= r["threshold"]]
        assert r["tpr"] == pytest.approx(flagged.y.sum() / pdf.y.sum())
        assert r["fpr"] == pytest.approx((1 - flagged.y).sum() / (1 - pdf.y).sum())
    for r in metrics.pr_curve(tied, "y", "p").collect():
        assert r["precision"] == pytest.approx(pdf[pdf.p >= r["threshold"]].y.mean())


@pytest.mark.parametrize("strategy", ["quantile", "uniform"])
def test_calibration(tied, strategy):
    pdf = tied.toPandas()
    edges = np.quantile(pdf.p, np.linspace(0, 1, 6)) if strategy == "quantile" else np.linspace(0, 1, 6)
    pdf["bin"] = np.searchsorted(edges[1:-1], pdf.p)
    expected = pdf.groupby("bin").agg(y=("y", "mean"), p=("p", "mean"))
    got = metrics.calibration_curve(tied, "y", "p", 5, strategy).toPandas().set_index("bin")
    got = got.sort_index()
    assert np.allclose(got.prob_true, expected.y) and np.allclose(got.prob_pred, expected.p)
    with pytest.raises(ValueError):
        metrics.calibration_curve(tied, "y", "p", 5, "other")


def test_gate(tied):
    assert not metrics.auc_gate(tied, "y", "p", 0.99).first()["passed"]


def test_numeric_profile_edges(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (1.0, -3.0, None), (1.0, float("nan"), None), (1.0, 900.0, 1.0)],
        "flat double, wide double, rare double",
    )
    rows = {r["feature"]: r for r in profiles.numeric_profile(df, df.columns).collect()}
    pdf = df.toPandas()
    assert rows["flat"]["skewness"] == 0.0
    assert rows["wide"]["skewness"] == pytest.approx(pdf.wide.skew())
    assert rows["wide"]["planned_transformation"] == "log"
    assert rows["wide"]["shift_for_transformation"] == pytest.approx(3.000001)
    assert rows["rare"]["skewness"] is None and rows["rare"]["missing_rate"] == 0.75


def test_quality_counts(spark):
    df = spark.createDataFrame(
        [(1, 500.0, -1.0, "A", "Jan-2015", 1), (1, 5.0, float("inf"), "Z", "bad", None)],
        "loan_id int, int_rate double, loan_amnt double, grade string, issue_d string, `default` int",
    )
    got = {r["check"]: r["violations"] for r in profiles.data_quality(df).collect()}
    for name in ("int_rate_out_of_range", "negative_loan_amnt", "infinite_loan_amnt",
                 "invalid_grade", "unreadable_issue_d", "null_default", "duplicate_loan_id"):
        assert got[name] == 1, name


def test_kept_baseline_equals_the_whole_report(two_periods):
    names = ["moved", "spiked", "steady", "constant", "gone"]
    kept = baseline.fit_baseline(two_periods.where("period = 'train'"), names)
    new = two_periods.where("period = 'recent'")
    parts = [baseline.period_counts(new.where(w), kept) for w in ("moved < 1", "not moved < 1")]
    got = baseline.report_from_counts(kept, baseline.added(*parts))
    wanted = {r["feature"]: r.asDict() for r in drift.drift_report(two_periods, "period", names).collect()}
    found = {r["feature"]: r.asDict() for r in got.collect()}
    assert set(found) == set(wanted) and "moved" in found and "gone" not in found
    for feature, row in wanted.items():
        for k, v in row.items():
            if isinstance(v, float):
                assert found[feature][k] == pytest.approx(v, abs=1e-9, nan_ok=True)
            else:
                assert found[feature][k] == v


def test_counts_are_counted_without_the_baseline_rows(two_periods):
    kept = baseline.fit_baseline(two_periods.where("period = 'train'"), ["moved"])
    same = baseline.period_counts(two_periods.where("period = 'train'"), kept)
    row = baseline.report_from_counts(kept, same).first()
    assert row["psi"] == pytest.approx(0.0) and row["train_n"] == row["recent_n"] == 2500


def test_drift_report_computes_its_columns_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def told(value):
        seen.add(1)
        return value

    period = F.when(F.col("id") < 100, "train").otherwise("recent").alias("period")
    df = spark.range(200).select(period, told(F.col("id").cast("double")).alias("x"))
    report = drift.drift_report(df, "period", ["x"]).collect()
    assert seen.value == 200 and (report[0]["train_max"], report[0]["recent_min"]) == (99.0, 100.0)


def test_bins_and_segments_at_their_edges(spark):
    rows = [(v,) for v in (None, -1.0, -0.0, 0.0, 1.0, math.nextafter(1.0, 2.0), 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "v double")
    cuts = {"v": [-1.0, 0.0, 2.0, 3.0]}
    assert [r[0] for r in ordering.with_bins(df, cuts).select("_bin0").collect()] == [None, 0, 1, 1, 1, 1, 2, 2, -1]
    after = math.nextafter(1.0, 2.0)
    brackets = [ordering._Bracket(-0.0, 1.0), ordering._Bracket(after, after), ordering._Bracket(3.0, 3.0)]
    fast = ordering._with_segments(df, "double", {"v": (brackets, [])}).select("_segment0")
    slow = df.select(ordering._segment(F.col("v"), brackets))
    wanted = [None, 0, 1, 1, 1, 3, 4, 5, 6]
    assert [r[0] for r in fast.collect()] == [r[0] for r in slow.collect()] == wanted
