import numpy as np
import pytest
from pyspark.sql import functions as F

from pdloom.operators import encoders, lookup, ordering, positions, preprocess, splits


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; the rest are spread and some are missing."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0))
        .when(F.col("id") % 100 == 1, F.lit(None))
        .when(F.col("id") % 100 == 2, F.lit(float("nan")))
        .when(F.col("id") % 100 == 4, F.lit(float("inf")))
        .otherwise((F.col("id") * 7919 % 5003) / 10.0)
        .alias("x"),
        (F.col("id") % 7).cast("double").alias("few"),
        F.lit(2.0).alias("same"),
        F.lit(None).cast("double").alias("none"),
    )
    return df.repartition(6)


@pytest.mark.parametrize("most", [20, 10**9])
def test_exact_percentiles(skewed, monkeypatch, most):
    monkeypatch.setattr(ordering, "BRACKET_VALUES", most)
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]
    got = ordering.exact_percentiles(
        skewed, {c: probs for c in ("x", "few", "same", "none")}, accuracy=50
    )
    pdf = skewed.toPandas()
    for name in ("x", "few", "same"):
        values = pdf[name].replace([np.inf, -np.inf], np.nan).dropna()
        assert np.allclose(got[name], np.quantile(values, probs), rtol=1e-15, atol=0)
    assert got["none"] is None


def test_ranks_outside_their_bracket_are_found(skewed, monkeypatch):
    """Brackets that miss the wanted ranks lead to a search of the gaps, and the exact value."""
    merge, read, calls = ordering._merge, ordering._read_ranks, []

    def ends_only(brackets):
        if calls:
            return merge(brackets)
        low, high = min(b.low for b in brackets), max(b.high for b in brackets)
        return [ordering._Bracket(low, low), ordering._Bracket(high, high)]

    def counted(*args):
        calls.append(1)
        return read(*args)

    monkeypatch.setattr(ordering, "_merge", ends_only)
    monkeypatch.setattr(ordering, "_read_ranks", counted)
    got = ordering.exact_percentiles(skewed, {"x": [0.2, 0.5, 0.95]}, accuracy=50)
    values = skewed.toPandas()["x"].replace([np.inf, -np.inf], np.nan).dropna()
    assert np.allclose(got["x"], np.quantile(values, [0.2, 0.5, 0.95]))
    assert len(calls) == 2


@pytest.mark.parametrize("most", [20, 10**9])
def test_kth_smallest(spark, monkeypatch, most):
    monkeypatch.setattr(ordering, "BRACKET_VALUES", most)
    df = spark.range(5000).select((F.col("id") * 7919 % 100003 + 2**60).alias("k"))
    expected = sorted(r["k"] for r in df.collect())
    for rank in (0, 17, 2500, 4999):
        got = ordering.kth_smallest(df, {"k": (rank, 5000)}, "bigint", accuracy=20)
        assert got["k"] == expected[rank]


def test_running_totals_across_buckets(spark):
    df = spark.range(900).select(
        (F.col("id") % 2).alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col("id") % 41 / 40.0).alias("s"),
        (F.col("id") % 5).alias("n"),
    )
    got = ordering.running_totals(df, "s", ["n"], [0.1, 0.3, 0.5, 0.8], ["g"]).collect()
    pdf = df.toPandas()
    for row in got:
        group = pdf[pdf.g == row["g"]]
        assert row["n"] == group[group.s == row["s"]].n.sum()
        assert row["n_below"] == group[group.s < row["s"]].n.sum()
        assert row["n_total"] == group.n.sum()
    assert len(got) == pdf.groupby("g").s.nunique().sum()


@pytest.fixture(scope="module")
def categories(spark):
    return spark.range(3000).select(
        F.col("id").alias("loan_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("c"), (F.col("id") % 200).cast("string")))
        .alias("job"),
        (F.col("id") * 31 % 7 < 2).cast("int").alias("default"),
    )


@pytest.mark.parametrize("large", [False, True])
def test_encoders_match_pandas_on_both_join_paths(categories, large, monkeypatch):
    if large:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    unseen = categories.withColumn(
        "job", F.when(F.col("loan_id") % 11 == 0, F.lit("new")).otherwise(F.col("job"))
    )
    fitted = encoders.fit_lookup_encoders(categories, ["job"], ["job"])
    assert all(e.small is not large for e in fitted.values())
    out = unseen
    for encoder in fitted.values():
        out = encoder.transform(out)
    got = out.toPandas().set_index("loan_id").sort_index()
    pdf = categories.toPandas()
    share = pdf.job.value_counts(dropna=False) / len(pdf)
    mean = pdf.groupby("job").default.mean()
    assert len(got) == len(pdf)
    for _, row in got.iterrows():
        if row.job is None:
            assert row.job__freq == pytest.approx(pdf.job.isna().mean())
            assert row.job__target_mean == pytest.approx(pdf.default.mean())
        else:
            assert row.job__freq == pytest.approx(share.get(row.job, share.mean()))
            assert row.job__target_mean == pytest.approx(mean.get(row.job, pdf.default.mean()))


@pytest.mark.parametrize("large", [False, True])
def test_out_of_fold_means(categories, large, monkeypatch):
    if large:
        monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    out = encoders.oof_target_mean(
        categories, "job", "loan_id", fold=F.col("loan_id") % 5
    ).toPandas()
    out["fold"] = out.loan_id % 5
    assert len(out) == 3000
    for (job, fold), group in out.groupby(["job", "fold"]):
        others = out[(out.job == job) & (out.fold != fold)]
        expected = others.default.mean() if len(others) else out.default.mean()
        assert np.allclose(group.job__target_mean, expected)
    assert np.allclose(out[out.job.isna()].job__target_mean, out.default.mean())


def test_hot_keys_do_not_meet_the_tail_shuffle(categories, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    fitted = encoders.fit_lookup_encoders(categories, ["job"])["job__freq"]
    plan = fitted.transform(categories)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_hot" in plan


def test_unseen_hot_value_is_spread(spark):
    """Half the rows on a value the fit never saw; no task of the join holds more than a share."""
    rows = spark.range(20_000).select(
        "id", F.when(F.col("id") % 2 == 0, "new").otherwise(F.concat(F.lit("c"), F.col("id") % 997)).alias("c")
    )
    table = spark.range(900).select(F.concat(F.lit("c"), "id").alias("c"), F.col("id").alias("v"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = lookup.lookup_join(rows, table, ["c"], ["v"], small=False)
        sizes = out.groupBy(F.spark_partition_id()).count().toPandas()["count"]
        got = out.toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(got) == 20_000 and got[got.c == "new"].v.isna().all()
    known = got[got.c != "new"]
    number = known.c.str[1:].astype(int)
    assert (known.v.fillna(-1) == number.where(number < 900, -1)).all()
    assert sizes.sum() == 20_000 and sizes.max() < 20_000 * 0.3


def test_one_hot(categories):
    fitted = encoders.fit_one_hot(categories, ["job"])["job"]
    assert fitted.outputs[-1] == "job_<NA>" and "job_hot" in fitted.outputs
    flags = fitted.transform(categories)
    total = sum(F.col(f"`{c}`") for c in fitted.outputs)
    assert flags.select(total.alias("t")).where("t <> 1").isEmpty()


@pytest.mark.parametrize("local", [5_000, 10])
def test_many_categories_become_sparse_vectors(spark, monkeypatch, local):
    monkeypatch.setattr(positions, "LOCAL_CATEGORIES", local)
    count = 50_000 if local == 10 else 4_900
    rows = spark.range(2 * count).select(
        "id",
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % count)).alias("c"),
    )
    fitted = encoders.fit_one_hot(rows, ["c"])["c"]
    assert fitted.width == count + 1
    names = sorted(f"c{i}" for i in range(count))
    if local > 10:
        assert list(fitted.categories) == names
    tested = rows.where("id < 2000").unionByName(spark.createDataFrame([(-1, "new")], rows.schema))
    got = fitted.vectors(tested, "v").collect()
    place = {n: i for i, n in enumerate(names)}
    assert len(got) == 2001
    for r in got:
        wanted = [] if r["c"] == "new" else [count if r["c"] is None else place[r["c"]]]
        assert r["v"].size == count + 1 and list(r["v"].indices) == wanted


def test_names_never_collide(spark):
    df = spark.createDataFrame(
        [("a.b", "c"), ("a_b", "x"), ("nan", "<NA>"), (None, None), ("<NA>", "=<NA>"), ("b_c", "c")],
        "a string, a_b string",
    )
    fitted = encoders.fit_one_hot(df, ["a", "a_b"], taken=["a_b", "loan"])
    names = fitted["a"].outputs + fitted["a_b"].outputs
    assert len(set(names)) == len(names) == 6 + 5 and "a_a.b" in names and "a_a_b" in names
    flags = fitted["a_b"].transform(fitted["a"].transform(df))
    assert flags.select(sum(F.col(f"`{n}`") for n in names).alias("t")).distinct().collect()[0]["t"] == 2
    pre = preprocess.fit_preprocess(df, [], ["a", "a_b"], impute=False)
    assert len(set(pre.outputs)) == pre.width == 6 + 5
    wide = [list(r) for r in pre.transform(df).collect()]
    sparse = [r["features"].toArray().tolist() for r in pre.vectors(df).collect()]
    assert wide == sparse


def test_numbered_is_the_rank(spark):
    df = spark.range(3_000).select(F.pmod(F.xxhash64("id"), F.lit(10_000)).alias("h"), "id")
    ranked = positions.numbered(df, ["h", "id"], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(3_000))
    assert [(r["h"], r["id"]) for r in ranked] == sorted((r["h"], r["id"]) for r in ranked)


def test_group_rare(categories):
    got = encoders.group_rare(categories, categories, "job", 100, 0.005)
    kinds = {r[0] for r in got.select("job__grouped").distinct().collect()}
    assert kinds == {"hot", "__MISSING__", "__OTHER__"}


def test_split_sizes_and_errors(spark):
    df = spark.range(101).select(
        F.col("id").alias("loan_id"), F.lit("Jan-2015").alias("issue_d"), F.lit(0).alias("default")
    )
    sizes = {r["split"]: r["count"] for r in splits.time_split(df, "issue_d", "loan_id").groupBy("split").count().collect()}
    assert sizes == {"train": 80, "holdout": 21}
    three = splits.time_split3(df, "issue_d", "loan_id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in three} == {"train": 70, "val": 15, "test": 16}
    with pytest.raises(ValueError):
        splits.time_split(df, "issue_d", "loan_id", 1.0)
    with pytest.raises(ValueError):
        splits.time_split3(df, "issue_d", "loan_id", (0.5, 0.2, 0.2))
    with pytest.raises(ValueError):
        splits.time_split(df.withColumn("issue_d", F.lit("x")), "issue_d", "loan_id")
    with pytest.raises(ValueError):
        splits.time_split(df.limit(1), "issue_d", "loan_id")
    with pytest.raises(ValueError):
        splits.prepare_split(df, strategy="random")
    with pytest.raises(KeyError):
        splits.prepare_split(df.drop("default"))


def test_text_ids_split_by_hash(spark):
    df = spark.range(50).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("loan_id"), F.lit("2015-01-01").alias("d")
    )
    got = splits.time_split(df, "d", "loan_id", 0.5).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"train": 25, "holdout": 25}


def test_copies_of_one_loan_stay_together(spark):
    ids = spark.range(30).select(F.when(F.col("id") < 20, F.lit(7)).otherwise(F.col("id")).alias("loan_id"))
    df = ids.withColumn("d", F.lit("2015-01-01"))
    got = splits.time_split(df, "d", "loan_id", 0.5)
    assert got.where("loan_id = 7").select("split").distinct().count() == 1
    assert got.count() == 30


def test_overlap_is_reported(spark):
    rows = [("train", 1, 5), ("val", 4, 6), ("test", 6, 7)]
    meta = spark.createDataFrame(rows, "split string, anchor_min int, anchor_max int")
    got = [r["overlaps"] for r in splits.temporal_overlap(meta).collect()]
    assert got == [True, False]
    with pytest.raises(ValueError):
        splits.require_no_overlap(meta)


def test_sample_is_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "loan_id")
    a = {r[0] for r in splits.sample_rows(df, 10, "loan_id", 1).collect()}
    b = {r[0] for r in splits.sample_rows(df.repartition(7), 10, "loan_id", 1).collect()}
    assert a == b and len(a) == 10
    assert splits.sample_rows(df, 500, "loan_id").count() == 100


def test_running_totals_shuffle_their_rows_once(spark):
    rows = [(i % 2, i / 100.0) for i in range(100)] + [(0, None)]
    df = spark.createDataFrame(rows, "g int, s double").select("g", "s", F.lit(1).alias("n"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ordering.running_totals(df, "s", ["n"], [0.25, 0.5], ["g"])
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("ReusedExchange") == 1
    found = got.collect()
    assert len(found) == 100
    assert all(r["n_total"] == 50 and r["n_below"] == round(r["s"] * 100) // 2 for r in found)
