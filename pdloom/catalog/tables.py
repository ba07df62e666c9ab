"""Encoders, profiles, splits and drift."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from pdloom.catalog.base import (
    DATE,
    cleaned,
    part,
    query,
    rounded,
    split2,
    using,
)
from pdloom.operators import baseline, drift, encoders, features, profiles, splits
from pdloom.plans.jobs import periods
from pdloom.session import cached, scratch_path
from pdloom.sources import tables
from pdloom.sources.fixture import loans

DRIFT_COLUMNS = [
    "loan_amnt",
    "annual_inc",
    "int_rate",
    "dti",
    "loan_to_income",
    "term_months",
    "grade_numeric",
    "sub_grade_numeric",
]

# ---------------------------------------------------------------- encoders

_FREQ = {
    "counts": """select emp_length as c, count(*) as n from split2 where split = 'train'
        group by 1""",
    "shares": "select c, n / (select sum(n) from counts) as freq from counts",
}
_FREQ_BODY = """select loan_id, round(coalesce(freq, (select 1.0 / count(*) from shares)), 9)
    as emp_length__freq from split2 left join shares on emp_length is not distinct from c"""


@query("freq_encode", using("split2", _FREQ_BODY, **_FREQ))
def freq_encode(spark, sf):
    rows = split2(spark, sf)
    encoded = encoders.freq_encode(part(rows, "train"), rows, "emp_length")
    return rounded(encoded, 9, "emp_length__freq").select("loan_id", "emp_length__freq")


@query(
    "apply_frequency",
    using(
        "split2",
        """select loan_id, round(coalesce(freq, (select 1.0 / count(*) from shares)), 9)
        as emp_length__freq from split2 left join shares
        on (case when loan_id % 5 = 0 then 'unseen' else emp_length end) is not distinct from c""",
        **_FREQ,
    ),
)
def apply_frequency(spark, sf):
    rows = split2(spark, sf)
    fitted = encoders.fit_lookup_encoders(part(rows, "train"), frequency=["emp_length"])
    other = F.when(F.expr("loan_id % 5 = 0"), F.lit("unseen")).otherwise(F.col("emp_length"))
    encoded = fitted["emp_length__freq"].transform(rows.withColumn("emp_length", other))
    return rounded(encoded, 9, "emp_length__freq").select("loan_id", "emp_length__freq")


@query(
    "apply_frequency_by_shuffle",
    using(
        "split2",
        """select loan_id, round(coalesce(freq, (select 1.0 / count(*) from shares)), 9)
        as emp_length__freq from split2 left join shares
        on (case when loan_id % 3 = 0 then 'unseen' else emp_length end) is not distinct from c""",
        **_FREQ,
    ),
)
def apply_frequency_by_shuffle(spark, sf):
    """The way of a fitted table too large to broadcast, a third of the rows on one unseen value."""
    rows = split2(spark, sf)
    fitted = encoders.fit_lookup_encoders(part(rows, "train"), frequency=["emp_length"])
    other = F.when(F.expr("loan_id % 3 = 0"), F.lit("unseen")).otherwise(F.col("emp_length"))
    large = replace(fitted["emp_length__freq"], small=False)
    encoded = large.transform(rows.withColumn("emp_length", other))
    return rounded(encoded, 9, "emp_length__freq").select("loan_id", "emp_length__freq")


_MEANS = {
    "means": """select sub_grade as c, avg(cast("default" as double)) as m from split2
        where split = 'train' and sub_grade is not null group by 1""",
    "prior": """select avg(cast("default" as double)) as p from split2 where split = 'train'""",
}


@query(
    "target_mean_fit_apply",
    using(
        "split2",
        """select loan_id, round(coalesce(m, (select p from prior)), 9)
        as sub_grade__target_mean from split2 left join means on sub_grade = c
        where split = 'holdout'""",
        **_MEANS,
    ),
)
def target_mean_fit_apply(spark, sf):
    rows = split2(spark, sf)
    encoded = encoders.target_mean_encode(
        part(rows, "train"), part(rows, "holdout"), "sub_grade"
    )
    return rounded(encoded, 9, "sub_grade__target_mean").select(
        "loan_id", "sub_grade__target_mean"
    )


@query(
    "apply_target_mean",
    using(
        "split2",
        """select loan_id, round(coalesce(m, (select p from prior)), 9)
        as sub_grade__target_mean from split2 left join means
        on (case when loan_id % 5 = 0 then null when loan_id % 5 = 1 then 'Z9'
        else sub_grade end) = c""",
        **_MEANS,
    ),
)
def apply_target_mean(spark, sf):
    rows = split2(spark, sf)
    fitted = encoders.fit_lookup_encoders(part(rows, "train"), target_mean=["sub_grade"])
    other = (
        F.when(F.expr("loan_id % 5 = 0"), F.lit(None))
        .when(F.expr("loan_id % 5 = 1"), F.lit("Z9"))
        .otherwise(F.col("sub_grade"))
    )
    encoded = fitted["sub_grade__target_mean"].transform(rows.withColumn("sub_grade", other))
    return rounded(encoded, 9, "sub_grade__target_mean").select(
        "loan_id", "sub_grade__target_mean"
    )


@query(
    "oof_target_mean",
    using(
        "cleaned",
        """select loan_id, round(coalesce(case when emp_length is not null and n > fn
        then (s - fs) / (n - fn) end, p), 9) as emp_length__target_mean from (
        select *, count(*) over (partition by emp_length) as n,
        sum(y) over (partition by emp_length) as s,
        count(*) over (partition by emp_length, fold) as fn,
        sum(y) over (partition by emp_length, fold) as fs, avg(y) over () as p from folds)""",
        folds="""select loan_id, emp_length, loan_id % 5 as fold,
        cast("default" as double) as y from cleaned""",
    ),
)
def oof_target_mean(spark, sf):
    fold = (F.col("loan_id") % 5).cast("int")
    encoded = encoders.oof_target_mean(cleaned(spark, sf), "emp_length", "loan_id", fold=fold)
    return rounded(encoded, 9, "emp_length__target_mean").select(
        "loan_id", "emp_length__target_mean"
    )


@query(
    "one_hot",
    using(
        "split2",
        "select loan_id, "
        + ", ".join(
            f"cast(coalesce(grade = '{g}', false) as integer) as grade_{g}" for g in "ABCDEFG"
        )
        + ", cast(grade is null as integer) as \"grade_<NA>\" from (select loan_id, "
        "case when loan_id % 5 = 0 then null when loan_id % 5 = 1 then 'Z' else grade end "
        "as grade from split2)",
    ),
)
def one_hot(spark, sf):
    rows = split2(spark, sf)
    fitted = encoders.fit_one_hot(part(rows, "train"), ["grade"])["grade"]
    other = (
        F.when(F.expr("loan_id % 5 = 0"), F.lit(None))
        .when(F.expr("loan_id % 5 = 1"), F.lit("Z"))
        .otherwise(F.col("grade"))
    )
    flags = fitted.transform(rows.select("loan_id", other.alias("grade")))
    return flags.select("loan_id", *fitted.outputs)


_CATEGORIES = ["term", "grade", "sub_grade", "emp_length", "home_ownership", "loan_id"]
_CARDINALITY = " union all ".join(
    f"""select '{c}' as feature, count(distinct {c})
    + max(cast({c} is null as integer)) as cardinality,
    round(avg(cast({c} is null as integer)), 9) as missing_rate from cleaned"""
    for c in _CATEGORIES
)


@query(
    "category_cardinality",
    using("cleaned", "select * from k", k=_CARDINALITY),
)
def category_cardinality(spark, sf):
    return rounded(
        encoders.category_cardinality(cleaned(spark, sf), _CATEGORIES), 9, "missing_rate"
    )


@query(
    "encode_strategy",
    using(
        "cleaned",
        """select feature, cardinality, case when cardinality <= 10 then 'one_hot'
        when cardinality <= 100 then 'target_mean' else 'count_frequency' end as strategy from k""",
        k=_CARDINALITY,
    ),
)
def encode_strategy(spark, sf):
    chosen = encoders.encode_strategy(cleaned(spark, sf), _CATEGORIES)
    return chosen.select("feature", "cardinality", "strategy")


@query(
    "group_rare",
    using(
        "split2",
        """select loan_id, case when sub_grade is null then '__MISSING__'
        when n >= 100 and n >= 0.005 * total then sub_grade else '__OTHER__' end
        as sub_grade__grouped from holes left join counts using (sub_grade)
        cross join (select count(*) as total from holes where split = 'train')""",
        holes="""select loan_id, split, case when loan_id % 9 <> 0 then sub_grade end
        as sub_grade from split2""",
        counts="select sub_grade, count(*) as n from holes where split = 'train' group by 1",
    ),
)
def group_rare(spark, sf):
    rows = split2(spark, sf).withColumn(
        "sub_grade", F.when(F.expr("loan_id % 9 <> 0"), F.col("sub_grade"))
    )
    grouped = encoders.group_rare(part(rows, "train"), rows, "sub_grade")
    return grouped.select("loan_id", "sub_grade__grouped")


# ---------------------------------------------------------------- profiles

_RAW_COLUMNS = [
    ("loan_id", "bigint", "numeric", True),
    ("loan_amnt", "double", "numeric", False),
    ("annual_inc", "double", "numeric", False),
    ("int_rate", "string", "percent", False),
    ("term", "string", "categorical", False),
    ("dti", "double", "numeric", False),
    ("grade", "string", "categorical", False),
    ("sub_grade", "string", "categorical", False),
    ("emp_length", "string", "categorical", False),
    ("home_ownership", "string", "categorical", False),
    ("issue_d", "string", "datetime", False),
    ("loan_status", "string", "categorical", False),
]


@query(
    "missingness_profile",
    using(
        "loans",
        "select * from m",
        m=" union all ".join(
            f"""select '{c}' as "column", round(avg(cast({c} is null as integer)), 9)
            as missing_rate, '{t}' as dtype, '{r}' as role, {str(i).lower()} as id_like
            from loans"""
            for c, t, r, i in _RAW_COLUMNS
        ),
    ),
)
def missingness_profile(spark, sf):
    return rounded(profiles.missingness_profile(loans(spark, sf)), 9, "missing_rate")


_NUMERIC = ["loan_amnt", "annual_inc", "int_rate", "dti", "loan_to_income"]


@query(
    "numeric_profile",
    using(
        "labelled",
        """select feature, round(missing_rate, 9) as missing_rate, round(skewness, 6) + 0 as skewness,
        min_value, case when abs(skewness) > 1 then 'log' else 'none' end
        as planned_transformation, case when abs(skewness) > 1 and min_value <= 0
        then abs(min_value) + 1e-6 else 0.0 end as shift_for_transformation from p""",
        numbers="""select loan_amnt, annual_inc, rate as int_rate,
        case when loan_id % 11 <> 0 then dti end as dti,
        loan_amnt * loan_amnt * loan_amnt - 1000 as cubed from labelled""",
        p=" union all ".join(
            f"""select '{c}' as feature, avg(cast({c} is null as integer)) as missing_rate,
            skewness({c}) as skewness, min({c}) as min_value from numbers"""
            for c in ("loan_amnt", "annual_inc", "int_rate", "dti", "cubed")
        ),
    ),
)
def numeric_profile(spark, sf):
    from pdloom.operators.cleaning import coerce_numeric

    amount = F.col("loan_amnt")
    rows = coerce_numeric(loans(spark, sf)).select(
        "loan_amnt",
        "annual_inc",
        "int_rate",
        F.when(F.expr("loan_id % 11 <> 0"), F.col("dti")).alias("dti"),
        (amount * amount * amount - 1000).alias("cubed"),
    )
    profile = profiles.numeric_profile(rows, rows.columns)
    return rounded(rounded(profile, 9, "missing_rate"), 6, "skewness")


@query(
    "status_counts",
    using(
        "loans",
        """select loan_status, count(*) as n from loans group by 1
        order by n desc, loan_status limit 20""",
    ),
)
def status_counts(spark, sf):
    return profiles.value_counts(loans(spark, sf), "loan_status", 20)


@query(
    "date_profile",
    using(
        "cleaned",
        """select 'issue_d' as feature, round(avg(cast(d is null as integer)), 9)
        as missing_rate, min(d) as min_date, max(d) as max_date from dates""",
        dates=f"""select case when loan_id % 13 <> 0 then {DATE} end as d from cleaned""",
    ),
)
def date_profile(spark, sf):
    bad = F.when(F.expr("loan_id % 13 = 0"), F.lit("not a date")).otherwise(F.col("issue_d"))
    rows = cleaned(spark, sf).withColumn("issue_d", bad)
    return rounded(profiles.date_profile(rows, ["issue_d"]), 9, "missing_rate")


@query(
    "positive_rate",
    using(
        "split2",
        """select split, count(*) as n, round(avg("default"), 9) as default_rate from split2
        group by 1""",
    ),
)
def positive_rate(spark, sf):
    return rounded(profiles.positive_rate(split2(spark, sf), ["split"]), 9, "default_rate")


@query(
    "class_balance",
    using(
        "cleaned",
        """select count(*) as classes, min(n) as smallest, max(n) as largest,
        round(min(n) / max(n), 9) as ratio from
        (select "default", count(*) as n from cleaned group by 1)""",
    ),
)
def class_balance(spark, sf):
    return rounded(profiles.class_balance(cleaned(spark, sf)), 9, "ratio")


@query(
    "target_checks",
    using(
        "cleaned",
        """select count(*) filter (where y is null) as null_targets,
        count(*) filter (where y not in (0, 1)) as foreign_targets, false as is_valid,
        true as has_every_value from (select case when loan_id % 10 = 0 then null
        when loan_id % 10 = 1 then 2 else "default" end as y from cleaned)""",
    ),
)
def target_checks(spark, sf):
    y = (
        F.when(F.expr("loan_id % 10 = 0"), F.lit(None))
        .when(F.expr("loan_id % 10 = 1"), F.lit(2))
        .otherwise(F.col("default"))
    )
    return profiles.target_checks(cleaned(spark, sf).withColumn("default", y))


_QUALITY = {
    "dirty": f"""select * from (select loan_id, case when loan_id % 20 = 0 then 500
        else rate end as int_rate, case when loan_id % 21 = 0 then -loan_amnt
        when loan_id % 22 = 0 then cast('inf' as double) else loan_amnt end as loan_amnt,
        annual_inc, case when loan_id % 23 = 0 then 'Z' else grade end as grade,
        case when loan_id % 24 = 0 then 'invalid-date' else issue_d end as issue_d,
        "default" from labelled) union all select loan_id, rate, loan_amnt, annual_inc, grade,
        issue_d, "default" from labelled where loan_id % 100 = 0""",
}
_CHECKS = [
    *[
        (f"null_{c}", f'"{c}" is null')
        for c in (
            "loan_id",
            "int_rate",
            "loan_amnt",
            "annual_inc",
            "grade",
            "issue_d",
            "default",
        )
    ],
    *[(f"infinite_{c}", f"isinf({c})") for c in ("int_rate", "loan_amnt", "annual_inc")],
    ("int_rate_out_of_range", "int_rate < 0 or int_rate > 100"),
    ("negative_loan_amnt", "loan_amnt < 0"),
    ("negative_annual_inc", "annual_inc < 0"),
    ("invalid_grade", "grade not in ('A','B','C','D','E','F','G')"),
    ("unreadable_issue_d", f"issue_d is not null and {DATE} is null"),
]


@query(
    "data_quality",
    using(
        "labelled",
        " union all ".join(
            f"""select '{name}' as "check", count(*) filter (where {rule}) as violations
            from dirty"""
            for name, rule in _CHECKS
        )
        + """ union all select 'duplicate_loan_id', count(*) from
        (select loan_id from dirty group by 1 having count(*) > 1)""",
        **_QUALITY,
    ),
)
def data_quality(spark, sf):
    from pdloom.functions.columns import status_label
    from pdloom.operators.cleaning import coerce_numeric

    rows = coerce_numeric(loans(spark, sf)).select(
        "loan_id",
        "int_rate",
        "loan_amnt",
        "annual_inc",
        "grade",
        "issue_d",
        status_label(F.col("loan_status")).alias("default"),
    )

    def broken(name, every, value):
        return F.when(F.col("loan_id") % every == 0, value).otherwise(F.col(name))

    amount = (
        F.when(F.expr("loan_id % 21 = 0"), -F.col("loan_amnt"))
        .when(F.expr("loan_id % 22 = 0"), F.lit(float("inf")))
        .otherwise(F.col("loan_amnt"))
    )
    dirty = rows.withColumns(
        {
            "int_rate": broken("int_rate", 20, F.lit(500.0)),
            "loan_amnt": amount,
            "grade": broken("grade", 23, F.lit("Z")),
            "issue_d": broken("issue_d", 24, F.lit("invalid-date")),
        }
    )
    return profiles.data_quality(dirty.unionByName(rows.where("loan_id % 100 = 0")))


# ---------------------------------------------------------------- splits


@query("time_split", using("split2", "select loan_id, split from split2"))
def time_split(spark, sf):
    return split2(spark, sf).select("loan_id", "split")


@query("time_split3", using("split3", "select loan_id, split from split3"))
def time_split3(spark, sf):
    return splits.time_split3(cleaned(spark, sf), "issue_d", "loan_id").select("loan_id", "split")


def _meta(spark, sf):
    dated = features.anchor_month(features.datetime_parts(cleaned(spark, sf), "issue_d"))
    split = splits.time_split3(dated, "anchor", "loan_id")
    return splits.split_meta(split, "anchor")


_META = {
    "meta": f"""select split, count(*) as n, min({DATE}) as anchor_min, max({DATE})
        as anchor_max, round(avg("default"), 9) as default_rate from split3 group by 1""",
}


@query("split_meta", using("split3", "select * from meta", **_META))
def split_meta(spark, sf):
    return rounded(_meta(spark, sf), 9, "default_rate")


@query(
    "temporal_overlap",
    using(
        "split3",
        """select a.split as earlier, b.split as later, a.anchor_max as earlier_max,
        b.anchor_min as later_min, a.anchor_max > b.anchor_min as overlaps
        from meta a join meta b on (a.split, b.split) in (('train', 'val'), ('val', 'test'))""",
        **_META,
    ),
)
def temporal_overlap(spark, sf):
    return splits.temporal_overlap(_meta(spark, sf))


@query("prepare_split", using("split2", "select * exclude (issue_d, rn, total) from split2"))
def prepare_split(spark, sf):
    return splits.prepare_split(cleaned(spark, sf))


@query(
    "sample_rows",
    using(
        "cleaned",
        """select loan_id, loan_amnt from (select *, row_number() over (order by
        md5(cast(loan_id as varchar) || ':7'), loan_id) as r, count(*) over () as total from cleaned)
        where r <= total // 2""",
    ),
)
def sample_rows(spark, sf):
    rows = cleaned(spark, sf)
    return splits.sample_rows(rows, rows.count() // 2, "loan_id", 7).select("loan_id", "loan_amnt")


# ---------------------------------------------------------------- drift

_STATS = ("mean", "std", "min", "max")
_SUMMARY = {
    "periods": """select * exclude (split), case split when 'train' then 'train'
        else 'recent' end as period from split2""",
    "summary": " union all ".join(
        f"""select period, '{c}' as feature, count({c}) as n,
        avg(cast({c} as double)) as mean, stddev_samp({c}) as std,
        cast(min({c}) as double) as min, cast(max({c}) as double) as max
        from periods group by period"""
        for c in DRIFT_COLUMNS
    ),
    "aligned": """select t.feature, t.mean as train_mean, t.std as train_std, t.min as train_min,
        t.max as train_max, r.mean as recent_mean, r.std as recent_std, r.min as recent_min,
        r.max as recent_max from summary t join summary r on t.feature = r.feature
        where t.period = 'train' and r.period = 'recent'""",
    "long": " union all ".join(
        f"select period, '{c}' as feature, cast({c} as double) as x from periods"
        for c in DRIFT_COLUMNS
    ),
    "cuts": """select feature, list_sort(list_distinct(quantile_cont(x,
        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) as cuts from long
        where period = 'train' and x is not null group by 1""",
    "binned": """select feature, period, least(len(list_filter(cuts, lambda c: c <= x)),
        len(cuts) - 1) as bin from long join cuts using (feature)
        where x >= cuts[1] and x <= cuts[-1]""",
    "shares": """select feature, bin, greatest(sum(cast(period = 'train' as integer))
        / sum(sum(cast(period = 'train' as integer))) over (partition by feature), 1e-6) as p,
        greatest(sum(cast(period = 'recent' as integer))
        / sum(sum(cast(period = 'recent' as integer))) over (partition by feature), 1e-6) as q
        from binned group by 1, 2""",
    "psi": """select feature, case when len(cuts) > 2 then s else cast('nan' as double) end
        as psi from cuts join (select feature, sum((p - q) * ln(p / q)) as s from shares
        group by 1) using (feature)""",
    "report": """select feature, psi, case when isnan(psi) then 'nan' when psi < 0.1
        then 'no_or_negligible_shift' when psi < 0.25 then 'moderate_shift'
        else 'significant_shift' end as psi_label, aligned.* exclude (feature)
        from psi join aligned using (feature)""",
}


def _through(last: str) -> dict[str, str]:
    names = list(_SUMMARY)
    return {n: _SUMMARY[n] for n in names[: names.index(last) + 1]}


def _round_sql(names, digits=6):
    return ", ".join(f"round({n}, {digits}) + 0 as {n}" for n in names)


_SIDES = [f"{p}_{s}" for p in ("train", "recent") for s in _STATS]


@query(
    "numeric_summary",
    using(
        "split2",
        f"select period, feature, n, {_round_sql(_STATS)} from summary",
        **_through("summary"),
    ),
)
def numeric_summary(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    return rounded(drift.numeric_summary(rows, "period", DRIFT_COLUMNS), 6, *_STATS)


@query(
    "align_train_recent",
    using(
        "split2",
        f"select feature, {_round_sql(_SIDES)} from aligned",
        **_through("aligned"),
    ),
)
def align_train_recent(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    summary = drift.numeric_summary(rows, "period", DRIFT_COLUMNS)
    return rounded(drift.align_periods(summary, "period"), 6, *_SIDES)


_RATES = """select avg("default") filter (where split = 'train') as train_rate,
    avg("default") filter (where split = 'holdout') as recent_rate from split2"""


@query(
    "default_rate_drift",
    using(
        "split2",
        """select round(train_rate, 9) as train_rate, round(recent_rate, 9) as recent_rate,
        round(recent_rate - train_rate, 9) + 0 as delta from rates""",
        rates=_RATES,
    ),
)
def default_rate_drift(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    return rounded(
        drift.default_rate_drift(rows, "period"), 9, "train_rate", "recent_rate", "delta"
    )


@query(
    "psi",
    using("split2", "select feature, round(psi, 9) as psi from psi", **_through("psi")),
)
def psi(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    return rounded(drift.psi(rows, "period", DRIFT_COLUMNS), 9, "psi")


_REPORT_SQL = using(
    "split2",
    f"select feature, round(psi, 9) as psi, psi_label, {_round_sql(_SIDES)} from report",
    **_through("report"),
)


def _report(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    report = drift.drift_report(rows, "period", DRIFT_COLUMNS)
    return rounded(rounded(report, 6, *_SIDES), 9, "psi")


@query("drift_report", _REPORT_SQL)
def drift_report(spark, sf):
    return _report(spark, sf)


@query("kept_baseline", _REPORT_SQL)
def kept_baseline(spark, sf):
    """The report of the recent period from a stored baseline and the added counts of two files."""
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id").select("loan_id", "period", *DRIFT_COLUMNS)
    folder = scratch_path(spark, "drift-state")
    with cached(rows):
        fitted = baseline.fit_baseline(rows.where("period = 'train'"), DRIFT_COLUMNS)
        tables.write_table(fitted, f"{folder}/baseline")
        kept = spark.read.parquet(f"{folder}/baseline")
        for i in range(2):
            arrived = rows.where(f"period = 'recent' and loan_id % 2 = {i}")
            tables.write_table(baseline.period_counts(arrived, kept), f"{folder}/counts/file={i}")
    counts = baseline.added(spark.read.parquet(f"{folder}/counts").drop("file"))
    report = baseline.report_from_counts(kept, counts)
    report = report.select("feature", "psi", "psi_label", *_SIDES)
    return rounded(rounded(report, 6, *_SIDES), 9, "psi")


@query("write_drift_csv", _REPORT_SQL)
def write_drift_csv(spark, sf):
    report = _report(spark, sf)
    path = tables.write_drift_csv(report, scratch_path(spark, "drift-csv"))
    return spark.read.schema(report.schema).csv(path, header=True)


@query("write_report", _REPORT_SQL)
def write_report(spark, sf):
    report = _report(spark, sf)
    path = tables.write_report(report, scratch_path(spark, "drift-json"))
    return spark.read.schema(report.schema).json(path)


@query(
    "period_monitor",
    using(
        "split2",
        """select metric, feature, round(value, 6) + 0 as value from (
        unpivot rates on train_rate, recent_rate, delta into name metric value value)
        cross join (select 'default' as feature) union all
        select metric, feature, round(value, 6) + 0 from (unpivot (select * exclude (psi_label)
        from report) on columns(* exclude (feature)) into name metric value value)""",
        rates=f"select *, recent_rate - train_rate as delta from ({_RATES})",
        **_through("report"),
    ),
)
def period_monitor(spark, sf):
    rows = periods(cleaned(spark, sf), "issue_d", "loan_id")
    return rounded(drift.drift_summary(rows, "period", DRIFT_COLUMNS), 6, "value")


