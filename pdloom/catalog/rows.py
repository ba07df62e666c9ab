"""Scans, sinks, projections, filters and scalar features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.catalog.base import (
    DATE,
    cleaned,
    engineered,
    part,
    query,
    split2,
    using,
    with_score,
)
from pdloom.functions import columns as C
from pdloom.operators import cleaning, features
from pdloom.plans.inputs import feature_manifest, modeling_inputs
from pdloom.session import scratch_path
from pdloom.sources import tables
from pdloom.sources.fixture import loans
from pdloom.sources.loans import read_loans_csv, read_loans_union

CLEAN_COLUMNS = (
    'loan_id, loan_amnt, annual_inc, int_rate, term, dti, grade, sub_grade, emp_length, '
    'home_ownership, issue_d, "default"'
)

# ---------------------------------------------------------------- scans and sinks


@query(
    "scan_loans_csv",
    using(
        "labelled",
        """select loan_id, loan_amnt, annual_inc, rate as int_rate, term, dti, grade, sub_grade,
        emp_length, home_ownership, issue_d, loan_status from labelled""",
    ),
)
def scan_loans_csv(spark, sf):
    path = scratch_path(spark, "raw") + ".csv"
    loans(spark, sf).write.csv(path, header=True, ignoreLeadingWhiteSpace=False)
    typed = cleaning.coerce_numeric(read_loans_csv(spark, path))
    return typed.withColumn("loan_id", F.col("loan_id").cast("long"))


@query(
    "scan_loans_union",
    using(
        "labelled",
        """select loan_id, loan_amnt, annual_inc, rate as int_rate, term, dti, grade, sub_grade,
        emp_length, home_ownership, issue_d, loan_status from (
        select * from labelled where loan_id % 2 = 0
        union all by name select * exclude (dti) from labelled where loan_id % 2 = 1)""",
    ),
)
def scan_loans_union(spark, sf):
    folder = scratch_path(spark, "loans-csv")
    raw = loans(spark, sf)
    options = {"header": True, "ignoreLeadingWhiteSpace": False}
    raw.where("loan_id % 2 = 0").write.options(**options).csv(folder)
    rest = raw.where("loan_id % 2 = 1").drop("dti")
    rest.write.mode("append").options(**options).csv(folder)
    stacked = read_loans_union(spark, folder, "part-", check=False)
    typed = cleaning.coerce_numeric(stacked)
    return typed.withColumn("loan_id", F.col("loan_id").cast("long"))


@query("write_cleaned", using("cleaned", f"select {CLEAN_COLUMNS} from cleaned"))
def write_cleaned(spark, sf):
    """Written by the job that also counts the steps; its last count is checked with the table."""
    rows, steps = cleaning.clean_loans_counted(loans(spark, sf), ["loan_id"])
    path = tables.write_table(rows, scratch_path(spark, "cleaned"))
    written, last = spark.read.parquet(path), steps().where("name = 'require_rows'").first()
    if written.count() != last["rows_after"]:
        raise RuntimeError(f"{last['rows_after']} rows counted, others written")
    return written


@query("scan_features", using("engineered", "select * from engineered"))
def scan_features(spark, sf):
    path = tables.write_table(engineered(spark, sf), scratch_path(spark, "features"))
    return tables.read_features(spark, path, date_col="issue_d")


@query(
    "feature_manifest",
    using(
        "engineered",
        """select count(*) as n_rows, cast(16 as bigint) as n_cols, 'default' as target_col,
        'issue_d' as date_col, 'loan_id' as id_cols, 'time_based' as split_strategy,
        cast(0.8 as double) as train_fraction, md5('loan_id:bigint|loan_amnt:double|'
        || 'annual_inc:double|int_rate:double|term:string|dti:double|grade:string|'
        || 'sub_grade:string|emp_length:string|home_ownership:string|issue_d:string|default:int|'
        || 'loan_to_income:double|term_months:int|grade_numeric:int|sub_grade_numeric:int')
        as schema_md5, 'loan_amnt|annual_inc|int_rate|term|dti|grade|sub_grade|emp_length|'
        || 'home_ownership|loan_to_income|term_months|grade_numeric|sub_grade_numeric'
        as first_features, md5('loan_amnt|annual_inc|int_rate|term|dti|grade|sub_grade|emp_length|home_ownership|'
        || 'loan_to_income|term_months|grade_numeric|sub_grade_numeric') as feature_list_md5
        from engineered""",
    ),
)
def manifest(spark, sf):
    return feature_manifest(engineered(spark, sf)).select(
        "n_rows", "n_cols", "target_col", "date_col", "id_cols", "split_strategy",
        "train_fraction", "schema_md5", "first_features", "feature_list_md5",
    )


# ---------------------------------------------------------------- projections


@query("normalize_columns", using("loans", "select * from loans"))
def normalize_columns(spark, sf):
    upstream = loans(spark, sf).withColumnsRenamed(
        {"loan_amnt": "loan_amount", "annual_inc": "annual_income"}
    )
    return cleaning.normalize_columns(upstream)


@query(
    "select_canonical",
    using(
        "labelled",
        """select loan_amnt, annual_inc, int_rate, term, dti, grade, sub_grade, emp_length,
        home_ownership, issue_d, "default" from labelled where "default" is not null""",
    ),
)
def select_canonical(spark, sf):
    return cleaning.select_canonical(cleaning.define_target(loans(spark, sf)))


@query(
    "coerce_numeric",
    using(
        "labelled",
        """select loan_id, loan_amnt, case when annual_inc < 0 then null else annual_inc end
        as annual_inc, rate as int_rate, case when loan_id % 10 = 3 then null else dti end as dti
        from labelled""",
    ),
)
def coerce_numeric(spark, sf):
    messy = loans(spark, sf).select(
        "loan_id",
        F.concat(F.lit(" "), F.col("loan_amnt").cast("string")).alias("loan_amnt"),
        F.when(F.col("annual_inc") < 0, F.lit(float("nan")))
        .otherwise(F.col("annual_inc"))
        .alias("annual_inc"),
        "int_rate",
        F.when(F.expr("loan_id % 10 = 3"), F.lit("about 12"))
        .otherwise(F.col("dti").cast("string"))
        .alias("dti"),
    )
    return cleaning.coerce_numeric(messy)


@query(
    "drop_date", using("engineered", "select * exclude (issue_d) from engineered")
)
def drop_date(spark, sf):
    return cleaning.drop_date(engineered(spark, sf), "issue_d")


@query(
    "drop_leakage_columns",
    using("cleaned", f"select {CLEAN_COLUMNS} from cleaned"),
)
def drop_leakage_columns(spark, sf):
    leaky = cleaned(spark, sf).withColumns(
        {
            "recoveries": F.col("loan_amnt") * F.col("default"),
            "total_pymnt": F.col("loan_amnt") * (1 - F.col("default")),
            "url": F.concat(F.lit("loan/"), F.col("loan_id").cast("string")),
        }
    )
    return cleaning.drop_leakage_columns(leaky)


@query(
    "drop_all_null_train",
    using(
        "split2",
        "select loan_id, loan_amnt, dti, split from split2 where split = 'holdout'",
    ),
)
def drop_all_null_train(spark, sf):
    split = split2(spark, sf).select(
        "loan_id",
        "loan_amnt",
        "dti",
        "split",
        F.when(F.col("split") == "holdout", F.col("dti")).alias("only_recent"),
    )
    _, (_, holdout) = cleaning.drop_all_null_train(part(split, "train"), part(split, "holdout"))
    return holdout


@query(
    "modeling_inputs",
    using(
        "engineered",
        """select annual_inc, dti, grade, home_ownership, int_rate, loan_amnt, term_months,
        "default" from engineered""",
    ),
)
def inputs(spark, sf):
    spec = {
        "target": "default",
        "numerical_cols": ["loan_amnt", "annual_inc", "int_rate", "dti"],
        "categorical_cols": ["grade", "home_ownership"],
        "datetime_cols": ["issue_d"],
        "engineered_cols": ["term_months"],
    }
    return modeling_inputs(engineered(spark, sf), spec)


# ---------------------------------------------------------------- filters


@query("drop_empty_rows", using("loans", "select * from loans"))
def drop_empty_rows(spark, sf):
    raw = loans(spark, sf)
    blank = raw.where("loan_id % 50 = 0").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema]
    )
    return cleaning.drop_empty_rows(raw.unionByName(blank))


@query(
    "define_target",
    using("labelled", 'select loan_id, loan_status, "default" from labelled '
          'where "default" is not null'),
)
def define_target(spark, sf):
    return cleaning.define_target(loans(spark, sf).select("loan_id", "loan_status"))


@query(
    "target_if_missing",
    using("labelled", 'select loan_id, loan_status, "default" from labelled '
          'where "default" is not null'),
)
def target_if_missing(spark, sf):
    return cleaning.target_if_missing(loans(spark, sf).select("loan_id", "loan_status"))


@query(
    "status_lookup",
    using("labelled", 'select loan_id, loan_status, "default" from labelled '
          'where "default" is not null'),
)
def status_lookup(spark, sf):
    joined = cleaning.status_lookup(loans(spark, sf).select("loan_id", "loan_status"))
    return joined.select("loan_id", "loan_status", "default")


@query(
    "drop_missing_critical",
    using(
        "labelled",
        """select loan_id, loan_amnt, annual_inc, rate as int_rate, term, issue_d, "default"
        from labelled where loan_id % 7 <> 0 and loan_id % 9 <> 4 and "default" is not null""",
    ),
)
def drop_missing_critical(spark, sf):
    labelled = cleaning.coerce_numeric(cleaning.define_target(loans(spark, sf)))
    holes = labelled.select(
        "loan_id",
        "loan_amnt",
        F.when(F.expr("loan_id % 9 = 4"), F.lit(float("nan")))
        .otherwise(F.col("annual_inc"))
        .alias("annual_inc"),
        "int_rate",
        F.when(F.expr("loan_id % 7 <> 0"), F.col("term")).alias("term"),
        "issue_d",
        "default",
    )
    return cleaning.drop_missing_critical(holes)


@query(
    "filter_impossible",
    using(
        "labelled",
        """select loan_id, loan_amnt, annual_inc, rate as int_rate, dti from labelled
        where loan_amnt > 0 and annual_inc > 0 and rate > 0 and rate <= 100
        and dti >= 0 and dti <= 100""",
    ),
)
def filter_impossible(spark, sf):
    numbers = cleaning.coerce_numeric(
        loans(spark, sf).select("loan_id", "loan_amnt", "annual_inc", "int_rate", "dti")
    )
    return cleaning.filter_impossible(numbers)


@query(
    "step_row_counts",
    using(
        "labelled",
        """select * from (values
        (1, 'drop_empty_rows', 12, 12), (2, 'normalize_columns', 12, 12),
        (3, 'define_target', 12, 13), (4, 'select_canonical', 13, 11),
        (5, 'coerce_numeric', 11, 11), (6, 'drop_missing_critical', 11, 11),
        (7, 'filter_impossible', 11, 11), (8, 'require_rows', 11, 11))
        s(step, name, cols_before, cols_after),
        lateral (select case when step <= 3 then a when step <= 6 then b when step = 7 then c
        else d end as rows_before, case when step <= 2 then a when step <= 5 then b
        when step = 6 then c else d end as rows_after from counts)""",
        counts="""select count(*) as a, count("default") as b,
        count(*) filter (where "default" is not null and rate is not null) as c,
        count(*) filter (where "default" is not null and loan_amnt > 0 and annual_inc > 0
        and rate > 0 and rate <= 100 and dti >= 0 and dti <= 100) as d from labelled""",
    ),
)
def step_row_counts(spark, sf):
    return cleaning.step_row_counts(loans(spark, sf))


@query("clean_loans", using("cleaned", f"select {CLEAN_COLUMNS} from cleaned"))
def clean_loans(spark, sf):
    return cleaned(spark, sf)


@query(
    "request_constraints",
    using(
        "loans",
        """select loan_id, trim(term) as term, concat_ws(',',
        case when annual_inc <= 0 then 'annual_inc_not_positive' end,
        case when dti < 0 then 'dti_negative' end,
        case when loan_id % 5 = 0 then 'sub_grade_length' end) as reasons,
        (annual_inc > 0 and dti >= 0 and loan_id % 5 <> 0) as valid from requests""",
        requests="select loan_id, annual_inc, dti - 1 as dti, term from loans",
    ),
)
def request_constraints(spark, sf):
    requests = loans(spark, sf).withColumns(
        {
            "dti": F.col("dti") - 1,
            "sub_grade": F.when(F.expr("loan_id % 5 = 0"), F.lit("A")).otherwise(
                F.col("sub_grade")
            ),
        }
    )
    checked = cleaning.request_constraints(requests)
    return checked.select(
        "loan_id", "term", F.concat_ws(",", "reject_reasons").alias("reasons"), "valid"
    )


# ---------------------------------------------------------------- scalar features

for _name in ("loan_to_income", "term_months", "grade_numeric", "sub_grade_numeric"):

    def _feature(spark, sf, name=_name):
        return engineered(spark, sf).select("loan_id", name)

    query(_name, using("engineered", f"select loan_id, {_name} from engineered"))(_feature)


@query("domain_features", using("engineered", "select * from engineered"))
def domain_features(spark, sf):
    return engineered(spark, sf)


@query(
    "datetime_parts",
    using(
        "cleaned",
        """select loan_id, cast(year(d) as integer) as opened_year,
        cast(month(d) as integer) as opened_month, cast(quarter(d) as integer) as opened_quarter
        from (select loan_id, case when loan_id % 4 < 3 then d end as d from dates)""",
        dates=f"select loan_id, {DATE} as d from cleaned",
    ),
)
def datetime_parts(spark, sf):
    date = F.to_date("issue_d", "MMM-yyyy")
    mixed = cleaned(spark, sf).select(
        "loan_id",
        F.when(F.expr("loan_id % 4 = 0"), F.col("issue_d"))
        .when(F.expr("loan_id % 4 = 1"), F.date_format(date, "yyyy-MM-dd"))
        .when(F.expr("loan_id % 4 = 2"), F.date_format(date, "MM/dd/yyyy"))
        .otherwise(F.lit("invalid-date"))
        .alias("opened"),
    )
    return features.datetime_parts(mixed, "opened", drop_raw=True)


@query(
    "months_since",
    using(
        "cleaned",
        f"""select loan_id, cast((2002 - year(d)) * 12 + (3 - month(d)) as integer)
        as months_since from (select loan_id, {DATE} as d from cleaned)""",
    ),
)
def months_since(spark, sf):
    aged = features.months_since(cleaned(spark, sf), "issue_d", dt.date(2002, 3, 15))
    return aged.select("loan_id", "months_since")


@query(
    "loan_age_months",
    using(
        "cleaned",
        """select loan_id, cast(greatest((year(r) - year(d)) * 12 + month(r) - month(d), 6)
        as integer) as loan_age_months from (select *, max(d) over () as r from dates)""",
        dates=f"select loan_id, {DATE} as d from cleaned",
    ),
)
def loan_age_months(spark, sf):
    aged = features.loan_age_months(cleaned(spark, sf), "issue_d", floor=6)
    return aged.select("loan_id", "loan_age_months")


@query(
    "numeric_log_plan",
    using(
        "loans",
        """select loan_id, annual_inc, round(ln(1 + greatest(annual_inc + 100.5, 0)), 9)
        as annual_inc__log1p from loans""",
    ),
)
def numeric_log_plan(spark, sf):
    planned = features.numeric_log_plan(loans(spark, sf), "annual_inc", "log", 100.5)
    return planned.select(
        "loan_id", "annual_inc", F.round("annual_inc__log1p", 9).alias("annual_inc__log1p")
    )


@query(
    "anchor_month",
    using(
        "cleaned",
        """select loan_id, make_date(year(d), month(d), 1) as month_anchor,
        make_date(year(d), (quarter(d) - 1) * 3 + 1, 1) as quarter_anchor from dates""",
        dates=f"select loan_id, {DATE} as d from cleaned",
    ),
)
def anchor_month(spark, sf):
    parts = features.datetime_parts(cleaned(spark, sf), "issue_d")
    monthly = features.anchor_month(parts, name="month_anchor").drop("issue_d_month")
    return features.anchor_month(monthly, name="quarter_anchor").select(
        "loan_id", "month_anchor", "quarter_anchor"
    )


@query(
    "risk_band",
    using(
        "scored",
        """select loan_id, case when prob < 0.10 then 'Low' when prob < 0.25 then 'Medium'
        else 'High' end as risk_band from scored""",
    ),
)
def risk_band(spark, sf):
    rows = with_score(cleaned(spark, sf))
    return rows.select("loan_id", C.risk_band(F.col("prob")).alias("risk_band"))


@query(
    "normalize_term",
    using(
        "loans",
        """select loan_id, case when loan_id % 2 = 0 then trim(term) else
        regexp_extract(term, '([0-9]+)', 1) || ' months' end as term from loans""",
    ),
)
def normalize_term(spark, sf):
    short = F.concat(F.lit(" "), F.regexp_extract("term", r"(\d+)", 1), F.lit(" "))
    rows = loans(spark, sf).select(
        "loan_id", F.when(F.expr("loan_id % 2 = 0"), F.col("term")).otherwise(short).alias("term")
    )
    return rows.select("loan_id", C.normalize_term(F.col("term")).alias("term"))


@query(
    "predicted_label",
    using("scored", "select loan_id, cast(prob >= 0.3 as integer) as predicted from scored"),
)
def predicted_label(spark, sf):
    rows = with_score(cleaned(spark, sf))
    return rows.select("loan_id", C.predicted_label(F.col("prob"), 0.3).alias("predicted"))


@query(
    "factor_direction",
    using(
        "cleaned",
        """select loan_id, a as attribution, abs(a) as size,
        case when a > 0 then 'increased' else 'decreased' end as direction
        from (select loan_id, case when loan_id % 6 = 0 then 0 else dti - 50 end as a
        from cleaned)""",
    ),
)
def factor_direction(spark, sf):
    text = F.when(F.expr("loan_id % 6 = 0"), F.lit("n/a")).otherwise(
        (F.col("dti") - 50).cast("string")
    )
    value = F.coalesce(C.to_number(F.col("text"), T.StringType()), F.lit(0.0))
    rows = cleaned(spark, sf).select("loan_id", text.alias("text"))
    rows = rows.select("loan_id", value.alias("attribution"))
    return rows.select(
        "loan_id",
        "attribution",
        F.abs("attribution").alias("size"),
        C.factor_direction(F.col("attribution")).alias("direction"),
    )
