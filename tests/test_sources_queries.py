import os

import duckdb
import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as entry_points
from pdloom.operators.cleaning import EmptyResultError
from pdloom.plans.jobs import preprocess_job
from pdloom.session import small_table
from pdloom.sources import tables
from pdloom.sources.loans import read_loans_csv, read_loans_union
from tools.compare import compare, connect

# One query per family; the whole list runs with ALL_QUERIES=1 or tools/compare.py.
SAMPLE = [
    "clean_loans", "scan_loans_union", "step_row_counts", "domain_features", "datetime_parts",
    "freq_encode", "oof_target_mean", "numeric_profile", "time_split3", "psi", "evaluate_binary",
    "calibration_curve", "fit_preprocess", "top_factors", "feature_matrix", "validate_matrix",
]
NAMES = sorted(entry_points.oracle_sql()) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf) == ""


def test_registry_is_consistent():
    names = set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= names and len(names) > 80
    assert isinstance(con_version(), str)


def con_version():
    return duckdb.__version__


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 7 and {"grade", "n", "default_rate"} == set(rows[0].asDict())


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_loans_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(RuntimeError):
        read_loans_csv(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        read_loans_csv(spark, write(tmp_path / "a.txt", "x\n1\n"))
    with pytest.raises(RuntimeError):
        read_loans_csv(spark, write(tmp_path / "empty.csv", ""))
    with pytest.raises(RuntimeError):
        read_loans_csv(spark, write(tmp_path / "header.csv", "x,y\n"))


def test_csv_folder_only_if_spark_wrote_it(spark, tmp_path):
    table = small_table(spark, [("a",), ("b",)], "x string")
    table.repartition(2).write.csv(str(tmp_path / "w.csv"), header=True)
    assert read_loans_csv(spark, str(tmp_path / "w.csv")).count() == 2
    (tmp_path / "d.csv").mkdir()
    write(tmp_path / "d.csv" / "a.csv", "x\n1\n")
    with pytest.raises(RuntimeError):
        read_loans_csv(spark, str(tmp_path / "d.csv"))


def test_csv_reads_text_and_missing(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'x,y\n" 36 months",NA\nNONE,"a ""b"", c"\n')
    rows = [tuple(r) for r in read_loans_csv(spark, path).collect()]
    assert rows == [(" 36 months", None), ("NONE", 'a "b", c')]


def test_union_by_name(spark, tmp_path):
    write(tmp_path / "b_2007_to_2018Q4.csv", "x,y\n1,2\n")
    write(tmp_path / "a_2007_to_2018Q4.CSV", "y,x\n3,4\n")
    write(tmp_path / "c_2007_to_2018Q4.csv", "x,z\n5,6\n")
    write(tmp_path / "other.csv", "x\n9\n")
    got = read_loans_union(spark, str(tmp_path))
    rows = sorted((r["x"], r["y"], r["z"]) for r in got.select("x", "y", "z").na.fill("-").collect())
    assert rows == [("1", "2", "-"), ("4", "3", "-"), ("5", "-", "6")]
    write(tmp_path / "d_2007_to_2018Q4.csv", "x,y\n")
    with pytest.raises(RuntimeError):
        read_loans_union(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        read_loans_union(spark, str(tmp_path), "nothing")


def test_preprocess_job_keeps_existing_output(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(
        raw / "accepted_2007_to_2018Q4.csv",
        "loan_amnt,annual_inc,int_rate,term,dti,issue_d,loan_status\n"
        "1000,50000,7.5%, 36 months,10,Jan-2015,Fully Paid\n"
        "1000,50000,7.5%, 36 months,10,Jan-2015,Current\n",
    )
    out = str(tmp_path / "cleaned")
    preprocess_job(spark, str(raw), out)
    assert tables.read_features(spark, out, date_col="issue_d").count() == 1
    with pytest.raises(AnalysisException):
        preprocess_job(spark, str(raw), out)
    preprocess_job(spark, str(raw), out, overwrite=True)


def test_feature_table_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_features(spark, str(tmp_path / "none"))
    path = tables.write_table(small_table(spark, [(1,)], "x int"), str(tmp_path / "t"))
    with pytest.raises(KeyError):
        tables.read_features(spark, path)
    empty = tables.write_table(small_table(spark, [], "`default` int"), str(tmp_path / "e"))
    with pytest.raises(EmptyResultError):
        tables.read_features(spark, empty)
