"""Loan table derived from the orders and customer tables, for queries and tests.

The same text runs in Spark and, with other tokens, in the SQL that checks the queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.session import scratch_path

COLUMNS = {
    "loan_id": "o_orderkey",
    "loan_amnt": "o_totalprice / 10",
    "annual_inc": "c_acctbal * 10",
    "int_rate": "concat(cast(cast((500 + (o_orderkey*37) % 2000) as double)/100 as varchar(20)), '%')",
    "term": "case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end",
    "dti": "cast((o_orderkey*7) % 1100 as double)/10",
    "grade": "substr('ABCDEFG', cast(((o_orderkey*37) % 2000) * 7 {DIV} 2000 as int) + 1, 1)",
    "sub_grade": "concat(substr('ABCDEFG', cast(((o_orderkey*37) % 2000) * 7 {DIV} 2000 as int) + 1, 1),"
    " cast(1 + o_orderkey % 5 as varchar(2)))",
    "emp_length": "case when o_orderkey % 17 = 0 then null"
    " when o_orderkey % 12 = 11 then '10+ years'"
    " when o_orderkey % 12 = 0 then '< 1 year'"
    " else concat(cast(o_orderkey % 12 as varchar(3)), ' years') end",
    "home_ownership": "c_mktsegment",
    "issue_d": "{MON}",
    "loan_status": "case when (o_orderkey*13) % 100 < 8 then 'Current'"
    " when (o_orderkey*13) % 100 < 10 then 'In Grace Period'"
    " when (o_orderkey*37) % 2000 + (o_orderkey*7919) % 4000 > 3800 then"
    " case o_orderstatus when 'F' then 'Charged Off' when 'O' then 'Late (31-120 days)'"
    " else 'Late (16-30 days)' end"
    " else 'Fully Paid' end",
}


def loans_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order with the raw column types of a loan file."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    tokens = {"{DIV}": "div", "{MON}": "date_format(o_orderdate,'MMM-yyyy')"}
    exprs = []
    for name, text in COLUMNS.items():
        for token, value in tokens.items():
            text = text.replace(token, value)
        exprs.append(F.expr(text).alias(name))
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(*exprs)


_STORED: dict[tuple, tuple[str, object]] = {}


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan table as a stored file, written below the shared folder at first use.

    Queries then start where a raw loan file would: columns are pruned and filters pushed
    at the scan, instead of every filter repeating the expressions of the view. A changed
    input table (file name, size or time) is written anew.
    """
    inputs = [f"{sf_dir}/{name}.parquet" for name in ("orders", "customer")]
    listed = spark.read.format("binaryFile").load(inputs)
    rows = listed.select("path", "length", "modificationTime").collect()
    files = sorted(tuple(row) for row in rows)
    key = (spark.sparkContext.applicationId, *files)
    if key not in _STORED:
        view, path = loans_view(spark, sf_dir), scratch_path(spark, "loans")
        cores = spark.sparkContext.defaultParallelism
        if view.rdd.getNumPartitions() < cores:
            # One small input file is one task; spread it over the cores once.
            view = view.repartition(cores)
        view.write.parquet(path)
        _STORED[key] = (path, view.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def loans_sql() -> str:
    """The same table as a DuckDB query."""
    tokens = {"{DIV}": "//", "{MON}": "strftime(o_orderdate,'%b-%Y')"}
    parts = []
    for name, text in COLUMNS.items():
        for token, value in tokens.items():
            text = text.replace(token, value)
        parts.append(f"{text} as {name}")
    return f"select {', '.join(parts)} from orders join customer on o_custkey = c_custkey"
