"""Raw loan CSV files."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.constants import CSV_MISSING
from pdloom.functions.columns import quoted


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> list[str]:
    """Paths of the files at or directly below ``path``, sorted; contents are not read."""
    reader = spark.read.format("binaryFile")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        rows = reader.load(path).select("path").collect()
    except AnalysisException as error:
        raise FileNotFoundError(f"no such file or folder: {path}") from error
    return sorted(row["path"] for row in rows)


def _base(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _scan(spark: SparkSession, paths: list[str], multi_line: bool) -> DataFrame:
    """All columns as text, in one scan; texts that stand for missing become null."""
    raw = spark.read.csv(
        paths,
        header=True,
        quote='"',
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
        enforceSchema=False,
    )
    return raw.select(
        *[F.when(~quoted(c).isin(CSV_MISSING), quoted(c)).alias(c) for c in raw.columns]
    )


def read_loans_csv(
    spark: SparkSession, path: str, multi_line: bool = False, check: bool = True
) -> DataFrame:
    """One CSV file as text columns; casts belong to cleaning.

    A folder is refused, unless it is a ``.csv`` Spark wrote as part files. ``multi_line`` reads quoted line breaks, at the price of one task per file.
    """
    files = list_files(spark, path)
    one_file = len(files) == 1 and _base(files[0]) == _base(path)
    written = bool(files) and all(_base(f).startswith("part-") for f in files)
    if not (one_file or written):
        raise RuntimeError(f"expected a file: {path}")
    if not path.lower().endswith(".csv"):
        raise RuntimeError(f"expected a .csv file: {path}")
    df = _scan(spark, files, multi_line)
    if check and (not df.columns or df.isEmpty()):
        raise RuntimeError(f"no rows in {path}")
    return df


def read_loans_union(
    spark: SparkSession,
    folder: str,
    contains: str = "_2007_to_2018Q4",
    multi_line: bool = False,
    check: bool = True,
    uniform: bool = False,
) -> DataFrame:
    """Every CSV file of a folder whose name holds ``contains``, stacked by column name.

    Files with the same header share one scan; finding that out opens every file once,
    which ``uniform`` (all headers are known to be equal) saves for folders of many files.
    ``check`` raises if a file has no rows.
    """
    files = list_files(spark, folder, f"*{contains}*.[cC][sS][vV]")
    if not files:
        raise RuntimeError(f"no .csv file containing {contains!r} in {folder}")
    by_header: dict[tuple[str, ...], list[str]] = {}
    if uniform:
        by_header[()] = files
    else:
        for path in files:
            header = tuple(spark.read.csv(path, header=True).columns)
            by_header.setdefault(header, []).append(path)
    parts = [_scan(spark, paths, multi_line) for paths in by_header.values()]
    if check:
        for paths in by_header.values():
            named = spark.read.csv(paths, header=True, multiLine=multi_line)
            seen = named.select(F.col("_metadata.file_name").alias("f")).distinct().collect()
            empty = {_base(p) for p in paths} - {row["f"] for row in seen}
            if empty:
                raise RuntimeError(f"no rows in {sorted(empty)}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
