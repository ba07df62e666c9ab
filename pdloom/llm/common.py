"""Tables, stored intermediate results and distributed ranks shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pdloom.session import scratch_path, shuffle_partitions

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space as a character class and as the characters themselves.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Rows one window or one Python group should hold at most, on average.
GROUP_ROWS = 5_000
#: A table is broadcast only after its rows were counted and found to be at most so many.
BROADCAST_ROWS = 500_000
#: Spark's limit on the bytes of an Arrow batch, and the one set where the session names none.
ARROW_LIMIT, ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small from now on, unless it sets a limit of its own.

    An executor's JVM holds a batch in buffers that double as it is filled, the Python worker as bytes
    and as objects. By default it has 10,000 rows or 64 MB, so long texts fill the memory of both.
    """
    if spark.conf.get(ARROW_LIMIT, None) is None:
        spark.conf.set(ARROW_LIMIT, str(ARROW_BYTES))


def giving_back(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The work; what Arrow held is given back at the end, as the worker stays for later tasks."""

    def run(batches: Batches) -> Batches:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return run


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty table as a local relation; one made of a list starts Python workers of its own."""
    fields = T.StructType.fromDDL(schema)
    return spark.createDataFrame(to_arrow_schema(fields).empty_table(), fields)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, computed once and kept as Parquet in the shared folder.

    Cuts the lineage: a lost executor costs at most the tasks that read the files again.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of stored tables that no result reads any more."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def counted_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint where the counted rows are within the bound, else a plain join side."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def tasks_for(spark: SparkSession, rows: int, each: int = GROUP_ROWS) -> int:
    """Number of partitions that keeps ``each`` rows in one, the session's number at least."""
    return max(shuffle_partitions(spark), -(-rows // each))


def with_running_total(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the group that come before, in order.

    ``bucket`` is a column that does not decrease along the order and keeps a window small:
    totals per bucket give the offset of a bucket, and the rows are only sorted within theirs.
    """
    rows = df.withColumn("_value", value)
    totals = rows.groupBy(*group, bucket).agg(F.sum("_value").alias("_total"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    inner = (
        Window.partitionBy(*group, bucket)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = rows.join(offsets, [*same, F.col(bucket) == F.col("_bucket")])
    return joined.withColumn(
        name, F.col("_offset") + F.coalesce(F.sum("_value").over(inner), F.lit(0))
    ).drop("_value", "_bucket", "_offset", *[f"_g{i}" for i in range(len(group))])
