"""Session settings and the shared folder intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(app: str = "pdloom", cpus: str | int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster pass your own session instead."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; a temporary one only for a local master."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="pdloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """The table kept in memory or on disk inside the block, unless it already is."""
    if df.is_cached or df.storageLevel.useDisk or df.storageLevel.useMemory:
        yield df
        return
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def small_table(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: str) -> DataFrame:
    """A few driver-side rows as a local relation, without a Python worker."""
    fields = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], fields)
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), schema=fields)
