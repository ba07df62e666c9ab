"""Left joins against fitted tables, safe for large tables and for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.functions.columns import quoted
from pdloom.session import materialize

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_KEYS = 500
HOT_KEY_BYTES = 64 * 1024
SALTS = 1_024


def key_bytes(key: str) -> Column:
    """Aggregate: bytes all texts of a key column take."""
    return F.sum(F.coalesce(F.octet_length(quoted(key).cast("string")), F.lit(0)))


def is_small(rows: int, size: int | None) -> bool:
    """Whether a fitted table of this size may be sent to every task."""
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def fits_broadcast(table: DataFrame, key: str) -> bool:
    """``is_small`` of a table that is already computed."""
    row = table.agg(F.count("*").alias("n"), key_bytes(key).alias("bytes")).first()
    return is_small(row["n"], row["bytes"])


def _hashable(df: DataFrame) -> list[Column]:
    return [quoted(f.name) for f in df.schema if isinstance(f.dataType, T.AtomicType)]


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    *,
    small: bool,
    match_null: bool = False,
) -> DataFrame:
    """Left join of ``table`` on ``keys``; ``match_null`` lets a null key match a null key.

    A ``small`` table (see ``is_small``) goes to every task and ``df`` is not moved.
    Otherwise the keys of ``df`` are counted. The hot ones, those of at least ``1/HOT_KEYS`` of
    its rows and so at most ``HOT_KEYS``, are broadcast with their values, whether the table
    holds them or not. Their rows are spread by a salt no table row has, so that the shuffle for
    the remaining keys has no hot key.
    """
    # Null keys as a flag and a filler, so that plain equality covers them.
    parts: list[str] = []
    for i, key in enumerate(keys):
        flag, text = f"_k{i}_null", f"_k{i}"
        df = df.withColumns(
            {flag: quoted(key).isNull(), text: F.coalesce(quoted(key).cast("string"), F.lit(""))}
        )
        table = table.withColumns(
            {flag: quoted(key).isNull(), text: F.coalesce(quoted(key).cast("string"), F.lit(""))}
        )
        parts += [flag, text]
    if not match_null:
        for i in range(len(keys)):
            table = table.where(~F.col(f"_k{i}_null"))
    right = table.select(*parts, *values)
    if small:
        return df.join(F.broadcast(right), parts, "left").drop(*parts)

    narrow = F.lit(True)
    for i in range(len(keys)):
        narrow = narrow & (F.octet_length(F.col(f"_k{i}")) <= HOT_KEY_BYTES)
    met = materialize(df.groupBy(*parts).agg(F.count("*").alias("_met")))
    total = met.agg(F.sum("_met")).first()[0] or 0
    # The count bounds this table: no more than HOT_KEYS keys can have such a share.
    frequent = met.where(narrow & (F.col("_met") * HOT_KEYS >= F.lit(total))).select(*parts)
    held = right.join(F.broadcast(frequent), parts)
    hot = frequent.join(held, parts, "left").select(
        *parts, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    tail = right.withColumn("_salt", F.lit(0))
    # Rows a hot key serves, and null keys nothing can match, need not meet the tail table.
    settled = F.col("_hot").isNotNull()
    if not match_null:
        for i in range(len(keys)):
            settled = settled | F.col(f"_k{i}_null")
    # From the row itself, so that a task run again after a loss sends it to the same place.
    salt = F.pmod(F.xxhash64(*_hashable(df)), F.lit(SALTS)).cast("int") + 1
    joined = (
        df.join(F.broadcast(hot), parts, "left")
        .withColumn("_salt", F.when(settled, salt).otherwise(F.lit(0)))
        .join(tail, [*parts, "_salt"], "left")
        .withColumns(
            {v: F.when(F.col("_hot"), F.col(f"_hot_{v}")).otherwise(F.col(v)) for v in values}
        )
    )
    return joined.drop(*parts, "_salt", "_hot", *[f"_hot_{v}" for v in values])
