"""Time-ordered splits, per-row rankings and seeded samples.

A split by time needs no global sort: only the loan at each cut has to be found. Rows per
date give the date of the cut, an exact order statistic among the rows of that date gives
the id, and the split itself is a comparison that moves no rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pdloom.constants import TARGET
from pdloom.functions.columns import quoted
from pdloom.operators.features import domain_features, parsed_date
from pdloom.operators.ordering import kth_smallest
from pdloom.session import cached


@dataclass(frozen=True)
class Cut:
    """Last date and id of the rows before a cut."""

    date: dt.date
    key: Any


def _order_key(df: DataFrame, id_col: str) -> tuple[Column, str]:
    """Ids order by value when whole numbers, else by hash."""
    kind = df.schema[id_col].dataType.typeName()
    if kind in ("long", "integer", "short", "byte"):
        return quoted(id_col).cast("bigint"), "bigint"
    return F.xxhash64(quoted(id_col)), "bigint"


def time_cuts(
    df: DataFrame, date_col: str, id_col: str, sizes_of
) -> tuple[list[Cut], int]:
    """Cuts after the first ``sizes_of(n)`` rows in (date, id) order.

    Rows with the same date and id stay on one side, so the sizes are exact when ids are
    unique.
    """
    key, dtype = _order_key(df, id_col)
    rows = df.select(parsed_date(df, date_col).alias("d"), key.alias("k"))
    # Dates are read once; the cuts are looked for among the kept dates and keys.
    with cached(rows):
        return _cuts_of(rows, date_col, dtype, sizes_of)


def _cuts_of(rows: DataFrame, date_col: str, dtype: str, sizes_of) -> tuple[list[Cut], int]:
    """Cuts of dates ``d`` and keys ``k``."""
    per_date = rows.groupBy("d").agg(F.count("*").alias("n"))
    # One row per calendar day at most reaches the driver.
    days, total = [], 0
    for row in sorted(per_date.collect(), key=lambda r: r["d"] or dt.date.min):
        if row["d"] is None:
            raise ValueError(f"unreadable dates in {date_col}")
        days.append({"d": row["d"], "n": row["n"], "start": total})
        total += row["n"]
    if not days:
        raise ValueError("no rows to split")
    sizes = sizes_of(total)
    if any(s <= 0 or s >= total for s in sizes):
        raise ValueError("a side of the split would be empty")
    picked = [next(d for d in days if d["start"] + d["n"] >= size) for size in sizes]
    cuts: list[Cut | None] = [None] * len(sizes)
    wanted, names = {}, {}
    for i, (size, day) in enumerate(zip(sizes, picked)):
        wanted[f"k{i}"] = (size - day["start"] - 1, day["n"])
        names[f"k{i}"] = F.when(F.col("d") == F.lit(day["d"]), F.col("k")).alias(f"k{i}")
    at_cut = rows.where(F.col("d").isin([d["d"] for d in picked]))
    found = kth_smallest(at_cut.select(*names.values()), wanted, dtype)
    for i, day in enumerate(picked):
        cuts[i] = Cut(day["d"], found[f"k{i}"])
    return cuts, total


def label_by_cuts(
    df: DataFrame, date_col: str, id_col: str, cuts: Sequence[Cut], names: Sequence[str],
    output: str = "split",
) -> DataFrame:
    """Name of the part each row falls into, ``len(cuts) + 1`` parts in time order."""
    key, _ = _order_key(df, id_col)
    date, expr = F.col("_date"), F.lit(names[-1])
    for cut, name in reversed(list(zip(cuts, names))):
        day = F.lit(cut.date)
        before = (date < day) | ((date == day) & (key <= F.lit(cut.key)))
        expr = F.when(before, F.lit(name)).otherwise(expr)
    return df.withColumn("_date", parsed_date(df, date_col)).withColumn(output, expr).drop("_date")


def time_split(
    df: DataFrame,
    date_col: str,
    id_col: str,
    train_fraction: float = 0.8,
    names: Sequence[str] = ("train", "holdout"),
) -> DataFrame:
    """Adds ``split``: the first share of the rows in time order, and the rest."""
    if not 0.0 < train_fraction < 1.0:
        raise ValueError("train_fraction must be in (0, 1)")
    cuts, _ = time_cuts(df, date_col, id_col, lambda n: [int(n * train_fraction)])
    return label_by_cuts(df, date_col, id_col, cuts, names)


def time_split3(
    df: DataFrame,
    date_col: str,
    id_col: str,
    fractions: Sequence[float] = (0.70, 0.15, 0.15),
    names: Sequence[str] = ("train", "val", "test"),
) -> DataFrame:
    """Adds ``split`` with three parts; the fractions must sum to one."""
    if abs(sum(fractions) - 1.0) > 1e-9:
        raise ValueError("fractions must sum to 1")

    def sizes(n: int) -> list[int]:
        first = int(n * fractions[0])
        return [first, first + int(n * fractions[1])]

    cuts, _ = time_cuts(df, date_col, id_col, sizes)
    return label_by_cuts(df, date_col, id_col, cuts, names)


def prepare_split(
    df: DataFrame,
    date_col: str = "issue_d",
    id_col: str = "loan_id",
    target: str = TARGET,
    train_fraction: float = 0.8,
    strategy: str = "time_based",
) -> DataFrame:
    """Split, add the domain features and drop the date, ready for a model."""
    if strategy != "time_based":
        raise ValueError(f"unsupported split strategy: {strategy}")
    for name in (target, date_col):
        if name not in df.columns:
            raise KeyError(f"missing column: {name}")
    split = time_split(df, date_col, id_col, train_fraction)
    return domain_features(split).drop(date_col)


def split_meta(
    df: DataFrame, anchor: str, target: str = TARGET, split: str = "split"
) -> DataFrame:
    """Rows, first and last anchor and default rate per split."""
    return df.groupBy(split).agg(
        F.count("*").alias("n"),
        F.min(anchor).alias("anchor_min"),
        F.max(anchor).alias("anchor_max"),
        F.avg(quoted(target).cast("double")).alias("default_rate"),
    )


def temporal_overlap(
    meta: DataFrame, order: Sequence[str] = ("train", "val", "test"), split: str = "split"
) -> DataFrame:
    """Per pair of neighbouring splits, whether the earlier one reaches past the later one."""
    ends = meta.agg(
        *[F.max(F.when(F.col(split) == s, F.col("anchor_max"))).alias(f"max_{s}") for s in order],
        *[F.min(F.when(F.col(split) == s, F.col("anchor_min"))).alias(f"min_{s}") for s in order],
    )
    pairs = [
        F.struct(
            F.lit(a).alias("earlier"),
            F.lit(b).alias("later"),
            F.col(f"max_{a}").alias("earlier_max"),
            F.col(f"min_{b}").alias("later_min"),
            (F.col(f"max_{a}") > F.col(f"min_{b}")).alias("overlaps"),
        )
        for a, b in zip(order, order[1:])
    ]
    return ends.select(F.inline(F.array(*pairs)))


def require_no_overlap(meta: DataFrame, order: Sequence[str] = ("train", "val", "test")) -> None:
    bad = temporal_overlap(meta, order).where("overlaps").collect()
    if bad:
        raise ValueError(f"temporal leakage: {[(r['earlier'], r['later']) for r in bad]}")


def sample_rows(df: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed; all rows if fewer.

    Rows are ordered by a hash of the id; the n-th hash is found by rank, and a filter keeps the rows
    below it in place. Only rows with that very hash are sorted.
    """
    key = F.md5(F.concat(F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))
    # 52 bits of the hash, so that a double holds it.
    rows = df.withColumn("_h", F.conv(F.substring(key, 1, 13), 16, 10).cast("bigint"))
    total = df.count()
    if n >= total:
        return df
    if n <= 0:
        return df.limit(0)
    edge = kth_smallest(rows.select("_h"), {"_h": (n - 1, total)}, "bigint")["_h"]
    below = rows.where(F.col("_h") < edge)
    ties = rows.where(F.col("_h") == edge).orderBy(key, id_col).limit(n - below.count())
    return below.unionByName(ties).drop("_h")
