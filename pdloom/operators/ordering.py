"""Exact order statistics and running totals without sorting the table in one task.

Both start from a quantile sketch, a bounded summary one scan makes. Its values become
literal split points, so every later step is a plain, repeatable plan:

* order statistics: the sketch brackets each wanted rank; one more scan counts the rows
  between the brackets exactly and keeps the distinct values inside them;
* running totals: the splits cut the value range into buckets of similar size, a window
  runs inside each bucket and small per-bucket totals give the offset of the bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.functions.columns import finite, quoted
from pdloom.session import cached, shuffle_partitions, small_table

ACCURACY = 10_000
MAX_BUCKETS = 8_192
# Distinct values of a bracket that one task sorts at most; a wider bracket is narrowed first.
BRACKET_VALUES = 200_000
# Times a bracket is narrowed. A sketch works on doubles, so it can't tell apart longs that only
# differ beyond their precision, and narrowing would not end there.
NARROWED = 3


@dataclass(frozen=True)
class _Bracket:
    low: Any
    high: Any


def _merge(brackets: Sequence[_Bracket]) -> list[_Bracket]:
    """Disjoint brackets in ascending order covering the given ones."""
    merged: list[_Bracket] = []
    for item in sorted(brackets, key=lambda b: (b.low, b.high)):
        if merged and item.low <= merged[-1].high:
            merged[-1] = _Bracket(merged[-1].low, max(merged[-1].high, item.high))
        else:
            merged.append(item)
    return merged


def _segment(value: Column, brackets: Sequence[_Bracket]) -> Column:
    """Odd numbers inside the brackets, even numbers in the gaps around them."""
    expr = F.lit(2 * len(brackets))
    for i in range(len(brackets) - 1, -1, -1):
        expr = (
            F.when(value < F.lit(brackets[i].low), F.lit(2 * i))
            .when(value <= F.lit(brackets[i].high), F.lit(2 * i + 1))
            .otherwise(expr)
        )
    return F.when(value.isNotNull(), expr)


def _cut_points(brackets: Sequence[_Bracket]) -> tuple[list[float], list[int]]:
    """Ascending splits of doubles, and the segment that starts at each but the last."""
    starts = {-math.inf: 0}
    for i, b in enumerate(brackets):
        starts[float(b.low) + 0.0] = 2 * i + 1
        starts[math.nextafter(float(b.high), math.inf) + 0.0] = 2 * i + 2
    starts.pop(math.inf, None)
    return [*starts, math.inf], list(starts.values())


def _with_segments(df: DataFrame, dtype: str, plan: Mapping[str, tuple[list[_Bracket], list[int]]]) -> DataFrame:
    """Adds ``_segment<i>``, the segment of the i-th column of the plan, found once per value.

    Doubles are searched for by bisection. One expression of all comparisons of many columns is too
    long a method for the JIT compiler, and it would be evaluated again wherever it is used.
    """
    for i, (name, (brackets, _)) in enumerate(plan.items()):
        out, value = f"_segment{i}", quoted(name)
        if dtype != "double" or any(math.isnan(b.low) or math.isnan(b.high) for b in brackets):
            df = df.withColumn(out, _segment(value, brackets))
            continue
        splits, segments = _cut_points(brackets)
        # Adding zero folds the two signed zeros into one value.
        df = df.withColumn("__value", value + F.lit(0.0))
        df = with_bucket(df, "__value", splits[1:-1], out).drop("__value")
        number = F.element_at(F.array(*[F.lit(s) for s in segments]), F.col(out) + 1)
        df = df.withColumn(out, F.when(value.isNotNull(), number))
    return df


def _inside(segment: Column, value: Column, brackets: Sequence[_Bracket]) -> Column:
    """The value where it has to be told apart: inside a bracket wider than one value."""
    wide = [2 * i + 1 for i, b in enumerate(brackets) if b.low != b.high]
    return F.when(segment.isin(wide), value) if wide else F.lit(None)


def _narrowed(df: DataFrame, name: str, wide: _Bracket, local: int, rows: int) -> _Bracket:
    """A bracket inside a wide one around a rank of it, by a sketch of the rows in it."""
    value, eps = quoted(name), 2.0 / ACCURACY
    around = [min(max((local + 0.5) / rows + d, 0.0), 1.0) for d in (-eps, eps)]
    inside = df.where((value >= F.lit(wide.low)) & (value <= F.lit(wide.high)))
    return _Bracket(*inside.agg(F.percentile_approx(value, around, ACCURACY).alias("q")).first()["q"])


def _read_ranks(
    df: DataFrame,
    dtype: str,
    plan: Mapping[str, tuple[list[_Bracket], list[int]]],
    narrow_wide: bool = True,
) -> tuple[dict[str, dict[int, Any]], dict[str, list[_Bracket]]]:
    """Values at the wanted ranks, and the brackets to read next for the ranks not found.

    A rank outside its bracket asks for the gap it fell into, which surely holds it. A bracket
    of too many distinct values for one task is replaced by a narrower one and its two ends.
    """
    names = list(plan)
    parts = []
    for i, name in enumerate(names):
        brackets, value = plan[name][0], quoted(name)
        segment = F.col(f"_segment{i}")
        parts.append(
            F.struct(
                F.lit(i).alias("c"),
                segment.alias("segment"),
                _inside(segment, value, brackets).cast(dtype).alias("value"),
            )
        )
    counts = (
        _with_segments(df, dtype, plan)
        .select(F.explode(F.array(*parts)).alias("p"))
        .select("p.*")
        .where(F.col("segment").isNotNull())
        .groupBy("c", "segment", "value")
        .agg(F.count("*").alias("n"))
    )
    # Only numbers leave this function, so the counts are kept in memory, not written.
    with cached(counts):
        return _ranks_in(counts, df, plan, narrow_wide)


def _ranks_in(
    counts: DataFrame,
    df: DataFrame,
    plan: Mapping[str, tuple[list[_Bracket], list[int]]],
    narrow_wide: bool,
) -> tuple[dict[str, dict[int, Any]], dict[str, list[_Bracket]]]:
    """The result of ``_read_ranks`` from rows per column, segment and value."""
    names = list(plan)
    sizes: dict[int, dict[int, int]] = {i: {} for i in range(len(names))}
    values: dict[tuple[int, int], int] = {}
    totals = counts.groupBy("c", "segment").agg(F.sum("n").alias("n"), F.count("*").alias("values"))
    for row in totals.collect():
        sizes[row["c"]][row["segment"]] = row["n"]
        values[row["c"], row["segment"]] = row["values"]

    found: dict[str, dict[int, Any]] = {name: {} for name in names}
    missed: dict[str, list[_Bracket]] = {}
    wanted: list[tuple[int, int, int, int]] = []
    for i, name in enumerate(names):
        brackets, ranks = plan[name]
        starts, total = [], 0
        for segment in range(2 * len(brackets) + 1):
            starts.append(total)
            total += sizes[i].get(segment, 0)
        for rank in ranks:
            segment = max(s for s, start in enumerate(starts) if start <= rank and sizes[i].get(s))
            if segment % 2 == 0:
                inner = segment // 2
                missed.setdefault(name, list(brackets)).append(
                    _Bracket(brackets[inner - 1].high, brackets[inner].low)
                )
            elif brackets[segment // 2].low == brackets[segment // 2].high:
                found[name][rank] = brackets[segment // 2].low
            elif narrow_wide and values[i, segment] > BRACKET_VALUES and (
                narrow := _narrowed(
                    df, name, brackets[segment // 2], rank - starts[segment], sizes[i][segment]
                )
            ) != brackets[segment // 2]:
                wide = brackets[segment // 2]
                ends = [_Bracket(wide.low, wide.low), narrow, _Bracket(wide.high, wide.high)]
                again = missed.setdefault(name, list(brackets))
                missed[name] = [b for b in again if b != wide] + ends
            else:
                wanted.append((i, segment, rank - starts[segment], rank))
    if wanted:
        wanted_df = small_table(
            df.sparkSession, wanted, "c int, segment int, local bigint, rank bigint"
        )
        upto = Window.partitionBy("c", "segment").orderBy("value")
        hits = (
            counts.join(wanted_df.select("c", "segment").distinct(), ["c", "segment"], "left_semi")
            .withColumn("end", F.sum("n").over(upto))
            .join(wanted_df, ["c", "segment"])
            .where((F.col("local") < F.col("end")) & (F.col("local") >= F.col("end") - F.col("n")))
        )
        for row in hits.select("c", "rank", "value").collect():
            found[names[row["c"]]][row["rank"]] = row["value"]
    return found, missed


def _select(
    df: DataFrame,
    dtype: str,
    probs: Mapping[str, Sequence[float]],
    ranks_of,
    accuracy: int,
) -> dict[str, tuple[int, dict[int, Any]]]:
    """Row count and the values at ``ranks_of(name, n)`` of each column, nulls left out."""
    eps = 2.0 / accuracy
    names = list(probs)
    df = df.select(*[quoted(name).cast(dtype).alias(name) for name in names])
    aggs = []
    for i, name in enumerate(names):
        value = quoted(name)
        around = sorted({min(max(p + d, 0.0), 1.0) for p in probs[name] for d in (-eps, eps)})
        aggs += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
            F.percentile_approx(value, around, accuracy).alias(f"q{i}"),
        ]
    summary = df.agg(*aggs).first()

    result: dict[str, tuple[int, dict[int, Any]]] = {}
    plan: dict[str, tuple[list[_Bracket], list[int]]] = {}
    for i, name in enumerate(names):
        n, low, high = summary[f"n{i}"], summary[f"min{i}"], summary[f"max{i}"]
        result[name] = (n, {})
        if not n:
            continue
        around = sorted({min(max(p + d, 0.0), 1.0) for p in probs[name] for d in (-eps, eps)})
        at = dict(zip(around, summary[f"q{i}"]))
        brackets = [_Bracket(low, low), _Bracket(high, high)]
        for p in probs[name]:
            below = low if p - eps <= 0 else at[p - eps]
            above = high if p + eps >= 1 else at[p + eps]
            brackets.append(_Bracket(below, above))
        ranks = sorted(set(ranks_of(name, n)))
        plan[name] = (_merge(brackets), ranks)
    step = 0
    while plan:
        found, missed = _read_ranks(df, dtype, plan, step < NARROWED)
        step += 1
        for name, values in found.items():
            result[name][1].update(values)
        plan = {
            name: (_merge(again), [r for r in plan[name][1] if r not in result[name][1]])
            for name, again in missed.items()
        }
    return result


def exact_percentiles(
    df: DataFrame,
    probs: Mapping[str, Sequence[float]],
    accuracy: int = ACCURACY,
) -> dict[str, list[float] | None]:
    """Percentiles with linear interpolation, exact at any size; None for an empty column.

    Nulls, NaN and infinities are left out. What reaches the driver is one number per
    column and probability.
    """
    df = df.select(*[finite(quoted(c).cast("double")).alias(c) for c in probs])

    def ranks_of(name: str, n: int) -> list[int]:
        spots = [(n - 1) * p for p in probs[name]]
        return [r for s in spots for r in (math.floor(s), math.ceil(s))]

    chosen = _select(df, "double", probs, ranks_of, accuracy)
    result: dict[str, list[float] | None] = {}
    for name, (n, values) in chosen.items():
        if not n:
            result[name] = None
            continue
        out = []
        for p in probs[name]:
            spot = (n - 1) * p
            low, high = values[math.floor(spot)], values[math.ceil(spot)]
            t = spot - math.floor(spot)
            # Interpolate from the nearer end, which keeps equal ends exact.
            step = high - low
            out.append(low + step * t if t < 0.5 else high - step * (1 - t))
        result[name] = out
    return result


def kth_smallest(
    df: DataFrame,
    wanted: Mapping[str, tuple[int, int]],
    dtype: str,
    accuracy: int = ACCURACY,
) -> dict[str, Any]:
    """Exact value at a zero-based rank: ``{column: (rank, non-null rows)}``."""
    probs = {name: [(rank + 0.5) / n] for name, (rank, n) in wanted.items()}
    chosen = _select(df, dtype, probs, lambda name, n: [wanted[name][0]], accuracy)
    return {name: values[wanted[name][0]] for name, (_, values) in chosen.items()}


def split_points(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Ascending cut values that divide the rows into about equal buckets."""
    buckets = buckets or min(max(4 * shuffle_partitions(df.sparkSession), 32), MAX_BUCKETS)
    probs = [i / buckets for i in range(1, buckets)]
    value = finite(quoted(column).cast("double"))
    points = df.agg(F.percentile_approx(value, probs, 10 * buckets).alias("q")).first()["q"]
    return sorted(set(points or []))


def with_bins(df: DataFrame, cuts: Mapping[str, Sequence[float]], outside: int = -1) -> DataFrame:
    """Adds ``_bin<i>``: the number of inner cuts of the i-th column at or below its value, ``outside``
    beyond the ends or where there are fewer than three cuts, null for a null."""
    for i, (name, points) in enumerate(cuts.items()):
        value, out = quoted(name), f"_bin{i}"
        beyond = F.when(value.isNotNull(), F.lit(outside))
        if len(points) <= 2:
            df = df.withColumn(out, beyond)
            continue
        df = with_bucket(df.withColumn("__value", value + F.lit(0.0)), "__value", points[1:-1], out).drop("__value")
        in_range = (value >= F.lit(points[0])) & (value <= F.lit(points[-1]))
        df = df.withColumn(out, F.when(in_range, F.col(out)).otherwise(beyond))
    return df


def with_bucket(df: DataFrame, column: str, points: Sequence[float], name: str) -> DataFrame:
    """Bucket number of a value; equal values share a bucket and buckets keep the order."""
    splits = [-math.inf, *(points or [0.0]), math.inf]
    cutter = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep")
    return cutter.transform(df).withColumn(name, F.col(name).cast("int"))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    points: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per group and order value: each sum, its total over the values before
    (``<sum>_below``) and over the group (``<sum>_total``).

    Rows are summed per value before they move, and each window runs inside one bucket. The
    bucket offsets are added up from the same sums, whose shuffle is read again: the rows are
    computed once, however costly they are.
    """
    keys = [*by, "_bucket"]
    rows = with_bucket(df.select(*by, order, *sums).where(quoted(order).isNotNull()), order, points, "_bucket")
    # A bucket that can't be null: the join then filters neither side, and both read one shuffle.
    rows = rows.withColumn("_bucket", F.coalesce("_bucket", F.lit(-1)))
    added = [F.sum(s).alias(s) for s in sums]
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*by)
    counts = rows.groupBy(*keys, order).agg(*added)
    offsets = (
        counts.groupBy(*keys)
        .agg(*added)
        .select(
            *keys,
            *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_{s}_offset") for s in sums],
            *[F.sum(s).over(group).alias(f"{s}_total") for s in sums],
        )
    )
    inner = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.join(offsets, keys)
        .withColumns(
            {
                f"{s}_below": F.col(f"_{s}_offset") + F.coalesce(F.sum(s).over(inner), F.lit(0))
                for s in sums
            }
        )
        .drop("_bucket", *[f"_{s}_offset" for s in sums])
    )
