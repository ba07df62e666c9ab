"""Category encoders: fitted on the training rows, applied to any rows.

A fitted state is a small table computed once (checkpointed). Rows are counted per
category before anything is shuffled, so a category holding a third of the rows costs one
row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.constants import (
    MISSING_TOKEN,
    NULL_CATEGORY,
    ONE_HOT_MAX,
    RARE_MIN_COUNT,
    RARE_MIN_FRACTION,
    RARE_TOKEN,
    TARGET,
    TARGET_MEAN_MAX,
)
from pdloom.functions.columns import quoted
from pdloom.operators.lookup import fits_broadcast, is_small, key_bytes, lookup_join
from pdloom.operators.positions import (
    CategoryPositions,
    VectorPlan,
    category_counts,
    category_text,
    fit_positions,
    output_names,
)
from pdloom.session import materialize


def fold_of(id_col: str, folds: int) -> Column:
    """Fold of a row from a hash of its id, so that any run gives the same folds."""
    return F.pmod(F.xxhash64(quoted(id_col)), F.lit(folds)).cast("int")


@dataclass(frozen=True)
class LookupEncoder:
    """Category to value table of one column, with the value for unknown categories."""

    column: str
    output: str
    table: DataFrame
    prior: float
    total: int
    match_null: bool
    small: bool

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``output``; categories the table lacks get the prior."""
        keyed = df.withColumn("category", category_text(df, self.column))
        joined = lookup_join(
            keyed,
            self.table,
            ["category"],
            ["_value"],
            small=self.small,
            match_null=self.match_null,
        )
        value = F.coalesce(F.col("_value"), F.lit(self.prior))
        return joined.withColumn(self.output, value).drop("category", "_value")


def fit_lookup_encoders(
    train: DataFrame,
    frequency: Sequence[str] = (),
    target_mean: Sequence[str] = (),
    target: str = TARGET,
) -> dict[str, LookupEncoder]:
    """Frequency and target-mean encoders of many columns from one pass over the rows.

    Frequency: share of rows per category, null being one; unknown gets the mean share.
    Target mean: mean label per category; unknown and null get the overall mean.
    """
    columns = list(dict.fromkeys([*frequency, *target_mean]))
    if not columns:
        return {}
    counts = materialize(category_counts(train, columns, target if target_mean else None))
    totals = counts.groupBy("feature").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        key_bytes("category").alias("bytes"),
        *([F.sum("positives").alias("positives")] if target_mean else []),
    )
    sizes = {row["feature"]: row for row in totals.collect()}
    encoders: dict[str, LookupEncoder] = {}
    for column in columns:
        table = counts.where(F.col("feature") == column)
        size = sizes.get(column)
        small = size is None or is_small(size["k"], size["bytes"])
        total = size["n"] if size else 0
        if column in frequency:
            share = F.col("n") / F.lit(float(total or 1))
            encoders[f"{column}__freq"] = LookupEncoder(
                column,
                f"{column}__freq",
                table.select("category", "n", share.alias("_value")),
                1.0 / size["k"] if size else 0.0,
                total,
                True,
                small,
            )
        if column in target_mean:
            mean = F.col("positives") / F.col("n")
            encoders[f"{column}__target_mean"] = LookupEncoder(
                column,
                f"{column}__target_mean",
                table.select("category", "n", mean.alias("_value")),
                size["positives"] / total if size else float("nan"),
                total,
                False,
                small,
            )
    return encoders


def freq_encode(train: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """``<column>__freq`` fitted on ``train``."""
    return fit_lookup_encoders(train, frequency=[column])[f"{column}__freq"].transform(df)


def target_mean_encode(
    train: DataFrame, df: DataFrame, column: str, target: str = TARGET
) -> DataFrame:
    """``<column>__target_mean`` fitted on ``train``."""
    fitted = fit_lookup_encoders(train, target_mean=[column], target=target)
    return fitted[f"{column}__target_mean"].transform(df)


def oof_target_mean(
    df: DataFrame,
    column: str,
    id_col: str,
    target: str = TARGET,
    folds: int = 5,
    output: str | None = None,
    fold: Column | None = None,
) -> DataFrame:
    """Mean target of the category over the other folds; else the overall mean.

    One pass: totals per category and fold, minus the row's own fold. ``fold`` replaces
    the default fold, a hash of the id.
    """
    if target not in df.columns:
        raise KeyError(f"missing target column: {target}")
    output = output or f"{column}__target_mean"
    fold = fold_of(id_col, folds) if fold is None else fold
    counts = materialize(category_counts(df, [column], target, fold))
    whole = counts.agg(
        F.count("*").alias("rows"),
        key_bytes("category").alias("bytes"),
        F.sum("n").alias("n"),
        F.sum("positives").alias("positives"),
    ).first()
    prior = whole["positives"] / whole["n"] if whole["n"] else float("nan")
    category = Window.partitionBy("category")
    others = F.sum("n").over(category) - F.col("n")
    positives = F.sum("positives").over(category) - F.col("positives")
    # A fold a category has no rows in needs no entry: no row will ask for it.
    table = counts.select(
        "category", "fold", "n", F.try_divide(positives, others).alias("_value")
    )
    keyed = df.withColumns({"category": category_text(df, column), "fold": fold})
    joined = lookup_join(
        keyed,
        table,
        ["category", "fold"],
        ["_value"],
        small=is_small(whole["rows"], whole["bytes"]),
    )
    value = F.coalesce(F.col("_value"), F.lit(prior))
    return joined.withColumn(output, value).drop("category", "fold", "_value")


@dataclass(frozen=True)
class OneHotEncoder:
    """The categories seen in training and null, as 0/1 columns or as a sparse vector."""

    column: str
    positions: CategoryPositions
    null_column: bool = True
    others: tuple[str, ...] = ()
    taken: tuple[str, ...] = ()

    @cached_property
    def categories(self) -> tuple[str, ...]:
        return tuple(c for c in self.positions.categories(self.column) if c is not None)

    @cached_property
    def outputs(self) -> list[str]:
        """A name per category; no two categories, nor null, share one."""
        told = [*self.categories, *([None] if self.null_column else [])]
        return output_names(self.column, told, NULL_CATEGORY, self.others, self.taken)

    def expressions(self, df: DataFrame) -> dict[str, Column]:
        value = category_text(df, self.column)
        flags = [value.eqNullSafe(F.lit(c)).cast("int") for c in self.categories]
        if self.null_column:
            flags.append(value.isNull().cast("int"))
        return dict(zip(self.outputs, flags))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the columns; a category not seen in training sets none of them."""
        return df.withColumns(self.expressions(df))

    @property
    def width(self) -> int:
        """Length of the vector: the seen categories, then null."""
        return self.positions.sizes[self.column] + self.null_column

    def index(self, df: DataFrame, output: str) -> DataFrame:
        """Adds the position of a row's category, by a join; ``width`` for an unknown one."""
        value = category_text(df, self.column)
        known = self.positions.index(df, self.column, value, output)
        size = F.lit(float(self.positions.sizes[self.column]))
        # A null is no category of the table: its place is the last one.
        unknown = F.col(output) == size
        place = F.when(unknown & value.isNull() & F.lit(self.null_column), size)
        return known.withColumn(
            output, F.when(unknown, F.coalesce(place, F.lit(float(self.width)))).otherwise(F.col(output))
        )

    def vectors(self, df: DataFrame, output: str) -> DataFrame:
        """Adds one sparse vector in the order of ``outputs``, with no column per category."""
        return VectorPlan(0, (self.width,)).assemble(self.index(df, "_index0"), output)


def fit_one_hot(
    train: DataFrame, columns: Sequence[str], null_column: bool = True, taken: Sequence[str] = ()
) -> dict[str, OneHotEncoder]:
    """Encoders of the categories of each column, any number of them, from one pass.

    ``taken`` are names of other columns the outputs must differ from.
    """
    positions = fit_positions(train, columns, with_null=False)
    return {
        c: OneHotEncoder(c, positions, null_column, tuple(o for o in columns if o != c), tuple(taken))
        for c in columns
    }


def category_cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values (null being one) and null share of each column."""
    counts = category_counts(df, columns)
    nulls = F.sum(F.when(F.col("category").isNull(), F.col("n")).otherwise(F.lit(0)))
    return counts.groupBy("feature").agg(
        F.count("*").alias("cardinality"), (nulls / F.sum("n")).alias("missing_rate")
    )


def encode_strategy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``one_hot``, ``target_mean`` or ``count_frequency`` by number of distinct values."""
    k = F.col("cardinality")
    return category_cardinality(df, columns).withColumn(
        "strategy",
        F.when(k <= ONE_HOT_MAX, "one_hot")
        .when(k <= TARGET_MEAN_MAX, "target_mean")
        .otherwise("count_frequency"),
    )


def group_rare(
    train: DataFrame,
    df: DataFrame,
    column: str,
    min_count: int = RARE_MIN_COUNT,
    min_fraction: float = RARE_MIN_FRACTION,
) -> DataFrame:
    """Missing and rare (by count or share in ``train``) categories as tokens.

    Adds ``<column>__grouped``. Categories not in ``train`` count as rare.
    """
    counts = materialize(category_counts(train, [column]))
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where(
        F.col("category").isNotNull()
        & (F.col("n") >= min_count)
        & (F.col("n") >= F.lit(min_fraction * total))
    ).withColumn("_common", F.lit(True))
    joined = lookup_join(
        df.withColumn("category", category_text(df, column)),
        common,
        ["category"],
        ["_common"],
        small=fits_broadcast(common, "category"),
    )
    grouped = (
        F.when(F.col("category").isNull(), F.lit(MISSING_TOKEN))
        .when(F.col("_common"), F.col("category"))
        .otherwise(F.lit(RARE_TOKEN))
    )
    return joined.withColumn(f"{column}__grouped", grouped).drop("category", "_common")
