"""Categories as positions of a sparse vector, any number of them.

Categories are counted map-side, numbered by a range-partitioned sort and kept as a table of
(feature, category, position). Rows get their position by a join, broadcast only after a check of
its size, and the vector is assembled from positions: no column, expression or driver memory per
category. Named 0/1 columns can be asked for as well; there are as many of them as categories.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import OneHotEncoder as PositionEncoder
from pyspark.ml.feature import OneHotEncoderModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.functions.columns import is_missing, quoted
from pdloom.operators.lookup import is_small, key_bytes, lookup_join
from pdloom.session import materialize, small_table

#: Up to so many categories, all columns together, the table is kept as a local relation.
LOCAL_CATEGORIES = 5_000
ESCAPE = "="
_TABLE = "feature string, category string, n bigint, position bigint"


def category_text(df: DataFrame, column: str) -> Column:
    """Category as text; NaN counts as missing."""
    value = quoted(column)
    return F.when(~is_missing(value, df.schema[column].dataType), value.cast("string"))


def category_counts(
    df: DataFrame, columns: Sequence[str], target: str | None = None, fold: Column | None = None
) -> DataFrame:
    """Rows (and positives) per feature, category and fold, all columns in one pass."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), category_text(df, c).alias("category"))
            for c in columns
        ]
    )
    extra = {}
    if target is not None:
        extra["_y"] = quoted(target).cast("double")
    if fold is not None:
        extra["fold"] = fold
    rows = df.select(F.explode(pairs).alias("p"), *[v.alias(k) for k, v in extra.items()])
    keys = ["feature", "category", *(["fold"] if fold is not None else [])]
    aggs = [F.count("*").alias("n")]
    if target is not None:
        aggs.append(F.sum("_y").alias("positives"))
    return rows.select("p.*", *extra).groupBy(*keys).agg(*aggs)


def numbered(df: DataFrame, order: Sequence[Column | str], output: str) -> DataFrame:
    """Adds the zero-based rank of each row in a total order.

    The rows are range-partitioned and kept; a window numbers each part, and the sizes of the parts
    before it, one number per part, are added.
    """
    parts = materialize(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(output, F.col("_offset") + F.row_number().over(inside) - 1)
        .drop("_part", "_offset")
    )


@dataclass(frozen=True)
class CategoryPositions:
    """Fitted table of (feature, category, n, position). The positions of a feature count from zero
    in the order of its categories, null being the last; ``sizes`` holds their number."""

    table: DataFrame
    sizes: Mapping[str, int]
    small: Mapping[str, bool]

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("feature") == column)

    def categories(self, column: str) -> list[str | None]:
        """All categories on the driver, for callers that want a column for each."""
        rows = self.of(column).select("category", "position").collect()
        return [r["category"] for r in sorted(rows, key=lambda r: r["position"])]

    def index(self, df: DataFrame, column: str, value: Column, output: str) -> DataFrame:
        """Adds the position of ``value`` as a double; the size of the feature for unknown ones."""
        joined = lookup_join(
            df.withColumn("_category", value),
            self.of(column).select(F.col("category").alias("_category"), F.col("position").alias("_position")),
            ["_category"],
            ["_position"],
            small=self.small[column],
            match_null=True,
        )
        unknown = F.lit(float(self.sizes[column]))
        place = F.coalesce(F.col("_position").cast("double"), unknown)
        return joined.withColumn(output, place).drop("_category", "_position")


def fit_positions(
    train: DataFrame, columns: Sequence[str], with_null: bool = True
) -> CategoryPositions:
    """Positions of the categories of each column, from one pass over the rows.

    Null gets a position where the column holds one and ``with_null`` is set.
    """
    counts = category_counts(train, columns)
    if not with_null:
        counts = counts.where("category is not null")
    few = counts.limit(LOCAL_CATEGORIES + 1).collect()
    if len(few) <= LOCAL_CATEGORIES:
        by_feature: dict[str, list[tuple[bool, str, int]]] = {c: [] for c in columns}
        for row in few:
            missing = row["category"] is None
            by_feature[row["feature"]].append((missing, row["category"] or "", row["n"]))
        rows = [
            (feature, None if missing else category, n, position)
            for feature, held in by_feature.items()
            for position, (missing, category, n) in enumerate(sorted(held))
        ]
        table = small_table(train.sparkSession, rows, _TABLE)
        sizes = {feature: len(held) for feature, held in by_feature.items()}
        return CategoryPositions(table, sizes, {c: True for c in columns})
    kept = materialize(counts)
    ranked = numbered(kept, ["feature", F.col("category").isNull(), "category"], "_rank")
    firsts = kept.groupBy("feature").agg(F.count("*").alias("k"), key_bytes("category").alias("bytes"))
    found = {row["feature"]: row for row in firsts.collect()}
    sizes = {c: found[c]["k"] if c in found else 0 for c in columns}
    start, at = {}, 0
    for column in sorted(found):
        start[column], at = at, at + found[column]["k"]
    first = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])
    table = materialize(
        ranked.select("feature", "category", "n", (F.col("_rank") - first[F.col("feature")]).alias("position"))
    )
    small = {c: c not in found or is_small(found[c]["k"], found[c]["bytes"]) for c in columns}
    return CategoryPositions(table, sizes, small)


def load_positions(table: DataFrame, columns: Sequence[str]) -> CategoryPositions:
    """Positions from a stored table."""
    sized = table.groupBy("feature").agg(F.count("*").alias("k"), key_bytes("category").alias("bytes"))
    found = {row["feature"]: row for row in sized.collect()}
    sizes = {c: found[c]["k"] if c in found else 0 for c in columns}
    small = {c: c not in found or is_small(found[c]["k"], found[c]["bytes"]) for c in columns}
    return CategoryPositions(table, sizes, small)


def output_names(
    column: str,
    categories: Sequence[str | None],
    null_token: str,
    others: Sequence[str] = (),
    taken: Sequence[str] = (),
) -> list[str]:
    """One name ``<column>_<category>`` per category, no two alike.

    A category is marked with an escape where its plain name could be another one's: the text of the
    null token, texts that start with the escape, names in ``taken`` and texts that begin like
    the names of an encoded column in ``others`` (``a`` with ``b_c`` next to ``a_b`` with ``c``).
    """
    head = f"{column}_"
    starts = tuple(f"{o[len(head):]}_" for o in others if o.startswith(head))
    taken_here = {t[len(head):] for t in taken if t.startswith(head)}

    def told(category: str | None) -> str:
        if category is None:
            return null_token
        clash = category == null_token or category.startswith((ESCAPE, *starts)) or category in taken_here
        return ESCAPE + category if clash else category

    return [head + told(c) for c in categories]


@dataclass(frozen=True)
class VectorPlan:
    """Numbers and categories as one vector, sparse where that is shorter."""

    numbers: int
    sizes: tuple[int, ...]

    @cached_property
    def _encoder(self) -> OneHotEncoderModel | None:
        wide = [i for i, size in enumerate(self.sizes) if size]
        if not wide:
            return None
        encoder = PositionEncoder(
            inputCols=[f"_index{i}" for i in wide],
            outputCols=[f"_flags{i}" for i in wide],
            handleInvalid="keep",
            dropLast=True,
        )
        from pyspark.sql import SparkSession

        schema = ", ".join(f"_index{i} double" for i in wide)
        last = [float(self.sizes[i] - 1) for i in wide]
        return encoder.fit(small_table(SparkSession.active(), [last], schema))

    def assemble(self, df: DataFrame, output: str) -> DataFrame:
        """From columns ``_number<i>`` (null becomes NaN) and ``_index<i>``; they are dropped."""
        inputs = [f"_number{i}" for i in range(self.numbers)]
        rows = df
        if self._encoder is not None:
            rows = self._encoder.transform(rows)
            inputs += self._encoder.getOutputCols()
        assembler = VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="keep")
        held = [*inputs, *[f"_index{i}" for i in range(len(self.sizes))]]
        return assembler.transform(rows).drop(*held)
