"""Mixing sources to target weights by weighted sampling keys (operator 8), Spark SQL only.

Each source has a target number of words. It gets as many complete epochs as fit, and the rest
from one more, partial epoch: documents of the source in the order of the sampling keys of
Efraimidis and Spirakis, an exponential variable divided by the document's quality weight, until
the words are reached. Sums before a document are found per bucket of keys, so a source of any
size is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.llm.common import (
    GROUP_ROWS,
    SPACE_CLASS,
    SPACES,
    counted_broadcast,
    free_name,
    stored,
    with_running_total,
)

MAX_EPOCHS = 3
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
SEED = 17
#: Characters that prose seldom holds; their share lowers a document's quality weight.
SYMBOLS = "!#$%&*+/<=>@[]^_`{|}~"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    counted = F.size(F.split(trimmed, SPACE_CLASS))
    return F.when(text.isNull() | (trimmed == ""), F.lit(0)).otherwise(counted).cast("bigint")


def symbol_weight(text: Column) -> Column:
    """Quality weight between 0.05 and 1: falls with the share of symbols; 1 without a text."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    share = symbols / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 4 * share), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source (null one included): source_size, n_docs and target.

    All words are shared by weight; a source takes at most ``max_epochs`` times its words and
    what it can't take goes to the others by weight. Sources in the order of cap to weight: one
    is capped if its cap is below its share of what the ones before it leave. The windows have a
    row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    options = F.array(*[F.lit(w).cast("bigint") for w in weights])
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(options, F.col("place") % len(weights) + 1))
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("left", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(rest))
        .withColumn("capped", F.col("cap") * F.col("weight_left") <= F.col("weight") * F.col("left"))
        .withColumn("free_words", F.col("all_words") - F.coalesce(_sum_if("capped", "cap"), F.lit(0)))
        .withColumn("free_weight", _sum_if("not capped", "weight"))
    )
    shared = (F.col("weight") * F.col("free_words")).cast("double") / F.col("free_weight")
    return totals.select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared).alias("target"),
    )


def _sum_if(condition: str, column: str) -> Column:
    return F.sum(F.when(F.expr(condition), F.col(column))).over(Window.partitionBy())


def weight_bins(sizes: DataFrame) -> DataFrame:
    """Per source the quality weights in bins of a fourth of a doubling: their mean and share of rows."""
    step = F.round(F.log2("quality") * 4)
    counted = sizes.groupBy("source", step.alias("bin")).agg(
        F.avg("quality").alias("w"), F.count("*").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("source"))
    shares = counted.select("source", F.struct("w", (F.col("n") / total).alias("share")).alias("b"))
    return shares.groupBy("source").agg(F.sort_array(F.collect_list("b")).alias("bins"))


def key_share(key: Column, bins: Column) -> Column:
    """Share of a source's rows with a smaller sampling key: each key is exponential with the row's
    weight. It rises with the key and is spread evenly from 0 to 1, whatever the weights."""
    return F.aggregate(
        bins, F.lit(0.0), lambda total, b: total + b["share"] * (1 - F.exp(-b["w"] * key))
    )


def sampling_key(weight: Column, seed: int = SEED) -> Column:
    """Exponential variable from a hash of doc_id and text, divided by the weight."""
    # 53 random bits, moved off zero so that the logarithm is finite.
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    uniform = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(uniform) / F.coalesce(weight, F.lit(1.0))


def mix_sources(
    docs: DataFrame,
    weight: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs`` with doc_id, source, size,
    source_size, target, sampling_key, epochs (times it is taken) and taken (words).

    ``docs`` has doc_id, text and source; other columns are ignored. The last document of the
    partial epoch is taken where that ends nearer to the target than leaving it out. The key
    comes from a hash of doc_id, so reruns agree; rows with one doc_id differ by a hash of the
    text, and repeated rows have one key and follow each other in any order. Null or empty texts
    have no words and are taken as often as their source has complete epochs. A null source is a
    source of its own, an empty table gives no row. ``weight`` is a positive quality weight per
    row (default: ``symbol_weight``); null counts as 1.
    """
    weight = symbol_weight(F.col("text")) if weight is None else weight
    sizes = stored(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            sampling_key(weight, seed).alias("sampling_key"),
            F.coalesce(weight, F.lit(1.0)).cast("double").alias("quality"),
        ),
        "mix-sizes",
    )
    binned = weight_bins(sizes).withColumnRenamed("source", "_binned")
    targets = source_targets(sizes, weights, max_epochs)
    targets = targets.join(binned, F.col("source").eqNullSafe(F.col("_binned"))).drop("_binned")
    buckets = F.ceil(F.col("n_docs") / GROUP_ROWS)
    share = key_share(F.col("sampling_key"), F.col("bins"))
    spread = F.least(F.floor(share * buckets), buckets - 1)
    joined = sizes.join(
        F.broadcast(targets.withColumnRenamed("source", "_source"))
        if targets.count() <= 10_000
        else targets.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    placed = with_running_total(
        joined.withColumn("_spread", spread).drop("bins", "quality"),
        ["source"],
        "_spread",
        ["sampling_key", "doc_id", "size"],
        F.col("size"),
        "_before",
    )
    full = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))
    wanted = F.col("target") - full * F.col("source_size")
    extra = (F.col("size") > 0) & (2 * (wanted - F.col("_before")) >= F.col("size"))
    epochs = (full + F.when(extra, 1).otherwise(0)).cast("bigint")
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "sampling_key",
        F.least(epochs, F.lit(max_epochs)).alias("epochs"),
    ).withColumn("taken", F.col("epochs") * F.col("size"))


def taken_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the columns of ``docs``.

    Repeated rows have one sampling key and are each taken as often as the first of them.
    """
    epochs = mix_sources(docs).where("epochs > 0").groupBy("doc_id", "sampling_key").agg(
        F.max("epochs").alias("_epochs")
    )
    id_, key_, times_, time_ = (free_name(docs, n) for n in ("_id", "_key", "_times", "_time"))
    keys = epochs.select(
        F.col("doc_id").alias(id_), F.col("sampling_key").alias(key_), F.col("_epochs").alias(times_)
    )
    key = sampling_key(symbol_weight(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (key == F.col(key_))
    joined = docs.join(counted_broadcast(keys, keys.count()), same)
    times = F.explode(F.sequence(F.lit(1), F.col(times_).cast("int"))).alias(time_)
    return joined.select(*[docs[c] for c in docs.columns], times).drop(time_)
