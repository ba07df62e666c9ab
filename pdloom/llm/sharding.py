"""Sharding by balanced label propagation (operator 10).

Documents are linked through keys they share, such as the hash of an equal text. Each linked
document starts with a label from its hash. In a round, joins count the labels per key, every
document asks for the label that most of its neighbours have, and a shard lets documents in up
to its quota: those that stay first, then groups in the order of their key. Documents that don't
get in have no label for the next round, do not vote and ask for their neighbours' label again,
or, where that shard is full, for one with room that their key chooses. After the last round the
documents without links and those still without a label fill what is left of the quotas, so the
shards have as many rows as each other, at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pdloom.llm.common import GROUP_ROWS, discard, stored, with_running_total

ROUNDS = 4


def text_links(rows: DataFrame) -> DataFrame:
    """Links (row_id, key) between rows whose text is equal; a null text has none."""
    return rows.where(F.col("text_key").isNotNull()).select("row_id", F.col("text_key").alias("key"))


def _split_large(links: DataFrame, most: int) -> DataFrame:
    """Keys of at least two rows; one too large for a shard is split by a hash into parts of
    about half a shard, as some of its links must be cut in any case."""
    sizes = links.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / max(1, most // 2))
    part = F.when(F.col("n") <= most, 0).otherwise(F.pmod(F.xxhash64("row_id"), parts))
    return links.join(sizes, "key").select("row_id", F.xxhash64("key", part).alias("key"))


def _bucketed_rank(df: DataFrame, group: list[str], order: str, rows: int, name: str) -> DataFrame:
    """Rank from 0 in the group by a hash column; buckets keep each window small."""
    buckets = max(1, -(-rows // GROUP_ROWS))
    at = (F.col(order).cast("double") / float(1 << 63) + 1) / 2 * buckets
    bucket = F.least(F.floor(at), F.lit(buckets - 1))
    return with_running_total(
        df.withColumn("_spread", bucket), group, "_spread", [order, "row_id"], F.lit(1), name
    ).drop("_spread")


def balanced_shards(
    rows: DataFrame, links: DataFrame, n_shards: int, rounds: int = ROUNDS, seed: int = 5
) -> DataFrame:
    """Columns ``shard`` (from 0) and ``slot`` (from 0 without gaps in its shard) for ``rows``.

    ``rows`` is a stored table with a unique row_id; its other columns are kept. ``links`` has
    (row_id, key). Shards have equally many rows, at most one apart. Repeated rows have row ids
    of their own; an empty table gives no row. Joins with one key that many rows share are dealt
    out by the adaptive skew join; the counts before them are summed on the map side.
    """
    total = rows.count()
    most = total // n_shards
    members = stored(_split_large(links, most), "shard-links")
    start = F.pmod(F.xxhash64(F.lit(seed), "row_id"), F.lit(n_shards)).cast("int")
    labels = stored(
        members.groupBy("row_id")
        .agg(F.min("key").alias("home"))
        .withColumn("label", start)
        .select("row_id", "home", "label"),
        "shard-labels",
    )
    linked = labels.count()
    # Full shards differ by one at most; the quota of every shard is what all of them can hold.
    for step in range(rounds if linked and most else 0):
        fresh = stored(_round(members, labels, n_shards, most, linked, seed + step), "shard-labels")
        discard(labels)
        labels = fresh
    placed = labels.where("label is not null").select("row_id", F.col("label").alias("shard"))
    filled = _fill(rows, placed, total, n_shards, seed)
    slots = _bucketed_rank(
        filled.withColumn("_order", F.xxhash64(F.lit(seed), "row_id")),
        ["shard"],
        "_order",
        most,
        "slot",
    )
    return slots.drop("_order").withColumn("slot", F.col("slot").cast("bigint"))


def _round(
    members: DataFrame, labels: DataFrame, n_shards: int, most: int, linked: int, seed: int
) -> DataFrame:
    """Labels after every linked document asked once."""
    known = labels.where("label is not null")
    votes = (
        members.join(known.select("row_id", "label"), "row_id")
        .groupBy("key", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("n", "label")), asc=False).alias("votes"))
    )
    # A row has a vote per key it belongs to and label; the key with most votes wins.
    asked = (
        members.join(votes, "key")
        .select("row_id", F.explode("votes").alias("v"))
        .groupBy("row_id", F.col("v.label").alias("wish"))
        .agg(F.sum("v.n").alias("n"))
        .groupBy("row_id")
        .agg(F.max(F.struct(F.col("n"), (-F.col("wish")).alias("wish")))["wish"].alias("wish"))
        .select("row_id", (-F.col("wish")).alias("wish"))
    )
    loads = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    room = [s for s in range(n_shards) if loads.get(s, 0) < most] or list(range(n_shards))
    elsewhere = F.element_at(
        F.array(*[F.lit(s) for s in room]),
        (F.pmod(F.xxhash64(F.lit(seed), "home"), F.lit(len(room))) + 1).cast("int"),
    )
    full = F.col("wish").isin([s for s in range(n_shards) if loads.get(s, 0) >= most])
    wish = F.when(F.col("label").isNull() & (F.col("wish").isNull() | full), elsewhere).otherwise(
        F.coalesce("wish", "label", elsewhere)
    )
    asking = labels.join(asked, "row_id", "left").withColumn("wish", wish)
    # Those that stay come first, then groups one after another.
    stays = F.col("label").eqNullSafe(F.col("wish"))
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "home"), 2)
    ordered = asking.withColumn("_order", F.when(stays, order - (1 << 62)).otherwise(order))
    ranked = _bucketed_rank(ordered, ["wish"], "_order", linked // n_shards, "_rank")
    return ranked.select(
        "row_id", "home", F.when(F.col("_rank") < most, F.col("wish")).alias("label")
    )


def _fill(
    rows: DataFrame, placed: DataFrame, total: int, n_shards: int, seed: int
) -> DataFrame:
    """All rows with a shard: the placed ones stay, the others fill up the quotas in order."""
    loads = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    ends, end = [], 0
    for shard in range(n_shards):
        quota = total // n_shards + (1 if shard < total % n_shards else 0)
        end += quota - loads.get(shard, 0)
        ends.append(end)
    free = rows.select("row_id").join(placed, "row_id", "left_anti")
    ranked = _bucketed_rank(
        free.withColumn("_order", F.xxhash64(F.lit(seed), "row_id")), [], "_order", end, "_rank"
    )
    # The first shard whose room ends behind the rank.
    chosen: Column = F.lit(n_shards - 1)
    for shard in range(n_shards - 2, -1, -1):
        chosen = F.when(F.col("_rank") < ends[shard], F.lit(shard)).otherwise(chosen)
    filling = ranked.select("row_id", chosen.cast("int").alias("shard"))
    return rows.join(placed.unionByName(filling), "row_id")


def shard_documents(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """Shards of documents linked by equal texts: doc_id, size, text_crc32, law, shard, slot and
    grown_shard (null, as the law is ``rows``).

    ``docs`` has doc_id and text; other columns are ignored. The size is the UTF-8 bytes of the
    text plus 8; a null text has none, checksum 0 and no link. Repeated rows are rows of their
    own. An empty table gives no row.
    """
    text = F.col("text")
    rows = stored(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
            F.md5(text.cast("binary")).alias("text_key"),
        ).withColumn("row_id", F.monotonically_increasing_id()),
        "shard-rows",
    )
    placed = balanced_shards(rows, text_links(rows), n_shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
