"""Bounded samples of labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a classifier is fitted on at most, chosen by a hash of the id.
SAMPLE_ROWS = 16_000


def fold(modulus: int) -> Column:
    """crc32 of the id as text, by a modulus."""
    return (F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus).cast("int")


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents in the order of a hash.

    Rows without a label, an id or a usable fold are left out; a repeated id keeps each row.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
