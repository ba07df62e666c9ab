"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the next documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.llm.common import counted_broadcast, free_name, table
from pdloom.llm.decontaminate import find_leaks
from pdloom.llm.jaccard import jaccard_components
from pdloom.llm.labelled import fold
from pdloom.llm.mixing import taken_documents
from pdloom.llm.quality import fit_quality, score_quality
from pdloom.llm.token_files import tokenize_to_files


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is not among the ids; rows without an id stay."""
    name = free_name(docs, "_id")
    ids = ids.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(counted_broadcast(ids, ids.count()), docs["doc_id"] == F.col(name), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, does not reject.

    Every row is judged by its own text: rows that repeat an id, null ids, null and empty texts and very
    long ones get a score like any other. Columns that the scores are named like keep their values;
    an empty table stays empty.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    aside = {c: free_name(docs, f"_{c}") for c in docs.columns if c.lower() in ("score", "predicted")}
    judged = score_quality(docs.withColumnsRenamed(aside), model).where("predicted = 1")
    return judged.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more;
    rows that repeat an id with an equal text are one document."""
    counts = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if counts.limit(1).count():
        docs = docs.dropDuplicates(["doc_id", "text"])
    found, _ = jaccard_components(docs, k=5, percent=80)
    return without(docs, found.where("doc_id != component_id"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows without an id or a text hold none and stay."""
    return without(docs, find_leaks(docs, table(spark, sf_dir, "benchmark")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them. A null source is a source of its own,
    a null or empty text has no words; rows that repeat an id and a text are taken alike."""
    return taken_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, as read back from them: a row per row, null texts as empty,
    null ids first, and no other column."""
    from public_tokenizers import path

    return tokenize_to_files(docs, path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("jaccard", one_of_each),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("tokens", tokens),
]
