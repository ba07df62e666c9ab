"""The registered queries of the subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


CHAT_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
places as (
  select *, role is distinct from lag(role) over (partition by conv_id order by turn, role, text)
    as first_of_block from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
    as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text)
    filter (role = 'assistant'), '')) as loss_sha256,
  sum(length(text) + ESCAPES(text)
    + case when first_of_block then 20 + length(role) + ESCAPES(role) else 8 end)::bigint
    as formatted_chars
from places group by conv_id"""


def _chat_sql() -> str:
    """The escapes of a column: one character per backslash and control string."""

    def escapes(column: str) -> str:
        parts = [
            f"(length({column}) - length(replace({column}, '{c}', ''))) // {len(c)}"
            for c in ("\\", "<|", "</s>", "[INST]", "[/INST]")
        ]
        return "(" + " + ".join(parts) + ")"

    return CHAT_SQL.replace("ESCAPES(text)", escapes("text")).replace("ESCAPES(role)", escapes("role"))


@query("op5_chat_format", _chat_sql())
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.chat import format_chats, read_chats

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.sql(
        "select * from values (-7L, 0, 'user', '</s>[INST] ok [/INST]'),"
        " (-7L, 1, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_chats(format_chats(rows.unionByName(planted))).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query("op8_mix_sources")
def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "epochs", "source"
    )


@query("op9_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from pdloom.llm.token_files import tokenize_to_files

    return tokenize_to_files(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"))


@query("op10_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.jaccard import jaccard_components

    found, _ = jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query("op2_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.labelled import fold
    from pdloom.llm.quality import fit_quality, score_quality

    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted"
    )


@query("op7_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.labelled import fold
    from pdloom.llm.toxicity import fit_toxicity, score_toxicity

    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), fold(3) != 1)
    return score_toxicity(docs, model).select(
        "doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted"
    )


@query("op3_decontaminate")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_near_vectors")
def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.embeddings import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op6_license_scan")
def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below a directory per source and language."""
    from pdloom.llm.licenses import license_scan

    path = F.concat_ws("/", "source", "lang", F.concat("doc_id", F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"), path.alias("path"), "text"
    )
    return license_scan(files).withColumnRenamed("file_id", "doc_id")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the words of every tenth document, by its id's checksum, from word a on
    repeated with a period that its checksum and length give."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", checksum.alias("h")).withColumn(
        "w",
        F.when(
            F.col("h") % 10 == 0,
            F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""),
        ),
    )
    g, n = F.floor(F.col("h") / 10), F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + g % 8))))
    a, p = F.col("a"), F.col("p")

    def source(i: Column) -> Column:
        return F.when(i < a, i).otherwise(a + (i - a) % p)

    planted = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.element_at("w", (source(i) + 1).cast("int"))
    )
    return rows.select(
        "doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text")
    )


@query("op13_periodic_runs")
def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.periodic import periodic_runs

    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run")))
    )["run"]
    told = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("run", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("run.start").alias("start"),
        F.col("run.length").alias("length"),
        F.col("run.period").alias("period"),
        F.floor(1000 * F.col("run.length") / F.col("run.period")).alias("exponent_milli"),
        F.sha2(F.array_join(told, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd's rounds over (part, entry, place, value) rows, each a few common table expressions."""
    near = """
near{r} as materialized (
  select row, part, arg_min(entry, dist * 1000 + entry) as entry, min(dist) as dist from (
    select p.row, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) as dist
    from pieces p join book{r} b on p.part = b.part and p.place = b.place
    group by p.row, p.part, b.entry) group by row, part),"""
    step = """
book{s} as materialized (
  select b.part, b.entry, b.place, coalesce(m.x, b.x) as x from book{r} b left join (
    select n.part, n.entry, p.place, ((sum(p.x) - ((sum(p.x) % count(*)) + count(*)) % count(*))
      // count(*))::bigint as x
    from near{r} n join pieces p on n.row = p.row and n.part = p.part
    group by n.part, n.entry, p.place) m
  on b.part = m.part and b.entry = m.entry and b.place = m.place),"""
    chain = "".join(near.format(r=r) + step.format(r=r, s=r + 1) for r in range(rounds))
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id) - 1 as row, vec_id, label, embedding as v from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding,
    lambda x: x is not null and isfinite(x)))),
spread as (
  select row, unnest(generate_series(0, len(v) - 1)) as i, len(v) // {parts} as width,
    unnest(list_transform(v, lambda x: floor(4096 * x::double)::bigint)) as x from kept),
pieces as materialized (select row, i // width as part, i % width as place, x from spread),
book0 as materialized (select part, row as entry, place, x from pieces where row < {entries}),
{chain}
{near.format(r=rounds)}
coded as (
  select row, string_agg(printf('%02x', entry), '' order by part) as code, sum(dist)::bigint as error
  from near{rounds} group by row),
books as (
  select sha256(string_agg(x::varchar, ',' order by part, entry, place)) as digest from book{rounds})
select vec_id, code, error,
  (sum(error) over (partition by label))::bigint as label_error, digest as codebooks_sha256
from kept join coded using (row), books"""


@query("op12_vector_codes", _codes_sql())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.vector_codes import compress_vectors

    found, books = compress_vectors(table(spark, sf_dir, "embeddings"), vector_col="embedding")
    return found.select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


@query("op11_repeated_bytes")
def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pdloom.llm.repeats import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
