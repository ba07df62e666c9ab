"""Token ids in Arrow files of equal-length sequences (operator 9).

Documents are dealt to tasks by ranges of their id. A task packs the ids of its documents, each
with the end id behind it, into sequences of one length and writes one Arrow file: record batches
with a fixed-size list of ids and one of mask bits per sequence, uncompressed, so that a reader
maps the file and takes any sequence without a copy. Only the last sequence of a file is padded.

The index that Spark commits names the file of the attempt that won, so a repeated or lost task
leaves at most a file that nothing refers to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pdloom.llm.common import giving_back, small_batches, stored
from pdloom.llm.tokens import WordEncoder
from pdloom.session import scratch_path, shuffle_partitions

#: Ids in a sequence and sequences in a record batch.
LENGTH = 2_048
BATCH = 256
END_ID = 2

INDEX = "doc_id bigint, file string, task int, local_start bigint, n_tokens bigint"


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    """Ids and mask of a sequence; mask bits are set where the ids belong to a document."""
    kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])


def _file_system(url: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    if "://" in url or url.startswith("file:"):
        return fs.FileSystem.from_uri(url)
    return fs.LocalFileSystem(), url


class _Writer:
    """Packs ids into sequences and writes full record batches as they come."""

    def __init__(self, folder: str, name: str, length: int, dtype: np.dtype) -> None:
        self.system, root = _file_system(folder)
        self.system.create_dir(root, recursive=True)
        self.schema, self.length, self.dtype = file_schema(length, dtype), length, dtype
        self.out = self.system.open_output_stream(f"{root}/{name}")
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.waiting = bytearray()
        self.batch_bytes = BATCH * length * dtype.itemsize

    def add(self, packed: bytes) -> None:
        self.waiting += packed
        while len(self.waiting) >= self.batch_bytes:
            self._write(bytes(self.waiting[: self.batch_bytes]))
            del self.waiting[: self.batch_bytes]

    def _write(self, packed: bytes) -> None:
        ids = np.frombuffer(packed, dtype=self.dtype)
        rows = -(-len(ids) // self.length)
        mask = np.arange(rows * self.length) < len(ids)
        padded = np.zeros(rows * self.length, dtype=self.dtype)
        padded[: len(ids)] = ids
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
            for values in (padded, mask)
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._write(bytes(self.waiting))
        self.file.close()
        self.out.close()


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Write the ids of all texts below ``folder``; returns the stored index.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. A null text counts as empty
    and has the end id alone. Rows follow one another by doc_id (null first), rows with one doc_id
    by a hash of the text, so repeated rows are kept next to each other. An empty table writes
    no file. The index has a row per row of ``docs``: doc_id, file, task, local_start (ids before
    it in the file) and n_tokens.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = (
        docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(shuffle_partitions(spark), "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        end, width = encoder.pack([end_id]), encoder.dtype.itemsize
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.arrow"
        writer, start = None, 0
        for batch in batches:
            if writer is None and batch.num_rows:
                writer = _Writer(folder, name, length, encoder.dtype)
            starts, counts = [], []
            for text in batch.column(1).to_pylist():
                packed = encoder.encode(text) + end
                writer.add(packed)
                starts.append(start)
                counts.append(len(packed) // width)
                start += counts[-1]
            n = batch.num_rows
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([name] * n, pa.string()),
                    pa.array([task.partitionId()] * n, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["doc_id", "file", "task", "local_start", "n_tokens"],
            )
        if writer is not None:
            writer.close()

    return stored(rows.mapInArrow(giving_back(write), INDEX), "token-index")


def with_global_start(index: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before it. The window has a row per file."""
    files = index.groupBy("file", "task").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        "file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return index.join(offsets, "file").withColumn("start", F.col("_offset") + F.col("local_start"))


class TokenFile:
    """Random access to the sequences of one file; a local file is mapped, not read."""

    def __init__(self, url: str) -> None:
        system, path = _file_system(url)
        local = system.type_name == "local"
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.dtype = self.reader.schema.field("ids").type.value_type.to_pandas_dtype()
        self.length = self.reader.schema.field("ids").type.list_size
        self.batch_no, self.ids = -1, None

    def batch_ids(self, number: int) -> np.ndarray:
        """Ids of all sequences of a record batch, as a view of the file."""
        if number != self.batch_no:
            column = self.reader.get_batch(number).column("ids")
            self.ids = np.frombuffer(column.flatten().buffers()[1], dtype=self.dtype)
            self.batch_no = number
        return self.ids

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask bits of one sequence."""
        at = number % BATCH
        mask = self.reader.get_batch(number // BATCH).column("mask")
        ids = self.batch_ids(number // BATCH)[at * self.length : (at + 1) * self.length]
        return ids, mask.flatten().slice(at * self.length, self.length)

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the file on, across sequences."""
        size, parts = BATCH * self.length, []
        while n > 0:
            at = start % size
            parts.append(self.batch_ids(start // size)[at : at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """Per row of the index (with ``start``), what the files hold: doc_id, start, n_tokens,
    ids_crc32 (unsigned, of the ids as little-endian 32-bit integers) and file."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, file string"
    rows = (
        index.select("doc_id", "file", "local_start", "n_tokens", "start")
        .repartition(shuffle_partitions(index.sparkSession), "file")
        .sortWithinPartitions("file", "local_start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, current = None, None
        for batch in batches:
            doc_ids, files, locals_, counts, starts = (c.to_pylist() for c in batch.columns)
            sums = []
            for file, start, n in zip(files, locals_, counts):
                if file != current:
                    opened, current = TokenFile(f"{folder}/{file}"), file
                sums.append(zlib.crc32(opened.span(start, n).astype("<u4").tobytes()))
            yield pa.record_batch(
                [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(files, pa.string()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
            )

    return rows.mapInArrow(giving_back(read), schema)


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the files (to a new folder below the shared one by default) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    index = write_token_files(docs, folder, tokenizer_path)
    return read_back(with_global_start(index), folder)
