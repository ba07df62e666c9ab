"""Near-duplicate vectors by spherical-cap filters with list decoding (operator 1).

A filter is a direction; a vector is kept by the filters it reaches a bound with, a cap of the
sphere. The directions form random product codes: the rotated vector is cut in two halves, each
with a codebook of Gaussian words, and a filter is a pair of words. Decoding lists all filters
over the bound without looking at every pair. Vectors of a cosine of 0.9 are very likely to share a
filter, others seldom do. Many codes that keep one filter each need fewer filters in all than few
codes that keep many, and wide caps fewer than narrow ones; the products of a wide cap's vectors are cheap.

Equal vectors form classes first. Vectors are joined on their filters; inside a bucket all
cosines are computed in double precision. A pair is counted in the smallest filter it shares, and
of the links of a bucket only a spanning forest leaves it, so no list of pairs is ever made. A
bucket too large for one task is cut into blocks, and every pair of blocks is a task's work.

Copies of the vectors go to the buckets in rounds, a hash of the filter each. A round's files are deleted
at its end, so that the disk holds a few copies of a vector at once, however many filters it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pdloom.llm.common import BROADCAST_ROWS, discard, stored, tasks_for
from pdloom.llm.components import components
from pdloom.session import scratch_path

#: Filters that keep a vector, on average, per code, and least number of codes.
KEPT, CODES = 1.0, 3
#: Share of the pairs at the threshold that may share no filter; codes are added for it.
MISSED = 0.005
#: Codes, and pairs per code, on which the share of one code is calculated.
TRIED, TRIALS = 12, 400
#: Least number of words in a codebook, and vectors of a bucket, on average, beyond it: the words
#: grow with the root of the number of vectors.
LEAST_WORDS, HELD = 8, 256
#: Vectors of one block of a bucket.
BLOCK = 1_024
#: Copies of every vector in the buckets of one round, on average, and least number of copies in a round.
COPIES, LEAST_COPIES = 1, 150_000
#: Filters looked up at once for the pairs of a bucket.
NAMES = 4_096
#: Spark's setting that deletes the shuffle files of a query at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Code:
    """Codebooks for vectors of one length; the same everywhere for the same seed."""

    rotation: np.ndarray
    first: np.ndarray
    second: np.ndarray
    bound: float

    @classmethod
    def make(cls, size: int, words: int, kept: float, seed: int) -> Code:
        random = np.random.default_rng([seed, size, words])
        rotation = np.linalg.qr(random.normal(size=(size, size)))[0]
        half = size // 2
        bound = NormalDist().inv_cdf(1 - min(kept / words**2, 0.5))
        return cls(
            rotation,
            random.normal(size=(words, half)),
            random.normal(size=(words, size - half)),
            bound,
        )

    def decoded(self, unit: np.ndarray) -> list[np.ndarray]:
        """For every row all filters with a score over the bound, in ascending order."""
        turned = unit @ self.rotation
        half = self.first.shape[1]
        one, two = turned[:, :half] @ self.first.T, turned[:, half:] @ self.second.T
        words, found = len(self.first), []
        step = max(1, (1 << 20) // words)
        row, i = np.nonzero(one >= self.bound - two.max(1, keepdims=True))
        for low in range(0, len(row), step):
            r, w = row[low : low + step], i[low : low + step]
            at, j = np.nonzero(two[r] >= self.bound - one[r, w][:, None])
            found.append((r[at], w[at] * words + j))
        rows, filters = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
        return np.split(filters, np.searchsorted(rows, np.arange(1, len(unit))))


_MADE: dict[tuple[int, int, int], Code] = {}


def _code(size: int, words: int, number: int) -> Code:
    if (size, words, number) not in _MADE:
        _MADE[size, words, number] = Code.make(size, words, KEPT, number)
    return _MADE[size, words, number]


def packed_numbers(row: np.ndarray) -> bytes:
    """The doubles, or singles and a byte more where these are the same numbers."""
    with np.errstate(over="ignore"):
        single = row.astype("<f4")
    return single.tobytes() + b"f" if (single == row).all() else row.astype("<f8").tobytes()


def length_of(value: bytes) -> int:
    return len(value) // 4 if len(value) % 2 else len(value) // 8


def unit_rows(values: list[bytes]) -> np.ndarray:
    """Unit vectors of packed ones of one length."""
    if len({len(v) for v in values}) == 1:
        held = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
        single = held.shape[1] % 2
        held = np.ascontiguousarray(held[:, :-1]) if single else held
        rows = held.view("<f4" if single else "<f8").astype(np.float64)
    else:
        kinds = [("<f4", v[:-1]) if len(v) % 2 else ("<f8", v) for v in values]
        rows = np.stack([np.frombuffer(v, kind).astype(np.float64) for kind, v in kinds])
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pairs_at(cosine: float, size: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors, and one at exactly that cosine to each."""
    one, other = np.random.default_rng([seed, size]).normal(size=(2, n, size))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(1, keepdims=True) * one
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return one, cosine * one + np.sqrt(1 - cosine**2) * other


def codes_for(sizes: list[int], words: int, cosine: float) -> int:
    """Number of codes with which at most MISSED of the pairs at the cosine share no filter.

    A code of larger codebooks has a higher bound and misses more pairs. The share one code misses
    is that of random pairs under a few codes, plus two standard errors; codes are independent.
    """
    most = CODES
    for size in sizes:
        if size < 2 or cosine >= 1:  # such vectors are equal or opposite
            continue
        one, two = pairs_at(cosine, size, TRIALS, 1)
        missed = 0
        for c in range(TRIED):
            code = Code.make(size, words, KEPT, c)
            lists = zip(code.decoded(one), code.decoded(two))
            missed += sum(not np.intersect1d(a, b, assume_unique=True).size for a, b in lists)
        share = (missed + 1) / (TRIED * TRIALS + 2)
        share = min(share + 2 * np.sqrt(share * (1 - share) / (TRIED * TRIALS)), 0.99)
        most = max(most, int(np.ceil(np.log(MISSED) / np.log(share))))
    return most


def filters(values: list[bytes], words: int, codes: int = CODES) -> list[np.ndarray]:
    """Filters of vectors of any lengths; a filter's number tells its code and the length."""
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(values)
    sizes = np.array([length_of(v) for v in values])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        unit = unit_rows([values[i] for i in at])
        lists = [_code(int(size), words, c).decoded(unit) for c in range(codes)]
        for k, i in enumerate(at):
            parts = [(c + codes * int(size)) * words**2 + x[k] for c, x in enumerate(lists)]
            found[i] = np.concatenate(parts)
    return found


def _bytes_of(batches: Batches) -> Batches:
    """(vec_id, value) with the vector's packed numbers; null where it links with nothing."""
    for batch in batches:
        values = []
        for v in batch.column(1).to_pylist():
            usable = v is not None and len(v) > 0 and None not in v
            row = np.array(v, "<f8") if usable else None
            usable = usable and bool(np.isfinite(row).all()) and bool(row.any())
            values.append(packed_numbers(row + 0.0) if usable else None)
        yield pa.record_batch(
            [batch.column(0), pa.array(values, pa.binary())], names=["vec_id", "value"]
        )


def _listed(words: int, codes: int) -> Callable[[Batches], Batches]:
    """Adds the filters of a vector, packed in ascending order. Only vectors of one length share a
    filter, so a number of four bytes tells the code and the words where that many are enough."""
    width = _packed_type(words, codes)

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for low in range(0, whole.num_rows, 2_048):
                batch = whole.slice(low, 2_048)
                values = batch.column("value").to_pylist()
                found = filters(values, words, codes)
                base = [codes * length_of(v) * words**2 * (width == "<u4") for v in values]
                lists = [(x - b).astype(width).tobytes() for x, b in zip(found, base)]
                size = pa.array([length_of(v) for v in values], pa.int32())
                yield pa.record_batch(
                    [*batch.columns, size, pa.array(lists, pa.binary())],
                    names=[*batch.schema.names, "size", "filters"],
                )

    return run


def _packed_type(words: int, codes: int) -> str:
    return "<u4" if codes * words**2 < 2**32 else "<i8"


def _flat(
    batch: pa.RecordBatch, words: int, codes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Row, place in its list and number of every filter of a batch, and the packed lists."""
    width = _packed_type(words, codes)
    packed = batch.column("filters").to_pylist()
    counts = np.array([len(x) for x in packed], np.int64) // np.dtype(width).itemsize
    row = np.repeat(np.arange(len(packed)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    bucket = np.frombuffer(b"".join(packed), width).astype(np.int64)
    if width == "<u4":
        bucket += codes * words**2 * batch.column("size").to_numpy().astype(np.int64)[row]
    return row, place, bucket, packed


def _sizes(words: int, codes: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            bucket, n = np.unique(_flat(batch, words, codes)[2], return_counts=True)
            yield pa.record_batch([pa.array(bucket), pa.array(n)], names=["bucket", "n"])

    return run


def _spread(numbers: np.ndarray, parts: np.ndarray | int) -> np.ndarray:
    """A part for every number, by a hash of it."""
    mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.asarray(parts, np.uint64)).astype(np.int64)


def _dealt(
    words: int, codes: int, large: dict[int, int], part: int, rounds: int
) -> Callable[[Batches], Batches]:
    """A row per filter of a vector in this round; in a bucket of several blocks one per pair of
    blocks. ``before`` are the vector's smaller filters."""
    item = np.dtype(_packed_type(words, codes)).itemsize
    keys = np.array(sorted(large), np.int64)
    counts = np.array([large[k] for k in keys.tolist()], np.int64)

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for low in range(0, whole.num_rows, 2_048):
                batch = whole.slice(low, 2_048)
                row, place, bucket, packed = _flat(batch, words, codes)
                mine = np.flatnonzero(_spread(bucket, rounds) == part)
                row, place, bucket = row[mine], place[mine], bucket[mine]
                ids = batch.column("vec_id").to_numpy()[row]
                blocks = np.ones(len(bucket), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, bucket), len(keys) - 1)
                    blocks = np.where(keys[at] == bucket, counts[at], 1)
                copy = np.repeat(np.arange(len(bucket)), blocks)
                other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                own = _spread(ids, blocks)[copy]
                for first in range(0, len(copy), 4_096):
                    c = copy[first : first + 4_096]
                    b, o = own[first : first + 4_096], other[first : first + 4_096]
                    r = pa.array(row[c])
                    before = [packed[k][: item * p] for k, p in zip(row[c].tolist(), place[c].tolist())]
                    columns = [bucket[c], np.minimum(b, o), np.maximum(b, o), b, ids[c]]
                    columns = [pa.array(x, t) for x, t in zip(columns, _DEALT.types)]
                    columns += [batch.column("n").take(r), batch.column("value").take(r)]
                    yield pa.record_batch([*columns, pa.array(before, pa.binary())], schema=_DEALT)

    return run


_DEALT = pa.schema(
    [
        ("bucket", pa.int64()), ("block_a", pa.int32()), ("block_b", pa.int32()),
        ("block", pa.int32()), ("vec_id", pa.int64()), ("n", pa.int64()),
        ("value", pa.binary()), ("before", pa.binary()),
    ]
)


def _groups(batches: Batches) -> Iterator[pa.Table]:
    """The rows of each (bucket, block_a, block_b), from batches sorted by it."""
    waiting: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            key = tuple(keys[low])
            if key != current and waiting:
                yield pa.Table.from_batches(waiting)
                waiting = []
            current = key
            waiting.append(batch.slice(low, high - low))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _linked(cosine: float, width: str) -> Callable[[Batches], Batches]:
    """Rows (a, b, n): links of vector a counted in this bucket, or an edge to vector b."""

    def run(batches: Batches) -> Batches:
        for group in _groups(batches):
            if group.num_rows < 2:
                continue
            ids, ns = group.column("vec_id").to_numpy(), group.column("n").to_numpy()
            bucket, a, b = (group.column(i)[0].as_py() for i in range(3))
            block = group.column("block").to_numpy()
            unit = unit_rows(group.column("value").to_pylist())
            near = unit @ unit.T >= cosine
            near &= (block[:, None] != block[None]) if a != b else ~np.eye(len(ids), dtype=bool)
            if not near.any():
                continue
            used = np.flatnonzero(near.any(1))
            near, ids, ns = near[np.ix_(used, used)], ids[used], ns[used]
            packed = group.column("before")
            counted = near & ~_shared([packed[int(i)].as_py() for i in used], width)
            links = (counted @ ns.astype(np.float64)).astype(np.int64)
            root = _roots(near, ids)
            at, moved = np.flatnonzero(links), np.flatnonzero(root != ids)
            yield pa.record_batch(
                [
                    pa.array(np.concatenate([ids[at], ids[moved]])),
                    pa.array(np.concatenate([ids[at], root[moved]])),
                    pa.array(np.concatenate([links[at], np.zeros(len(moved), np.int64)])),
                ],
                names=["a", "b", "n"],
            )

    return run


def _shared(lists: list[bytes], width: str) -> np.ndarray:
    """Whether two members share one of their packed filters."""
    held = [np.frombuffer(x, width) for x in lists]
    names, place, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(len(held)), [len(x) for x in held])
    common = np.flatnonzero(times > 1)
    out = np.zeros((len(held), len(held)), bool)
    number = np.full(len(names), -1)
    number[common] = np.arange(len(common))
    number = number[place]
    for low in range(0, len(common), NAMES):
        at = np.flatnonzero((number >= low) & (number < low + NAMES))
        table = np.zeros((len(held), min(NAMES, len(common) - low)), np.float32)
        table[member[at], number[at] - low] = 1
        out |= table @ table.T > 0
    return out


def _roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id each vector reaches inside the bucket."""
    ids = ids.astype(np.int64)
    root, before = ids, None
    largest = np.iinfo(np.int64).max
    while before is None or (root != before).any():
        before = root
        reached = np.where(near, root[None], largest).min(1)
        root = np.minimum(root, reached)
    return root


@contextmanager
def _cleaned_up(spark: SparkSession) -> Iterator[None]:
    """Queries inside the block delete their shuffle files when they end, not when the driver's
    memory happens to be collected."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _length(value: str) -> Column:
    size = F.octet_length(value)
    return F.when(size % 2 == 1, F.floor(size / 4)).otherwise(F.floor(size / 8)).cast("int")


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, digest of the vector) and classes (digest, vec_id, n, value) of equal vectors."""
    held = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(
        _bytes_of, "vec_id bigint, value binary"
    )
    whole = stored(held.withColumn("digest", F.unhex(F.md5("value"))), "vectors")
    usable = whole.where("value is not null and vec_id is not null")
    classes = usable.groupBy("digest").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("n"), F.any_value("value").alias("value")
    )
    classes, rows = stored(classes, "vector-classes"), stored(whole.select("vec_id", "digest"), "vector-rows")
    discard(whole)
    return rows, classes


def _links(classes: DataFrame, total: int, cosine: float) -> DataFrame:
    """Rows (a, b, n) of every bucket, stored; see ``_linked``. Deletes the classes' vectors."""
    spark = classes.sparkSession
    words = max(LEAST_WORDS, int(np.ceil(np.sqrt(total * KEPT / HELD))))
    lengths = classes.select(_length("value").alias("size")).distinct()
    codes = codes_for([r["size"] for r in lengths.collect()], words, cosine)
    listed = stored(
        classes.select("vec_id", "n", "value").mapInArrow(
            _listed(words, codes), "vec_id bigint, n bigint, value binary, size int, filters binary"
        ),
        "vector-filters",
    )
    discard(classes)
    sizes = listed.select("size", "filters").mapInArrow(_sizes(words, codes), "bucket bigint, n bigint")
    full = sizes.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK)
    held = {r["bucket"]: r["n"] for r in full.collect()}
    if len(held) > BROADCAST_ROWS:
        raise ValueError("more large buckets than a task can look up; raise LEAST_WORDS")
    large = {bucket: -(-n // BLOCK) for bucket, n in held.items()}
    copies = listed.agg(F.sum(F.octet_length("filters")).alias("n")).first()["n"] or 0
    width = _packed_type(words, codes)
    copies = copies // np.dtype(width).itemsize + sum(n * (large[bucket] - 1) for bucket, n in held.items())
    rounds = max(1, -(-copies // max(COPIES * total, LEAST_COPIES)))
    schema = (
        "bucket bigint, block_a int, block_b int, block int, vec_id bigint, n bigint,"
        " value binary, before binary"
    )
    unit = ["bucket", "block_a", "block_b"]
    tasks = tasks_for(spark, copies // rounds, 50_000)
    path, found = scratch_path(spark, "vector-links"), "a bigint, b bigint, n bigint"
    for part in range(rounds):
        listed.mapInArrow(_dealt(words, codes, large, part, rounds), schema).repartition(
            tasks, *unit
        ).sortWithinPartitions(*unit).mapInArrow(_linked(cosine, width), found).write.mode("append").parquet(path)
    discard(listed)
    out = spark.read.schema(found).parquet(path)
    out._stored_at = path
    return out


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per row of ``vectors`` with vec_id, n_links (other vectors of that cosine or more
    that were found), component_id (smallest vec_id reachable by links) and kept.

    ``vectors`` has vec_id and embedding (an array of numbers); other columns, labels among them,
    are ignored. Vectors that are null, empty, zero or hold null or non-finite numbers link with
    nothing; vectors of different lengths don't link. Equal vectors link; rows that repeat a
    vec_id are vectors of their own with one id. An empty table gives no row. The codes grow with
    the number of vectors, so that buckets stay small, and there are as many as keep the pairs missed
    at the threshold within MISSED. Vectors are told apart by 128 bits of a digest.
    """
    with _cleaned_up(vectors.sparkSession):
        rows, classes = _classes(vectors)
        vectors_of, classes = classes, stored(classes.select("digest", "vec_id", "n"), "vector-groups")
        found = _links(vectors_of, classes.count(), cosine)
        links = found.groupBy("a").agg(F.sum("n").alias("links"))
        roots = components(found.where("n = 0"))
        per_class = stored(
            classes.join(links, F.col("vec_id") == F.col("a"), "left")
            .join(roots, F.col("vec_id") == F.col("node"), "left")
            .select(
                "digest",
                (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                F.coalesce("component", "vec_id").alias("component"),
            ),
            "vector-links",
        )
        discard(found, classes)
    return (
        rows.join(per_class.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest"), "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
