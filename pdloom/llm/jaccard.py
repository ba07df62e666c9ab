"""Jaccard join of word shingles by partitioning the universe of shingles (operator 4).

Sets are put into bands of similar size. For a band, every shingle is hashed into one of m
segments. Two sets of the band with Jaccard similarity at or over the threshold differ in at most
H shingles, so with m = H + 1 + s segments they agree in s + 1 at least: equal hashes of equal
segment subsets find every link, also where a set leaves out its empty segments, s at most. A set
close below a band also joins the index of that band.

1. Equal sets form classes; the smallest doc_id stands for its class, and it alone is put into
   buckets.
2. Round by round, documents that share a segment are compared with one member of their bucket
   whose component is another, and links are verified on the whole sets. In a bucket of near copies
   that connects them without all pairs; a bucket of one member more than rounds is done.
3. A larger bucket whose members are not one component after that is taken up again with all its
   pairs across components. An entry holds the smallest buckets of its document, and a pair that
   shares one of them is left to that bucket. Where a segment of a band would cost much more pairs
   than another segment's one-deletion neighbourhood has entries, the costly segment is left out and
   a cheap one also matches subsets that differ by one shingle: segments with tolerances t_i still
   find every link while the sum of (t_i + 1) exceeds H + s.

Shingles are 64-bit hashes. Buckets are 48-bit hashes; a collision only costs a comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.llm.common import (
    Batches,
    counted_broadcast,
    discard,
    giving_back,
    no_rows,
    small_batches,
    stored,
    tasks_for,
)
from pdloom.llm.components import components

#: Bytes of a bucket's hash, and the growth of a band's size from the smallest to the largest.
KEY_BYTES = 6
BAND_RATIO = 1.4
#: Bucket entries one task of the index holds, on average.
TASK_ENTRIES = 250_000
#: Members of a bucket that all its others are compared with, one in a round.
ROUNDS = 3
#: Smallest buckets of a document that its entries in other buckets hold.
FIRST = 8
#: Comparisons of signatures inside a task that take as long as one more entry of the index, and those
#: of a segment that are worth a look at swaps.
ENTRY_COST = 100
SWAP_COST = 1_000_000

#: Documents of a batch that are worked on at once.
DOCUMENTS = 2_000


def in_parts(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The work on batches of at most ``DOCUMENTS`` rows; what Arrow held is given back at the end."""

    def run(batches: Batches) -> Batches:
        cut = (
            batch.slice(low, DOCUMENTS)
            for batch in batches
            for low in range(0, max(1, batch.num_rows), DOCUMENTS)
        )
        yield from work(cut)

    return giving_back(run)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of a text between ASCII white space, with A-Z in lower case."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of all words as one where they are fewer."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    k = min(k, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total = mixed(total ^ words[i : len(words) - k + 1 + i])
    return np.unique(total)


@dataclass(frozen=True)
class Bands:
    """Sizes of the bands and the number of segments for a threshold in percent."""

    percent: int
    edges: tuple[int, ...]

    @classmethod
    def up_to(cls, largest: int, percent: int) -> Bands:
        if percent < 80:
            raise ValueError("bands reach their neighbours only, so the threshold is 80 at least")
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_RATIO)))
        return cls(percent, (*edges, max(edges[-1] + 1, int(edges[-1] * BAND_RATIO))))

    def most_different(self, band: int) -> int:
        """Most shingles in one but not both of two linked sets, the larger of them in the band."""
        largest = self.edges[band + 1] - 1
        return (100 - self.percent) * 2 * largest // (100 + self.percent)

    def spare(self, band: int) -> int:
        """Segments beyond those the threshold needs, about half more than a small set leaves empty."""
        if self.percent >= 100:
            return 0
        filled = self.percent * (100 + self.percent) / (200 * (100 - self.percent) * BAND_RATIO)
        return round(1.5 * (self.most_different(band) + 1) * exp(-filled))

    def segments(self, band: int) -> int:
        return self.most_different(band) + 1 + self.spare(band)

    def of(self, size: int) -> list[int]:
        """The band of a set of that size, and the next one if a partner may be there."""
        band = int(np.searchsorted(self.edges, size, side="right")) - 1
        near = 100 * size >= self.percent * self.edges[band + 1]
        return [band, band + 1] if near else [band]


def _segments(items: np.ndarray, band: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixed items ordered by segment, and where each of the m segments starts and ends."""
    place = mixed(items ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(m)
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(np.bincount(place.astype(np.int64), minlength=m))
    return mixed(items[order] ^ np.uint64(band + 1)), ends - np.diff(ends, prepend=0), ends


def _bucket(band: int, segment: np.ndarray, total: np.ndarray) -> np.ndarray:
    tag = mixed(np.uint64(band << 32) + segment.astype(np.uint64) + np.uint64(1))
    return mixed(total ^ tag) >> np.uint64(64 - 8 * KEY_BYTES)


def segment_keys(items: np.ndarray, bands: Bands) -> np.ndarray:
    """Bucket hashes of all segments, for the own band and then the next one if near; 0 for empty
    segments, unless there are more than the spare ones."""
    found = []
    for band in bands.of(len(items)):
        m = bands.segments(band)
        values, starts, ends = _segments(items, band, m)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        keys = np.maximum(_bucket(band, np.arange(m), sums[ends] - sums[starts]), np.uint64(1))
        empty = starts == ends
        found.append(np.where(empty, np.uint64(0), keys) if empty.sum() <= bands.spare(band) else keys)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def deletion_keys(items: np.ndarray, band: int, m: int, chosen: list[int]) -> np.ndarray:
    """Bucket hashes of the chosen segments and of each with one item taken out."""
    values, starts, ends = _segments(items, band, m)
    found = []
    for i in chosen:
        part = values[starts[i] : ends[i]]
        total = part.sum(dtype=np.uint64)
        sums = np.concatenate([[total], total - part]).astype(np.uint64)
        found.append(_bucket(band, np.full(len(sums), m + i), sums))
    return np.concatenate(found)


def most_apart(size_a, size_b, percent: int):
    """Most shingles in one but not both of two linked sets of these sizes."""
    return (100 - percent) * (size_a + size_b) // (100 + percent)


def signature(items: np.ndarray, percent: int) -> bytes:
    """One byte per fine segment: the number of its items in two bits, the sum of their hashes in six.
    Lengths are powers of two; a longer one folds to a shorter one by adding halves of both."""
    size = 32
    while size < 2 * (most_apart(len(items), len(items), percent) + 1) and size < 4_096:
        size *= 2
    place = mixed(items ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(size - 1)
    value = (mixed(items ^ np.uint64(0x14057B7EF767814F)) & np.uint64(63)).astype(np.float64)
    count = np.bincount(place.astype(np.int64), minlength=size)
    total = np.bincount(place.astype(np.int64), value, minlength=size).astype(np.int64)
    return ((count & 3) << 6 | total & 63).astype(np.uint8).tobytes()


def folded(signatures: list[bytes], size: int) -> np.ndarray:
    """Signatures as rows of ``size`` bytes."""
    out = np.empty((len(signatures), size), np.uint8)
    for i, held in enumerate(signatures):
        row = np.frombuffer(held, np.uint8)
        if len(row) != size:
            parts = row.reshape(-1, size).astype(np.int64)
            row = ((parts >> 6).sum(axis=0) & 3) << 6 | (parts & 63).sum(axis=0) & 63
        out[i] = row
    return out


def least_apart(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A lower bound of the items in one but not both of two sets, by rows of signatures: one in a
    segment whose numbers of items differ by an odd one, two in others that differ."""
    unequal = one ^ two
    return 2 * np.count_nonzero(unequal, axis=-1) - np.count_nonzero(unequal & 64, axis=-1)


def _may_link(percent: int) -> Callable[[Batches], Batches]:
    """Pairs whose signatures leave a link possible."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sigs_a, sigs_b = (batch.column(i).to_pylist() for i in (4, 5))
            allowed = most_apart(batch.column(1).to_numpy(), batch.column(3).to_numpy(), percent)
            sizes = np.array([min(len(a), len(b)) for a, b in zip(sigs_a, sigs_b)], np.int64)
            near = np.zeros(batch.num_rows, bool)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                one, two = (folded([x[i] for i in rows], size) for x in (sigs_a, sigs_b))
                near[rows] = least_apart(one, two) <= allowed[rows]
            yield batch.filter(pa.array(near)).select(["a", "b"])

    return run


def _possible(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and signatures do not rule out; ``facts`` has doc_id, n_shingles
    and signature."""
    sizes, signatures = facts.select("doc_id", "n_shingles"), facts.select("doc_id", "signature")
    sized = (
        pairs.join(sizes.toDF("a", "n_a"), "a")
        .join(sizes.toDF("b", "n_b"), "b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .join(signatures.toDF("a", "sig_a"), "a")
        .join(signatures.toDF("b", "sig_b"), "b")
        .select("a", "n_a", "b", "n_b", "sig_a", "sig_b")
    )
    return sized.mapInArrow(in_parts(_may_link(percent)), "a bigint, b bigint").distinct()


def _packed(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    full = np.zeros((len(short), 8), np.uint8)
    full[:, :KEY_BYTES] = short
    return full.view("<u8").reshape(-1)


def _describe(k: int, percent: int) -> Callable[[Batches], Batches]:
    """Per document: size and two hashes of its set, and its buckets."""

    def run(batches: Batches) -> Batches:
        bands = Bands.up_to(1 << 40, percent)
        for batch in batches:
            sizes, firsts, seconds, keys, signatures = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                items = shingles(text, k)
                sizes.append(len(items))
                firsts.append(int(mixed(items).sum(dtype=np.uint64).view(np.int64)))
                again = mixed(items ^ np.uint64(0x2545F4914F6CDD1D))
                seconds.append(int(again.sum(dtype=np.uint64).view(np.int64)))
                keys.append(_packed(segment_keys(items, bands)) if len(items) else b"")
                signatures.append(signature(items, percent))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(firsts, pa.int64()),
                    pa.array(seconds, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "hash1", "hash2", "keys", "signature"],
            )

    return run


def _packed_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as steps, byte by byte: all lowest bytes first, so that a shuffle compresses them."""
    steps = np.diff(ids, prepend=np.int64(0)).astype("<i8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpacked_ids(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8).reshape(8, -1).T.copy()
    return np.cumsum(steps.view("<i8").reshape(-1))


def _combine(parts: int) -> Callable[[Batches], Batches]:
    """Buckets (doc_id, keys) of a batch of documents dealt to parts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            counts = np.array([len(b) // KEY_BYTES for b in blobs], np.int64)
            keys = _unpacked(b"".join(blobs))
            owners = np.repeat(batch.column(0).to_numpy(), counts)[keys != 0]
            keys = keys[keys != 0]
            part = (keys % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((owners, part))
            keys, owners, part = keys[order], owners[order], part[order]
            rows = []
            for p in np.unique(part):
                low, high = np.searchsorted(part, [p, p + 1])
                owner, count = np.unique(owners[low:high], return_counts=True)
                held = _packed_ids(owner), count.astype("<u4").tobytes()
                rows.append((int(p), *held, _packed(keys[low:high])))
            names = ["part", "owners", "counts", "keys"]
            kinds = [pa.int64(), *[pa.binary()] * 3]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def _meet(batches: Batches) -> Batches:
    """Members of the buckets of a part that have two or more: the bucket, its number of members, the
    member and the first ones by a hash, which the others are compared with."""
    keys, owners = [], []
    for batch in batches:
        for owner, count, key in zip(*[c.to_pylist() for c in batch.columns[1:]]):
            keys.append(_unpacked(key))
            owners.append(np.repeat(_unpacked_ids(owner), np.frombuffer(count, "<u4")))
    if not keys:
        return
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    same = key[1:] == key[:-1]
    met = np.r_[same, False] | np.r_[False, same]
    key, owner = key[met], owner[met]
    order = np.lexsort((owner, mixed(owner.astype(np.uint64)), key))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[start, len(key)])
    first, members = np.repeat(start, count), np.repeat(count, count)
    heads = [owner[first + np.minimum(r, members - 1)] for r in range(ROUNDS)]
    columns = [key.astype(np.int64), members, owner, *heads]
    columns = [c[members > 1] for c in columns]
    names = ["key", "members", "id", *[f"head{r}" for r in range(ROUNDS)]]
    for low in range(0, len(columns[0]), 50_000):
        yield pa.record_batch([pa.array(c[low : low + 50_000]) for c in columns], names=names)


def _sets(k: int) -> Callable[[Batches], Batches]:
    """Sets of the texts, a few documents at a time."""

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for low in range(0, whole.num_rows, 256):
                batch = whole.slice(low, 256)
                found = [shingles(t, k) for t in batch.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                items = np.concatenate(found).view(np.int64)
                yield pa.record_batch(
                    [batch.column(0), pa.ListArray.from_arrays(ends, items)], names=["id", "items"]
                )

    return run


def _verified(
    pairs: DataFrame, facts: DataFrame | None, docs: DataFrame, k: int, percent: int
) -> DataFrame:
    """Stored (a, b) for the linked ones of candidate pairs (a, b); sets are made of the texts of
    documents in pairs that sizes and signatures leave possible, which without ``facts`` all are."""
    near = stored(_possible(pairs, facts, percent) if facts else pairs, "jaccard-possible")
    ids = stored(
        near.select(F.col("a").alias("id")).union(near.select("b")).distinct(), "jaccard-ids"
    )
    wanted = docs.join(
        counted_broadcast(ids, ids.count()), F.col("doc_id") == F.col("id"), "left_semi"
    )
    sets = stored(wanted.mapInArrow(in_parts(_sets(k)), "id bigint, items array<bigint>"), "jaccard-sets")
    with_a = near.select("a", "b").join(sets.toDF("a", "items_a"), "a")
    common = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - common
    checked = with_a.join(sets.toDF("b", "items_b"), "b").select(
        "a", "b", (100 * common >= percent * union).alias("linked")
    )
    out = stored(checked.where("linked").select("a", "b").distinct(), "jaccard-linked")
    discard(near, ids, sets)
    return out


def _labelled(labels: DataFrame, column: str, name: str) -> DataFrame:
    return labels.select(F.col("node").alias(column), F.col("component").alias(name))


def _with_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds the components of both ends; a document without links is its own."""
    return (
        pairs.join(_labelled(labels, "a", "_la"), "a", "left")
        .join(_labelled(labels, "b", "_lb"), "b", "left")
        .withColumns({"la": F.coalesce("_la", "a"), "lb": F.coalesce("_lb", "b")})
        .drop("_la", "_lb")
    )


def jaccard_components(
    docs: DataFrame, k: int = 5, percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Classes of documents connected by links, and the links that were verified.

    ``docs`` has doc_id and text; other columns are ignored. First result: one row per row of
    ``docs`` with doc_id, n_shingles, class_id (smallest doc_id with an equal set) and
    component_id (smallest doc_id reachable by links). Second result: verified links (a, b)
    between class representatives that connect every component; a link inside a component that
    is already connected need not be among them.

    Null, empty or blank texts have an empty set and are linked with nothing; a text of fewer
    than ``k`` words is one shingle. Rows that repeat a doc_id are judged by their own text.
    An empty table gives no row.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = (
        "doc_id bigint, n_shingles bigint, hash1 bigint, hash2 bigint, keys binary, signature binary"
    )
    described = stored(docs.mapInArrow(in_parts(_describe(k, percent)), schema), "jaccard-keys")
    sets = ["n_shingles", "hash1", "hash2"]
    filled = described.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy(*sets).agg(F.min("doc_id").alias("class_id"))
    members = stored(
        described.select("doc_id", *sets)
        .join(classes, sets, "left")
        .select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id")),
        "jaccard-classes",
    )
    reps = _representatives(described, members)
    entries = filled.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    tasks = tasks_for(spark, entries // KEY_BYTES, TASK_ENTRIES)
    blocks = reps.select("doc_id", "keys").mapInArrow(
        in_parts(_combine(4 * tasks)), "part bigint, owners binary, counts binary, keys binary"
    )
    heads = ", ".join(f"head{r} bigint" for r in range(ROUNDS))
    met = blocks.repartition(tasks, "part").mapInArrow(
        giving_back(_meet), f"key bigint, members bigint, id bigint, {heads}"
    )
    buckets = stored(met, "jaccard-buckets")
    ids = stored(buckets.select("id").distinct(), "jaccard-met")
    facts = stored(
        _among(reps.select("doc_id", "n_shingles", "signature"), ids), "jaccard-facts"
    )
    links = no_rows(spark, "a bigint, b bigint")
    labels = no_rows(spark, "node bigint, component bigint")
    tested: list[DataFrame] = []
    for r in range(ROUNDS + 1):
        if r < ROUNDS:
            pairs = buckets.where(f"id != head{r}").select(
                F.least("id", f"head{r}").alias("a"), F.greatest("id", f"head{r}").alias("b")
            )
            pairs = pairs.distinct()
        else:
            pairs = _across(docs, reps, members, buckets, labels, k, percent)
        if tested:
            pairs = _with_labels(pairs, labels).where("la != lb").select("a", "b")
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        tested.append(stored(pairs, "jaccard-pairs"))
        if not tested[-1].limit(1).count():
            continue
        found = _verified(tested[-1], facts if r < ROUNDS else None, docs, k, percent)
        if found.limit(1).count():
            links = links.unionByName(found)
            labels = stored(components(links), "jaccard-labels")
    result = (
        members.join(_labelled(labels, "class_id", "_c"), "class_id", "left")
        .withColumn("component_id", F.coalesce("_c", "class_id"))
        .select("doc_id", "n_shingles", "class_id", "component_id")
    )
    discard(described, buckets, ids, facts, *tested)
    return result, links


def _representatives(described: DataFrame, members: DataFrame) -> DataFrame:
    """The described documents that stand for their class; the others' ids are the shorter list."""
    others = (
        members.groupBy(F.col("doc_id").alias("id"))
        .agg(F.max(F.col("class_id") == F.col("doc_id")).alias("stands"))
        .where("not stands")
        .select("id")
    )
    filled = described.where("n_shingles > 0 and doc_id is not null")
    others = counted_broadcast(others, others.count())
    return filled.join(others, F.col("doc_id") == F.col("id"), "left_anti")


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is in the column id."""
    ids = ids.select("id")
    return docs.join(counted_broadcast(ids, ids.count()), F.col("doc_id") == F.col("id"), "left_semi")


def _open_entries(
    bands: Bands, skipped: list[tuple[int, int]]
) -> Callable[[Batches], Batches]:
    """Rows (id, place, key, first) of the wanted buckets of documents outside the skipped segments,
    with their further columns. ``first`` has the smallest of these buckets. Documents come with
    doc_id, keys and n_shingles first and wanted last; rows are only made of buckets that are wanted,
    and a batch of them holds little more than ``HELD`` bytes."""
    left_out = {}
    for band, segment in skipped:
        left_out.setdefault(band, []).append(segment)

    def wanted_places(blob: bytes, size: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = _unpacked(blob).view(np.int64)
        hit = np.isin(keys, wanted)
        start = 0
        for band in bands.of(size):
            segments = np.array(left_out.get(band, []), np.int64)
            hit[start + segments] = False
            start += bands.segments(band)
        places = np.flatnonzero(hit)
        return places, keys[places]

    def made(batch: pa.RecordBatch, owners: list, places: list, keys: list, firsts: list):
        counts = [len(x) for x in places]
        owner = pa.array(np.repeat(np.array(owners, np.int64), counts))
        first = pa.array(firsts, pa.binary()).take(
            pa.array(np.repeat(np.arange(len(counts)), counts))
        )
        columns = [c.take(owner) for c in batch.columns[2:-1]]
        return pa.record_batch(
            [
                batch.column(0).take(owner),
                pa.array(np.concatenate(places)),
                pa.array(np.concatenate(keys)),
                first,
                *columns,
            ],
            names=["id", "place", "key", "first", *batch.schema.names[2:-1]],
        )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            each = [c.nbytes // max(1, batch.num_rows) for c in batch.columns[2:-1]]
            at = batch.schema.get_field_index("signature")
            held: tuple[list, list, list, list] = ([], [], [], [])
            total = 0
            for i in range(batch.num_rows):
                wanted = batch.column(batch.num_columns - 1)[i].values.to_numpy(zero_copy_only=False)
                places, keys = wanted_places(
                    batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), wanted
                )
                if not len(places):
                    continue
                row = len(batch.column(at)[i].as_py()) if at >= 0 else sum(each)
                first = np.sort(keys)[:FIRST].astype("<i8").tobytes()
                for to, value in zip(held, (i, places, keys, first)):
                    to.append(value)
                total += len(places) * (row + 8 * FIRST + 48)
                if total > HELD:
                    yield made(batch, *held)
                    held, total = ([], [], [], []), 0
            if held[0]:
                yield made(batch, *held)

    return run


def _across(
    docs: DataFrame,
    reps: DataFrame,
    members: DataFrame,
    buckets: DataFrame,
    labels: DataFrame,
    k: int,
    percent: int,
) -> DataFrame:
    """Possible pairs (a, b) between components in the buckets that the rounds left open."""
    ends = buckets.where(F.col("members") > ROUNDS + 1).select("key", "id", *buckets.columns[3:])
    apart = _with_labels(ends.withColumnsRenamed({"id": "a", "head0": "b"}), labels).where("la != lb")
    left = ends.where(" and ".join(f"id != head{r}" for r in range(ROUNDS)))
    left = left.join(apart.select("key").distinct(), "key", "left_semi")
    wanted = stored(
        left.groupBy(F.col("id").alias("doc_id")).agg(F.collect_set("key").alias("wanted")), "jaccard-open"
    )
    if not wanted.limit(1).count():
        return buckets.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    # Everything a bucket's row needs is joined per document, before the buckets are written out.
    whole = stored(
        _among(reps, wanted.select(F.col("doc_id").alias("id")))
        .join(wanted, "doc_id")
        .join(_labelled(labels, "doc_id", "_c"), "doc_id", "left")
        .select(
            "doc_id", "keys", "n_shingles", F.coalesce("_c", "doc_id").alias("comp"), "signature", "wanted"
        ),
        "jaccard-whole",
    )
    discard(wanted)
    kinds = "id bigint, place bigint, key bigint, first binary, n_shingles bigint, comp bigint"
    bands = Bands.up_to(max(1, members.agg(F.max("n_shingles")).first()[0] or 1), percent)
    plain = whole.drop("signature").mapInArrow(in_parts(_open_entries(bands, [])), kinds)
    skipped, doubled = _allocation(plain, members, bands)
    rows = whole.mapInArrow(in_parts(_open_entries(bands, skipped)), f"{kinds}, signature binary")
    entries = rows.select("key", "id", "n_shingles", "comp", "signature", "first")
    more = _deleted(docs, members, labels, bands, doubled, k)
    if more is not None:
        firsts = rows.groupBy("id").agg(F.first("first").alias("first"))
        signatures = reps.select(F.col("doc_id").alias("id"), "signature")
        more = more.join(signatures, "id").join(firsts, "id", "left")
        entries = entries.unionByName(more.select(*entries.columns))
    return (
        entries.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(in_parts(_compared(percent)), "a bigint, b bigint")
        .distinct()
    )


#: Bytes of signatures compared at once, and of rows of open buckets made at once.
COMPARED = 8_000_000
HELD = 8_000_000


def _shared_before(one: np.ndarray, two: np.ndarray, key: int) -> np.ndarray:
    """Whether rows of two arrays of buckets have one in common that is smaller than this one."""
    none = np.iinfo(np.int64).max
    one, two = (np.where(x < key, x, none) for x in (one, two))
    found = np.zeros(len(one), bool)
    for column in one.T:
        found |= ((two == column[:, None]) & (column != none)[:, None]).any(axis=1)
    return found


def _compared(percent: int) -> Callable[[Batches], Batches]:
    """Pairs across components in each bucket that sizes and signatures leave possible. Rows come
    sorted by bucket; a bucket is compared in blocks, and nothing is emitted for the other pairs, nor
    for those that share a smaller bucket by their last column: near copies share almost all."""

    def pairs_of(sizes, comps, signatures, firsts, key) -> np.ndarray:
        """Places (i, j) of possible pairs. Rows of the largest component are not compared with one
        another: they come last, and each other row meets the rows after it."""
        found, counts = np.unique(comps, return_counts=True)
        order = np.argsort(comps == found[counts.argmax()], kind="stable")
        others = len(comps) - int(counts.max())
        width = min(map(len, signatures))
        rows, sizes, comps = folded(signatures, width)[order], sizes[order], comps[order]
        firsts = firsts[order]
        pairs = []
        low = 0
        while low < others:
            end = min(others, low + max(1, COMPARED // ((len(rows) - low) * width)))
            apart = np.stack([least_apart(rows[low:], rows[i]) for i in range(low, end)])
            close = apart <= most_apart(sizes[low:end, None], sizes[None, low:], percent)
            close &= comps[low:end, None] != comps[None, low:]
            one, two = np.nonzero(close)
            one, two = one[one < two] + low, two[one < two] + low
            new = ~_shared_before(firsts[one], firsts[two], key)
            pairs.append(np.stack([one[new], two[new]], 1))
            low = end
        return order[np.concatenate(pairs)]

    def flush(held: list[tuple]) -> Batches:
        ids, sizes, comps = (np.array([r[i] for r in held], np.int64) for i in (1, 2, 3))
        if len(held) < 2 or (comps == comps[0]).all():
            return
        firsts = np.full((len(held), FIRST), np.iinfo(np.int64).max)
        for i, row in enumerate(held):
            smallest = np.frombuffer((row[5] if len(row) > 5 else None) or b"", "<i8")
            firsts[i, : len(smallest)] = smallest
        at = pairs_of(sizes, comps, [r[4] for r in held], firsts, held[0][0])
        at = np.where((ids[at[:, 0]] > ids[at[:, 1]])[:, None], at[:, ::-1], at)
        at = at[ids[at[:, 0]] != ids[at[:, 1]]]
        if len(at):
            columns = [ids[at[:, 0]], ids[at[:, 1]]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["a", "b"])

    def run(batches: Batches) -> Batches:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[0][0]:
                    yield from flush(held)
                    held = []
                held.append(row)
        if held:
            yield from flush(held)

    return run


def _with_segment(rows: DataFrame, bands: Bands) -> DataFrame:
    """Band and segment of an entry, from the size of its set and its place among the entries."""
    edges = F.array(*[F.lit(e).cast("bigint") for e in bands.edges])
    own = (F.size(F.filter(edges, lambda e: e <= F.col("n_shingles"))) - 1).cast("int")
    counts = F.array(*[F.lit(bands.segments(b)) for b in range(len(bands.edges) - 1)])
    in_own = F.element_at(counts, F.col("_own") + 1)
    next_one = F.col("place") >= in_own
    return rows.withColumn("_own", own).withColumns(
        {
            "_band": F.col("_own") + next_one.cast("int"),
            "_segment": F.col("place") - F.when(next_one, in_own).otherwise(0),
        }
    ).drop("_own")


def _allocation(
    rows: DataFrame, members: DataFrame, bands: Bands
) -> tuple[list[tuple[int, int]], dict[int, list[int]]]:
    """Segments to leave out, and per band those to match with one deletion instead.

    A segment's cost is the number of pairs across components in its buckets. Leaving it out
    needs another of the band doubled, which costs an entry per set and shingle of the segment;
    only swaps that save are made. Costs are summed per segment; segments cheaper than any swap
    stay in Spark.
    """
    per_bucket = (
        _with_segment(rows, bands)
        .groupBy("_band", "_segment", "key", "comp")
        .agg(F.count("*").alias("n"))
        .groupBy("_band", "_segment", "key")
        .agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"))
    )
    costs = per_bucket.groupBy("_band", "_segment").agg(F.sum("pairs").alias("cost"))
    edges = F.array(*[F.lit(e).cast("bigint") for e in bands.edges])
    band = (F.size(F.filter(edges, lambda e: e <= F.col("n_shingles"))) - 1).cast("int")
    sets = {
        r["band"]: r["n"]
        for r in members.where("n_shingles > 0 and class_id = doc_id")
        .groupBy(band.alias("band"))
        .agg(F.count("*").alias("n"))
        .collect()
    }
    skipped: list[tuple[int, int]] = []
    doubled: dict[int, list[int]] = {}
    # A doubled segment costs at least the sets of the band, so cheaper ones need no look.
    for r in costs.where(F.col("cost") > SWAP_COST).orderBy(F.desc("cost")).collect():
        b, m = r["_band"], bands.segments(r["_band"])
        near = sets.get(b, 0) + sets.get(b - 1, 0)
        if r["cost"] <= ENTRY_COST * near * (1 + bands.edges[b + 1] / m):
            continue
        used = {s for c, s in skipped if c == b} | set(doubled.get(b, []))
        free = [s for s in range(m) if s not in used and s != r["_segment"]]
        if r["_segment"] in doubled.get(b, []) or not free:
            continue
        skipped.append((b, r["_segment"]))
        doubled.setdefault(b, []).append(free[-1])
    return skipped, doubled


def _deleted(
    docs: DataFrame,
    members: DataFrame,
    labels: DataFrame,
    bands: Bands,
    doubled: dict[int, list[int]],
    k: int,
) -> DataFrame | None:
    """One-deletion entries (id, key, n_shingles, comp) of the sets in bands with swaps."""
    if not doubled:
        return None

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                items = shingles(text, k)
                for band in bands.of(len(items)) if len(items) else []:
                    if band in doubled:
                        m = bands.segments(band)
                        keys.append(deletion_keys(items, band, m, doubled[band]).astype(np.int64))
                        ids.append(np.full(len(keys[-1]), doc_id, np.int64))
            if ids:
                yield pa.record_batch(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys))],
                    names=["id", "key"],
                )

    reps = members.where("class_id = doc_id and n_shingles > 0").select(
        F.col("doc_id").alias("id"), "n_shingles"
    )
    return (
        docs.mapInArrow(run, "id bigint, key bigint")
        .join(reps.distinct(), "id")
        .join(_labelled(labels, "id", "_c"), "id", "left")
        .select("id", "key", "n_shingles", F.coalesce("_c", "id").alias("comp"))
    )
