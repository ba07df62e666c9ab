"""Product codes of vectors by Lloyd's iteration over two trees, in whole numbers.

Components become integers, vectors are cut into parts, and every part position has a codebook. The
vectors are stored once in blocks; a block holds, for each part position, a tree over its parts
(boxes, counts and sums of the nodes, parts in tree order). In a round, each block is walked together
with a small tree over the codebook's entries: a pair of nodes is dropped when the entry node's
least possible distance to the box exceeds another entry node's greatest one. A node left with one
entry is assigned whole, by its stored count and sum; in leaves with several entries the integer
distances decide, ties by the lower index. Blocks return sums per entry, so one round moves at most
entries times dimension numbers per task, whatever the number of vectors.

All sums and distances are exact: 64-bit integers where the components of the block allow it, Python
integers else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.llm.common import counted_broadcast, discard, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block, and parts in a leaf of its trees, at most.
BLOCK, LEAF = 2_048, 16
#: A component this large or larger counts as not finite.
LARGEST = float(2**50)
_LONG = 2**63 - 1


@dataclass(frozen=True)
class Tree:
    """Nodes in breadth-first order; node i holds the rows order[first[i]:last[i]]."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray  # the left child, the right one follows it; -1 in leaves
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def build_tree(rows: np.ndarray, leaf: int) -> Tree:
    """Halves the rows along the widest side of their box until ``leaf`` rows are left."""
    order = np.arange(len(rows))
    spans, left, low, high, sums = [(0, len(rows))], [], [], [], []
    node = 0
    while node < len(spans):
        first, last = spans[node]
        held = rows[order[first:last]]
        low.append(held.min(axis=0))
        high.append(held.max(axis=0))
        sums.append(held.sum(axis=0))
        sides = high[-1] - low[-1]
        if last - first > leaf and (sides > 0).any():
            middle = (last - first) // 2
            values = held[:, int(np.argmax(sides))]
            order[first:last] = order[first:last][np.argsort(values, kind="stable")]
            left.append(len(spans))
            spans += [(first, first + middle), (first + middle, last)]
        else:
            left.append(-1)
        node += 1
    firsts, lasts = np.array(spans).T
    return Tree(order, firsts, lasts, np.array(left), np.array(low), np.array(high), np.array(sums))


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry."""
    return np.stack([((points - entry) ** 2).sum(axis=1) for entry in entries], axis=1)


def _pair_bounds(tree: Tree, nodes: np.ndarray, book: Tree, others: np.ndarray):
    """Least and greatest squared distance between the boxes of each pair of nodes."""
    below = book.low[others] - tree.high[nodes]
    above = tree.low[nodes] - book.high[others]
    apart = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(book.high[others] - tree.low[nodes], tree.high[nodes] - book.low[others])
    return (apart * apart).sum(axis=1), (reach * reach).sum(axis=1)


def nearest_entries(
    rows: np.ndarray, tree: Tree, entries: np.ndarray, book: Tree
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of every row (ties: the lower index), and the rows' counts and sums per
    entry; whole nodes add their stored sums."""
    chosen = np.zeros(len(rows), np.int64)
    counts = np.zeros(len(entries), np.int64)
    sums = np.zeros(entries.shape, rows.dtype)
    nodes, others = np.zeros(1, np.int64), np.zeros(1, np.int64)
    uncertain: list[np.ndarray] = []
    while len(nodes):
        # Entry nodes are opened first, then pairs of which no entry of the node can be nearest go.
        inner = book.left[others] >= 0
        nodes = np.concatenate([nodes[~inner], nodes[inner], nodes[inner]])
        others = np.concatenate([others[~inner], book.left[others[inner]], book.left[others[inner]] + 1])
        least, greatest = _pair_bounds(tree, nodes, book, others)
        by = np.argsort(nodes, kind="stable")
        nodes, others, least, greatest = nodes[by], others[by], least[by], greatest[by]
        heads = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        best = np.minimum.reduceat(greatest, heads)
        near = least <= np.repeat(best, np.diff(np.r_[heads, len(nodes)]))
        nodes, others = nodes[near], others[near]
        heads = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        sizes = np.diff(np.r_[heads, len(nodes)])
        settled = np.minimum.reduceat(book.left[others] < 0, heads)
        whole = settled & (sizes == 1)
        for node, other in zip(nodes[heads[whole]].tolist(), others[heads[whole]].tolist()):
            # Equal entries share a leaf of the codebook's tree; the lowest index stands for them.
            pick = int(book.order[book.first[other] : book.last[other]].min())
            chosen[tree.order[tree.first[node] : tree.last[node]]] = pick
            counts[pick] += tree.last[node] - tree.first[node]
            sums[pick] += tree.sums[node]
        leaves = settled & ~whole & (tree.left[nodes[heads]] < 0)
        uncertain += [tree.order[tree.first[n] : tree.last[n]] for n in nodes[heads[leaves]].tolist()]
        opened = np.repeat(~whole & ~leaves, sizes)
        nodes, others = nodes[opened], others[opened]
        last = tree.left[nodes] < 0
        child = tree.left[nodes[~last]]
        nodes = np.concatenate([nodes[last], child, child + 1])
        others = np.concatenate([others[last], others[~last], others[~last]])
    if uncertain:
        held = np.concatenate(uncertain)
        points = rows[held]
        picked = _distances(points, entries).argmin(axis=1)
        chosen[held] = picked
        for pick in np.unique(picked).tolist():
            mine = picked == pick
            counts[pick] += np.count_nonzero(mine)
            sums[pick] += points[mine].sum(axis=0)
    return chosen, counts, sums


def _exact(rows: np.ndarray, width: int) -> np.ndarray:
    """The integers in a type whose distances, and sums over a block, can't overflow."""
    largest = max(int(rows.max(initial=0)), -int(rows.min(initial=0)))
    if max(4 * largest * largest * max(width, 1), largest * BLOCK) < _LONG:
        return rows
    return rows.astype(object)


def part_bounds(dimension: int, parts: int) -> list[tuple[int, int]]:
    return [(i * dimension // parts, (i + 1) * dimension // parts) for i in range(parts)]


TREE_FIELDS = ("order", "first", "last", "left", "low", "high", "sums")


def _packed(tree: Tree) -> dict:
    """The tree's arrays as 64-bit integers; sums too large for them are left to ``_unpacked``."""
    kept = {f: getattr(tree, f) for f in TREE_FIELDS}
    if tree.sums.dtype == object:
        kept["sums"] = np.zeros(tree.sums.shape)
    return {f: np.ascontiguousarray(a.astype(np.int64)).ravel() for f, a in kept.items()}


def _unpacked(trees: pa.StructArray, place: int, rows: np.ndarray, exact: bool) -> Tree:
    shaped = {f: trees.field(f)[place].values.to_numpy(zero_copy_only=False) for f in TREE_FIELDS}
    for f in ("low", "high", "sums"):
        shaped[f] = shaped[f].reshape(-1, rows.shape[1])
        shaped[f] = shaped[f].astype(object) if exact else shaped[f]
    if rows.dtype == object:
        spans = zip(shaped["first"], shaped["last"])
        shaped["sums"] = np.array([rows[shaped["order"][a:b]].sum(axis=0) for a, b in spans], object)
    return Tree(**shaped)


def _block_builder(dimension: int, parts: int, names: list[str]) -> Callable:
    bounds = part_bounds(dimension, parts)

    def block(held: pa.Table) -> pa.RecordBatch:
        flat = held.column("ints").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(held.num_rows, dimension)
        trees = []
        for at, end in bounds:
            part = rows[:, at:end]
            trees.append(_packed(build_tree(_exact(part, end - at), LEAF)) if end > at else None)
        kept = [pa.array([held.column(n).combine_chunks().to_pylist()], pa.list_(held.schema.field(n).type))
                for n in names]
        kept.append(pa.array([flat], pa.list_(pa.int64())))
        kept.append(
            pa.array(
                [[{f: t[f] for f in TREE_FIELDS} if t else None for t in trees]],
                pa.list_(pa.struct([(f, pa.list_(pa.int64())) for f in TREE_FIELDS])),
            )
        )
        return pa.RecordBatch.from_arrays(kept, names=[*names, "ints", "trees"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            while count >= BLOCK:
                together = pa.Table.from_batches(waiting)
                yield block(together.slice(0, BLOCK))
                waiting, count = together.slice(BLOCK).to_batches(), count - BLOCK
        if count:
            yield block(pa.Table.from_batches(waiting))

    return build


def _walked(batch: pa.RecordBatch, books: list[np.ndarray], dimension: int):
    """For every block and part position: rows, codes, counts and sums."""
    bounds = part_bounds(dimension, len(books))
    for i in range(batch.num_rows):
        flat = batch.column("ints")[i].values.to_numpy(zero_copy_only=False)
        rows = flat.reshape(-1 if dimension else len(batch.column(0)[i]), dimension)
        trees = batch.column("trees")[i].values
        walked = []
        for place, ((at, end), book) in enumerate(zip(bounds, books)):
            part = _exact(rows[:, at:end], end - at)
            if end == at:
                walked.append((part, np.zeros(len(rows), np.int64), None, None))
                continue
            entries = _exact(book, end - at)
            exact = object in (entries.dtype, part.dtype)
            tree = _unpacked(trees, place, part, exact)
            if exact:
                entries, part = entries.astype(object), part.astype(object)
            walked.append((part, *nearest_entries(part, tree, entries, build_tree(entries, 1))))
        yield i, walked


def _round_summer(books: list[np.ndarray], dimension: int) -> Callable:
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), object) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for _, walked in _walked(batch, books, dimension):
                for part, (_, _, n, s) in enumerate(walked):
                    if n is not None:
                        counts[part] += n
                        sums[part] += s
        rows = [
            (part, entry, place, int(counts[part][entry]), str(value))
            for part in range(len(books))
            for entry in np.flatnonzero(counts[part] > 0).tolist()
            for place, value in enumerate(sums[part][entry].tolist())
        ]
        if rows:
            columns = [pa.array(list(c)) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "n", "total"])

    return total


def _coder(books: list[np.ndarray], dimension: int, names: list[str]) -> Callable:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, walked in _walked(batch, books, dimension):
                error, digits = 0, []
                for (part, chosen, n, _), book in zip(walked, books):
                    digits.append(chosen)
                    if n is not None:
                        gaps = part - book.astype(part.dtype)[chosen]
                        error = error + (gaps * gaps).sum(axis=1)
                codes = ["".join(f"{d:02x}" for d in row) for row in np.stack(digits, axis=1).tolist()]
                whole = np.broadcast_to(np.asarray(error, object), len(codes))
                errors = [int(e) if e <= _LONG else None for e in whole]
                kept = [batch.column(name)[i].values for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                    names=[*names, "code", "error"],
                )

    return code


def whole_components(vector: Column, scale: int) -> Column:
    """The vector's components times ``scale``, rounded down; null unless all are finite."""
    usable = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < LARGEST),
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(vector.isNotNull() & usable, whole)


@dataclass(frozen=True)
class Codebooks:
    """Entries by part position, an array of (entries, width) integers each."""

    books: list[np.ndarray]

    def sha256(self) -> str:
        numbers = [str(int(x)) for book in self.books for entry in book for x in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _first_books(kept: DataFrame, dimension: int, parts: int, entries: int) -> list[np.ndarray]:
    order = [F.col("id").asc_nulls_last(), F.array_join("ints", ",")]
    first = kept.orderBy(*order).limit(entries).select("ints").collect()
    rows = np.array([r["ints"] for r in first], np.int64).reshape(len(first), dimension)
    return [rows[:, at:end] for at, end in part_bounds(dimension, parts)]


def _next_books(books: list[np.ndarray], sums: list) -> list[np.ndarray]:
    new = [book.copy() for book in books]
    for row in sums:
        new[row["part"]][row["entry"], row["place"]] = int(row["total"]) // row["n"]
    return new


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds the sum of errors over rows of an equal label; a label on a large share of the rows is
    summed before the shuffle and joined by broadcast, one row per hot label."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    totals = stored(totals, "label-errors").withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    rows = totals.agg(F.count("*").alias("c"), F.sum("n").alias("n")).first()
    if rows["c"] <= 2_000:
        return coded.join(F.broadcast(totals.drop("n")), same, "left").drop("_label")
    # At most 500 labels hold a share of 1/500 each; they are joined without a shuffle.
    hot = F.col("n") * 500 >= F.lit(rows["n"])
    near = coded.join(F.broadcast(totals.where(hot).drop("n")), same, "left")
    rest = near.where("label_error is null").drop("_label", "label_error")
    cold = rest.join(totals.where(~hot).drop("n"), same, "left").drop("_label")
    return near.where("label_error is not null").drop("_label").unionByName(cold)


def compress_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Rows (id, label, code, error, label_error) and the final codebooks.

    Left out: vectors that are null, hold null, NaN, infinite components or such of 2**50 or more in
    size, and vectors of another length than that of the smallest id's vector. Parts are equal where
    ``parts`` divides the length, else as near as can be. Codebooks start as the parts of the
    ``entries`` smallest ids (null ids last, repeated ids by their vector), fewer if there are fewer
    rows. ``code`` has two hex digits per part; ``error`` is null where it exceeds a long. Repeated
    rows are answered one by one; null labels count as one label; no rows give no rows and empty
    codebooks. Other columns are not read.
    """
    spark: SparkSession = vectors.sparkSession
    ids, labels = vectors.schema[id_col].dataType, vectors.schema[label_col].dataType
    kept = vectors.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{label_col}`").alias("label"),
        whole_components(F.col(f"`{vector_col}`"), scale).alias("ints"),
    ).where("ints is not null")
    least = kept.orderBy(F.col("id").asc_nulls_last(), F.array_join("ints", ",")).limit(1).collect()
    dimension = len(least[0]["ints"]) if least else 0
    kept = kept.where(F.size("ints") == dimension)
    books = _first_books(kept, dimension, parts, entries)
    names = ["id", "label"]
    tree = T.StructType([T.StructField(f, T.ArrayType(T.LongType())) for f in TREE_FIELDS])
    block = T.StructType(
        [
            T.StructField("id", T.ArrayType(ids)),
            T.StructField("label", T.ArrayType(labels)),
            T.StructField("ints", T.ArrayType(T.LongType())),
            T.StructField("trees", T.ArrayType(tree)),
        ]
    )
    blocks = stored(kept.mapInArrow(_block_builder(dimension, parts, names), block), "vector-blocks")
    for _ in range(rounds):
        sums = (
            blocks.select("ints", "trees")
            .mapInArrow(
                _round_summer(books, dimension), "part bigint, entry bigint, place bigint, n bigint, total string"
            )
            .groupBy("part", "entry", "place")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
            .collect()  # at most entries x dimension rows
        )
        books = _next_books(books, sums)
    out = T.StructType(
        [
            T.StructField("id", ids),
            T.StructField("label", labels),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )
    coded = stored(blocks.mapInArrow(_coder(books, dimension, names), out), "vector-codes")
    discard(blocks)
    found = label_errors(coded).withColumnsRenamed({"id": id_col, "label": label_col})
    return found, Codebooks(books)
