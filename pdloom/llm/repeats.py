"""Repeated byte strings across and within texts, by interval trees over sparse suffix arrays.

Every string of ``length`` bytes chooses one of its grams of 32 bytes, the leftmost with the least
hash, so that equal strings choose the same place: its anchor. Anchors are about ``length`` / 2
bytes apart. An anchor's context is all that strings around it can hold: ``length`` - 32 bytes
before its gram and ``length`` bytes from it on, cut at the ends of the text.

* Occurrences are counted per (gram, context) before the shuffle. A context that occurs twice is a
  repeat as a whole, whatever the number of copies.
* Contexts that occur once share a string with another place only if another context has their
  gram. Those are sorted by what follows the anchor: a suffix array. A stack scan of its common
  prefixes yields the interval tree; in every interval the reversed left contexts are sorted, and
  where they agree the repeat is extended to the left, up to the place where its occurrences differ.
  The strings so found can be extended neither way without losing an occurrence.
* A gram with more contexts than one task should hold is compared by its strings themselves, each
  counted per (gram, place in the context, hash).

A document's bytes lie in one row; its memory use is that of its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.llm.common import discard, stored

LENGTH, GRAM = 200, 32
#: Contexts of one gram that one task sorts at most.
GROUP = 4_096
#: Bytes of text, strings hashed, and rows of contexts a Python worker handles at once.
SLICE, STRINGS, ROWS = 2_000_000, 1 << 16, 8_192


@dataclass(frozen=True)
class Shape:
    """Sizes that follow from the length of a repeat."""

    length: int

    @property
    def before(self) -> int:
        return self.length - GRAM

    @property
    def width(self) -> int:
        """Bytes of a stored context, a multiple of eight."""
        return -(-(self.before + self.length) // 8) * 8


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from every place on, by halves."""
    out = data.astype(np.uint64)
    for size in (1, 2, 4):
        out = out[:-size] | (out[size:] << np.uint64(8 * size))
    out = _mixed(out + np.uint64(0x5851F42D4C957F2D))
    for size in (8, 16):
        out = _mixed(out[:-size] * np.uint64(0xA24BAED4963EE407) + out[size:])
    return out


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least value in every window of ``width`` values.

    The place replaces the low bits of a value, so one minimum finds both, and equal high bits go to
    the left.
    """
    bits = np.uint64((STRINGS + width).bit_length())
    least = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while span < width:
        shift = min(span, width - span)
        least = np.minimum(least[:-shift], least[shift:])
        span += shift
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


@dataclass(frozen=True)
class Anchors:
    """One entry per anchor, by text and place. ``least`` and ``most`` bound the distances from the
    starts of the strings that chose the anchor; ``contexts`` has zeros outside the text."""

    text: np.ndarray
    place: np.ndarray
    least: np.ndarray
    most: np.ndarray
    gram: np.ndarray
    buffer: np.ndarray
    at: np.ndarray
    size: np.ndarray
    shape: Shape

    def contexts(self, picked: np.ndarray) -> np.ndarray:
        return self.buffer[self.at[picked, None] + np.arange(-self.shape.before, self.shape.width - self.shape.before)]

    def context_hashes(self) -> np.ndarray:
        out = np.empty(len(self.at), np.uint64)
        before = np.minimum(self.place, self.shape.before).astype(np.uint64)
        after = np.minimum(self.size - self.place, self.shape.length).astype(np.uint64)
        for first in range(0, len(out), ROWS):
            part = np.arange(first, min(first + ROWS, len(out)))
            words = np.ascontiguousarray(self.contexts(part).view(np.uint64).T)
            held = _mixed(before[part] * np.uint64(65_537) + after[part])
            for column in words:
                held = _mixed(held * np.uint64(3) ^ column)
            out[part] = held
        return out


def anchors_of(texts: list[bytes], shape: Shape) -> Anchors:
    """The anchors of all strings of the texts; shorter texts have none."""
    pad = shape.width
    sizes = np.array([len(t) if len(t) >= shape.length else 0 for t in texts], np.int64)
    starts = pad + np.concatenate([[0], np.cumsum(sizes + np.where(sizes > 0, pad, 0))[:-1]]).astype(np.int64)
    total = int(starts[-1] + sizes[-1] + pad) if len(texts) else pad
    buffer = np.zeros(total, np.uint8)
    valid = np.zeros(total, bool)
    for text, start, size in zip(texts, starts.tolist(), sizes.tolist()):
        if size:
            buffer[start : start + size] = np.frombuffer(text, np.uint8)
            valid[start : start + size - shape.length + 1] = True
    chosen, grams, begins, ends = [], [], [], []
    for first in range(0, total - shape.length + 1, STRINGS):
        last = min(first + STRINGS, total - shape.length + 1)
        strings = np.flatnonzero(valid[first:last])
        if not len(strings):
            continue
        hashes = gram_hashes(buffer[first : last + shape.length - 1])
        owner = _least_places(hashes, shape.before + 1)[strings]
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        tails = np.r_[heads[1:], len(owner)] - 1
        chosen.append(owner[heads] + first)
        grams.append(hashes[owner[heads]])
        begins.append(strings[heads] + first)
        ends.append(strings[tails] + first)
    at, gram, begin, end = (
        np.concatenate(x) if x else np.zeros(0, np.int64) for x in (chosen, grams, begins, ends)
    )
    if len(at):  # an anchor whose strings lie on both sides of a cut is one anchor
        heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        tails = np.r_[heads[1:], len(at)] - 1
        at, gram, begin, end = at[heads], gram[heads], begin[heads], end[tails]
    held = np.flatnonzero(sizes > 0)
    text = held[np.searchsorted(starts[held], at, side="right") - 1] if len(at) else at
    place = at - starts[text] if len(at) else at
    return Anchors(
        text, place, at - end, at - begin, gram.astype(np.uint64), buffer, at,
        sizes[text] if len(at) else at, shape,
    )


def _sliced(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in parts of about ``SLICE`` bytes of text, with the texts as bytes."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(text).to_pylist()]
        at = 0
        while at < len(texts):
            end, held = at + 1, len(texts[at])
            while end < len(texts) and held + len(texts[end]) <= SLICE:
                held, end = held + len(texts[end]), end + 1
            yield batch.slice(at, end - at), texts[at:end]
            at = end


def _describer(shape: Shape):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _sliced(batches, 2):
            found = anchors_of(texts, shape)
            if len(found.at):
                rows = pa.array(found.text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.gram.view(np.int64)),
                        pa.array(found.context_hashes().view(np.int64)),
                        part.column(0).take(rows),
                        part.column(1).take(rows),
                        pa.array(found.place),
                    ],
                    names=["gram", "context", "id", "t", "place"],
                )

    return describe


def _extractor(shape: Shape):
    """Contexts of the listed places of each text."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _sliced(batches, 2):
            found = anchors_of(texts, shape)
            lists = part.column(3)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            picks = lists.flatten()
            owner = np.repeat(np.arange(len(texts)), lengths)
            wanted = picks.field("place").to_numpy(zero_copy_only=False).astype(np.int64)
            span = max((len(t) for t in texts), default=0) + 1
            rank = np.searchsorted(found.text * span + found.place, owner * span + wanted)
            for first in range(0, len(rank), ROWS):
                some = rank[first : first + ROWS]
                of, mine = pa.array(owner[first : first + ROWS]), picks.slice(first, len(some))
                bytes_of = np.ascontiguousarray(found.contexts(some)).view(f"V{shape.width}").ravel()
                cut = np.minimum(found.size[some] - found.place[some], shape.length)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[mine.field(n) for n in ("gram", "context", "n", "kin")],
                        part.column(0).take(of),
                        part.column(1).take(of),
                        mine.field("place"),
                        pa.array(np.minimum(found.place[some], shape.before).astype(np.int32)),
                        pa.array(cut.astype(np.int32)),
                        pa.array(found.least[some].astype(np.int32)),
                        pa.array(found.most[some].astype(np.int32)),
                        pa.array(bytes_of.tolist(), pa.binary()),
                    ],
                    names=CONTEXT_NAMES,
                )

    return extract


CONTEXT_NAMES = [
    "gram", "context", "n", "kin", "id", "t", "place", "before", "after", "least", "most", "bytes",
]


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (length, first, last) of a sorted list, inner ones first.

    ``common[i]`` is the common length of entries i - 1 and i; the first one is not read.
    """
    stack, count = [(0, 0)], len(common)
    for i in range(1, count + 1):
        now = common[i] if i < count else 0
        first = i - 1
        while stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if stack[-1][0] < now:
            stack.append((now, first))


def _agreement(rows: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row with the one before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for first in range(1, len(rows), ROWS):
        last = min(first + ROWS, len(rows))
        unequal = rows[first:last] != rows[first - 1 : last - 1]
        same = ~unequal.any(axis=1)
        out[first:last] = np.where(same, rows.shape[1], unequal.argmax(axis=1))
    return np.minimum(out, limit)


class SuffixArray:
    """Contexts of several grams, sorted by gram and what follows the anchor."""

    def __init__(self, grams, before, after, contexts: np.ndarray, shape: Shape):
        self.shape, self.before = shape, before
        # Bytes are shifted by one: zero is the end of a text and equals no byte.
        places = np.arange(shape.length)
        right = contexts[:, shape.before : shape.before + shape.length].astype(np.uint16) + 1
        right[places >= after[:, None]] = 0
        self.left = contexts[:, : shape.before][:, ::-1].astype(np.uint16) + 1
        self.left[np.arange(shape.before) >= before[:, None]] = 0
        self.order = np.lexsort((self._ranks(right), grams))
        self.left_rank = self._ranks(self.left)
        self.common = _agreement(right[self.order], after[self.order])
        new = np.r_[True, grams[self.order][1:] != grams[self.order][:-1]]
        self.common[new] = 0
        self.beside = _agreement(self.left[self.order], before[self.order])

    @staticmethod
    def _ranks(rows: np.ndarray) -> np.ndarray:
        keys = np.ascontiguousarray(rows.astype(">u2")).view(f"S{2 * rows.shape[1]}").ravel()
        ranks = np.empty(len(rows), np.int64)
        ranks[np.argsort(keys, kind="stable")] = np.arange(len(rows))
        return ranks

    def _by_left(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Members of an interval by their left contexts, and how far each agrees with the one before."""
        members = self.order[first : last + 1]
        members = members[np.argsort(self.left_rank[members])]
        return members, _agreement(self.left[members], self.before[members])

    def reaches(self) -> list[list[tuple[int, int]]]:
        """For every context the (left, right) reaches of the strings it shares with others, the
        longest to the right first; each further one reaches more to the left."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.order]
        best = np.full(len(self.order), -1)
        for length, first, last in intervals(self.common.tolist()):
            need = self.shape.length - length
            if need > self.shape.before:
                continue
            if last == first + 1:
                reach = int(self.beside[last])
                pairs = [(int(self.order[first]), reach), (int(self.order[last]), reach)] if reach >= need else []
            else:
                inside = self.order[first : last + 1]
                if (best[inside] >= self.before[inside]).all():
                    continue
                members, agree = self._by_left(first, last)
                reach = np.maximum(agree, np.r_[agree[1:], 0])
                far = (reach >= need) & (reach > best[members])
                pairs = zip(members[far].tolist(), reach[far].tolist())
            for member, left in pairs:
                if left > best[member]:
                    out[member].append((left, length))
                    best[member] = left
        return out

    def groups(self) -> Iterator[tuple[list[int], int, int]]:
        """Maximal repeats: members, reach to the left and reach to the right. The members differ
        both before and after the string, or end there."""
        at = np.empty(len(self.order), np.int64)
        at[self.order] = np.arange(len(self.order))
        for length, first, last in intervals(self.common.tolist()):
            if self.shape.length - length > self.shape.before:
                continue
            members, agree = self._by_left(first, last)
            for left, begin, end in intervals([0, *(agree[1:] + 1).tolist()]):
                held = members[begin : end + 1]
                if left - 1 + length < self.shape.length:
                    continue
                # All within one inner interval: the string goes on to the right for all of them.
                spots = at[held]
                if self.common[spots.min() + 1 : spots.max() + 1].min() == length:
                    yield held.tolist(), left - 1, length


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by their first column, regrouped so that equal values stay together."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        grams = batch.column(0).to_numpy()
        change = np.flatnonzero(np.r_[False, grams[1:] != grams[:-1]])
        if waiting and waiting[-1].column(0)[-1].as_py() != grams[0]:
            change = np.r_[0, change]
        held = sum(b.num_rows for b in waiting)
        if len(change) and held + int(change[-1]) >= ROWS // 2:
            cut = int(change[-1])
            yield pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            waiting = [batch.slice(cut)]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _sorted_contexts(table: pa.Table, shape: Shape) -> tuple[pa.Table, SuffixArray]:
    grams, contexts = (table.column(n).to_numpy() for n in ("gram", "context"))
    _, once = np.unique(np.stack([grams, contexts], axis=1), axis=0, return_index=True)
    table = table.take(pa.array(np.sort(once)))  # repeated rows of one document list a context twice
    grams, before, after = (table.column(n).to_numpy() for n in ("gram", "before", "after"))
    flat = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    return table, SuffixArray(grams, before, after, flat.reshape(-1, shape.width), shape)


REACHES = "array<struct<left: int, right: int>>"
_REACH_TYPE = pa.list_(pa.struct([("left", pa.int32()), ("right", pa.int32())]))


def _reach_finder(shape: Shape):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            table, array = _sorted_contexts(table, shape)
            reaches = array.reaches()
            kept = [i for i, (r, n) in enumerate(zip(reaches, table.column("n").to_pylist())) if r and n == 1]
            if kept:
                rows = table.select(["id", "t", "place"]).take(pa.array(kept)).combine_chunks()
                told = [[{"left": a, "right": b} for a, b in reaches[i]] for i in kept]
                columns = [rows.column(n).combine_chunks() for n in ("id", "t", "place")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(told, _REACH_TYPE)], names=["id", "t", "place", "reaches"]
                )

    return find


def _group_finder(shape: Shape):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            table, array = _sorted_contexts(table, shape)
            grams, contexts = (table.column(n).to_pylist() for n in ("gram", "context"))
            rows = [
                (grams[m], contexts[m], contexts[min(members, key=contexts.__getitem__)], left, right)
                for members, left, right in array.groups()
                for m in members
            ]
            if rows:
                types = [pa.int64()] * 3 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                    names=["gram", "context", "least_context", "left", "right"],
                )

    return find


def _remover(shape: Shape):
    """Spans and kept bytes of each text from the reaches of the contexts that occur once."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _sliced(batches, 1):
            found = anchors_of(texts, shape)
            bounds = np.searchsorted(found.text, np.arange(len(texts) + 1))
            singles = part.column(2).to_pylist()
            spans, kept = [], []
            for i, text in enumerate(texts):
                places = found.place[bounds[i] : bounds[i + 1]]
                single = singles[i] or []
                alone = np.isin(places, [s["place"] for s in single])
                begin = np.maximum(places[~alone] - shape.before, 0).tolist()
                end = np.minimum(places[~alone] + shape.length, len(text)).tolist()
                for s in single:
                    for reach in s["reaches"] or []:
                        begin.append(s["place"] - reach["left"])
                        end.append(s["place"] + reach["right"])
                covered = np.zeros(len(text) + 1, np.int64)
                np.add.at(covered, np.array(begin, np.int64), 1)
                np.add.at(covered, np.array(end, np.int64), -1)
                inside = np.r_[False, np.cumsum(covered)[:-1] > 0, False]
                edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
                spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
                kept.append(np.frombuffer(text, np.uint8)[~inside[1:-1]].tobytes() if len(edges) else text)
            span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(spans, span_type),
                    pa.array(kept, pa.binary()),
                ],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return remove


class RepeatIndex:
    """The anchors of a table and the contexts that share a gram, as stored tables."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, length: int, group: int):
        if length < 2 * GRAM:
            raise ValueError(f"the length must be {2 * GRAM} at least")
        self.shape, self.group = Shape(length), group
        self.id_type = docs.schema[id_col].dataType.simpleString()
        text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
        self.texts = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).select(
            "id", F.xxhash64("text").alias("t"), "text"
        )
        schema = f"gram bigint, context bigint, id {self.id_type}, t bigint, place bigint"
        self.places = self.texts.mapInArrow(_describer(self.shape), schema)
        first = F.min(F.struct("id", "t", "place")).alias("first")
        self.distinct = stored(
            self.places.groupBy("gram", "context").agg(F.count("*").alias("n"), first), "repeat-contexts"
        )
        self.contexts = stored(self._shared_contexts(), "repeat-bytes")

    def _shared_contexts(self) -> DataFrame:
        """The contexts whose gram has others, with their bytes from one of their documents."""
        kin = self.distinct.groupBy("gram").agg(F.count("*").alias("kin")).where("kin > 1")
        picks = (
            self.distinct.join(kin, "gram")
            .groupBy("first.id", "first.t")
            .agg(F.collect_list(F.struct("gram", "context", "n", "kin", "first.place")).alias("picks"))
            .select(F.col("id").alias("_id"), F.col("t").alias("_t"), "picks")
        )
        same = self.texts["id"].eqNullSafe(picks["_id"]) & (self.texts["t"] == picks["_t"])
        whole = self.texts.join(picks, same).select("id", "t", "text", "picks")
        schema = (
            f"gram bigint, context bigint, n bigint, kin bigint, id {self.id_type}, t bigint, place bigint,"
            " before int, after int, least int, most int, bytes binary"
        )
        return whole.mapInArrow(_extractor(self.shape), schema)

    def by_gram(self) -> DataFrame:
        """Contexts for the suffix arrays: a gram's rows in one task, one after another."""
        return self.contexts.where(F.col("kin") <= self.group).repartition("gram").sortWithinPartitions("gram")

    def hot_strings(self) -> DataFrame:
        """Every string of the contexts of grams with too many of them, that occurs in another."""
        strings = (
            self.contexts.where(F.col("kin") > self.group)
            .withColumn("left", F.explode(F.sequence("least", "most")))
            .withColumn(
                "string",
                F.xxhash64(
                    F.substring("bytes", F.lit(self.shape.before + 1) - F.col("left"), F.lit(self.shape.length))
                ),
            )
            .drop("bytes")
        )
        repeated = (
            strings.groupBy("gram", "left", "string")
            .agg(F.min("context").alias("least_context"), F.max("context").alias("_other"), F.max("n").alias("_n"))
            .where("least_context != _other")
            .drop("_other", "_n")
        )
        return strings.join(repeated, ["gram", "left", "string"])

    def discard(self) -> None:
        discard(self.distinct, self.contexts)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    group: int = GROUP,
) -> DataFrame:
    """Per row: its id, ``n_bytes``, ``spans`` (start and end of removed bytes) and ``kept``.

    Texts count as their UTF-8 bytes. Removed is each byte of a string of ``length`` bytes that
    also starts at another place of any row, the same one included; ``kept`` joins the other bytes.
    A null text is empty. Rows that repeat an id are rows of their own, so equal rows are repeats
    of each other; null ids stay null; no rows give no rows. Other columns are not read.
    """
    index = RepeatIndex(docs, id_col, text_col, length, group)
    shape, id_type = index.shape, index.id_type
    reaches = index.by_gram().mapInArrow(
        _reach_finder(shape), f"id {id_type}, t bigint, place bigint, reaches {REACHES}"
    )
    hot = (
        index.hot_strings()
        .where("n = 1")
        .groupBy("id", "t", "place")
        .agg(F.collect_list(F.struct("left", (F.lit(length) - F.col("left")).alias("right"))).alias("reaches"))
    )
    shared = reaches.unionByName(hot.select("id", "t", "place", F.col("reaches").cast(REACHES)))
    # Every context that occurs once is listed with its reaches; the others repeat as a whole.
    single = index.distinct.where("n = 1").select("first.*", F.lit(None).cast(REACHES).alias("reaches"))
    listed = (
        single.unionByName(shared)
        .groupBy("id", "t")
        .agg(F.collect_list(F.struct("place", "reaches")).alias("singles"))
        .select(F.col("id").alias("_id"), F.col("t").alias("_t"), "singles")
    )
    texts = index.texts
    same = texts["id"].eqNullSafe(listed["_id"]) & (texts["t"] == listed["_t"])
    cleaned = texts.join(listed, same, "left").select("id", "text", "singles")
    schema = f"id {id_type}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    out = stored(cleaned.mapInArrow(_remover(shape), schema), "repeats-removed")
    index.discard()
    return out.withColumnRenamed("id", id_col)


def repeat_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    group: int = GROUP,
) -> DataFrame:
    """Groups of repeats with all their occurrences: (group_id, n_bytes, id, start).

    Within a context, the groups are maximal: no string that holds it occurs as often. A repeat longer
    than a context appears as overlapping groups, one per anchor. Grams of more than ``group``
    contexts give groups of ``length`` bytes. A group has two occurrences at least.
    """
    index = RepeatIndex(docs, id_col, text_col, length, group)
    shape = index.shape
    trees = index.by_gram().mapInArrow(
        _group_finder(shape), "gram bigint, context bigint, least_context bigint, left int, right int"
    )
    hot = index.hot_strings().select(
        "gram", "context", "least_context", "left", (F.lit(length) - F.col("left")).alias("right")
    )
    several = index.distinct.where("n > 1").select(
        "gram", "context", F.col("context").alias("least_context"), F.lit(None).cast("int").alias("left"),
        F.lit(None).cast("int").alias("right"),
    )
    members = trees.unionByName(hot).unionByName(several)
    sizes = F.octet_length("text").alias("size")
    sized = index.texts.select(F.col("id").alias("_id"), F.col("t").alias("_t"), sizes).distinct()
    places = index.places.join(members, ["gram", "context"])
    same = places["id"].eqNullSafe(sized["_id"]) & (places["t"] == sized["_t"])
    left = F.coalesce("left", F.least("place", F.lit(shape.before)))
    right = F.coalesce("right", F.least(F.col("size") - F.col("place"), F.lit(length)))
    return (
        places.join(sized, same)
        .withColumn("left", left)
        .withColumn("right", right)
        .select(
            F.xxhash64("gram", "least_context", "left", "right").alias("group_id"),
            (F.col("left") + F.col("right")).alias("n_bytes"),
            F.col("id").alias(id_col),
            (F.col("place") - F.col("left")).alias("start"),
        )
    )
