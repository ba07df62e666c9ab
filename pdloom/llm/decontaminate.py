"""Benchmark decontamination by latent semantic retrieval (operator 3).

1. Texts become arrays of word hashes, stored once. Words fall into ``FEATURES`` hashed features
   whose document frequency is counted over all documents.
2. A randomised SVD of the TF-IDF passages of all documents in one pass: a task multiplies its
   passages with a random matrix and back, Spark adds the products up per feature, and the driver
   works on the features-by-rank matrix only (Nystroem's method gives vectors and values).
3. Passages of texts and of benchmark items (long items are cut) are projected on the singular
   vectors, each divided by its singular value, so that what most texts share does not outweigh
   the rest; every passage is compared by cosine with those of items of its length, block by block.
4. A candidate is checked on its words: longest common subsequence with the item, and the answer
   check, the share of the item's last words and of its rare words that the passage holds.
5. A verbatim copy is also found by the hash of a run of its words, at any length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pdloom.llm.common import Batches, discard, giving_back, small_batches, stored

FEATURES = 4_096
RANK = 96
#: Words of a passage of the decomposition.
PASSAGE = 192
#: Words from one window of the search to the next, for passages of items below so many words. A
#: window holds any passage below 34 words wholly, with fewer than two steps of other words.
STEPS = ((8, 1), (15, 2), (30, 8))
#: Step and longest window for longer passages, the longest item that is not cut into passages, and
#: words of the passages of a cut one.
STEP, WINDOW, UNCUT, PIECE = 16, 48, 64, 48
#: Cosines computed at once, and windows of it at most.
CELLS, WINDOWS = 1 << 22, 1 << 14
#: Words of the run by which verbatim copies are found; shorter items are one run.
RUN = 8
#: Items compared in one pass over the documents.
ITEM_BLOCK = 20_000
COSINE = 0.5
#: Share of an item's words in the common subsequence, and of its answer in the passage.
LCS_SHARE, ANSWER_SHARE = 0.6, 0.5

_LETTERS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def word_hashes(text: str | None) -> np.ndarray:
    """32-bit hashes of the words of a text: lower case, cut at ASCII marks and white space."""
    from xxhash import xxh32_intdigest

    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()
    return np.fromiter(map(xxh32_intdigest, raw), np.uint32, len(raw))


def _hash_texts(batches: Batches) -> Batches:
    for batch in batches:
        words = [word_hashes(t).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(words, pa.binary())], names=["id", "words"])


def hashed(rows: DataFrame, id_column: str) -> DataFrame:
    """Stored (id, words) of all texts."""
    texts = rows.select(F.col(id_column).cast("bigint").alias("id"), "text")
    return stored(texts.mapInArrow(giving_back(_hash_texts), "id bigint, words binary"), "hashed-words")


def _document_frequency(batches: Batches) -> Batches:
    counts = np.zeros(FEATURES, np.int64)
    for batch in batches:
        for words in batch.column(1).to_pylist():
            counts[np.unique(np.frombuffer(words, "<u4") % FEATURES)] += 1
    used = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(used), pa.array(counts[used])], names=["feature", "n"])


def inverse_frequency(words: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every feature, over all documents."""
    counts = words.mapInArrow(giving_back(_document_frequency), "feature bigint, n bigint")
    found = np.zeros(FEATURES)
    for row in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        found[row["feature"]] = row["n"]
    return np.log((words.count() + 1) / (found + 1)) + 1


def _batch_chunks(
    batch: pa.RecordBatch, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch, the start of every chunk, the row of a chunk and chunks per row."""
    parts = [np.frombuffer(w, "<u4") for w in batch.column(1).to_pylist()]
    lengths = np.array([len(p) for p in parts], np.int64)
    counts = -(-lengths // size)
    offsets = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(parts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    return words, offsets[row] + within * size, row, counts


def _chunk_sums(
    weighted: np.ndarray, feature: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int
) -> np.ndarray:
    """Sum of the rows of the words of every chunk; the last row of ``weighted`` is zero."""
    total = np.zeros((len(starts), weighted.shape[1]), np.float32)
    taken = np.empty_like(total)
    for i in range(size):
        at = np.where(starts + i < ends, starts + i, len(feature) - 1)
        np.take(weighted, feature[at], axis=0, out=taken, mode="clip")
        total += taken
    return total


def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of so many words."""
    total = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : i + len(total)]
    return total


def _product(idf: np.ndarray, matrix: np.ndarray) -> Callable[[Batches], Batches]:
    """Rows of (transposed passages) times passages times matrix, per feature."""
    right = matrix.astype(np.float32)

    def run(batches: Batches) -> Batches:
        total = np.zeros(matrix.shape)
        room = np.empty((1024, FEATURES), np.float32)
        weight = idf.astype(np.float32)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                words, starts, _, _ = _batch_chunks(whole.slice(at, 256), PASSAGE)
                ends = np.append(starts[1:], len(words))
                cell = np.repeat(np.arange(len(starts)), ends - starts) * FEATURES
                cell += words % np.uint32(FEATURES)
                for low in range(0, len(starts), len(room)):
                    high = min(low + len(room), len(starts))
                    passages = room[: high - low]
                    passages.fill(0)
                    inside = cell[starts[low] : ends[high - 1]] - low * FEATURES
                    np.add.at(passages.reshape(-1), inside, np.float32(1))
                    passages *= weight
                    passages /= np.sqrt(np.einsum("ij,ij->i", passages, passages))[:, None]
                    total += passages.T @ (passages @ right)
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.record_batch(
            [
                pa.array(used),
                pa.ListArray.from_arrays(
                    np.arange(len(used) + 1, dtype=np.int32) * matrix.shape[1],
                    total[used].reshape(-1),
                ),
            ],
            names=["feature", "value"],
        )

    return run


def _multiplied(words: DataFrame, idf: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    rows = words.mapInArrow(giving_back(_product(idf, matrix)), "feature bigint, value array<double>")
    sums = (
        rows.withColumn("value", array_to_vector("value"))
        .groupBy("feature")
        .agg(vector_to_array(Summarizer.sum(F.col("value"))).alias("value"))
    )
    found = np.zeros(matrix.shape)
    for row in sums.collect():
        found[row["feature"]] = row["value"]
    return found


def singular_vectors(words: DataFrame, idf: np.ndarray, seed: int = 3) -> np.ndarray:
    """Right singular vectors (features by rank) of the passages of all documents, each divided
    by its singular value; zeros where there are no passages."""
    test = np.linalg.qr(np.random.default_rng(seed).normal(size=(FEATURES, RANK)))[0]
    product = _multiplied(words, idf, test)
    shift = np.finfo(np.float32).eps * np.linalg.norm(product)
    if shift == 0:
        return product
    product = product + shift * test
    core = test.T @ product
    values, rotation = np.linalg.eigh((core + core.T) / 2)
    root = rotation / np.sqrt(np.maximum(values, shift))
    vectors, singular, _ = np.linalg.svd(product @ root, full_matrices=False)
    # Singular values of the passages, as the decomposed matrix is that of their products.
    return vectors / np.maximum(singular, np.sqrt(shift))


def _padded(weighted: np.ndarray) -> np.ndarray:
    return np.concatenate([weighted, np.zeros((1, weighted.shape[1]))]).astype(np.float32)


@dataclass
class Items:
    """Benchmark items ready for the search: words, latent vectors and what the checks need."""

    ids: list[int]
    words: list[np.ndarray]
    latent: np.ndarray
    #: Item, first word and words of every passage, a row of ``latent`` each.
    passages: list[tuple[int, int, int]]
    rare: list[set[int]]
    masks: list[dict[int, int]] = field(default_factory=list)
    counts: list[Counter[int]] = field(default_factory=list)
    #: Per length of a run: its sorted hashes, with the items and where in them the run is.
    runs: dict[int, tuple[np.ndarray, list[list[tuple[int, int]]]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for words in self.words:
            masks: dict[int, int] = {}
            for i, w in enumerate(words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << i
            self.masks.append(masks)
            self.counts.append(Counter(words.tolist()))
        self._find_runs()

    def _find_runs(self) -> None:
        """The run of every item that fewest items hold."""
        for size in {min(RUN, len(w)) for w in self.words}:
            mine = {
                i: _run_hashes(w, size).tolist()
                for i, w in enumerate(self.words)
                if min(RUN, len(w)) == size
            }
            held = Counter(h for runs in mine.values() for h in set(runs))
            known: dict[int, list[tuple[int, int]]] = {}
            for i, runs in mine.items():
                at = min(range(len(runs)), key=lambda j: held[runs[j]])
                known.setdefault(runs[at], []).append((i, at))
            hashes = sorted(known)
            self.runs[size] = np.array(hashes, np.uint64), [known[h] for h in hashes]

    def copies(
        self, words: np.ndarray, row: np.ndarray, ends: np.ndarray
    ) -> Iterator[tuple[int, int, int]]:
        """Text, item and first word of all verbatim copies; ``row`` is the text of every word."""
        for size, (hashes, holders) in self.runs.items():
            runs = _run_hashes(words, size)
            place = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
            for at in np.flatnonzero(hashes[place] == runs).tolist():
                text = int(row[at])
                for item, before in holders[place[at]]:
                    first, n = at - before, len(self.words[item])
                    if first < 0 or row[first] != text or first + n > ends[text]:
                        continue
                    if np.array_equal(words[first : first + n], self.words[item]):
                        yield text, item, first

    def checked(self, item: int, passage: list[int]) -> tuple[float, float] | None:
        """Share of the common subsequence and of the answer where both reach their bounds."""
        masks, n = self.masks[item], len(self.words[item])
        held = masks.keys() & passage
        # Words of the item that the passage doesn't hold are in no common subsequence.
        if sum(map(self.counts[item].__getitem__, held)) < LCS_SHARE * n:
            return None
        full = (1 << n) - 1
        row = full
        for w in passage:
            mask = masks.get(w)
            if mask is not None:
                hit = row & mask
                row = (row + hit) | (row - hit)
        common = (n - (row & full).bit_count()) / n
        last = self.words[item][-max(1, n // 4) :].tolist()
        rare = self.rare[item]
        answer = min(
            sum(w in held for w in last) / len(last), sum(w in held for w in rare) / len(rare)
        )
        return (common, answer) if common >= LCS_SHARE and answer >= ANSWER_SHARE else None


def _latent(words: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    total = weighted[(words % FEATURES).astype(np.int64)].sum(0)
    return total / (np.linalg.norm(total) or 1.0)


def _step_and_window(n: int) -> tuple[int, int]:
    """Words between the windows for a passage of n words, and of a window."""
    step = next((s for bound, s in STEPS if n < bound), STEP)
    return step, min(WINDOW, -(-(n + step - 1) // step) * step)


def _search(items: Items, weighted: np.ndarray) -> Callable[[Batches], Batches]:
    """Checked hits of all passages: (doc_id, item_id, cosine, lcs, answer, word_from, word_to)."""
    by_kind: dict[tuple[int, int], list[int]] = {}
    for p, (_, _, n) in enumerate(items.passages):
        by_kind.setdefault(_step_and_window(n), []).append(p)
    kinds = [
        (*kind, np.array(mine, np.int64), items.latent[mine].astype(np.float32))
        for kind, mine in by_kind.items()
    ]

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                hits = list(_hits(batch, kinds, items, weighted))
                if hits:
                    yield pa.RecordBatch.from_pylist(hits, schema=_HITS)

    return run


_HITS = pa.schema(
    [
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()),
        ("lcs_share", pa.float64()), ("answer_share", pa.float64()),
        ("word_from", pa.int64()), ("word_to", pa.int64()),
    ]
)


def _candidates(
    kinds: list[tuple[int, int, np.ndarray, np.ndarray]],
    items: Items,
    weighted: np.ndarray,
    chunks: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    chunk: int,
) -> dict[tuple[int, int, int, int], float]:
    """Best cosine per text, item, and the first word and end of where the item may be."""
    words, starts, row, counts = chunks
    feature = np.append(words % np.uint32(FEATURES), FEATURES).astype(np.int64)
    ends = np.append(starts[1:], len(words))
    after = np.cumsum(counts)
    first = after - counts
    within = np.arange(len(starts)) - first[row]
    longest = max(window for _, window, _, _ in kinds) // chunk
    most = max(len(mine) for _, _, mine, _ in kinds)
    size = max(1, min(WINDOWS, CELLS // most))
    found: dict[tuple[int, int, int, int], float] = {}
    for low in range(0, len(starts), size):
        high = min(low + size, len(starts))
        to = min(high + longest, len(starts))
        sums = _chunk_sums(weighted, feature, starts[low:to], ends[low:to], chunk)
        running = np.concatenate([np.zeros((1, RANK)), np.cumsum(sums, axis=0, dtype=np.float64)])
        for step, window, mine, latent in kinds:
            at = low + np.flatnonzero(within[low:high] % (step // chunk) == 0)
            stop = np.minimum(at + window // chunk, after[row[at]])
            passages = (running[stop - low] - running[at - low]).astype(np.float32)
            passages /= np.maximum(np.linalg.norm(passages, axis=1, keepdims=True), 1e-12)
            cosine = passages @ latent.T
            for place, column in zip(*np.nonzero(cosine >= COSINE)):
                item, offset, n = items.passages[mine[column]]
                whole, text = len(items.words[item]), int(row[at[place]])
                start, end = int(starts[first[text]]), int(ends[after[text] - 1])
                begin = int(starts[at[place]]) - offset - whole // 2 - start
                close = int(ends[stop[place] - 1]) + whole - offset - n + whole // 2 - start
                if n < whole:  # all passages of a long item look at few places
                    begin = begin // (whole // 4) * (whole // 4)
                    close = -(-close // (whole // 4)) * (whole // 4)
                key = text, item, max(begin, 0) + start, min(close + start, end)
                found[key] = max(found.get(key, 0.0), float(cosine[place, column]))
    return found


def _hits(
    batch: pa.RecordBatch,
    kinds: list[tuple[int, int, np.ndarray, np.ndarray]],
    items: Items,
    weighted: np.ndarray,
) -> Iterator[dict]:
    if not kinds:
        return
    chunk = min(step for step, _, _, _ in kinds)
    chunks = _batch_chunks(batch, chunk)
    words = chunks[0]
    if not len(words):
        return
    ids = batch.column(0).to_pylist()
    lengths = np.array([len(w) // 4 for w in batch.column(1).to_pylist()], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths

    def hit(text: int, item: int, cosine: float, shares: tuple, low: int, high: int) -> dict:
        return {
            "doc_id": ids[text],
            "item_id": items.ids[item],
            "cosine": cosine,
            "lcs_share": shares[0],
            "answer_share": shares[1],
            "word_from": low - int(starts[text]),
            "word_to": high - int(starts[text]),
        }

    copied: set[tuple[int, int]] = set()
    row = np.repeat(np.arange(len(lengths)), lengths)
    for text, item, at in items.copies(words, row, ends):
        if (text, item) not in copied:
            copied.add((text, item))
            yield hit(text, item, 1.0, (1.0, 1.0), at, at + len(items.words[item]))
    found = _candidates(kinds, items, weighted, chunks, chunk)
    for (text, item, low, high), cosine in found.items():
        if (text, item) in copied:
            continue
        shares = items.checked(item, words[low:high].tolist())
        if shares:
            yield hit(text, item, cosine, shares, low, high)


def _items(rows: list, weighted: np.ndarray, idf: np.ndarray) -> Items:
    rows = [(r["id"], np.frombuffer(r["words"], "<u4")) for r in rows]
    rows = [(i, w) for i, w in rows if i is not None and len(w)]
    rare = []
    for _, words in rows:
        ordered = sorted(set(words.tolist()), key=lambda w: (-idf[w % FEATURES], w))
        rare.append(set(ordered[: max(1, len(ordered) // 2)]))
    passages = []
    for i, (_, words) in enumerate(rows):
        pieces = 1 if len(words) <= UNCUT else -(-len(words) // PIECE)
        cuts = [len(words) * p // pieces for p in range(pieces + 1)]
        passages += [(i, at, to - at) for at, to in zip(cuts, cuts[1:])]
    latent = [_latent(rows[i][1][at : at + n], weighted) for i, at, n in passages]
    return Items(
        [i for i, _ in rows],
        [w for _, w in rows],
        np.stack(latent) if latent else np.zeros((0, RANK)),
        passages,
        rare,
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, the best cosine,
    lcs_share, answer_share, and the words the passage lies between.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored. Null
    or empty texts hold nothing and are never found; repeated items or documents with one id are
    reported once; an empty table on either side gives no row. Items are compared in blocks, each
    a pass over all stored documents; no candidate over the cosine bound is left out.
    """
    small_batches(docs.sparkSession)
    items = hashed(benchmark, "item_id")
    words = hashed(docs, "doc_id")
    idf = inverse_frequency(words)
    weighted = _padded(idf[:, None] * singular_vectors(words, idf))
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    block = F.pmod(F.xxhash64("id", "words"), F.lit(blocks))
    schema = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_share double, word_from bigint, word_to bigint"
    passes = []
    for number in range(blocks):
        part = _items(items.where(block == number).collect(), weighted, idf)
        passes.append(words.mapInArrow(giving_back(_search(part, weighted)), schema))
    found = reduce(DataFrame.unionByName, passes)
    best = F.struct("lcs_share", "answer_share", "cosine", (-F.col("word_from")).alias("at"), "word_to")
    leaks = stored(
        found.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.cosine").alias("cosine"),
            F.col("best.lcs_share").alias("lcs_share"),
            F.col("best.answer_share").alias("answer_share"),
            (-F.col("best.at")).alias("word_from"),
            F.col("best.word_to").alias("word_to"),
        ),
        "leaks",
    )
    discard(words, items)
    return leaks
