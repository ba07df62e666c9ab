"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4 * q) words long,
that no neighbouring word extends. At scale B the texts are cut into blocks of B words. A run with
B <= q < 2B holds a whole block that returns q words later, inside the window of 2B - 1 words after
the block. The squared differences of block and window, summed per distance, are

    sum(u * u) + sum(v * v) - 2 * sum(u * v)

whose last term is a number-theoretic transform modulo a prime, so that a sum of zero is exact and
a true occurrence is never missed. Every distance with a zero seeds an extension that compares the
words themselves, to the left and to the right, and yields the whole stretch.

Two facts keep the work small without leaving a run out. A block can only return if each of its
words occurs again B to 2B - 1 words later; other blocks are not transformed. And a block whose
whole window lies in a run of a shorter period only returns at multiples of that period, which is
that run again.

A document is one row of one task, which needs memory in proportion to its longest text; all
documents of a slice are searched at once, with a word of its own between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 15 * 2**27 + 1, with 31 as a generator: products of two residues fit 64 bits.
PRIME, GENERATOR = 2013265921, 31
#: The longest block one transform takes; a longer one is cut, and the sums of its pieces are added.
PIECE = 1 << 18
#: Residues transformed at once.
RESIDUES = 1 << 20
#: Bytes of text searched at once (one longer text is searched alone).
SLICE = 4_000_000
SHORTEST, EXPONENT = 6, 4

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _powers(base: int, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    done, step = 1, base % PRIME
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step) % np.uint64(PRIME)
        done, step = done + more, step * step % PRIME
    return out


_ROOTS: dict[tuple[int, bool], np.ndarray] = {}


def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order ``size``, the first half."""
    if (size, inverse) not in _ROOTS:
        root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
        _ROOTS[size, inverse] = _powers(pow(root, -1, PRIME) if inverse else root, size // 2)
    return _ROOTS[size, inverse]


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of every row, in bit-reversed order; a power of two of residues a row."""
    prime, (count, size) = np.uint64(PRIME), rows.shape
    out = rows.astype(np.uint64)
    half = size // 2
    while half:
        pairs = out.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0], pairs[:, :, 1]
        difference = (low + (prime - high)) * _roots(2 * half, False) % prime
        pairs[:, :, 0] = (low + high) % prime
        pairs[:, :, 1] = difference
        half //= 2
    return out


def inverse(rows: np.ndarray) -> np.ndarray:
    """The rows whose transform is given."""
    prime, (count, size) = np.uint64(PRIME), rows.shape
    out, half = rows.astype(np.uint64), 1
    while half < size:
        pairs = out.reshape(count, -1, 2, half)
        low, high = pairs[:, :, 0].copy(), pairs[:, :, 1] * _roots(2 * half, True) % prime
        pairs[:, :, 0] = (low + high) % prime
        pairs[:, :, 1] = (low + (prime - high)) % prime
        half *= 2
    return out * np.uint64(pow(size, -1, PRIME)) % prime


def differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences, modulo the prime, of every block of B numbers with the B
    stretches of its window of 2B - 1 numbers."""
    prime, (count, size) = np.uint64(PRIME), blocks.shape
    if size > PIECE:
        total = np.zeros((count, size), np.uint64)
        for at in range(0, size, PIECE):
            piece = blocks[:, at : at + PIECE]
            for first in range(0, size, PIECE):
                part = windows[:, at + first : at + first + 2 * PIECE - 1]
                total[:, first : first + PIECE] += differences(piece, part)
        return total % prime
    turned = np.zeros((count, 2 * size), np.uint64)
    turned[:, :size] = blocks[:, ::-1]
    ahead = np.zeros((count, 2 * size), np.uint64)
    ahead[:, : 2 * size - 1] = windows
    products = inverse(transform(turned) * transform(ahead) % prime)[:, size - 1 : 2 * size - 1]
    squares = np.zeros((count, 2 * size), np.uint64)
    np.cumsum(ahead[:, :-1] * ahead[:, :-1] % prime, axis=1, out=squares[:, 1:])
    own = (turned * turned % prime).sum(axis=1, keepdims=True)
    return (own + squares[:, size:] - squares[:, :size] + (prime - products) * np.uint64(2)) % prime


def _returning(keys: np.ndarray, places: np.ndarray, size: int, count: int) -> np.ndarray:
    """Whether each of the first ``count`` blocks can return: all its words occur again
    ``size`` to 2 * ``size`` - 1 words later. ``keys`` are sorted (word, place) pairs."""
    wanted = keys + size
    found = np.searchsorted(keys, wanted)
    found[found == len(keys)] = 0
    again = np.zeros(count * size, bool)
    inside = places < count * size
    next_key = keys[found]
    again[places[inside]] = ((next_key >= wanted) & (next_key < wanted + size))[inside]
    return again.reshape(count, size).all(axis=1)


def _seeds(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of blocks and the distances at which they return in their window."""
    places, distances = [], []
    step = max(1, RESIDUES // (2 * min(size, PIECE)))
    for at in range(0, len(firsts), step):
        first = firsts[at : at + step]
        blocks = words[first[:, None] + np.arange(size)]
        windows = words[first[:, None] + np.arange(size, 3 * size - 1)]
        row, distance = np.nonzero(differences(blocks, windows) == 0)
        places.append(first[row])
        distances.append(distance + size)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(distances)


def _stretched(words: np.ndarray, at: int, distance: int, step: int) -> int:
    """The first place from ``at`` on, in the direction of ``step``, that differs from the word
    ``distance`` further on. The separators at both ends of a text end it."""
    width = 64
    while True:
        if step > 0:
            width = min(width, len(words) - distance - at)
            equal = words[at : at + width] == words[at + distance : at + distance + width]
        else:
            width = min(width, at + 1)
            equal = words[at - width + 1 : at + 1] == words[at - width + 1 + distance : at + 1 + distance]
            equal = equal[::-1]
        if not equal.all():
            return at + step * int(equal.argmin())
        at, width = at + step * width, 2 * width


def _short(words: np.ndarray, places: np.ndarray, distances: np.ndarray, size: int) -> np.ndarray:
    """Which seeds end, on both sides and within 16 words, too early to belong to a run."""
    left, right = places.copy(), places + size
    ended = np.ones(len(places), bool)
    for end, step in ((left, -1), (right, 1)):
        active = np.arange(len(places))
        for _ in range(16):
            look = end[active] - (step < 0)
            active = active[words[look] == words[look + distances[active]]]
            end[active] += step
            if not len(active):
                break
        ended[active] = False
    length = right + distances - left
    return ended & (length < np.maximum(SHORTEST, EXPONENT * distances))


def runs_of(words: np.ndarray, active: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a sequence of numbers below the prime.

    The sequence starts with a number that occurs nowhere else and has such a one after each text.
    ``active[j]`` is the length of the part that holds texts long enough for a period of 2 ** j.
    """
    order = np.argsort(words, kind="stable").astype(np.int64)
    span = np.int64(1) << np.int64(int(8 * len(words)).bit_length())
    keys = words[order].astype(np.int64) * span + order
    padded = np.concatenate([words, np.full(2, words[0])])
    runs: dict[tuple[int, int], int] = {}
    covered = np.zeros(len(words) + 1, np.int64)  # end of a known run that holds the place
    period_at = np.ones(len(words) + 1, np.int64)
    for scale, length in enumerate(active):
        size = 1 << scale
        if length < EXPONENT * size:
            break
        kept = order < length
        keys, order = keys[kept], order[kept]
        firsts = np.flatnonzero(_returning(keys, order, size, length // size)) * size
        firsts = firsts[firsts + 3 * size - 1 <= len(words)]
        firsts = firsts[covered[firsts] < firsts + 3 * size - 1]
        places, distances = _seeds(words, firsts, size)
        inside = (covered[places] >= places + distances + size) & (distances % period_at[places] == 0)
        places, distances = places[~inside], distances[~inside]
        long = ~_short(padded, places, distances, size)
        places, distances = places[long], distances[long]
        by = np.lexsort((places, distances))
        done, at_distance, fresh = 0, 0, []
        for place, distance in zip(places[by].tolist(), distances[by].tolist()):
            if distance == at_distance and place + size <= done:
                continue
            start = _stretched(words, place + size - 1, distance, -1) + 1
            done = _stretched(words, place, distance, 1)
            at_distance = distance
            end = done + distance
            if end - start >= max(SHORTEST, EXPONENT * distance) and start <= place:
                if (start, end) not in runs:
                    runs[start, end] = distance
                    fresh.append((start, end, distance))
        for start, end, distance in fresh:
            part = covered[start:end]
            wider = part < end
            part[wider] = end
            period_at[start:end][wider] = distance
    return [(start, end, period) for (start, end), period in runs.items()]


def _searched(texts: list[bytes]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text and its runs (start, length, period), by start and period."""
    split = [text.split() for text in texts]
    by_length = sorted(range(len(texts)), key=lambda i: -len(split[i]))
    joined = [word for i in by_length for word in split[i]]
    codes = pa.array(joined, pa.binary()).dictionary_encode()
    vocabulary = len(codes.dictionary)
    ids = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.array([len(split[i]) for i in by_length], np.int64)
    ends = np.cumsum(counts)
    # Word 0 of the sequence and the one after each text are words of their own.
    words = np.insert(ids, np.concatenate([[0], ends]), vocabulary + np.arange(len(counts) + 1))
    active, size = [], 1
    while len(counts) and EXPONENT * size <= counts[0]:
        fit = int(np.count_nonzero(counts >= EXPONENT * size))
        active.append(int(ends[fit - 1]) + fit + 1)
        size *= 2
    starts = np.concatenate([[0], ends[:-1]]) + np.arange(len(counts)) + 1 if len(counts) else ends
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, period in runs_of(words, active):
        at = int(np.searchsorted(starts, start, side="right")) - 1
        out[by_length[at]].append((start - int(starts[at]), end - start, period))
    return split, [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def _search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [text or b"" for text in batch.column(1).to_pylist()]
        at = 0
        while at < batch.num_rows:
            end, held = at + 1, len(texts[at])
            while end < batch.num_rows and held + len(texts[end]) <= SLICE:
                held, end = held + len(texts[end]), end + 1
            words, runs = _searched(texts[at:end])
            told = pa.array(
                [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs],
                pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, end - at),
                    pa.array([len(w) for w in words], pa.int64()),
                    told,
                    pa.array([_collapsed(w, r) for w, r in zip(words, runs)], pa.binary()),
                ],
                names=["id", "n_words", "runs", "collapsed"],
            )
            at = end


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ``n_words``, ``runs`` (start, length and period in words, by start and
    period) and ``collapsed``, the words no run repeats joined by one space.

    Words are runs of anything but ASCII white space. A run's first period is kept, the rest of it
    dropped. A null or empty text has no words, no runs and an empty ``collapsed``; rows that
    repeat an id are answered one by one, a null id stays null; no rows give no rows. Other columns
    of ``docs`` are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
        .mapInArrow(_search_batches, f"id {id_type}, n_words bigint, runs {RUNS}, collapsed binary")
        .select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
    )
