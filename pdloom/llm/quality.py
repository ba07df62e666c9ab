"""Quality classifier: a factorisation machine over hashed words, structure and size (operator 2).

Features of a text are the hashed words (log counts, scaled to length one), statistics of its
structure and its size, the latter as numbers and as one-hot bins. The machine adds weights and
pairwise interactions of rank ``RANK`` between all features. The interactions cost linear time:
half the sum over factors of the squared sum minus the sum of squares.

It is fitted on the driver with a bounded sample of labelled rows; all rows are scored in tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pdloom.llm.common import giving_back, small_batches
from pdloom.llm.labelled import SAMPLE_ROWS, training_sample

WORD_BITS = 14
RANK = 8
BINS = 8
#: Passes over the sample, and steps at least, so that a small sample is learned as well.
EPOCHS, LEAST_STEPS = 6, 400
BATCH_ROWS = 256
STEP = 0.02
DECAY = 1e-4
#: Names of the statistics, in order.
STATS = (
    "upper", "digit", "mark", "symbol", "bar", "other_byte", "line_end", "log_bytes",
    "log_words", "word_bytes", "distinct", "repeated_next", "top_word", "line_words",
    "same_lines", "ends_with_symbol",
)


def _byte_set(chars: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


_SETS = np.stack(
    [
        _byte_set(bytes(range(65, 91))),
        _byte_set(b"0123456789"),
        _byte_set(b".,;:?'\"()-"),
        _byte_set(b"!#$%&*+/<=>@[]^_`{}~\\"),
        _byte_set(b"|"),
        _byte_set(bytes(range(128, 256))),
        _byte_set(b"\n"),
    ]
).T.astype(np.float64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices and values of the hashed words, and the statistics of a text."""
    from xxhash import xxh3_64_intdigest

    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.lower().split()
    n, size = max(1, len(words)), max(1, len(raw))
    stats = np.empty(len(STATS))
    stats[:7] = counts @ _SETS / size
    tally = Counter(words)
    lines = raw.splitlines()
    stats[7:] = (
        np.log1p(len(raw)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(tally) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        max(tally.values(), default=0) / n,
        n / max(1, len(lines)),
        1 - len(set(lines)) / max(1, len(lines)),
        sum(1 for w in tally if w[-1:] in b"!$%&#*|") / max(1, len(tally)),
    )
    hashed = np.fromiter(map(xxh3_64_intdigest, tally), np.uint64, len(tally))
    index = (hashed & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    values = np.log1p(np.fromiter(tally.values(), np.float64, len(tally)))
    index, where = np.unique(index, return_inverse=True)
    values = np.bincount(where, values, minlength=len(index))
    return index, values / (np.linalg.norm(values) or 1.0), stats


@dataclass(frozen=True)
class Model:
    """Weights of the machine and the scaling of the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    cuts: np.ndarray

    def structure(self, stats: np.ndarray) -> np.ndarray:
        """Scaled statistics and one-hot bins, a row per text."""
        scaled = np.clip((stats - self.means) / self.deviations, -3, 3) / 3
        bins = (stats[:, :, None] > self.cuts.T[None]).sum(2)
        hot = (bins[:, :, None] == np.arange(BINS)).reshape(len(stats), -1)
        return np.concatenate([scaled, hot / np.sqrt(len(STATS))], 1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities of label 1."""
        parts = [features(t) for t in texts]
        dense = self.structure(np.stack([s for _, _, s in parts]))
        index = np.concatenate([i for i, _, _ in parts])
        value = np.concatenate([v for _, v, _ in parts])
        owner = np.repeat(np.arange(len(parts)), [len(i) for i, _, _ in parts])
        base = 1 << WORD_BITS
        linear = np.bincount(owner, self.weights[index] * value, minlength=len(parts))
        total = dense @ self.factors[base:]
        squares = dense**2 @ (self.factors[base:] ** 2).sum(1)
        for f in range(RANK):
            term = self.factors[index, f] * value
            total[:, f] += np.bincount(owner, term, minlength=len(parts))
            squares += np.bincount(owner, term**2, minlength=len(parts))
        margin = self.bias + linear + dense @ self.weights[base:]
        margin += 0.5 * ((total**2).sum(1) - squares)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _scaling(stats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cuts = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0)
    return stats.mean(0), stats.std(0) + 1e-9, cuts


def fit(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Fit by Adam on the logistic loss, the rows in a fixed shuffled order.

    Without rows every score is one half; with one class only, its smoothed rate.
    """
    stats = np.stack([s for _, _, s in parts]) if parts else np.zeros((1, len(STATS)))
    base = 1 << WORD_BITS
    width = base + len(STATS) * (1 + BINS)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(rate / (1 - rate)))
    model = Model(bias, np.zeros(width), np.zeros((width, RANK)), *_scaling(stats))
    if len(set(labels.tolist())) < 2:
        return model
    dense = model.structure(stats).astype(np.float32)
    random = np.random.default_rng(7)
    theta = np.zeros((width, 1 + RANK), np.float32)
    theta[:, 1:] = random.normal(0, 0.01, (width, RANK))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    b, b1, b2 = bias, 0.0, 0.0
    epochs = max(EPOCHS, -(-LEAST_STEPS // -(-len(parts) // BATCH_ROWS)))
    for _ in range(epochs):
        order = random.permutation(len(parts))
        for at in range(0, len(parts), BATCH_ROWS):
            rows = order[at : at + BATCH_ROWS]
            x = np.zeros((len(rows), width), np.float32)
            for r, i in enumerate(rows):
                x[r, parts[i][0]] = parts[i][1]
            x[:, base:] = dense[rows]
            squared = x * x
            totals = x @ theta
            own = squared @ (theta[:, 1:] ** 2)
            margin = b + totals[:, 0] + 0.5 * ((totals[:, 1:] ** 2) - own).sum(1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)
            error = error.astype(np.float32)
            gradient = np.empty_like(theta)
            gradient[:, 0] = x.T @ error
            gradient[:, 1:] = x.T @ (error[:, None] * totals[:, 1:])
            gradient[:, 1:] -= theta[:, 1:] * (squared.T @ error)[:, None]
            gradient += DECAY * theta
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            scale = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            theta -= STEP * scale * first / (np.sqrt(second) + 1e-8)
            slope = float(error.sum())
            b1, b2 = 0.9 * b1 + 0.1 * slope, 0.999 * b2 + 0.001 * slope**2
            b -= STEP * scale * b1 / (np.sqrt(b2) + 1e-8)
    full = theta.astype(np.float64)
    return Model(b, full[:, 0], full[:, 1:], model.means, model.deviations, model.cuts)


def fit_quality(
    docs: DataFrame, labels: DataFrame, usable: Column, rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on at most ``rows`` labelled documents; only their features reach the driver."""
    small_batches(docs.sparkSession)
    sample = training_sample(docs, labels, "quality", usable, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [features(t) for t in batch.column(1).to_pylist()]
            blobs = [
                [i.astype("<u2").tobytes() for i, _, _ in parts],
                [v.astype("<f4").tobytes() for _, v, _ in parts],
                [s.astype("<f8").tobytes() for _, _, s in parts],
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(2), *[pa.array(b, pa.binary()) for b in blobs]],
                names=["doc_id", "label", "words", "counts", "stats"],
            )

    found = sample.mapInArrow(
        giving_back(run), "doc_id bigint, label int, words binary, counts binary, stats binary"
    ).collect()
    found.sort(key=lambda r: (r[0], r[1], bytes(r[2]), bytes(r[3]), bytes(r[4])))
    parts = [
        (
            np.frombuffer(r[2], "<u2").astype(np.int64),
            np.frombuffer(r[3], "<f4"),
            np.frombuffer(r[4], "<f8"),
        )
        for r in found
    ]
    return fit(parts, np.array([r[1] for r in found], np.float64))


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with the columns score (0 to 1) and predicted (1 from the threshold on).

    Needs the column text; whole texts are scored. A null text is scored like an empty one.
    Other columns are kept, but for ones named score or predicted, which are replaced.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            scores = [model.scores(texts[i : i + 128]) for i in range(0, len(texts), 128)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(score, pa.float64()),
                    pa.array((score >= threshold).astype(np.int32), pa.int32()),
                ],
                names=[*batch.schema.names, "score", "predicted"],
            )

    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return kept.mapInArrow(giving_back(run), schema)
