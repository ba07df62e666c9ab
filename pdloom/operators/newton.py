"""Logistic regression by Newton steps over sums of products.

One aggregation per step: every task adds up the products of its rows (a matrix of features times
features), the gradient and the loss; Spark adds the tasks' sums, and the step is solved from
``(width + 1) ** 2`` numbers. The rows stay where they are, in blocks of numbers that are kept as
arrays: a step converts no columns.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of tasks travel with them: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Widest model solved this way: a task returns the square of it.
WIDEST = 128


BLOCK_SCHEMA = "x binary, label binary, weight binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block per batch: the inputs by row, the labels and the weights."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = (batch.column(0).flatten(), batch.column(1), batch.column(2))
        held = [c.to_numpy(zero_copy_only=False).astype(np.float64).tobytes() for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array([h], pa.binary()) for h in held], names=["x", "label", "weight"])


def _blocks(rows: DataFrame) -> RDD:
    def arrays(row) -> tuple[np.ndarray, ...]:
        y = np.frombuffer(row["label"], np.float64)
        return np.frombuffer(row["x"], np.float64).reshape(len(y), -1), y, np.frombuffer(row["weight"], np.float64)

    return rows.mapInArrow(_pack, BLOCK_SCHEMA).rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def _summer(beta: np.ndarray, shift: np.ndarray) -> Callable:
    """Adds the sums of a block, of inputs less ``shift``: products by row, the gradient, the loss."""
    width = len(beta)

    def add(total: np.ndarray, block: tuple[np.ndarray, ...]) -> np.ndarray:
        inputs, y, w = block
        x = np.ones((len(y), width))
        x[:, :-1] = inputs - shift
        margin = x @ beta
        p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
        loss = float((w * (np.logaddexp(0, margin) - y * margin)).sum())
        gradient = x.T @ (w * (p - y))
        products = (x * (w * p * (1 - p))[:, None]).T @ x
        return total + np.concatenate([products.ravel(), gradient, [loss]])

    return add


def _sums(blocks: RDD, beta: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    width = len(beta)
    zeros = np.zeros(width * width + width + 1)
    told = blocks.treeAggregate(zeros, _summer(beta, shift), np.add)
    return told[: width * width].reshape(width, width), told[width * width : -1], float(told[-1])


def fit_logistic(
    rows: DataFrame,
    width: int,
    penalty: float = 0.0,
    steps: int = 50,
    tolerance: float = 1e-10,
) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise the weighted loss plus ``penalty`` / 2 times the
    squared coefficients.

    ``rows`` has an array of ``width`` numbers, the 0/1 label (or a share of ones) and a weight, in
    this order; it is read once. A step that raises the loss is halved. With no rows all
    coefficients are zero.
    """
    blocks = _blocks(rows)
    try:
        return _newton(blocks, width, penalty, steps, tolerance)
    finally:
        blocks.unpersist()


def _newton(blocks: RDD, width: int, penalty: float, steps: int, tolerance: float) -> tuple[np.ndarray, float]:
    beta = np.zeros(width + 1)
    ridge = np.full(width + 1, float(penalty))
    ridge[-1] = 0.0

    # Inputs are measured from their means: far from zero they would all but equal the intercept's.
    products, _, _ = _sums(blocks, beta, np.zeros(width))
    shift = products[:-1, -1] / products[-1, -1] if products[-1, -1] else np.zeros(width)

    def at(point: np.ndarray):
        products, gradient, loss = _sums(blocks, point, shift)
        whole = loss + 0.5 * float((ridge * point * point).sum())
        return products + np.diag(ridge), gradient + ridge * point, whole

    hessian, gradient, loss = at(beta)
    for _ in range(steps):
        try:
            step = np.linalg.solve(hessian, gradient)
        except np.linalg.LinAlgError:
            step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        share = 1.0
        while share > 1e-6:
            moved = beta - share * step
            found = at(moved)
            if found[2] <= loss * (1 + 1e-12) + 1e-12:
                break
            share /= 2
        else:
            break
        size = float(np.abs(share * step).max())
        beta, (hessian, gradient, loss) = moved, found
        if size <= tolerance * max(1.0, float(np.abs(beta).max())):
            break
    return beta[:-1], float(beta[-1] - beta[:-1] @ shift)


class LinearScorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Margin and probability of a logistic model, from the column ``features``."""

    coefficients = Param(
        Params._dummy(), "coefficients", "one per feature", TypeConverters.toListFloat
    )
    intercept = Param(Params._dummy(), "intercept", "margin of zeros", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, coefficients: list[float] | None = None, intercept: float = 0.0):
        super().__init__()
        self._set(intercept=intercept)
        if coefficients is not None:
            self._set(coefficients=coefficients)

    def terms(self) -> tuple[list[float], float]:
        return self.getOrDefault(self.coefficients), self.getOrDefault(self.intercept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        coefficients, intercept = self.terms()
        margin = F.lit(intercept)
        for i, c in enumerate(coefficients):
            margin = margin + F.col("_x")[i] * F.lit(c)
        p = 1 / (1 + F.exp(-F.col("_m")))
        return (
            dataset.withColumn("_x", vector_to_array("features"))
            .withColumn("_m", margin)
            .withColumns(
                {
                    "rawPrediction": array_to_vector(F.array(-F.col("_m"), F.col("_m"))),
                    "probability": array_to_vector(F.array(1 - p, p)),
                }
            )
            .drop("_x", "_m")
        )
