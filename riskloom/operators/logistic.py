"""Penalised logistic regression by Newton steps; each step is one aggregate over the rows.

Inputs are scaled to mean 0 and population deviation 1. The loss is the summed log loss plus
``penalty / 2`` times the squared weights; the intercept is free. A step needs the gradient and the
weighted Gram matrix, some k**2 sums for k features from each task, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.model_table import Model, Node, require_features
from riskloom.schemas import LABEL

#: Largest change of a coefficient at which the fit has settled.
TOLERANCE = 1e-9


def scales(rows: DataFrame, features: list[str]) -> list[tuple[float, float]]:
    """Mean and population deviation of each feature; a constant feature has deviation 1."""
    wanted = [f(F.col(c).cast("double")) for c in features for f in (F.avg, F.stddev_pop)]
    found = rows.agg(*wanted).first()
    return [(found[2 * i] or 0.0, found[2 * i + 1] or 1.0) for i in range(len(features))]


def _sums(rows: DataFrame, scaling: list[tuple[float, float]], beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed log loss, its gradient and its curvature at ``beta``; the first coefficient is the intercept.

    ``rows`` holds the outcome and then the inputs. A task adds up its rows batch by batch and returns the sums alone.
    """
    size = len(beta)
    means, deviations = (np.array(x) for x in zip(*scaling))

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient, curve = 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            y, *x = (np.asarray(column, np.float64) for column in batch.columns)
            z = np.column_stack([np.ones(len(y)), (np.column_stack(x) - means) / deviations])
            t = z @ beta
            small = np.exp(-np.abs(t))
            p = np.where(t >= 0, 1.0, small) / (1 + small)
            # log(1 + exp(t)) - y t, without overflow
            loss += float(np.sum(np.maximum(t, 0) + np.log1p(small) - y * t))
            gradient += z.T @ (p - y)
            curve += z.T @ (z * (p * (1 - p))[:, None])
        sums = np.concatenate([[loss], gradient, curve.ravel()])
        yield pa.RecordBatch.from_pydict({"sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    found = np.array([r.sums for r in rows.mapInArrow(add_up, "sums array<double>").collect()]).reshape(-1, 1 + size + size**2)
    total = found.sum(axis=0)
    return float(total[0]), total[1 : size + 1], total[size + 1 :].reshape(size, size)


def fit_logistic(
    rows: DataFrame,
    features: list[str],
    name: str,
    label: str = LABEL,
    penalty: float = 1.0,
    iterations: int = 1000,
) -> Model:
    """The penalised optimum; a step that would raise the loss is halved until it does not."""
    rows = require_features(rows.select(label, *features), features)
    scaling = scales(rows, features)
    inputs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    numbers = rows.select(F.col(label).cast("double").alias("y"), *inputs).where("y IS NOT NULL")
    ridge = np.diag([0.0, *[penalty] * len(features)])

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, curve = _sums(numbers, scaling, beta)
        return loss + beta @ ridge @ beta / 2, gradient + ridge @ beta, curve + ridge

    beta = np.zeros(len(features) + 1)
    loss, gradient, curve = at(beta)
    for _ in range(iterations):
        step = -np.linalg.lstsq(curve, gradient, rcond=None)[0]
        if np.abs(step).max() < TOLERANCE:
            break
        for _ in range(30):
            new = at(beta + step)
            if new[0] <= loss + 1e-9 * abs(loss):
                break
            step = step / 2
        beta = beta + step
        loss, gradient, curve = new
    nodes = [Node(0, 0, value=float(beta[0]))]
    for i, (feature, (mean, deviation)) in enumerate(zip(features, scaling), start=1):
        nodes.append(Node(-i, 0, feature, mean=mean, deviation=deviation, value=float(beta[i])))
    return Model(name, list(features), nodes)
