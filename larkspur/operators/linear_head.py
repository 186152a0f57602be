"""M3 and M10, the linear classification head over latents: trained by reweighted least squares, and applied.

A Newton step needs of the data only one Gram matrix and one gradient for each label. Tasks add up their
rows' share in numpy, the shares are summed by (label, cell) in Spark, and the driver solves as many
small systems as there are labels: what it holds has the size of the model. A positive row weighs as much as its label's
class weight; a small ridge on the weights, and a millionth of it on the bias, keeps separable labels finite.

Rows with a null vector or value, or a value that isn't finite, take no part in training; a null label counts for
the other labels only. A label with one class gets a bias of its sign, as large as the ridge allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.classification import class_weights
from larkspur.schema import CLASS_WEIGHTS, LABELS

#: The bias' share of the ridge.
BIAS_RIDGE = 1e-6


@dataclass
class LinearHeads:
    """``weights`` has a row for each label, the bias last."""

    labels: list[str]
    weights: np.ndarray
    steps: int
    loss: np.ndarray

    def scores(self, latents: DataFrame, key: str, column: str, relu: bool = True) -> DataFrame:
        """(key, label, score): the sigmoid of each label's line at each latent; null for a null latent."""
        x = F.col("_x")
        lines = [F.struct(F.lit(label).alias("label"), _line(x, w).alias("logit")) for label, w in zip(self.labels, self.weights.tolist(), strict=True)]
        rows = latents.select(F.col(key).alias(key), rectified(F.col(column), relu).alias("_x")).select(key, F.explode(F.array(*lines)).alias("l"))
        return rows.select(key, "l.label", (1 / (1 + F.exp(-F.col("l.logit")))).alias("score"))


def _line(x: Column, weights: list[float]) -> Column:
    w = F.array(*[F.lit(v) for v in weights[:-1]])
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(weights[-1]), lambda s, v: s + v)


def rectified(x: Column, relu: bool = True) -> Column:
    """A latent as the head takes it: negative values are 0."""
    doubles = x.cast("array<double>")
    return F.transform(doubles, lambda v: F.greatest(v, F.lit(0.0))) if relu else doubles


def positive_weights(rows: DataFrame, names: list[str]) -> dict[str, float]:
    """The published class weights where all ``names`` have one, else negatives over positives of each label (1 without positives)."""
    known = dict(zip(LABELS, CLASS_WEIGHTS, strict=True))
    if all(n in known for n in names):
        return {n: known[n] for n in names}
    long = rows.select(F.posexplode("ys").alias("label", "y")).where("y IS NOT NULL")
    found = {r["label"]: r["pos_weight"] for r in class_weights(long).collect()}  # a row for each label
    return {n: found.get(i) or 1.0 for i, n in enumerate(names)}


def newton_sums(rows: DataFrame, weights: np.ndarray, positive: np.ndarray) -> DataFrame:
    """(label, i, j, v): at ``weights``, the weighted Gram matrix of each label (j from 0), its gradient (j = -1) and its loss
    (i = j = -1). ``rows`` is (x, ys); the last of a vector's values is the bias' 1, which is added here."""
    labels, width = weights.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, slope, loss = np.zeros((labels, width, width)), np.zeros((labels, width)), np.zeros(labels)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ones((batch.num_rows, width))
            x[:, :-1] = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width - 1)
            y = np.array(batch.column(1).flatten().cast(pa.float64()).fill_null(np.nan)).reshape(batch.num_rows, labels)
            use = ~np.isnan(y)
            y = np.where(use, y, 0)
            z = x @ weights.T
            u = np.where(use, np.where(y > 0, positive, 1.0), 0.0)
            p = 1 / (1 + np.exp(-z))
            loss += (u * (np.logaddexp(0, z) - y * z)).sum(axis=0)
            slope += (u * (y - p)).T @ x
            r = u * p * (1 - p)
            for k in range(labels):
                gram[k] += (x * r[:, k : k + 1]).T @ x
        k, i = np.divmod(np.arange(labels * width), width)
        cells = [
            (np.repeat(np.arange(labels), width * width), np.tile(np.repeat(np.arange(width), width), labels), np.tile(np.arange(width), labels * width), gram.ravel()),
            (k, i, np.full(len(k), -1), slope.ravel()),
            (np.arange(labels), np.full(labels, -1), np.full(labels, -1), loss),
        ]
        label, i, j, v = (np.concatenate(c) for c in zip(*cells, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v)], ["label", "i", "j", "v"])

    return rows.select("x", "ys").mapInArrow(add, "label int, i int, j int, v double").groupBy("label", "i", "j").agg(F.sum("v").alias("v"))


def fit_heads(rows: DataFrame, names: list[str], latent: str, labels: str, relu: bool = True, ridge: float = 1e-3, positive: dict[str, float] | None = None, most_steps: int = 50, tolerance: float = 1e-10) -> LinearHeads:
    """Heads for ``names`` from latents and arrays of 0 and 1 (``labels``, in the order of ``names``), which are read once for each step."""
    x = rectified(F.col(latent), relu)
    used = rows.select(x.alias("x"), F.col(labels).cast("array<double>").alias("ys")).where("x IS NOT NULL AND ys IS NOT NULL")
    used = used.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    weight = positive or positive_weights(used, names)
    u = np.array([weight[n] for n in names])
    first = used.select(F.size("x").alias("n")).first()
    width = (first["n"] if first else 0) + 1
    shrink = ridge * np.append(np.ones(width - 1), BIAS_RIDGE)
    w, step, before, step_size = np.zeros((len(names), width)), np.zeros((len(names), width)), np.full(len(names), np.inf), np.ones(len(names))
    for n in range(1, most_steps + 1):
        got = newton_sums(used, w, u).toArrow()  # as many cells as the model has
        k, i, j, v = (got.column(c).to_numpy() for c in ("label", "i", "j", "v"))
        gram, slope, loss = np.zeros((len(names), width, width)), np.zeros((len(names), width)), np.zeros(len(names))
        gram[k[j >= 0], i[j >= 0], j[j >= 0]] = v[j >= 0]
        at = (j == -1) & (i >= 0)
        slope[k[at], i[at]] = v[at]
        loss[k[i == -1]] = v[i == -1]
        loss += (shrink * w * w).sum(axis=1) / 2
        worse = loss > before + 1e-12 * np.abs(before)  # a step that went too far is halved
        w = np.where(worse[:, None], w - step * step_size[:, None] / 2, w)
        step_size = np.where(worse, step_size / 2, 1.0)
        if (~worse).any():
            ok = np.flatnonzero(~worse)
            before[ok] = loss[ok]
            diagonal = np.einsum("kii->ki", gram)
            diagonal += shrink + 1e-12
            step[ok] = np.linalg.solve(gram[ok], (slope - shrink * w)[ok][:, :, None])[:, :, 0]
            w[ok] += step[ok]
            if not worse.any() and np.abs(step).max(initial=0) <= tolerance * (1 + np.abs(w).max(initial=0)):
                return LinearHeads(names, w, n, before)
    raise RuntimeError(f"the heads did not settle in {most_steps} steps")
