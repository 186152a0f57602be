"""Distances between feature distributions. Spark sums n, x and x xT per group; the d x d algebra of each group runs
where its sums are merged, so no feature row leaves its executor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ranks import global_rank


def moments(df: DataFrame, by: str, side: str, vector: str) -> DataFrame:
    """(by, side, n, s, ss): partial sums of each Arrow batch; at most one row per batch and group."""
    rows = df.select(F.col(by).cast("string").alias("g"), F.col(side).cast("string").alias("side"), F.col(vector).cast("array<double>").alias("v"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            keys = pd.MultiIndex.from_arrays([batch.column(0).to_pylist(), batch.column(1).to_pylist()])
            codes, values = keys.factorize()
            out = [[], [], [], [], []]
            for i, (g, s) in enumerate(values):
                own = x[codes == i]
                for column, value in zip(out, (g, s, len(own), own.sum(axis=0).tobytes(), (own.T @ own).tobytes()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())], ["g", "side", "n", "s", "ss"])

    return rows.mapInArrow(sums, "g string, side string, n long, s binary, ss binary")


def sqrt_psd(m: np.ndarray) -> np.ndarray:
    w, v = np.linalg.eigh((m + m.T) / 2)
    return (v * np.sqrt(np.clip(w, 0, None))) @ v.T


def frechet_from(n1: int, s1: np.ndarray, q1: np.ndarray, n2: int, s2: np.ndarray, q2: np.ndarray) -> float:
    """A23 from sums: |m1 - m2|^2 + tr(C1 + C2 - 2 (C1^1/2 C2 C1^1/2)^1/2); at least two rows on each side."""
    if min(n1, n2) < 2:
        raise ValueError("a covariance needs two rows")
    m1, m2 = s1 / n1, s2 / n2
    c1, c2 = (q1 - n1 * np.outer(m1, m1)) / (n1 - 1), (q2 - n2 * np.outer(m2, m2)) / (n2 - 1)
    root = sqrt_psd(c1)
    w = np.linalg.eigvalsh((lambda m: (m + m.T) / 2)(root @ c2 @ root))
    return float(((m1 - m2) ** 2).sum() + np.trace(c1) + np.trace(c2) - 2 * np.sqrt(np.clip(w, 0, None)).sum())


def frechet(df: DataFrame, by: str, side: str, vector: str, thin: bool = False) -> DataFrame:
    """(g, frechet) between the two sides of each group. With ``thin``, a group with fewer than two rows on a
    side, which has no covariance, gets null; else it is an error."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = {}
        for side_, part in pdf.groupby("side"):
            s = sum(np.frombuffer(x) for x in part["s"])
            total[side_] = (int(part["n"].sum()), s, sum(np.frombuffer(x) for x in part["ss"]).reshape(len(s), len(s)))
        if len(total) != 2:
            raise ValueError(f"group {pdf['g'].iloc[0]} has {len(total)} sides, not 2")
        a, b = (total[k] for k in sorted(total))
        if thin and min(a[0], b[0]) < 2:
            return pd.DataFrame({"g": [pdf["g"].iloc[0]], "frechet": [None]}).astype({"frechet": float})
        return pd.DataFrame({"g": [pdf["g"].iloc[0]], "frechet": [frechet_from(*a, *b)]})

    return moments(df, by, side, vector).groupBy("g").applyInPandas(merge, "g string, frechet double")


def frechet_by_chunk(pairs: DataFrame, name: str, real: str, made: str, size: int = 4) -> DataFrame:
    """(g, frechet) of each chunk of ``size`` consecutive pairs by name; a last chunk of one pair has null, which
    means leave out."""
    ranked = global_rank(pairs, F.col(name), "_pos").withColumn("chunk", F.floor(F.col("_pos") / size))
    sides = F.explode(F.array(F.struct(F.lit("real").alias("side"), F.col(real).alias("v")), F.struct(F.lit("made").alias("side"), F.col(made).alias("v"))))
    return frechet(ranked.select("chunk", sides.alias("x")).select("chunk", "x.side", "x.v"), "chunk", "side", "v", thin=True)


def column_moments(df: DataFrame, vector: str) -> DataFrame:
    """(i, j, mean_i, cov) of the vectors' components; cov is null for one vector. Tasks add up products of what is left of the means, a row for each
    pair of components and task; no vector becomes rows of its own. Null vectors take no part."""
    rows = df.select(F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
    sums = rows.mapInArrow(_component_sums, "i int, n long, s double").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()  # a row for each component
    means = np.array([r["s"] / r["n"] for r in sums])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(means)
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d) - means
                total += x.T @ x
        i, j = np.divmod(np.arange(d * d, dtype=np.int32), max(d, 1))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(means[i] if d else np.zeros(0)), pa.array(total.ravel())], ["i", "j", "mean_i", "q"])

    count = sums[0]["n"] if sums else 0
    cells = rows.mapInArrow(products, "i int, j int, mean_i double, q double").groupBy("i", "j").agg(F.first("mean_i").alias("mean_i"), F.sum("q").alias("q"))
    return cells.select("i", "j", "mean_i", (F.col("q") / F.nullif(F.lit(count - 1), F.lit(0))).alias("cov"))


def _component_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            s = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s), dtype=np.int32)), pa.array(np.full(len(s), batch.num_rows)), pa.array(s)], ["i", "n", "s"])
