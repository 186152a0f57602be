"""V9, the contrastive loss of paired vectors, over all pairs but without their matrix.

Rows are dealt to blocks and every two blocks are a tile. A task multiplies one tile at a time, in strips of about ``CELLS``
cells, and keeps, for each row and each column of it, the largest similarity and the sum of exponentials below it. These
two numbers merge in any order, so the logarithm of a whole row's or column's sum follows from its strips' and tiles'.
A row travels once for each block, in either role and in its own type; blocks have ``BLOCK`` rows, so a tile's memory is bounded
and what travels is small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.retrieval import dot

#: Rows of a block, about, and cells of a strip.
BLOCK, CELLS = 32_768, 1 << 20


def masked_mean(values: Column, mask: Column, eps: float = 1e-6) -> Column:
    """Mean of the ``values`` whose ``mask`` is true; 0 where none is, as the count is ``eps`` at least."""
    kept = F.zip_with(values.cast("array<double>"), mask, lambda v, m: F.when(m, v).otherwise(0.0))
    count = F.aggregate(mask, F.lit(0.0), lambda s, m: s + F.when(m, 1.0).otherwise(0.0))
    return F.aggregate(kept, F.lit(0.0), lambda s, v: s + v) / F.greatest(count, F.lit(eps))


def diagonal(pairs: DataFrame, temperature: float = 1.0) -> DataFrame:
    """(key, own): each pair's own similarity. ``pairs`` is (key, x, y)."""
    return pairs.select("key", (dot(F.col("x"), F.col("y")) * temperature).alias("own"))


def merged_sums(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lse): log of the sum of exponentials from (keys, most, total) parts, ``total`` relative to ``most``."""
    top = F.max("most").over(Window.partitionBy(*keys))
    scaled = parts.withColumn("_top", top)
    return scaled.groupBy(*keys).agg((F.max("_top") + F.log(F.sum(F.col("total") * F.exp(F.col("most") - F.col("_top"))))).alias("lse"))


def strip_sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(largest, sum of exponentials below it) of the rows and of the columns of ``s``; an empty sum has the largest ``-inf`` and is 0."""
    rows, columns = s.max(axis=1), s.max(axis=0)
    top = rows.max()
    if not np.isfinite(rows).all() or top - columns.min() > 500:  # too far apart for one set of exponentials
        shifted = lambda most, axis: np.exp(s - np.expand_dims(np.where(np.isfinite(most), most, 0), axis)).sum(axis=axis)
        return rows, shifted(rows, 1), columns, shifted(columns, 0)
    s = np.exp(s - rows[:, None])
    return rows, s.sum(axis=1), columns, (np.exp(rows - top) @ s) * np.exp(top - columns)


def log_sums(pairs: DataFrame, temperature: float = 1.0, decoupled: bool = False, block: int = BLOCK) -> DataFrame:
    """(key, side, lse): log of the sum of exponentials of ``x`` with every ``y`` (side ``x``) and of ``y`` with every
    ``x`` (side ``y``). ``decoupled`` leaves a pair's own similarity out. ``pairs`` is (key, x, y) with one row for a key."""
    rows = pairs.where("x IS NOT NULL AND y IS NOT NULL")
    blocks = max(1, -(-rows.count() // block))
    own = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    left = rows.select("key", F.col("x").alias("v"), F.lit(True).alias("is_x"), own.alias("i"), F.explode(others).alias("j"))
    right = rows.select("key", F.col("y").alias("v"), F.lit(False).alias("is_x"), own.alias("j"), F.explode(others).alias("i"))
    kind = pairs.schema["key"].dataType.simpleString()

    def tile(table: pa.Table) -> pa.Table:
        keys, is_x = table.column("key").combine_chunks(), table.column("is_x").to_numpy()
        lists = table.column("v").combine_chunks()
        width = len(lists[0])
        v = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), width)
        a, b = np.flatnonzero(is_x), np.flatnonzero(~is_x)
        sides = []
        if len(a) and len(b):
            y = v[b].astype(float, copy=False).T
            place = {k: n for n, k in enumerate(keys.take(pa.array(b)).to_pylist())} if decoupled else {}
            own_place = np.array([place.get(k, -1) for k in keys.take(pa.array(a)).to_pylist()]) if decoupled else None
            x_most, x_total = np.full(len(a), -np.inf), np.zeros(len(a))
            y_most, y_total = np.full(len(b), -np.inf), np.zeros(len(b))
            step = max(1, CELLS // len(b))
            for low in range(0, len(a), step):
                s = v[a[low : low + step]].astype(float, copy=False) @ y * temperature
                if decoupled:
                    at = own_place[low : low + step]
                    held = np.flatnonzero(at >= 0)
                    s[held, at[held]] = -np.inf
                most, total, columns, below = strip_sums(s)
                x_most[low : low + step], x_total[low : low + step] = most, total
                after = np.maximum(y_most, columns)
                safe = np.where(np.isfinite(after), after, 0)
                y_total = y_total * np.exp(y_most - safe) + np.where(np.isfinite(columns), below * np.exp(columns - safe), 0)
                y_most = after
            for side, rows_of, most, total in (("x", a, x_most, x_total), ("y", b, y_most, y_total)):
                keep = np.isfinite(most)
                sides.append(pa.table({"key": keys.take(pa.array(rows_of[keep])), "side": pa.array([side] * int(keep.sum())), "most": most[keep], "total": total[keep]}))
        empty = pa.table({"key": keys.slice(0, 0), "side": pa.array([], pa.string()), "most": pa.array([], pa.float64()), "total": pa.array([], pa.float64())})
        return pa.concat_tables(sides or [empty])

    parts = left.unionByName(right).groupBy("i", "j").applyInArrow(tile, f"key {kind}, side string, most double, total double")
    return merged_sums(parts, ["key", "side"])


def contrastive_loss(pairs: DataFrame, temperature: float = 1.0, decoupled: bool = False, block: int = BLOCK) -> DataFrame:
    """One row (n, x_to_y, y_to_x, loss): mean of ``lse - own`` in both directions, and the mean of the two."""
    sums = log_sums(pairs, temperature, decoupled, block).join(diagonal(pairs, temperature), "key")
    mean = lambda side: F.avg(F.when(F.col("side") == side, F.col("lse") - F.col("own")))
    return sums.agg(F.count_if(F.col("side") == "x").alias("n"), mean("x").alias("x_to_y"), mean("y").alias("y_to_x")).withColumn("loss", (F.col("x_to_y") + F.col("y_to_x")) / 2)
