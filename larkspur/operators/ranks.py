"""Positions in a total order without one task that sorts everything.

A bounded sample of the order column gives bounds, each slice between two bounds is sorted by
a task of its own, and slices start at the counts of the slices before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most slices, and sampled values of each; bounds what the driver gathers.
SLICES, SAMPLED = 256, 32


def global_rank(df: DataFrame, order: Column, out: str, ties: tuple[Column, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with 0-based positions by ``order`` (then ``ties``), inside each group of ``by``. Nulls come first. Rows of one
    value of ``order`` share a slice, so it should tell rows apart."""
    n = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), SLICES)
    keyed = df.withColumn("_k", order)
    seen = keyed.select("_k").where("_k IS NOT NULL").orderBy(F.xxhash64("_k"), "_k").limit(n * SAMPLED).collect()
    bounds = sorted({r["_k"] for r in seen})
    bounds = sorted({bounds[len(bounds) * i // n] for i in range(1, n)}) if bounds else []
    kind = keyed.schema["_k"].dataType
    above = F.size(F.filter(F.array(*[F.lit(b).cast(kind) for b in bounds]), lambda b: b <= F.col("_k"))) if bounds else F.lit(0)
    sliced = keyed.withColumn("_s", F.when(F.col("_k").isNull(), F.lit(-1)).otherwise(above))
    counts = sliced.groupBy(*by, "_s").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # a row for each slice
    starts = counts.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)], F.col("_s").alias("_s2"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy(*by, "_s").orderBy("_k", *ties)) - 1
    same = F.col("_s") == F.col("_s2")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_b{i}"))
    ranked = sliced.withColumn("_i", inside).join(starts, same)
    return ranked.withColumn(out, (F.col("_first") + F.col("_i")).cast("long")).drop("_k", "_s", "_s2", "_i", "_first", *[f"_b{i}" for i in range(len(by))])
