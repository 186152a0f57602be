"""Rank metrics. Every one starts from counts per (label, distinct score), so a window orders distinct scores of
one label, never all rows, and ties are exact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def levels(df: DataFrame) -> DataFrame:
    """(label, score, pos, neg, tp, fp, P, N): counts at each distinct score and at or above it."""
    base = df.groupBy("label", "score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    down = Window.partitionBy("label").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("label")
    return base.select("*", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"), F.sum("pos").over(all_).alias("P"), F.sum("neg").over(all_).alias("N"))


def auroc(df: DataFrame) -> DataFrame:
    """A3: ties count half; null with one class only."""
    below = F.col("N") - F.col("fp")
    return levels(df).groupBy("label").agg((F.sum(F.col("pos") * (below + F.col("neg") / 2)) / F.nullif(F.max(F.col("P") * F.col("N")), F.lit(0))).alias("auroc"))


def average_precision(df: DataFrame) -> DataFrame:
    """Step-wise sum; null without positives."""
    return levels(df).groupBy("label").agg(F.sum(F.col("pos") / F.nullif(F.col("P"), F.lit(0)) * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))


def roc_points(df: DataFrame) -> DataFrame:
    """(label, threshold, fpr, tpr) at each distinct score."""
    return levels(df).select("label", F.col("score").alias("threshold"), (F.col("fp") / F.nullif(F.col("N"), F.lit(0))).alias("fpr"), (F.col("tp") / F.nullif(F.col("P"), F.lit(0))).alias("tpr"))


def pr_trapezoid(df: DataFrame) -> DataFrame:
    """Area under precision over recall by trapezoids, from (0, 1)."""
    points = levels(df).select("label", "score", (F.col("tp") / F.nullif(F.col("P"), F.lit(0))).alias("r"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("p"))
    w = Window.partitionBy("label").orderBy(F.col("score").desc())
    steps = points.select("label", ((F.col("r") - F.lag("r", 1, 0.0).over(w)) * (F.col("p") + F.lag("p", 1, 1.0).over(w)) / 2).alias("a"))
    return steps.groupBy("label").agg(F.sum("a").alias("pr_auc"))


def partial_auroc(df: DataFrame, limit: float = 0.2) -> DataFrame:
    """Trapezoids over curve points with fpr below ``limit``, the origin included; null with fewer than two points."""
    points = roc_points(df).where(F.col("fpr") < limit)
    w = Window.partitionBy("label").orderBy(F.col("threshold").desc())
    steps = points.select("label", ((F.col("fpr") - F.lag("fpr", 1, 0.0).over(w)) * (F.col("tpr") + F.lag("tpr", 1, 0.0).over(w)) / 2).alias("a"))
    return df.select("label").distinct().join(steps.groupBy("label").agg(F.sum("a").alias("partial_auroc")), "label", "left")


def youden(df: DataFrame) -> DataFrame:
    """Sensitivity and specificity at the largest tpr - fpr; the highest threshold wins ties; (0, 0) if never positive."""
    j = F.col("tpr") - F.col("fpr")
    best = roc_points(df).groupBy("label").agg(F.max_by(F.struct("tpr", "fpr", "threshold"), F.struct(j, F.col("threshold"))).alias("b"), F.max(j).alias("j"))
    on = F.col("j") > 0
    return best.select("label", F.when(on, F.col("b.tpr")).otherwise(0.0).alias("sensitivity"), F.when(on, 1 - F.col("b.fpr")).otherwise(0.0).alias("specificity"), F.when(on, F.col("b.threshold")).alias("threshold"))


def youden_threshold(df: DataFrame) -> DataFrame:
    """(label, threshold): the operating point of the largest tpr - fpr, whatever its sign; the highest wins ties."""
    best = roc_points(df).groupBy("label").agg(F.max_by("threshold", F.struct(F.col("tpr") - F.col("fpr"), F.col("threshold"))).alias("threshold"))
    return best


def grid_threshold(df: DataFrame, steps: int = 100) -> DataFrame:
    """Of ``steps`` thresholds from 0 to 1 the one nearest to the corner, strict ``>``; the last wins ties.

    Counts per distinct score meet the grid, so the product has ``steps`` rows per distinct score, not per row.
    """
    at = levels(df).select("label", "score", "pos", "neg", "P", "N")
    grid = at.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn("t", F.col("i") / (steps - 1))
    hit = F.col("score") > F.col("t")
    rates = grid.groupBy("label", "i", "t").agg((F.sum(F.when(hit, F.col("pos")).otherwise(0)) / F.nullif(F.max("P"), F.lit(0))).alias("tpr"), (F.sum(F.when(hit, F.col("neg")).otherwise(0)) / F.nullif(F.max("N"), F.lit(0))).alias("fpr"))
    away = F.round(F.sqrt((1 - F.col("tpr")) * (1 - F.col("tpr")) + F.col("fpr") * F.col("fpr")), 12)
    return rates.groupBy("label").agg(F.min_by("t", F.struct(away, -F.col("i"))).alias("threshold"), F.min(away).alias("distance"))


def top_k_label_accuracy(df: DataFrame) -> DataFrame:
    """For every k the mean over keys of hits among the k best labels over min(k, positives); 1 without positives."""
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), "label")
    ranked = df.select("key", F.row_number().over(best).cast("long").alias("k"), F.sum("y").over(best.rowsBetween(Window.unboundedPreceding, 0)).alias("hits"), F.sum("y").over(Window.partitionBy("key")).alias("P"))
    value = F.when(F.col("P") == 0, 1.0).otherwise(F.col("hits") / F.least("k", "P"))
    return ranked.groupBy("k").agg(F.avg(value).alias("accuracy"))


def top_k_accuracy(df: DataFrame, k: int) -> DataFrame:
    """A19 for single labels: share of keys whose positive label is among the ``k`` best-scored; ties to the smaller name."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("score").desc(), "label"))
    hit = df.select("key", (F.col("y") * (place <= k).cast("int")).alias("h")).groupBy("key").agg(F.max("h").alias("h"))
    return hit.agg(F.avg(F.col("h").cast("double")).alias("accuracy"))


def top_1_accuracy(df: DataFrame) -> DataFrame:
    """Share of keys whose best-scored label is positive."""
    best = df.groupBy("key").agg(F.max_by("y", F.struct("score", "label")).alias("y"))
    return best.agg(F.avg(F.col("y").cast("double")).alias("accuracy"))
