"""Multi-label classification metrics over the long form ``(key, label, y, yhat)``; one pass of counts feeds them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)).cast("double")


def confusion(df: DataFrame, *by: str) -> DataFrame:
    """Tp, fp, fn, tn."""
    y, p = F.col("y") == 1, F.col("yhat") == 1
    return df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, f1, accuracy and support."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *[c for c in counts.columns if c not in ("tp", "fp", "fn", "tn")],
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        (tp + fn).alias("support"),
    )


METRICS = ("precision", "recall", "f1")


def report(df: DataFrame) -> DataFrame:
    """Rows per label, micro, macro, weighted and samples averages (precision, recall, f1, support)."""
    counts = confusion(df, "label")
    per_label = scores(counts)
    columns = ["label", *METRICS, "support"]
    micro = scores(counts.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).withColumn("label", F.lit("micro avg")))
    macro = per_label.agg(*[F.avg(c).alias(c) for c in METRICS], F.sum("support").alias("support")).withColumn("label", F.lit("macro avg"))
    weighted = per_label.agg(*[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in METRICS], F.sum("support").alias("support")).withColumn("label", F.lit("weighted avg"))
    samples = scores(confusion(df, "key")).agg(*[F.avg(c).alias(c) for c in METRICS], F.sum("support").alias("support")).withColumn("label", F.lit("samples avg"))
    out = per_label.select(*columns)
    for part in (micro, macro, weighted, samples):
        out = out.unionByName(part.select(*columns))
    return out


def with_weighted_row(df: DataFrame) -> DataFrame:
    """Per label and one support-weighted row."""
    per_label = scores(confusion(df, "label")).select("label", *METRICS, "support")
    total = per_label.agg(*[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in METRICS], F.sum("support").alias("support"))
    return per_label.unionByName(total.withColumn("label", F.lit("Weighted Average")))


def crg(df: DataFrame) -> DataFrame:
    """A5: the clinically weighted score; an error if nothing is positive."""
    c = df.agg(F.count(F.lit(1)).alias("X"), F.count_if(F.col("y") == 1).alias("A"), F.count_if((F.col("y") == 1) & (F.col("yhat") == 1)).alias("TP"), F.count_if((F.col("y") == 1) & (F.col("yhat") == 0)).alias("FN"), F.count_if((F.col("y") == 0) & (F.col("yhat") == 1)).alias("FP"))
    positive = F.when(F.col("A") == 0, F.raise_error(F.lit("no positive label: CRG is undefined"))).otherwise(F.col("A"))
    c = c.withColumn("r", (F.col("X") - F.col("A")) / (2 * positive)).withColumn("U", (F.col("X") - F.col("A")) / 2)
    c = c.withColumn("score_s", F.col("r") * F.col("TP") - F.col("r") * F.col("FN") - F.col("FP"))
    return c.withColumn("CRG", ratio(F.col("U"), 2 * F.col("U") - F.col("score_s")))


def clinical_rates(df: DataFrame) -> DataFrame:
    """Sensitivity, specificity, ppv, npv; null where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    div = lambda a, b: a / F.nullif(b, F.lit(0))
    return confusion(df, "label").select("label", div(tp, tp + fn).alias("sensitivity"), div(tn, tn + fp).alias("specificity"), div(tp, tp + fp).alias("ppv"), div(tn, tn + fn).alias("npv"))


def percent_scores(df: DataFrame) -> DataFrame:
    """Micro f1, macro f1 and flat accuracy, times 100."""
    counts = confusion(df, "label")
    macro = scores(counts).agg(F.avg("f1").alias("m"))
    total = counts.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    one = scores(total).crossJoin(macro)  # one row each
    return one.select((F.col("f1") * 100).alias("micro_f1"), (F.col("m") * 100).alias("macro_f1"), (F.col("accuracy") * 100).alias("flat_accuracy"))


def both_class_f1(df: DataFrame) -> DataFrame:
    """A10: f1 of both classes of each label, weighted by class size."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    one, zero = ratio(2 * tp, 2 * tp + fp + fn), ratio(2 * tn, 2 * tn + fp + fn)
    return confusion(df, "label").select("label", ratio(one * (tp + fn) + zero * (tn + fp), tp + fp + fn + tn).alias("f1_weighted"))


def class_weights(df: DataFrame) -> DataFrame:
    """Negatives over positives of each label."""
    return df.groupBy("label").agg((F.count_if(F.col("y") == 0) / F.nullif(F.count_if(F.col("y") == 1), F.lit(0))).alias("pos_weight"))
