"""A29, loss accumulators and early stopping over training histories of any length.

A run's epochs in order are a scan with resets: a loss below all before it is the best so far and resets the
patience. The scan's states merge, so it needs no task that sees a whole run: epochs are numbered over all
tasks, blocks of ``BLOCK`` epochs are reduced to their least loss, running minima over blocks tell
each block where it begins, and inside a block it is a window. The last reset before each epoch is a running
maximum, found in the same two levels; the run stops at the first epoch that lies ``patience`` epochs behind it.

A null loss, or one that isn't a number, is never better; the first epoch with a loss is. A run without one has no best epoch and
counts its patience from its first epoch. Rows of one run and epoch are ordered by loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ranks import global_rank

#: Epochs of a block.
BLOCK = 4_096


def epoch_losses(steps: DataFrame) -> DataFrame:
    """(run, epoch, loss, accuracy, steps): means over batches of (run, epoch, loss, correct, size); accuracy over examples, in percent."""
    return steps.groupBy("run", "epoch").agg(F.avg("loss").alias("loss"), (100.0 * F.sum("correct") / F.nullif(F.sum("size"), F.lit(0))).alias("accuracy"), F.count("loss").alias("steps"))


def running(df: DataFrame, key: str, position: str, value: Column, reduce, out: str, block: int = BLOCK) -> DataFrame:
    """``df`` with ``reduce`` (``F.min`` or ``F.max``) of ``value`` over the rows before each one, by 0-based ``position`` inside ``key``."""
    rows = df.withColumn("_v", value).withColumn("_block", F.floor(F.col(position) / block))
    blocks = rows.groupBy(key, "_block").agg(reduce("_v").alias("_v"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    starts = blocks.select(F.col(key).alias("_key2"), F.col("_block").alias("_block2"), reduce("_v").over(earlier).alias("_start"))
    inside = Window.partitionBy(key, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    least_or_most = F.least if reduce is F.min else F.greatest
    met = rows.withColumn("_inside", reduce("_v").over(inside)).join(starts, F.col(key).eqNullSafe(F.col("_key2")) & (F.col("_block") == F.col("_block2")))
    return met.withColumn(out, least_or_most("_start", "_inside")).drop("_v", "_block", "_key2", "_block2", "_start", "_inside")


def early_stops(history: DataFrame, patience: int, block: int = BLOCK) -> DataFrame:
    """(run, best_epoch, best_loss, stop_epoch, epochs) of (run, epoch, loss): the epoch that is kept, the one after which training ends
    (null: it never does) and the number of epochs trained."""
    loss = F.when(~F.isnan("loss"), F.col("loss"))
    rows = history.select("run", "epoch", loss.alias("loss"))
    placed = global_rank(rows, F.col("epoch"), "at", ties=(F.col("loss"),), by=("run",))
    best = running(placed, "run", "at", F.col("loss"), F.min, "least", block)
    improves = F.col("loss").isNotNull() & (F.col("least").isNull() | (F.col("loss") < F.col("least")))
    marked = best.withColumn("reset", F.when(improves, F.col("at")))
    since = running(marked, "run", "at", F.col("reset"), F.max, "last", block).withColumn("last", F.coalesce("reset", "last"))
    stops = since.where(F.col("at") - F.coalesce("last", F.lit(-1)) >= patience).groupBy("run").agg(F.min("at").alias("stop"))
    stops = stops.withColumnRenamed("run", "_run")
    until = since.join(stops, F.col("run").eqNullSafe(F.col("_run")), "left").where(F.col("stop").isNull() | (F.col("at") <= F.col("stop")))
    kept = F.max(F.when(F.col("reset").isNotNull(), F.struct("reset", "epoch", "loss"))).alias("b")
    ended = F.max(F.when(F.col("at") == F.col("stop"), F.col("epoch"))).alias("stop_epoch")
    return until.groupBy("run").agg(kept, ended, F.count(F.lit(1)).alias("epochs")).select("run", F.col("b.epoch").alias("best_epoch"), F.col("b.loss").alias("best_loss"), "stop_epoch", "epochs")
