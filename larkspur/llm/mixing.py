"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Rates ``w`` stay as near to one copy of each document as the token constraints allow:
minimise ``sum w log w - w`` subject to ``sum w * size = target`` for each source and
``w <= cap``. The convex dual has one multiplier ``m`` for each source and gives
exponentially tilted rates ``w = min(cap, exp(m * size / mean))``. A rate depends only on
(source, size), so documents are counted by those two first and each safeguarded Newton
step is one aggregation of that table. Rates are then rounded into copies along sizes in
descending order, so a source misses its target by less than its largest document, and one
correction over size classes takes away most of what is left.

* null text: size 0, taken 0; a null source is a source of its own and comes last;
* sources of size 0 have target 0; equal rows are told apart by rank only;
* all sums and ranks use fixed orders and rounded multipliers, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.spark_util import distributed_rank, slices_for, stage_table

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(source, source_size, target). Weights repeat over sources by code point, null last; the
    excess over ``cap`` times a source's size is shared again by weight until none is above.

    The end of that sharing has a closed form: with sources sorted by cap size over weight, a
    prefix is full and the rest get ``level * weight``.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source
    w = F.array(*[F.lit(float(x)) for x in weights])
    ordered = sizes.withColumn("_i", F.row_number().over(by_name) - 1).withColumn("_w", F.element_at(w, (F.col("_i") % len(weights) + 1).cast("int"))).withColumn("_most", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("_most") / F.col("_w"), "_i")
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    full_before = F.coalesce(F.sum("_most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_from = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (total - full_before) / weight_from
    levels = ordered.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_most"))
    found = levels.withColumn("_final", F.first(F.when(F.col("_open"), F.col("_level")), ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return found.select("source", "source_size", F.least(F.col("_most"), F.coalesce(F.col("_final"), F.lit(float("inf"))) * F.col("_w")).alias("target"))


def tilts(cells: DataFrame, targets: DataFrame, cap: float, steps: int, tolerance: float) -> DataFrame:
    """(source, tilt): the dual multiplier of each source, by Newton steps kept inside a bracket."""
    # the rate at m is min(cap, exp(m z)); z = size / mean size of the source
    state = targets.join(cells.groupBy("source").agg(F.sum("n").alias("_docs")), targets["source"].eqNullSafe(cells["source"])).drop(cells["source"])
    state = state.where("source_size > 0").select("source", "source_size", "target", (F.col("source_size") / F.col("_docs")).alias("mean"), F.lit(0.0).alias("m"), F.lit(-64.0).alias("lo"), F.lit(64.0).alias("hi"), F.lit(False).alias("done"))
    state = stage_table(state, "tilts")
    for _ in range(steps):
        cell = cells.where("size > 0").withColumnRenamed("source", "_s").join(state.where(~F.col("done")), F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
        z = F.col("size") / F.col("mean")
        free = F.col("m") * z < F.log(F.lit(float(cap)))
        rate = F.when(free, F.exp(F.col("m") * z)).otherwise(F.lit(float(cap)))
        sums = cell.groupBy("source", "source_size", "target", "mean", "m", "lo", "hi").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.when(free, F.col("n") * F.col("size") * z * rate).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        stop = (F.abs(gap) <= F.col("target") * tolerance) | (F.col("hi") - F.col("lo") < 1e-13)
        low = F.when(gap < 0, F.col("m")).otherwise(F.col("lo"))
        high = F.when(gap > 0, F.col("m")).otherwise(F.col("hi"))
        step = F.col("m") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        nxt = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        moved = sums.select("source", "source_size", "target", "mean", F.when(stop, F.col("m")).otherwise(F.round(nxt, 12)).alias("m"), low.alias("lo"), high.alias("hi"), stop.alias("done"))
        state = stage_table(state.where("done").unionByName(moved), "tilts")
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "mean", F.round("m", 9).alias("tilt"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), cap: int = 3, seed: int = 29, steps: int = 60, tolerance: float = 1e-7) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of all documents."""
    rows = stage_table(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h")), "mix-sizes")
    cells = stage_table(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    targets = stage_table(source_targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size")), weights, cap), "mix-targets")
    tilt = tilts(cells, targets, cap, steps, tolerance).withColumnRenamed("source", "_s2")
    known = targets.withColumnRenamed("source", "_s1")
    rated = cells.join(known, F.col("source").eqNullSafe(F.col("_s1")), "left").drop("_s1").join(tilt, F.col("source").eqNullSafe(F.col("_s2")), "left").drop("_s2")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.round(F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(8.0)))), 9))
    rated = rated.withColumn("rate", F.coalesce(rate, F.lit(1.0)))
    # copies of a cell: the step of the floor of the running sum, from large sizes to small
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    run = F.round(F.sum(F.col("n") * F.col("rate")).over(down.rowsBetween(Window.unboundedPreceding, 0)), 6)
    cum = rated.withColumn("_to", F.floor(run + 0.5))
    copied = stage_table(cum.withColumn("k", F.least(F.col("n") * cap, F.greatest(F.lit(0), F.col("_to") - F.coalesce(F.lag("_to").over(down), F.lit(0)))).cast("long")).drop("_to"), "mix-copies")
    fixed = copied.join(corrections(copied, cap), (F.col("source").eqNullSafe(F.col("_fs"))) & (F.col("size") == F.col("_fsize")), "left").drop("_fs", "_fsize")
    cell = fixed.select(F.col("source").alias("_cs"), F.col("size").alias("_csize"), "n", "source_size", "target", "rate", (F.col("k") + F.coalesce(F.col("add"), F.lit(0))).alias("k"))
    cell = stage_table(cell, "mix-plan")
    slices = slices_for(rows.count())
    bits = slices.bit_length() - 1
    slot = F.shiftrightunsigned("_h", 64 - bits).cast("int") if bits else F.lit(0)
    ranked = distributed_rank(rows, ["source", "size"], slot, [F.shiftrightunsigned("_h", 1), F.col("_h"), F.col("doc_id")], out="_r")
    ranked = stage_table(ranked, "mix-ranked")
    joined = ranked.join(cell, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("size") == F.col("_csize")), "left").drop("_cs", "_csize", "_h")
    copies = F.expr("CAST((_r + 1) * k DIV n - _r * k DIV n AS INT)")
    out = joined.withColumn("copies", copies)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def corrections(copied: DataFrame, cap: int) -> DataFrame:
    """(_fs, _fsize, add): one cell of each size class (power of two) of a source takes up what rounding left,
    from large classes to small. A source has at most 63 classes, so its scan is one short array."""
    worth = copied.where("size > 0").withColumn("_class", F.floor(F.log2("size")).cast("int"))
    # the cell with the most documents of its class has the most room
    best = worth.groupBy("source", "_class").agg(F.max_by(F.struct("size", "n", "k"), F.struct("n", F.col("size"))).alias("c"))
    left = copied.groupBy("source").agg(F.first("target").alias("_target"), F.sum(F.col("k") * F.col("size")).alias("_got")).withColumnRenamed("source", "_ls")
    lists = best.groupBy("source").agg(F.sort_array(F.collect_list(F.struct(F.col("c.size").alias("size"), F.col("c.n").alias("n"), F.col("c.k").alias("k"))), asc=False).alias("cells"))
    both = lists.join(left, F.col("source").eqNullSafe(F.col("_ls"))).drop("_ls").withColumn("gap", F.round(F.col("_target") - F.col("_got"), 3))
    scan = f"""aggregate(cells, named_struct('gap', gap, 'out', cast(array() as array<struct<size:bigint,add:bigint>>)),
      (a, c) -> named_struct(
        'gap', a.gap - c.size * greatest(-c.k, least(c.n * {cap} - c.k, cast(round(a.gap / c.size) as bigint))),
        'out', array_append(a.out, named_struct('size', c.size, 'add', greatest(-c.k, least(c.n * {cap} - c.k, cast(round(a.gap / c.size) as bigint)))))))"""
    done = both.select("source", F.explode(F.expr(scan)["out"]).alias("x"))
    return done.where("x.add <> 0").select(F.col("source").alias("_fs"), F.col("x.size").alias("_fsize"), F.col("x.add").alias("add"))
