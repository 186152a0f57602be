"""Connected components by alternating large-star and small-star steps.

Every step is a join and an aggregation; a node with very many neighbours is reduced
by partial aggregation and its join is split by the skew-join rule. Each round is
written to the shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.spark_util import drop_table, stage_table

#: Links that a task contracts together.
TOGETHER = 1 << 20


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node. Rounds go on until nothing changes."""
    edges = stage_table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: every larger neighbour of u hangs on the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u, and u, hang on the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stage_table(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop_table(edges)
        edges = nxt
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def least_labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the links a-b, for nodes that aren't the least themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        while (after != (further := after[after])).any():
            after = further
        if (after == label).all():
            own = label != np.arange(len(nodes))
            return nodes[own], nodes[label[own]]
        label = after


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) to (node, least node of its component in this task)."""

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(2))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in least_labels(u, v)], ["u", "v"])

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            yield answer(held)
            held, rows = [], 0
    if rows:
        yield answer(held)


def contracted_components(links: DataFrame) -> DataFrame:
    """As ``connected_components``, for links that are already dealt so that most of a component's lie in few tasks.

    A round contracts the links of each task to stars around its least nodes; so a node has one parent for each task at most.
    Its parents are then hung on the least of them, and every node on its parent's parent. A round in which nothing moves is the last.
    """
    edges = stage_table(links.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u <> v"), "edges")
    by = Window.partitionBy("u").orderBy("v")
    while True:
        stars = edges.select("u", "v").mapInArrow(contract, "u long, v long")
        parents = stars.select("u", "v", F.first("v").over(by).alias("m"), F.row_number().over(by).alias("r"))
        above = parents.where("r = 1").select(F.col("u").alias("_u"), F.col("m").alias("_m"))
        hung = parents.where("r = 1 OR v <> m").select(F.when(F.col("r") == 1, F.col("u")).otherwise(F.col("v")).alias("u"), "m", (F.col("r") > 1).alias("more"))
        jumped = hung.join(above, F.col("m") == F.col("_u"), "left")
        after = stage_table(jumped.select("u", F.coalesce("_m", "m").alias("v"), (F.col("more") | F.col("_m").isNotNull()).alias("moved")), "edges")
        drop_table(edges)
        edges = after
        if not edges.agg(F.max("moved").alias("moved")).first()["moved"]:
            break
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(edges.select("v", "v").distinct().toDF("node", "component"))
