"""Spark helpers shared by the training-data operators.

``stage_table`` cuts lineage by writing a table to the folder that all executors
share (``spark.checkpoint.dir``); losing an executor never loses what it wrote.
``distributed_rank`` numbers rows inside a key without gathering the key in one
task: rows are dealt by slices of a uniform hash and each slice starts at the
count of the slices before it.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
import re
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most bytes of an Arrow batch; a longer row is a batch of its own.
BATCH_BYTES = "8m"
#: Slices whose totals are summed together.
BLOCK = 1_024
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. Where none is set, a local session gets a temporary one; a cluster has none that all see."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _drop_all() -> None:
    while _written:
        spark, path = _written.pop()
        try:
            delete_path(spark, path)
        except Exception:  # the session has ended: the cluster clears its checkpoint folder itself
            return


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_table(df: DataFrame) -> None:
    """Remove a staged table that no later plan reads."""
    path = getattr(df, "_staged_at", None)
    if path:
        delete_path(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


def fresh_names(taken: list[str], *wanted: str) -> list[str]:
    """``wanted``, with underscores before them until none is a name that is taken, in either case."""
    lower = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in lower:
            name = f"_{name}"
        lower.add(name.lower())
        out.append(name)
    return out


def give_back_memory() -> None:
    """Return what this Python, the driver's or a worker's, has freed to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def give_back_shuffles(spark: SparkSession) -> None:
    """Let the cluster delete the shuffle files of plans that are no longer held."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Rows in an Arrow batch while the jobs inside run, and at most ``BATCH_BYTES``; small where a row holds a whole text."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def slices_for(rows: int, per_slice: int = 2_000) -> int:
    """A power of two of slices with about ``per_slice`` rows in each."""
    n = 1
    while n * per_slice < rows:
        n *= 2
    return n


def distributed_rank(df: DataFrame, keys: list[str], slot: Column, order: list[Column], out: str = "rank") -> DataFrame:
    """Add ``out``: 0-based rank inside ``keys`` by (``slot``, ``order``).

    ``slot`` must be non-decreasing in the wanted order and deal the rows of one key
    evenly over its values, so a key with a third of all rows is ranked by many tasks.
    Slices start at running sums of two levels, so the totals of a key are summed by many
    tasks too: one task orders a total for each ``BLOCK`` slices.
    """
    dealt = df.withColumn("_slice", slot.cast("int"))
    sizes = dealt.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_block", F.floor(F.col("_slice") / BLOCK).cast("int"))
    inner = Window.partitionBy(*keys, "_block").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy(*keys, "_block").agg(F.sum("_n").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(outer), F.lit(0)))
    blocks = blocks.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], F.col("_block").alias("_block2"), "_first")
    same = F.col("_block") == F.col("_block2")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_b{i}"))
    starts = sizes.withColumn("_inner", F.coalesce(F.sum("_n").over(inner), F.lit(0))).join(blocks, same).withColumn("_start", F.col("_first") + F.col("_inner"))
    renamed = starts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_slice2"), "_start")
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = dealt.withColumn("_rn", F.row_number().over(within))
    on = F.col("_slice") == F.col("_slice2")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (
        numbered.join(renamed, on, "left")
        .withColumn(out, (F.col("_start") + F.col("_rn") - 1).cast("long"))
        .drop("_slice", "_slice2", "_rn", "_start", *[f"_k{i}" for i in range(len(keys))])
    )
