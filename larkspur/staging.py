"""Tables written between the rounds of an iterative job, in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it gets a temporary folder, a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: its lineage ends here, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def dropped(df: DataFrame) -> None:
    """Remove a staged table that no later plan reads."""
    path = getattr(df, "_staged_at", None)
    if path:
        _delete(df.sparkSession, path)
        _written[:] = [x for x in _written if x[1] != path]


@atexit.register
def _drop_all() -> None:
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # the session has ended: the cluster clears its folder itself
            return
