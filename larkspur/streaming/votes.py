"""The vote log as a stream (an addition; the evaluators only append to it): watermarked counts per window and type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

VOTES = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_votes(spark: SparkSession, directory: str, kind: str = "parquet") -> DataFrame:
    return spark.readStream.schema(VOTES).format(kind).load(directory)


def windowed(votes: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total); rows later than ``late`` behind the newest are dropped by the watermark."""
    w = votes.withWatermark("ts", late) if votes.isStreaming else votes
    return w.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def write_windows(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished windows as Parquet, exactly once by the checkpoint."""
    return df.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
