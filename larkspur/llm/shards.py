"""Sharding by proportional stratified interleaving.

Rows of each source are shuffled by a seeded hash of id, checksum and size, and ranked; a row's fractional rank is
``(rank + 1/2) / rows of its source``. Sorted by fractional rank, any contiguous run of the
corpus holds every source in proportion, so cutting the sorted rows into equal runs makes
every shard match the mixture. Law: ``rows`` (counts at most one apart).

* a null source is a source of its own; null text: 0 bytes, checksum of the empty text;
* groups of equal texts get no treatment under the law ``rows``: each row is a row, copies are dealt
  like others and may lie in several shards;
* rows of equal hash follow ``doc_id``, checksum and size; full duplicates are interchangeable;
* very long texts count as one row like any other;
* an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.spark_util import distributed_rank, slices_for, stage_table


def hash60(*parts: Column | str) -> Column:
    """The first 60 bits of the MD5 digest of the parts, joined by colons; null is the empty string."""
    columns = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 15), 16, 10).cast("long")


def interleave(rows: DataFrame, source: str = "source", seed: int = 17, shards: int = 40) -> DataFrame:
    """Add ``shard`` and ``slot`` to rows (doc_id, size, text_crc32, and their source). ``rows`` should be narrow: it moves three times."""
    seeded = stage_table(rows.withColumn("_h", hash60(F.lit(seed), "doc_id", "text_crc32", "size")), "shard-rows")
    total = seeded.count()
    slices = slices_for(total)
    bits = slices.bit_length() - 1
    by_hash = F.shiftright("_h", 60 - bits).cast("int")  # its top bits deal the rows of a source evenly
    ties = [F.col(c) for c in ("_h", "doc_id", "text_crc32", "size")]
    ranked = distributed_rank(seeded, [source], by_hash, ties, out="_rank")
    counts = seeded.groupBy(source).agg(F.count(F.lit(1)).alias("_of")).withColumnRenamed(source, "_source")
    placed = ranked.join(counts, F.col(source).eqNullSafe(F.col("_source")), "left").withColumn("_at", (F.col("_rank") + 0.5) / F.col("_of")).drop("_source", "_of")
    placed = stage_table(placed, "shard-places")
    by_place = F.floor(F.col("_at") * slices)
    # equal fractions of sources of equal size: a hash of the source decides, so no source always comes first
    order = [F.col("_at"), hash60(F.lit(seed), F.col(source), F.col("_rank")), *ties]
    whole = distributed_rank(placed.withColumn("_all", F.lit(0)), ["_all"], by_place, order, out="_g").drop("_all", "_h", "_at", "_rank")
    shard = F.expr(f"_g * {shards} div {max(total, 1)}")
    # first row of a shard: ceil(shard * n / shards)
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return whole.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("_g") - first).cast("long")).drop("_g")


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 17) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, source) of all documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return interleave(rows, "source", seed, shards).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def mixture_error(sharded: DataFrame) -> DataFrame:
    """For each shard the largest distance, in rows, between a source's count and its proportional share."""
    cells = sharded.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n"))
    shards = cells.groupBy("shard").agg(F.sum("n").alias("shard_n"))
    sources = cells.groupBy("source").agg(F.sum("n").alias("source_n"))
    total = sharded.count()
    grid = cells.join(shards, "shard").join(sources, cells["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    return grid.withColumn("off", F.abs(F.col("n") - F.col("shard_n") * F.col("source_n") / F.lit(max(total, 1)))).groupBy("shard").agg(F.max("off").alias("max_off"))
