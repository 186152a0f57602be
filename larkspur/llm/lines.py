"""Corpus-wide line de-duplication.

Normalised lines are exploded and hashed to 128 bits; a hash found in at least
``min_docs`` documents is repeated, and every document but the smallest id that holds
it loses those lines. What is left is put together again by position.

* null or empty text: one empty line, kept;
* a null ``doc_id``: the row keeps all its lines and is not counted as a document;
* rows that share a ``doc_id`` count as one document;
* other columns pass through untouched, whatever their names; a column of a name that is
  added (``names``) is replaced;
* a very common line is one hash: its documents are reduced by partial aggregation, and the join
  that finds its places is a sort-merge join whose large partitions the engine's skew rule splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.spark_util import fresh_names, stage_table

SPACES = "\t\n\x0b\x0c\r "
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without surrounding white space, A-Z in lower case."""
    bare = F.btrim(line, F.lit(SPACES))
    ascii_only = F.octet_length(bare) == F.char_length(bare)  # then the faster function does the same
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """(doc_id, _tag, drop): positions of the lines to drop; ``_tag`` is the hash of the row's text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64(text).alias("_tag"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("_key", line_key(F.col("line"))).where(F.char_length("_key") >= min_chars)
    keyed = stage_table(keyed.select("doc_id", "_tag", "pos", F.xxhash64("_key").alias("k1"), F.xxhash64(F.lit(1), "_key").alias("k2")), "line-keys")
    if min_docs == 2:  # two documents at least: the least and the greatest id differ, so no set of ids is held
        counted = keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("keep_in"), F.max("doc_id").alias("_last")).where("keep_in < _last")
    else:
        per_doc = keyed.groupBy("k1", "k2", "doc_id").agg(F.lit(1).alias("_one"))
        counted = per_doc.groupBy("k1", "k2").agg(F.min("doc_id").alias("keep_in"), F.count("_one").alias("_docs")).where(F.col("_docs") >= min_docs)
    repeated = stage_table(counted.select("k1", "k2", "keep_in"), "repeated-lines")
    found = keyed.join(repeated, ["k1", "k2"]).where("doc_id > keep_in")
    return found.groupBy("doc_id", "_tag").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, names: tuple[str, str, str] = ("n_lines", "n_dropped", "kept_sha256")) -> DataFrame:
    """``docs`` with the kept lines as ``text``, and three more columns called ``names``."""
    docs = docs.drop(*names)
    own, tag, doc, drop = fresh_names(docs.columns, "_own_tag", "_tag", "_doc", "_drop")
    gone = dropped_lines(docs.select("doc_id", "text"), min_chars, min_docs).toDF(doc, tag, drop)
    tagged = docs.withColumn(own, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    both = tagged.join(gone, (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(tag)), "left")
    kept = docs.columns
    at = kept.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()), T.StructField(names[2], T.StringType())])

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept))]
            texts, n_lines, n_dropped, digests = [], [], [], []
            for text, drop in zip(columns[at], batch.column(len(kept)), strict=True):
                lines = (text.as_py() or "").split("\n")
                gone = set(drop.as_py() or ())
                left = [x for i, x in enumerate(lines) if i not in gone] if gone else lines
                out = "\n".join(left)
                texts.append(out)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                digests.append(hashlib.sha256(out.encode()).hexdigest())
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())], [*kept, *names])

    return both.select(*[F.col(f"`{c}`") for c in kept], drop).mapInArrow(reassemble, schema)
