"""The training-corpus pipeline: toxicity, line dedup, near duplicates, mixing, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
Rows that share a ``doc_id`` are one document for every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import jaccard, lines, mixing, packing, toxicity
from larkspur.llm.queries import table, tokenizer_path
from larkspur.llm.spark_util import distributed_rank, fresh_names, stage_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches their language's threshold go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh_names(docs.columns, "_tox_score")
    scored = toxicity.score_documents(docs, model, score)
    return scored.where(~toxicity.flagged(F.col(score), F.col("lang"), model.thresholds)).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay only in the first document that holds them; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs, names=tuple(fresh_names(docs.columns, "_n_lines", "_n_dropped", "_kept_sha256")))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    gone = jaccard.near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows of one id, source and size are numbered on both sides, so each has its own copies."""
    size, copies, row, copy = fresh_names(docs.columns, "_size", "_copies", "_row", "_copy")
    key = ["doc_id", "source", size]
    plan = stage_table(mixing.mix_sources(docs).select("doc_id", "source", F.col("size").alias(size), F.col("copies").alias(copies)), "mix-plan")
    several = stage_table(plan.groupBy(*key).agg(F.count(F.lit(1)).alias(row)).where(F.col(row) > 1).select(*key), "mix-several")
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    if several.isEmpty():
        plan, sized = plan.withColumn(row, F.lit(0).cast("long")), sized.withColumn(row, F.lit(0).cast("long"))
    else:
        plan, sized = numbered(plan, several, key, row), numbered(sized, several, key, row)
    plan = plan.where(F.col(copies) > 0)
    on = (sized[row] == plan[row]) & (sized[size] == plan[size]) & sized["doc_id"].eqNullSafe(plan["doc_id"]) & sized["source"].eqNullSafe(plan["source"])
    taken = sized.join(plan, on).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return taken.select(*[sized[c] for c in docs.columns])


def numbered(rows: DataFrame, several: DataFrame, key: list[str], row: str) -> DataFrame:
    """``rows`` with a number from 0 inside rows of one key, as ``row``; only rows whose key is one of ``several`` have
    to move, and many rows without id are numbered by many tasks."""
    mark, other = fresh_names([*rows.columns, row], "_mark", "_mark2")
    same = [rows[k].eqNullSafe(several[k]) for k in key]
    marked = stage_table(rows.join(several, same, "left_semi").withColumn(mark, F.monotonically_increasing_id()), "mix-rows")  # staged, so that marks stay
    slot = F.pmod(F.xxhash64(mark), F.lit(64)).cast("int")
    rank = distributed_rank(marked.select(*key, mark), key, slot, [F.col(mark)], out=row).select(F.col(mark).alias(other), row)
    counted = marked.join(rank, F.col(mark) == F.col(other)).drop(mark, other)
    single = rows.join(several, same, "left_anti").withColumn(row, F.lit(0).cast("long"))
    return single.unionByName(counted)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.best_fit_pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("packing", pack),
]

#: The classifier and the packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
