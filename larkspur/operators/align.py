"""Joins between ground truth and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ranks import global_rank


def strict_align(truth: DataFrame, pred: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Exactly the rows of ``truth``. Extra predictions are dropped; a missing or repeated one is an error, raised
    by the value itself, so that no plan can prune the check away."""
    once = pred.groupBy(*keys).agg(F.first(value).alias(value), F.count(F.lit(1)).alias("_n"))
    both = truth.join(once, keys, "left")
    checked = (
        F.when(F.col("_n").isNull(), F.raise_error(F.concat(F.lit("missing prediction: "), F.concat_ws("/", *keys))))
        .when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated prediction: "), F.concat_ws("/", *keys))))
        .otherwise(F.col(value))
    )
    return both.withColumn(value, checked).drop("_n")


def last_wins(df: DataFrame, key: str, value: str, position: Column) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, position).alias(value))


def sorted_intersection(ref: DataFrame, hyp: DataFrame, key: str, position: str) -> DataFrame:
    """(idx, key, ref, hyp) of keys on both sides, numbered from 0 by key; of repeated keys the last counts."""
    both = last_wins(ref, key, "ref", F.col(position)).join(last_wins(hyp, key, "hyp", F.col(position)), key)
    return global_rank(both, F.col(key), "idx")


def file_pairs(generated: DataFrame, truth: DataFrame, name: str, value: str) -> DataFrame:
    """Each generated file with the true one of the same name: (name, generated, truth). A generated file without a true
    one, or with several, is an error raised by the value itself; other true files are not looked at."""
    made = generated.select(name, F.col(value).alias("generated"))
    counts = truth.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))  # names only: volumes move once
    both = made.join(counts, name, "left").join(truth.select(name, F.col(value).alias("_v")), name, "left")
    wrong = F.when(F.col("_n").isNull(), F.raise_error(F.concat(F.lit("no true file: "), F.col(name)))).when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("several true files: "), F.col(name))))
    return both.select(name, "generated", wrong.otherwise(F.col("_v")).alias("truth"))


def having_then_first(df: DataFrame, having: DataFrame, values: DataFrame, key: str, value: str, first_by: str) -> DataFrame:
    """Rows whose key is in ``having``, with the first match of ``values``; rows without a match go."""
    once = values.groupBy(key).agg(F.min_by(value, first_by).alias(value))
    return df.join(having.select(key), key, "left_semi").join(once, key)


def outer_on_shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on all columns that both sides have."""
    return left.join(right, [c for c in left.columns if c in right.columns], "full_outer")


def chained(ids: DataFrame, log: DataFrame, key: str, status: str, done: tuple[str, ...], subset: str, wanted: tuple[str, ...]) -> DataFrame:
    """The log's rows of a wished status for ids of a wished subset."""
    return log.where(F.col(status).isin(*done)).join(ids.where(F.col(subset).isin(*wanted)), key)


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, default: object = None, first_by: str | None = None) -> DataFrame:
    """Left lookup of the first match, with a default or, without one, an error."""
    once = table.groupBy(key).agg((F.min_by(value, first_by) if first_by else F.first(value)).alias(value), F.lit(True).alias("_hit"))
    both = df.join(once, key, "left")
    found = F.coalesce(F.col(value), F.lit(default)) if default is not None else F.when(F.col("_hit").isNull(), F.raise_error(F.concat(F.lit("no match: "), F.col(key).cast("string")))).otherwise(F.col(value))
    return both.withColumn(value, found).drop("_hit")


def suffix_collisions(df: DataFrame, name: str, order: str) -> DataFrame:
    """Repeated base names get ``_1``, ``_2`` before their extension, in ``order``."""
    n = F.col("_r")
    stem, ext = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    ranked = global_rank(df, F.col(order), "_r", by=(name,))
    return ranked.withColumn("staged", F.when(n == 0, F.col(name)).otherwise(F.concat(stem, F.lit("_"), n.cast("string"), ext))).drop("_r")
