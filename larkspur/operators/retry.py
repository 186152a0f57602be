"""X5, generation that is tried again until its answer is valid.

Attempts are rounds over a table: only rows without a valid answer go into the next one, every round is staged, and there
are at most ``most`` of them. A row whose last answer is still invalid is returned with it and marked; nothing is lost or tried for ever.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.staging import dropped, staged

Generate = Callable[[DataFrame, int], DataFrame]


def until_valid(rows: DataFrame, key: str, generate: Generate, valid: Callable[[Column], Column], most: int = 5) -> DataFrame:
    """(key, answer, attempts, valid). ``generate`` maps the open rows and the attempt's number, from 1, to (key, answer); a row that it leaves
    out has a null answer, and a null answer or verdict is invalid. ``rows`` has one row for a key."""
    if most < 1:
        raise ValueError("at least one attempt is needed")
    pending = staged(rows, "retry-rows")
    done = []
    for attempt in range(1, most + 1):
        answers = generate(pending, attempt).select(F.col(key).alias("_key"), F.col("answer").alias("_answer"))
        tried = pending.join(answers, F.col(key) == F.col("_key"), "left").withColumn("_valid", F.coalesce(valid(F.col("_answer")), F.lit(False)))
        tried = staged(tried.withColumn("_attempts", F.lit(attempt)), "retry")
        dropped(pending)
        over = tried if attempt == most else tried.where("_valid")
        done.append(over.select(key, F.col("_answer").alias("answer"), F.col("_attempts").alias("attempts"), F.col("_valid").alias("valid")))
        rest = tried.where("NOT _valid").select(*rows.columns)
        if attempt == most or rest.isEmpty():
            break
        pending = staged(rest, "retry-rows")
    return reduce(DataFrame.unionByName, done)
