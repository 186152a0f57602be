"""W13, a random subset of each row's positions, of a size that depends on the row.

Of the ``n`` positions of a row that may be drawn, the ``ceil(share * n)`` with the least seeded draws are taken. Rows of a token
table can be very long, so none is sorted whole: positions fall into slots by the high bits of their draw, slots are
counted by partial aggregation, and only the slot in which a row's last place lies is ranked. Words of a text are one value of a row
already; their positions are drawn in place, and nothing moves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: High bits of a draw that make its slot, of 32.
SLOT_BITS = 10


def seeded_draw(seed: int, row: str, position: str) -> Column:
    """An integer below 2**32 from the md5 of seed, row and position."""
    text = F.concat_ws("_", F.lit(str(seed)), F.col(row).cast("string"), F.col(position).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def random_subset(tokens: DataFrame, row: str, position: str, share: float, seed: int, allowed: Column | None = None) -> DataFrame:
    """``tokens`` with ``drawn``. Positions that are not ``allowed`` are neither drawn nor counted; equal draws go by position. Position
    must tell the rows of a ``row`` apart."""
    free = F.coalesce(allowed, F.lit(False)) if allowed is not None else F.lit(True)
    rows = tokens.withColumn("_draw", F.when(free, seeded_draw(seed, row, position))).withColumn("_slot", F.shiftright("_draw", 32 - SLOT_BITS))
    counts = rows.where("_draw IS NOT NULL").groupBy(row, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(row)
    before = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # 1,024 slots at most
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_k", F.ceil(F.sum("_n").over(whole) * F.lit(share)))
    last = counts.where("_before < _k AND _k <= _before + _n").select(F.col(row).alias("_row2"), F.col("_slot").alias("_last"), (F.col("_k") - F.col("_before")).alias("_left"))
    met = rows.join(last, F.col(row).eqNullSafe(F.col("_row2")), "left")
    edge = met.where("_slot = _last").withColumn("_place", F.row_number().over(Window.partitionBy(row, "_slot").orderBy("_draw", position)))
    sure = met.where("_slot IS NULL OR _last IS NULL OR _slot <> _last").withColumn("drawn", F.coalesce(F.col("_slot") < F.col("_last"), F.lit(False)))
    return sure.select(*tokens.columns, "drawn").unionByName(edge.select(*tokens.columns, (F.col("_place") <= F.col("_left")).alias("drawn")))


def drawn_places(words: Column, row: Column, share: float, seed: int, allowed: Callable[[Column], Column]) -> Column:
    """The drawn positions of an array of words, least draw first: the same as ``random_subset`` draws from its (position, word) table.
    Eight hexadecimal digits are in the order of their numbers."""
    free = F.filter(F.transform(words, lambda w, i: F.when(allowed(w), i)), lambda i: i.isNotNull())
    head = F.concat(F.lit(f"{seed}_"), row.cast("string"), F.lit("_"))
    draws = F.transform(free, lambda i: F.struct(F.substring(F.md5(F.concat(head, i.cast("string")).cast("binary")), 1, 8).alias("draw"), i.alias("pos")))
    return F.transform(F.slice(F.sort_array(draws), F.lit(1), F.ceil(F.size(draws) * F.lit(share)).cast("int")), lambda d: d["pos"])
