"""Expressions over numbers and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within(n: Column, low: float, high: float, strict: bool = False) -> Column:
    """Inside the range; the strict kind leaves out its ends."""
    return (n > low) & (n < high) if strict else n.between(low, high)


def reversed_if(condition: Column, values: Column) -> Column:
    """An array (or text) in reverse order where the condition holds."""
    return F.when(condition, F.reverse(values)).otherwise(values)


def count_bucket(n: Column) -> Column:
    """P20: 0, 1-3, 4-6, 7-9, 10-12 and more as 0 to 5."""
    return F.when(n == 0, 0).when(n <= 3, 1).when(n <= 6, 2).when(n <= 9, 3).when(n <= 12, 4).otherwise(5)


def sigmoid(x: Column) -> Column:
    """P22."""
    return 1 / (1 + F.exp(-x))


def softmax(*xs: Column) -> tuple[Column, ...]:
    """Of the values of one row, shifted by their maximum."""
    top = F.greatest(*xs)
    total = sum((F.exp(x - top) for x in xs[1:]), F.exp(xs[0] - top))
    return tuple(F.exp(x - top) / total for x in xs)


def log_eps(x: Column, eps: float = 1e-20) -> Column:
    """P22."""
    return F.log(x + eps)


def round_half_even(x: Column) -> Column:
    """P28."""
    return F.bround(x, 0)


def without_prefix(df: DataFrame, prefix: str = "findings") -> DataFrame:
    """P5: columns whose name begins with ``prefix``, in any case, go."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.lower().startswith(prefix)])


def external_labels(df: DataFrame, key: str, mapping: dict[str, tuple[str, ...]]) -> DataFrame:
    """One column for each label of another set: the score of its label here, or the largest of several."""
    best = {name: F.greatest(*[F.col(f"`{c}`") for c in own]) if len(own) > 1 else F.col(f"`{own[0]}`") for name, own in mapping.items()}
    return df.select(key, *[c.alias(name) for name, c in best.items()])
