"""Alignments against exhaustive search, scores by hand."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import meteor


def exhaustive(hyp, ref):
    best = (0, 0)
    for places in itertools.product(*[[None, *(j for j, w in enumerate(ref) if w == h)] for h in hyp]):
        used = [j for j in places if j is not None]
        if len(used) == len(set(used)):
            chunks = sum(j is not None and (i == 0 or places[i - 1] is None or places[i - 1] + 1 != j) for i, j in enumerate(places))
            best = max(best, (len(used), -chunks))
    return best[0], -best[1]


def test_alignments_equal_exhaustive_search():
    g = np.random.default_rng(3)
    for _ in range(300):
        hyp, ref = (g.choice(list("abcd"), size=g.integers(0, 7)).tolist() for _ in range(2))
        assert meteor.alignment(hyp, ref, 1 << 20) == exhaustive(hyp, ref)
    long = g.choice(list("abcdefgh"), size=150).tolist()
    assert meteor.alignment(long, long) == (150, 1) and meteor.alignment(long, [])[0] == 0


def test_scores_by_hand(spark):
    rows = [("same", "the lungs are clear", "the lungs are clear"), ("stem", "nodules are growing", "nodule growing"), ("none", "a b", "c"), ("empty", "a", ""), ("null", None, "a"), ("swap", "b c a", "a b c")]
    got = {r.key: r for r in meteor.meteor_exact_stem(spark.createDataFrame(rows, "key string, ref string, hyp string")).collect()}
    assert (got["same"].matches, got["same"].chunks) == (4, 1) and got["same"].meteor == pytest.approx(1 - 0.5 / 64)
    p, r = 1.0, 2 / 3
    assert (got["stem"].matches, got["stem"].chunks) == (2, 2) and got["stem"].meteor == pytest.approx(10 * p * r / (r + 9 * p) * 0.5)
    assert [got[k].meteor for k in ("none", "empty", "null")] == [0, 0, 0]
    assert got["swap"].chunks == 2
    words = spark.createDataFrame([("Studies",), ("passes",), ("stopped",), ("scanning",), ("is",), ("mildly",), ("bones",)], "w string").select(meteor.stem(F.col("w")).alias("s")).collect()
    assert [w.s for w in words] == ["study", "pass", "stop", "scan", "i", "mild", "bon"]
