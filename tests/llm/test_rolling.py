"""Rolling medians against sorted windows."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import types as T

from larkspur.llm import rolling

SCHEMA = T.StructType([T.StructField("click_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("kind", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("at", T.StringType())])
START = datetime(2024, 1, 1)


def brute(rows, minutes=60):
    once = {}
    cents = lambda v: None if v is None or not np.isfinite(v) or abs(v * 100) >= 1 << 58 else int(np.floor(100 * v + 0.5))
    for i, ts, kind, value, _ in rows:
        if ts is not None:
            c = cents(value)
            own = (ts, kind is not None, kind or "", c is not None, c or 0)
            once[i] = min(once.get(i, own), own)
    out = {}
    for i, (ts, some, kind, valued, c) in once.items():
        w = sorted(x[4] for x in once.values() if x[1:3] == (some, kind) and x[3] and ts - timedelta(minutes=minutes) < x[0] <= ts)
        n = len(w)
        if n < 2:
            out[i] = (kind if some else None, n, None, None, None)
            continue
        m = w[(n - 1) // 2] + w[n // 2]
        d = sorted(abs(2 * x - m) for x in w)
        mad = d[(n - 1) // 2] + d[n // 2]
        out[i] = (kind if some else None, n, m, mad, 2 * abs(2 * c - m) > 3 * mad if valued else None)
    return out


def held(spark, rows, **more):
    got = rolling.rolling_medians(spark.createDataFrame(rows, SCHEMA), **more).collect()
    assert len(got) == len({r.click_id for r in got})
    return {r.click_id: (r.kind, r.n, r.median2, r.mad4, r.far) for r in got}


def made(seed, n, seconds, values):
    g = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        ts = START + timedelta(microseconds=int(g.integers(seconds * 1_000_000)) // 500_000 * 500_000)
        kind = [None, "", "view", "view", "view"][g.integers(5)]
        value = None if g.random() < 0.05 else float(values(g))
        rows.append((i, None if g.random() < 0.02 else ts, kind, value, "x"))
    return rows + [rows[j] for j in g.integers(n, size=n // 20)]


@pytest.mark.parametrize("seed", range(3))
def test_windows_equal_sorted_windows(spark, seed):
    values = [lambda g: g.integers(-3, 4), lambda g: g.exponential(30), lambda g: g.normal() * 10 ** g.integers(8)][seed]
    rows = made(seed, 600, [9_000, 40_000, 4_000][seed], values)
    assert held(spark, rows) == brute(rows)


def test_halved_chunks(spark):
    """Chunks cut to parts of some rows, a burst inside a minute and one time with many values."""
    g = np.random.default_rng(9)
    rows = made(5, 500, 10_000, lambda g: g.exponential(40))
    rows += [(1_000 + i, START + timedelta(seconds=5_000, microseconds=int(g.integers(2_000_000))), "view", float(g.integers(50)), "x") for i in range(200)]
    rows += [(2_000 + i, START + timedelta(seconds=6_000), "view", float(i % 7), "x") for i in range(100)]
    want = brute(rows)
    for chunk in (8, 40, 300):
        assert held(spark, rows, chunk=chunk) == want


def test_large_chunks_go_in_runs_of_times(monkeypatch):
    g = np.random.default_rng(3)
    n = 3_000
    cols = np.zeros(n, np.int64), g.integers(0, 3_600, n), g.integers(0, 500, n), g.random(n) < 0.9, g.integers(1, 4, n), g.choice([0, 0, 1, 2], n)
    whole = rolling.slide(*cols, 3_600)
    monkeypatch.setattr(rolling, "TIMES", 50)
    for a, b in zip(whole, rolling.slide(*cols, 3_600), strict=True):
        assert (a == b).all()


def test_odd_rows(spark):
    big = float(1 << 57) / 100
    rows = [
        (1, START, "a", float("nan"), "x"), (2, START, "a", float("inf"), "x"), (3, START, "a", 1e300, "x"), (4, START, "a", big, "x"), (5, START, "a", -big, "x"),
        (6, None, "a", 1.0, "x"), (None, START, None, 1.0, "x"), (None, START, None, 2.0, "x"),
        (7, START + timedelta(minutes=60), "a", 1.0, "x"), (8, START + timedelta(minutes=60, microseconds=-1), "a", 0.005, "x"), (9, datetime(1969, 12, 31, 23, 59, 59, 999999), "a", 2.0, "x"), (10, datetime(1970, 1, 1), "a", 3.0, "x"),
        (11, START, "b", 5.0, "x"), (11, START, "b", 4.0, "x"), (11, None, "b", 3.0, "x"),
    ]
    got = held(spark, rows)
    assert got == brute(rows)
    assert got[8][1] == 3 and got[7][1] == 2 and got[10] == ("a", 2, 500, 200, False)
    assert held(spark, []) == {}
