"""t-SNE, random subsets and retries against plain implementations."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import retry, subsets, tsne
from larkspur.plans import training_queries


def plain_affinities(x, perplexity):
    n, k = len(x), round(3 * perplexity)
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    p = np.zeros((n, n))
    for i in range(n):
        near = [j for j in np.argsort(d2[i], kind="stable") if j != i][:k]
        d = d2[i, near] - d2[i, near].min()
        lo, hi = -30.0, 30.0
        for _ in range(60):
            m = (lo + hi) / 2
            w = np.exp(-np.exp(m) * d)
            wide = np.log(w.sum()) + np.exp(m) * (w * d).sum() / w.sum() > np.log(perplexity)
            lo, hi = (m, hi) if wide else (lo, m)
        w = np.exp(-np.exp((lo + hi) / 2) * d)
        p[i, near] = w / w.sum()
    return (p + p.T) / (2 * n)


def plain_layout(p, start, iterations, exaggerated, exaggeration):
    n = len(p)
    y, v, g = start.copy(), np.zeros((n, 2)), np.ones((n, 2))
    rate = max(n / exaggeration / 4, 50.0)
    for i in range(iterations):
        early = i < exaggerated
        away = y[:, None] - y[None]
        w = 1 / (1 + (away**2).sum(axis=2))
        np.fill_diagonal(w, 0)
        slope = 4 * (((exaggeration if early else 1.0) * p * w - w * w / w.sum())[:, :, None] * away).sum(axis=1)
        g = np.maximum(np.where(slope * v < 0, g + 0.2, g * 0.8), 0.01)
        v = (0.5 if early else 0.8) * v - rate * g * slope
        y = y + v
    w = 1 / (1 + ((y[:, None] - y[None]) ** 2).sum(axis=2))
    np.fill_diagonal(w, 0)
    some = p > 0
    return float((p[some] * np.log(p[some] / (w / w.sum())[some])).sum())


def test_layout_is_as_good_as_an_exact_one(spark):
    g = np.random.default_rng(0)
    centres = g.normal(size=(6, 10)) * 4
    x = centres[g.integers(6, size=240)] + g.normal(size=(240, 10))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, v array<double>")
    edges = tsne.affinities(df, 12.0).cache()
    want = plain_affinities(x, 12.0)
    got = np.zeros((240, 240))
    for r in edges.collect():
        got[r.i, r.j] = r.p
    assert np.allclose(got, want, atol=1e-12)
    found = {r.id: (r.x, r.y) for r in tsne.start_positions(df.where("v IS NOT NULL").select("id"), 41).collect()}
    exact = plain_layout(want, np.array([found[i] for i in range(240)]), 40, 25, 4.0)
    positions = tsne.layout(edges, iterations=40, exaggerated=25, exaggeration=4.0)
    kl = tsne.divergence(edges, positions)
    assert positions.count() == 240 and kl < 1.05 * exact and kl < 1.5


def test_affinities_of_few_and_equal_rows(spark):
    few = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [5.0, 1.0])], "id long, v array<double>")
    p = {(r.i, r.j): r.p for r in tsne.affinities(few, 30.0).collect()}
    assert len(p) == 6 and sum(p.values()) == pytest.approx(1) and all(v > 0 for v in p.values())
    assert tsne.layout(tsne.affinities(few.where("id < 0"), 5.0), iterations=2).count() == 0


def test_steps_of_many_blocks_equal_exact_ones(spark, monkeypatch):
    """Edges between blocks, a hub that oscillates far out, and rows outside of the grid."""
    monkeypatch.setattr(tsne, "BLOCK", 60)
    monkeypatch.setattr(tsne, "FAR", 15)
    x = np.random.default_rng(3).normal(size=(200, 8))
    p = plain_affinities(x, 10.0)
    p[0, 1:] = p[1:, 0] = 0.002
    p /= p.sum()
    edges = spark.createDataFrame([(int(i) * 7, int(j) * 7, float(p[i, j])) for i, j in zip(*np.nonzero(p), strict=True)], "i long, j long, p double")
    start = {r.id: (r.x, r.y) for r in tsne.start_positions(edges.select(F.col("i").alias("id")).distinct(), 41).collect()}
    y = np.array([start[7 * i] for i in range(200)])
    v, g = np.zeros((200, 2)), np.ones((200, 2))
    for i in range(12):
        away = y[:, None] - y[None]
        w = 1 / (1 + (away**2).sum(axis=2))
        z = w.sum() - 200
        slope = 4 * (((12.0 if i < 8 else 1.0) * p * w - w * w / z)[:, :, None] * away).sum(axis=1)
        g = np.maximum(np.where(slope * v < 0, g + 0.2, g * 0.8), 0.01)
        v = (0.5 if i < 8 else 0.8) * v - 50.0 * g * slope
        y = y + v
    got = {r.id: (r.x, r.y) for r in tsne.layout(edges, iterations=12, exaggerated=8, rate=50.0).collect()}
    assert len(got) == 200 and np.abs(np.array([got[7 * i] for i in range(200)]) - y).max() < 1e-3 * np.abs(y).max()


def test_repulsion_is_near_the_exact_one_with_rows_far_out():
    g = np.random.default_rng(4)
    for scale, n in ((1e-4, 5_000), (0.1, 5_000), (30.0, 6_000)):
        x, y = g.normal(size=(2, n)) * scale
        x[:60] *= 500
        rings = np.frombuffer(tsne._weighed(tsne.Grid(1.0), 0, x, y)[0], "<i8")
        grid = tsne.Grid(tsne._best_half(rings))
        inside = grid.inside(x, y)
        push, pushed, z = grid.potentials(grid.weights(x[inside], y[inside]), n, np.stack([x[~inside], y[~inside]]))
        got = np.zeros((2, n))
        got[:, ~inside] = pushed
        for node, share in grid.shares(x[inside], y[inside]):
            got[:, inside] += share * push[:, node]
        d = np.stack([x[:, None] - x, y[:, None] - y])
        k = 1 / (1 + (d**2).sum(axis=0))
        want = (d * k**2).sum(axis=2)
        assert z == pytest.approx(k.sum() - n, rel=1e-3) and rings.sum() == n and (~inside).sum() <= tsne.FAR
        assert np.sqrt(((got - want) ** 2).sum() / (want**2).sum()) < (1e-3 if scale < 1 else 0.03)


def test_the_query_makes_all_steps_of_the_reference(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(tsne, "layout", lambda edges, iterations, exaggerated: seen.append((iterations, exaggerated)) or spark.createDataFrame([(1, 0.0, 0.0)], "id long, x double, y double"))
    assert training_queries.QUERIES["tsne_layout"](spark, sf_dir).count() == 1 and seen == [(300, 250)]


def seeded(seed, row, pos):
    return int(hashlib.md5(f"{seed}_{row}_{pos}".encode()).hexdigest()[:8], 16)


@pytest.mark.parametrize("share", [0.0, 0.15, 1.0])
def test_subsets_of_short_and_long_rows(spark, share):
    rows = [("a", i, i % 3 > 0) for i in range(20_000)] + [("b", 0, True), ("c", 0, False), ("d", 0, None)] + [("e", i, True) for i in range(7)] + [(None, i, True) for i in range(9)]
    df = spark.createDataFrame(rows, "row string, pos long, ok boolean").repartition(4)
    got = subsets.random_subset(df, "row", "pos", share, 3, F.col("ok")).collect()
    assert len(got) == len(rows)
    for own in ("a", "b", "c", "d", "e"):
        free = [p for r, p, ok in rows if r == own and ok]
        k = math.ceil(share * len(free))
        assert {r.pos for r in got if r.row == own and r.drawn} == set(sorted(free, key=lambda p, own=own: (seeded(3, own, p), p))[:k])
    assert sum(r.drawn for r in got if r.row is None) == math.ceil(share * 9)


def test_retry(spark):
    """Row k is valid at attempt k; 0 never; 4 is too late; a row that the generator leaves out counts as failed."""
    asked = []

    def generate(rows, attempt):
        asked.append(sorted(r.k for r in rows.collect()))
        return rows.where("k <> 5").select("k", F.when(F.col("k") == attempt, "good").otherwise("bad").alias("answer"))

    df = spark.createDataFrame([(k, "x", "y") for k in range(6)], "k int, answer string, more string")
    got = {r.k: (r.answer, r.attempts, r.valid) for r in retry.until_valid(df, "k", generate, lambda a: a == "good", most=3).collect()}
    assert got == {0: ("bad", 3, False), 1: ("good", 1, True), 2: ("good", 2, True), 3: ("good", 3, True), 4: ("bad", 3, False), 5: (None, 3, False)}
    assert asked == [[0, 1, 2, 3, 4, 5], [0, 2, 3, 4, 5], [0, 3, 4, 5]]
    assert retry.until_valid(df.where("k = 1"), "k", generate, lambda a: a == "good").count() == 1 and len(asked) == 4
    assert retry.until_valid(df.limit(0), "k", generate, lambda a: a == "good").count() == 0
