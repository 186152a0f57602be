"""Merges, contrastive loss, heads and histories against plain implementations."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import text as X
from larkspur.operators import contrastive, history, linear_head, merges
from larkspur.plans import training_queries
from larkspur.schema import CLASS_WEIGHTS, LABELS
from larkspur.streaming import stopping


def plain_merges(symbols, ranks):
    while len(symbols) > 1:
        rank, pair = min((ranks.get(p, 1 << 30), p) for p in zip(symbols, symbols[1:], strict=False))
        if rank == 1 << 30:
            break
        out, i = [], 0
        while i < len(symbols):
            if tuple(symbols[i : i + 2]) == pair:
                out.append("".join(pair))
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


def test_merges_equal_a_plain_loop(spark):
    """Random merges over two letters make overlapping pairs and long chains of merges."""
    g = np.random.default_rng(5)
    words = {"".join(g.choice(list("ab"), size=g.integers(1, 14))) for _ in range(150)} | {"a" * 9, "ab" * 6, "é", "aé"}
    pairs, symbols = [], ["a", "b", "a</w>", "b</w>"]
    while len(pairs) < 25:
        pair = tuple(g.choice(symbols, size=2).tolist())
        if pair not in pairs and not pair[0].endswith("</w>"):
            pairs.append(pair)
            symbols.append("".join(pair))
    ranked = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(pairs)], "left string, right string, rank int")
    out = merges.merge_words(spark.createDataFrame([(w,) for w in [*words, *words, ""]], "word string"), ranked)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    table = merges.byte_characters()
    ranks = {p: i for i, p in enumerate(pairs)}
    want = {}
    for w in words:
        own = [table[b] for b in w.encode()]
        own[-1] += "</w>"
        want[w] = plain_merges(own, ranks)
    got = out.collect()
    assert len(got) == len(want) and {r.word: list(r.symbols) for r in got} == want


@pytest.mark.skipif(not os.path.exists(training_queries.MERGES_FILE), reason="no tokenizer file")
def test_encoding_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(training_queries.MERGES_FILE)
    own.encode_special_tokens = True
    texts = ["It's the lungs' NODULES, 3.5cm!!", "  naïve \t café — 日本語 😀  ", "", None, "don't 'VE we'll", "x" * 40 + " ..... ,,,"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", X.normalise_spaces(F.col("text")).alias("text"))
    got = {r.id: list(r.ids) for r in merges.encode(rows, "id", "text", *merges.read_merges(spark, training_queries.MERGES_FILE)).collect()}
    assert got == {i: own.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}


def vectors(spark, n, d, seed, scale=1.0):
    g = np.random.default_rng(seed)
    x, y = g.normal(size=(n, d)) * scale, g.normal(size=(n, d)) * scale
    return x, y, spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))], "key long, x array<double>, y array<double>")


@pytest.mark.parametrize("decoupled", [False, True])
def test_contrastive_loss_by_tiles(spark, decoupled):
    """Similarities beyond what an exponential can hold, in blocks of 20 rows."""
    x, y, pairs = vectors(spark, 90, 8, 1, scale=12)
    s = 3.0 * x @ y.T
    off = np.where(np.eye(90, dtype=bool) & decoupled, -np.inf, s)
    lse = lambda m, axis: np.log(np.exp(m - m.max(axis, keepdims=True)).sum(axis)) + m.max(axis)
    a, b = (lse(off, 1) - np.diag(s)).mean(), (lse(off, 0) - np.diag(s)).mean()
    (got,) = contrastive.contrastive_loss(pairs, 3.0, decoupled, block=20).collect()
    assert got.n == 90 and np.allclose([got.x_to_y, got.y_to_x, got.loss], [a, b, (a + b) / 2], rtol=1e-12)
    assert np.abs(s).max() > 710


def test_contrastive_loss_of_one_pair_and_of_none(spark):
    _, _, pairs = vectors(spark, 1, 3, 2)
    (one,) = contrastive.contrastive_loss(pairs).collect()
    assert one.n == 1 and abs(one.loss) < 1e-12
    (none,) = contrastive.contrastive_loss(pairs.where("key < 0")).collect()
    assert none.n == 0 and none.loss is None


def test_masked_mean(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 4.0], [True, False, True]), (2, [1.0], [False]), (3, [], [])], "k int, v array<double>, m array<boolean>")
    got = {r.k: r.x for r in rows.select("k", contrastive.masked_mean(F.col("v"), F.col("m")).alias("x")).collect()}
    assert got == {1: 2.5, 2: 0.0, 3: 0.0}


def newton(x, y, u, ridge, steps=60):
    x = np.column_stack([x, np.ones(len(x))])
    shrink = ridge * np.append(np.ones(x.shape[1] - 1), 0)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        weight = np.where(y > 0, u, 1)
        w = w + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(shrink), x.T @ (weight * (y - p)) - shrink * w)
    return w


def test_heads_equal_numpy(spark):
    g = np.random.default_rng(8)
    x = g.normal(size=(400, 6))
    y = (x @ g.normal(size=(6, 2)) + g.normal(size=(400, 2)) > 1).astype(float)
    y[5, 1] = np.nan
    rows = [(i, a.tolist(), [None if v != v else int(v) for v in b]) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    rows += [(900, None, [1, 1]), (901, [float("nan")] * 6, [1, 1]), (902, [1.0] * 6, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>, ys array<int>").repartition(3)
    heads = linear_head.fit_heads(df, ["a", "b"], "v", "ys", relu=True, ridge=0.5)
    for k in range(2):
        use = ~np.isnan(y[:, k])
        u = (y[use, k] == 0).sum() / (y[use, k] == 1).sum()
        want = newton(np.maximum(x[use], 0), y[use, k], u, 0.5)
        assert np.allclose(heads.weights[k], want, atol=1e-6)
    got = {(r.id, r.label): r.score for r in heads.scores(df, "id", "v").collect()}
    line = np.maximum(x[7], 0) @ heads.weights[1][:-1] + heads.weights[1][-1]
    assert abs(got[7, "b"] - 1 / (1 + np.exp(-line))) < 1e-12 and got[900, "a"] is None


def test_heads_of_separable_and_one_sided_labels_stay_finite(spark):
    df = spark.createDataFrame([([float(i)], [int(i > 5), 0]) for i in range(12)], "v array<double>, ys array<int>")
    heads = linear_head.fit_heads(df, ["split", "never"], "v", "ys", ridge=0.1)
    assert np.isfinite(heads.weights).all() and heads.weights[0, 0] > 0
    assert (heads.scores(df, "v", "v").where("label = 'never'").agg(F.max("score").alias("m")).first().m) < 0.01


def test_published_class_weights(spark):
    assert linear_head.positive_weights(None, LABELS[3:5]) == dict(zip(LABELS[3:5], CLASS_WEIGHTS[3:5], strict=True))


def plain_stops(rows, patience):
    out = {}
    for run in {r[0] for r in rows}:
        best, since, n, stop = (None, None), 0, 0, None
        for _, epoch, loss in sorted((r for r in rows if r[0] == run), key=lambda r: r[1]):
            n += 1
            if loss is not None and loss == loss and (best[1] is None or loss < best[1]):
                best, since = (epoch, loss), 0
            else:
                since += 1
            if since >= patience:
                stop = epoch
                break
        out[run] = (*best, stop, n)
    return out


def histories(n=300):
    g = np.random.default_rng(11)
    rows = [(f"r{k}", e * 2, float(np.round(g.random() + 3 / (1 + e), 2))) for k in range(5) for e in range(n if k < 2 else 7 * k)]
    rows += [("down", e, -float(e)) for e in range(40)] + [("flat", e, 1.0) for e in range(40)] + [("none", e, None) for e in range(9)]
    return rows + [("odd", 0, float("nan")), ("odd", 1, 5.0), ("odd", 2, None), ("odd", 3, 4.0)]


@pytest.mark.parametrize("patience", [1, 4, 30])
def test_early_stops_in_blocks(spark, patience):
    rows = histories()
    got = history.early_stops(spark.createDataFrame(rows, "run string, epoch long, loss double").repartition(4), patience, block=7).collect()
    assert {r.run: (r.best_epoch, r.best_loss, r.stop_epoch, r.epochs) for r in got} == plain_stops(rows, patience)


def test_stream_equals_batch(spark, tmp_path):
    rows = sorted(histories(60), key=lambda r: r[1])
    for k in range(3):  # a file for a batch; the last rows of one come again with the next
        part = rows[max(0, len(rows) * k // 3 - 4) : len(rows) * (k + 1) // 3]
        spark.createDataFrame(part, "run string, epoch long, loss double").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    seen = {}
    try:
        stream = spark.readStream.schema("run string, epoch long, loss double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        keep = lambda df, _: seen.update({r.run: (r.best_epoch, r.best_loss, r.stop_epoch, r.epochs) for r in df.collect()})
        for _ in range(2):  # a second start on the same checkpoint has nothing left to do
            query = stopping.stopping(stream, 5).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert seen == plain_stops(rows, 5)
