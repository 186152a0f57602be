import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import toxicity


def corpus(n=900, seed=3):
    rng = np.random.default_rng(seed)
    vocab = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "tu", "re") for b in ("ra", "se", "no", "li") for c in ("n", "st", "é", "ro")]
    bad = ["vilemo", "hatxu"]
    rows = []
    for i in range(n):
        w = [str(rng.choice(vocab)) for _ in range(rng.integers(5, 80))]
        y = int(rng.random() < 0.2)
        if y:
            for _ in range(rng.integers(1, 4)):
                w[rng.integers(len(w))] = str(rng.choice(bad)) + str(rng.choice(["", "ne", "rst", "ta"]))
        rows.append((i, " ".join(w), ["en", "de", None][i % 3], y))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).withColumn("h", toxicity.held_out(F.col("doc_id"))).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    y = {r[0]: r[3] for r in rows}
    out = [(r["tox_score"] >= 0.3, y[r["doc_id"]]) for r in got if r["h"]]
    assert np.mean([bool(a) == bool(b) for a, b in out]) > 0.95
    again = toxicity.fit(docs.repartition(3), labels)
    assert np.allclose(again.scores(pa.array([r[1] for r in rows])), model.scores(pa.array([r[1] for r in rows])))
    # only the text counts, held-out labels are not read
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.allclose(toxicity.fit(docs, flipped).scores(pa.array(["kara vilemone"])), model.scores(pa.array(["kara vilemone"])))
    long = " ".join(["karan losest"] * 20_000)
    clean, toxic = model.scores(pa.array([long, long + " vilemota"]))
    assert clean < 0.3 <= toxic


def test_edge_cases(spark, odd_docs, rows, no_docs):
    labels = spark.createDataFrame([(0, 1), (0, 0), (3, None), (None, 1), (6, 0), (9, 0), (99999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    got = toxicity.score_documents(odd_docs.drop("tox_score"), model)
    assert got.count() == len(rows) + 6 and got.where("tox_score is null or tox_score < 0 or tox_score > 1").count() == 0
    assert toxicity.score_documents(odd_docs, model).columns.count("tox_score") == 1
    nothing = toxicity.fit(no_docs, labels.limit(0))
    assert toxicity.score_documents(no_docs, nothing).count() == 0
    assert nothing.scores(pa.array(["a", None, ""])).max() < 0.3


def test_scores_do_not_depend_on_the_batch(spark):
    rows = corpus(200)
    model = toxicity.train([r[1] for r in rows], np.array([r[3] for r in rows]), [r[2] for r in rows])
    texts = [r[1] for r in rows[:40]] + [None, "", "x", "x y"]
    together = model.scores(pa.array(texts, pa.string()))
    assert together == pytest.approx([model.scores(pa.array([t], pa.string()))[0] for t in texts], abs=1e-5)


def test_language_thresholds():
    s = np.array([0.9, 0.8, 0.45, 0.1] * 30)
    y = np.array([1, 1, 0, 0] * 30)
    got = toxicity.language_thresholds(s, y, ["en"] * 120)
    assert 0.45 < got["en"] <= 0.65 and got[""] == 0.3


def plain_maxima(model, words):
    """All filters at every position of one text, beyond whose end there are no words."""
    out = []
    for k, width in enumerate(toxicity.WIDTHS):
        for c in range(toxicity.FILTERS):
            at = [sum(float(words[p + j] @ model.filters[k][j][:, c]) for j in range(width) if p + j < len(words)) for p in range(len(words))]
            out.append(max(0.0, max(at) + float(model.bias[k * toxicity.FILTERS + c])) if at else 0.0)
    return out


def test_pooled_equals_a_plain_convolution():
    rng = np.random.default_rng(6)
    filters = [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    model = toxicity.ConvModel(np.zeros(0, np.uint64), np.zeros((1, toxicity.DIM), np.float32), filters, rng.normal(size=24).astype(np.float32), np.zeros(24), 0.0, {})
    lengths = [0, 1, 2, 3, 0, 7, 1]
    first = np.cumsum([0, *lengths])
    vectors = rng.normal(size=(sum(lengths), toxicity.DIM)).astype(np.float32)
    want = [plain_maxima(model, vectors[a:b]) for a, b in zip(first, first[1:])]
    assert np.allclose(model.pooled(vectors, first), want, atol=1e-4)


def test_sample_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i, f"t{i} " * 50, "en") for i in range(40)] + [(3, "again", "de"), (5, None, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    texts, y, langs = toxicity.labelled_sample(docs, labels, rows=10)
    assert len(texts) == len(y) == len(langs) == 10
    every = {r["doc_id"]: set() for r in docs.collect()}
    for r in docs.collect():
        every[r["doc_id"]].add(r["text"] or "")
    texts, y, _ = toxicity.labelled_sample(docs, labels, most_bytes=900)
    assert 0 < len(texts) < 10 and sum(len(t.as_py()) for t in texts) <= 900 and all(any(t.as_py() in v for v in every.values()) for t in texts)


def test_training_ends_by_the_rows_kept_out():
    rows = corpus(400)
    texts, y, langs = [r[1] for r in rows], np.array([r[3] for r in rows]), [r[2] for r in rows]
    kept_out = np.concatenate([np.flatnonzero(y == v)[4::5] for v in (0, 1)])
    losses = [toxicity.log_loss(toxicity.train(texts, y, langs, epochs=e).scores(pa.array([texts[i] for i in kept_out])), y[kept_out]) for e in (0, 1, 8)]
    assert losses[2] <= losses[1] < losses[0]
