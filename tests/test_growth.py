"""Steps that must not grow with the whole table, on small cases with small bounds."""

import contextlib
import hashlib
import math
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError

from pyspark.sql import functions as F

from larkspur.operators import contrastive, merges, meteor, resampling, retrieval, sentences, subsets, text_metrics, tokens
from larkspur.sources import sinks, submissions


def test_wrappers_are_bounded_and_whole(spark):
    rows = [(f"k{i:04}", None if i % 50 == 7 else f"text {i} \u00e9|\n") for i in range(700)]
    df = spark.createDataFrame(rows, "input_image_name string, report string").repartition(5)
    parts = sinks.report_wrappers(df, "n", "t", 100)
    assert sorted(r.part for r in parts.collect()) == list(range(7)) and parts.agg(F.max(F.size(F.from_json("json", "generated_reports array<string>")["generated_reports"]))).first()[0] == 100
    back = submissions.parse_truth(parts.select(F.col("json").alias("value")))
    assert sorted(map(tuple, back.collect())) == rows
    got = sinks.ordered_digest(back, "input_image_name", "report").first()
    assert (got.digest, got.n) == (hashlib.md5("|".join(t for _, t in rows if t is not None).encode()).hexdigest(), 700)
    none = sinks.ordered_digest(back.limit(0), "input_image_name", "report").first()
    assert (none.digest, none.n) == (None, 0)


def test_products_of_a_search_are_bounded(monkeypatch):
    g = np.random.default_rng(8)
    x, y = g.normal(size=(90, 5)), g.normal(size=(400, 5))
    seen, plain = [], retrieval.best_of
    monkeypatch.setattr(retrieval, "best_of", lambda a, b, k: seen.append(len(a) * len(b)) or plain(a, b, k))
    monkeypatch.setattr(retrieval, "CELLS", 4_000)
    found = pa.Table.from_batches(retrieval._met(pa.array(range(90)), x, pa.array(range(400)), y, 7)).to_pydict()
    assert max(seen) <= 4_000 and len(seen) == 9
    order = np.argsort(-(x @ y.T), axis=1)[:, :7]
    assert found["q"] == [i for i in range(90) for _ in range(7)] and found["c"] == order.ravel().tolist()


def test_best_of_with_ties_and_gaps():
    g = np.random.default_rng(9)
    for x, y in ((g.integers(-2, 3, (40, 3)).astype(float), g.integers(-2, 3, (333, 3)).astype(float)), (g.normal(size=(40, 8)) * 1e6, g.normal(size=(500, 8)))):
        for hole in (False, True):
            y = y.copy()
            if hole:
                y[5] = np.nan
            row, col, sim = retrieval.best_of(x, y, 9)
            sims = np.round(x @ y.T, 12)
            want = [(i, c) for i in range(40) for c in [c for c in np.lexsort((np.arange(len(y)), -sims[i])) if not np.isnan(sims[i, c])][:9]]
            assert list(zip(row.tolist(), col.tolist(), strict=True)) == want and (sim == (x @ y.T)[row, col]).all()


def test_a_search_scores_few_cells_in_double_precision(monkeypatch):
    """Packets in any order; only the first of them go to best_of, unless values are odd, tied or missing."""
    g = np.random.default_rng(12)
    plain = retrieval.best_of
    for kind in ("plain", "ties", "large", "copies"):
        x, y = g.normal(size=(50, 8)), g.normal(size=(3_000, 8))
        if kind == "ties":
            x, y = np.round(x), np.round(y)
        elif kind == "large":
            y[7] *= 1e30
        elif kind == "copies":
            y[:] = y[0]
        seen = []
        monkeypatch.setattr(retrieval, "best_of", lambda a, b, k, seen=seen: seen.append(len(a) * len(b)) or plain(a, b, k))
        monkeypatch.setattr(retrieval, "CELLS", 10_000)
        best, order = retrieval.Best(x, 9), g.permutation(3_000)
        for low in range(0, 3_000, 200):
            best.meet(pa.array(order[low : low + 200]), y[order[low : low + 200]])
            assert best.held <= best.most
        got = pa.Table.from_batches(best.batches(pa.array(range(50)), np.zeros(50)))
        sims = np.round(x @ y.T, 12)
        assert got["q"].to_pylist() == list(range(50)) and got["c"].to_pylist() == [np.lexsort((np.arange(3_000), -s))[:9].tolist() for s in sims]
        assert kind != "plain" or sum(seen) <= 50 * 3_000 / 2


def test_nearest_gives_a_row_for_each_query(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 40)
    monkeypatch.setattr(retrieval, "PACKET", 30)
    v = np.random.default_rng(13).normal(size=(700, 4))
    v[5] = v[6]
    rows = spark.createDataFrame([*((f"r{i:03}", x.tolist()) for i, x in enumerate(v)), ("none", None), ("gap", [1.0, None, 0.0, 0.0])], "id string, v array<double>").repartition(3)
    got = {r.q: (r.c, r.sim) for r in retrieval.nearest(rows, rows, 7, "distance").collect()}
    d2 = ((v[:, None] - v[None]) ** 2).sum(axis=2)
    order = [np.lexsort((np.arange(700), np.round(d, 9)))[:7] for d in d2]
    assert len(got) == 700 and all(got[f"r{i:03}"][0] == [f"r{j:03}" for j in order[i]] and np.allclose(got[f"r{i:03}"][1], -d2[i][order[i]]) for i in range(700))


def test_a_row_of_a_loss_travels_a_few_times(spark, monkeypatch):
    """Strips of a tile, far apart values, own pairs left out; 5,000 pairs are one tile."""
    g = np.random.default_rng(10)
    x, y = g.normal(size=(120, 3)), g.normal(size=(120, 3))
    x[7] *= 400
    df = spark.createDataFrame([(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))], "key long, x array<double>, y array<double>")
    monkeypatch.setattr(contrastive, "CELLS", 900)
    for decoupled in (False, True):
        s = 2 * x @ y.T
        if decoupled:
            np.fill_diagonal(s, -np.inf)
        lse = lambda m: m.max(axis=1) + np.log(np.exp(m - m.max(axis=1, keepdims=True)).sum(axis=1))
        want = {"x": lse(s), "y": lse(s.T)}
        got = contrastive.log_sums(df, 2.0, decoupled).collect()
        assert len(got) == 240 and all(np.isclose(r.lse, want[r.side][r.key], rtol=1e-10) for r in got)
    many = spark.range(5_000).select(F.col("id").alias("key"), F.array(F.lit(1.0)).alias("x"), F.array(F.lit(1.0)).alias("y"))
    merged, parts = contrastive.merged_sums, []
    monkeypatch.setattr(contrastive, "CELLS", 1 << 20)
    monkeypatch.setattr(contrastive, "merged_sums", lambda p, keys: parts.append(p) or merged(p, keys))
    contrastive.log_sums(many)
    assert parts[0].count() == 10_000


def test_ids_leave_a_task_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(tokens, "HELD", 50)
    encode = lambda text: [1, *map(ord, text)]
    talks = [(i, None if i % 9 == 4 else [("user", "q" * (i % 7)), ("assistant", None if i % 5 == 0 else "ab" * (i % 11))]) for i in range(60)]
    df = spark.createDataFrame(talks, "id long, t array<struct<role:string,text:string>>").coalesce(1)
    want = {r.id: (r.m.ids, r.m.labels) for r in df.select("id", tokens.masked_ids("t", encode, bos=1).alias("m")).collect()}
    out = tokens.masked_rows(df, "id", "t", encode, bos=1)
    assert {r.id: (r.ids, r.labels) for r in out.collect()} == want and out.columns == ["id", "ids", "labels"]


def test_places_are_drawn_without_a_shuffle(spark):
    texts = [(i, " ".join("abcdef"[: 1 + (i + j) % 6] for j in range(i * 3))) for i in range(25)]
    df = spark.createDataFrame(texts, "id long, text string").select("id", F.expr("filter(split(text, ' '), x -> x <> '')").alias("w"))
    rows = df.select("id", F.posexplode("w").alias("pos", "word"))
    want = {(r.id, r.pos) for r in subsets.random_subset(rows, "id", "pos", 0.3, 5, F.length("word") > 2).where("drawn").collect()}
    out = df.select("id", F.explode(subsets.drawn_places(F.col("w"), F.col("id"), 0.3, 5, lambda w: F.length(w) > 2)).alias("pos"))
    assert {tuple(r) for r in out.collect()} == want and len(want) > 100
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_statistics_and_ends_from_pieces_as_they_stand(spark):
    texts = [(1, "Dr. (Who) said: \"go.\"  Now! e.g. x,y; [a.]\n b?) c.d. end"), (2, None), (3, "..."), (4, "a.  a.\u00a0b. A\u3000c.' (d.)]"), (5, "")]
    df = spark.createDataFrame(texts, "id long, text string")
    places = sentences.word_places(df, "id", "text")
    rows = lambda x: sorted(map(str, x.collect()))
    assert rows(sentences.text_statistics(df, "text")) == rows(sentences.word_statistics(places))
    found = sentences.ending_places(df, "id", "text")
    assert rows(found) == rows(places.where("ends <> ''")) and found.schema["at"].dataType == places.schema["at"].dataType


def test_alignments_are_dealt_over_all_partitions(spark):
    rows = [(f"k{i}", "a b c", "b c a" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "key string, ref string, hyp string").groupBy("key").agg(F.first("ref").alias("ref"), F.first("hyp").alias("hyp"))
    out = meteor.meteor_exact_stem(df).cache()  # tasks of the final plan
    assert out.count() == 200 and out.agg(F.sum("matches")).first()[0] == 3 * len([r for r in rows if r[2]])
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_alignments_skip_words_without_a_place():
    """A word that the reference lacks leaves all states as they are, and costs nothing."""
    ref, many = [f"w{i}" for i in range(12)] * 2, ["none"] * 20_000

    assert meteor.alignment([*ref[:9], *many, *ref[9:]], ref) == (24, 2)
    began = time.process_time()
    meteor.alignment([*ref[:9], *many, *ref[9:]], ref)
    assert time.process_time() - began < 0.8


def test_grams_move_once_for_their_frequency(spark):
    rows = [("a", "x y z x y", "x y q"), ("a", "x y", None), ("b", "x y z", "x y z"), ("c", None, "u v"), ("d", "", ""), (None, "x y", "x y"), ("e", "z x", "z x z x z")]
    df = spark.createDataFrame(rows, "key string, ref string, hyp string")
    grams = lambda text, n: [tuple(t[i : i + n]) for t in [(text or "").split()] for i in range(len(t) - n + 1)]
    count = lambda side: {k: Counter((n, g) for r in rows if r[0] == k for n in range(1, 5) for g in grams(r[side], n)) for k, _, _ in rows}
    ref, hyp = count(1), count(2)
    held = Counter(g for c in ref.values() for g in c)
    weigh = lambda c, n: {g: x * (math.log(len(rows)) - math.log(max(held[g], 1))) for g, x in c.items() if g[0] == n}

    def one(k):
        out = 0.0
        for n in range(1, 5):
            h, r = weigh(hyp[k], n), weigh(ref[k], n)
            norm = math.sqrt(sum(x * x for x in h.values())) * math.sqrt(sum(x * x for x in r.values()))
            out += sum(min(h[g], r[g]) * r[g] for g in h if g in r) / norm if norm else 0.0
        delta = sum(x for g, x in hyp[k].items() if g[0] == 2) - sum(x for g, x in ref[k].items() if g[0] == 2)
        return 0.0 if k is None else out / 4 * math.exp(-(delta**2) / 72) * 10

    out = text_metrics.cider(df)
    assert sorted((str(r.key), round(r.cider, 9)) for r in out.collect()) == sorted((str(k), round(one(k), 9)) for k, _, _ in rows)
    for plan in (out, text_metrics.bleu(df)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(key#\d+, n#\d+, gram#", text)


def test_draws_are_made_for_many_at_once_and_move_once(spark):
    numbers = np.array([0, 7, 9, 10, 99, 100, 12_345, 10**9, 10**15 - 1, 3])
    for prefix in (b"0_", b"999_"):
        assert resampling.md5_heads(prefix, numbers).tolist() == [int(hashlib.md5(b"%s%d" % (prefix, i)).hexdigest()[:8], 16) for i in numbers]
    got = {(r.round, r.i): r.pos for r in resampling.drawn_positions(spark, 13, 40).collect()}
    want = spark.range(40 * 13).select(F.expr("id div 13").alias("b"), (F.col("id") % 13).alias("i"))
    want = want.withColumn("p", resampling.draw(F.col("b").cast("string"), F.col("i").cast("string")) % 13)
    assert got == {(r.b, r.i): r.p for r in want.collect()} and resampling.drawn_positions(spark, 0, 3).count() == 0
    rows = spark.createDataFrame([(p, x, p % 2, p / 7, p % 3 // 2) for p in range(13) for x in "ab"], "pos long, label string, y int, score double, yhat int")
    plan = resampling.bootstrap_metrics(spark, rows, 13, 40)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(round#" in plan and not re.search(r"hashpartitioning\(round#\d+L, pos#", plan)


def test_words_of_documents_make_no_rows(spark, monkeypatch):
    """Blocks of a few documents; ids that the vocabulary lacks; white space of all kinds, empty and null texts and a null key."""
    ranked = spark.createDataFrame([("a", "b</w>", 0), ("a", "b", 1), ("ab", "c</w>", 2), ("a", "a", 3)], "left string, right string, rank int")
    ids = {"ab</w>": 1, "abc</w>": 2, "aa": 3, "a</w>": 4, "1</w>": 5, "'": 6, "s</w>": 7, "a": 8, "<|endoftext|>": 9}
    vocabulary = spark.createDataFrame(list(ids.items()), "symbol string, id int")
    told = {"ab": [1], "abc": [2], "aaaaa": [3, 3, 4], "1": [5], "'s": [6, 7], "<|endoftext|>": [9], "a?": [4, None], "12": [5, None]}
    many = ["ab", "abc", "1", "aaaaa"] * 250
    texts = [many, many[::-1]] * 6 + [["ab's", "a?"], ["\u2003", "ab\u00a0abc\u0085", "\n"], [" \t"], [], ["12", "1<|endoftext|>ab"]]
    parts = {"ab's": ["ab", "'s"], "ab\u00a0abc\u0085": ["ab", "abc"], "1<|endoftext|>ab": ["1", "<|endoftext|>", "ab"]}
    rows = [(None if i == 3 else i, " ".join(w)) for i, w in enumerate(texts)] + [(99, None)]
    want = {k: [x for w in own for part in parts.get(w, [w]) for x in told.get(part, [])] for (k, _), own in zip(rows, [*texts, []], strict=True)}
    monkeypatch.setattr(merges, "BLOCK", 9_000, raising=False)
    context = spark.sparkContext._jsc.sc()
    first = context.dagScheduler().nextStageId()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as in large tables
    try:
        got = merges.encode(spark.createDataFrame(rows, "id long, text string"), "id", "text", ranked, vocabulary).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == len(rows) and {r.id: r.ids for r in got} == want
    context.listenerBus().waitUntilEmpty()
    moved = 0
    for stage in range(first, context.dagScheduler().nextStageId()):
        with contextlib.suppress(Py4JJavaError):  # a stage that was skipped
            moved += context.statusStore().lastStageAttempt(stage).shuffleWriteRecords()
    assert 0 < moved < 2_000
