import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import hooks, keys, text
from larkspur.operators import align, classification, conversations, distribution, ranked, resampling, retrieval, text_metrics
from larkspur.sources import sinks, submissions


def long(spark, rows):
    return spark.createDataFrame(rows, "key string, label string, y int, score double").withColumn("yhat", (F.col("score") >= 0.5).cast("int"))


def test_missing_and_repeated_predictions_are_errors(spark):
    gt = spark.createDataFrame([("a", 1), ("b", 0)], "key string, y int")
    good = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.3)], "key string, p double")
    assert {r["key"] for r in align.strict_align(gt, good, ["key"], "p").collect()} == {"a", "b"}
    with pytest.raises(Exception, match="missing prediction"):
        align.strict_align(gt, good.where("key <> 'b'"), ["key"], "p").collect()
    with pytest.raises(Exception, match="repeated prediction"):
        align.strict_align(gt, good.union(good.where("key = 'a'")), ["key"], "p").select("p").collect()


def test_absent_and_extra_labels(spark):
    value = '[{"outputs":[{"value":{"predictions":[{"input_image_name":"x.nii.gz","probabilities":{"a":0.5,"z":0.9}}]}}]}]'
    preds = submissions.parse_predictions(spark.createDataFrame([(value,)], "value string"))
    got = {r["label"]: r["score"] for r in submissions.label_probabilities(preds, ["a", "b"]).collect()}
    assert got == {"a": 0.5, "b": 0.0}


def test_threshold_edges(spark):
    df = long(spark, [("k", "a", 1, 0.5)])
    assert df.first()["yhat"] == 1
    assert df.where(F.col("score") > 0.5).count() == 0


def test_one_class_has_no_auroc_and_macro_skips_it(spark):
    df = long(spark, [("1", "a", 1, 0.9), ("2", "a", 1, 0.1), ("1", "b", 1, 0.9), ("2", "b", 0, 0.1)])
    got = {r["label"]: r["auroc"] for r in ranked.auroc(df).collect()}
    assert got == {"a": None, "b": 1.0}
    assert ranked.auroc(df).agg(F.avg("auroc")).first()[0] == 1.0


def test_zero_division_is_zero(spark):
    df = long(spark, [("1", "none", 0, 0.1), ("2", "none", 0, 0.2), ("1", "missed", 1, 0.1), ("2", "missed", 0, 0.2)])
    for r in classification.scores(classification.confusion(df, "label")).collect():
        assert (r["precision"], r["recall"], r["f1"]) == (0, 0, 0)


def test_crg_needs_a_positive_and_matches_hand_count(spark):
    with pytest.raises(Exception, match="CRG is undefined"):
        classification.crg(long(spark, [("1", "a", 0, 0.1)])).collect()
    got = classification.crg(long(spark, [("1", "a", 1, 0.9), ("2", "a", 0, 0.1), ("3", "a", 0, 0.8), ("4", "a", 1, 0.2)])).first()
    # X 4, A 2, r 0.5, U 1, s = 0.5 - 0.5 - 1 = -1, 1 / 3
    assert got["score_s"] == -1 and got["CRG"] == pytest.approx(1 / 3)


def brute_auroc(y, s):
    p, n = s[y == 1], s[y == 0]
    return ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))


def test_rank_metrics_against_brute_force(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 200), rng.integers(0, 12, 200) / 12
    df = long(spark, [(str(i), "a", int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))])
    assert ranked.auroc(df).first()["auroc"] == pytest.approx(brute_auroc(y, s))
    order = sorted(set(s), reverse=True)
    ap = prev = 0
    for t in order:
        tp = ((s >= t) & (y == 1)).sum()
        ap += (tp / y.sum() - prev) * tp / (s >= t).sum()
        prev = tp / y.sum()
    assert ranked.average_precision(df).first()["ap"] == pytest.approx(ap)
    best = min((round(math.hypot(1 - ((s > t) & (y == 1)).sum() / y.sum(), ((s > t) & (y == 0)).sum() / (y == 0).sum()), 12), -i) for i, t in enumerate(np.arange(100) / 99))
    assert ranked.grid_threshold(df).first()["threshold"] == pytest.approx(-best[1] / 99)


def test_top_k_without_positives_is_one(spark):
    got = {r["k"]: r["accuracy"] for r in ranked.top_k_label_accuracy(long(spark, [("1", "a", 0, 0.9), ("1", "b", 0, 0.8)])).collect()}
    assert got == {1: 1.0, 2: 1.0}


def test_interval_guards_the_lower_index(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)], "label string, v double")
    r = resampling.interval(df, "v", "label").first()
    assert (r["lower"], r["upper"]) == (0.0, 8.0)


def test_bootstrap_draws_rows_again(spark):
    rows = resampling.numbered(spark.range(50).toDF("key"), "key")
    drawn = resampling.bootstrap_rows(spark, rows, 50, 4)
    assert drawn.count() == 200 and drawn.where("round = 0").select("key").distinct().count() < 50


def test_key_rules(spark):
    one = spark.createDataFrame([("1.2.840.6_B",), ("v.nii.gz",), ("v_embedded.npz",), ("a/b/v.npz",)], "k string")
    got = one.select(*[r(F.col("k")).alias(n) for n, r in keys.RULES.items()]).collect()
    assert got[0]["k1"] == "1.2.840" and got[1]["k1"] == "v" and got[2]["k2"] == "v" and got[3]["k7"] == "v.nii.gz" and got[1]["k9"] == "v"


def test_cleaning_order(spark):
    t = spark.createDataFrame([('"a . b ._c<|eot_id|>\n .',)], "t string")
    assert t.select(text.clean_prediction(F.col("t"))).first()[0] == "a.b.c."
    ages = spark.createDataFrame([("058Y", "M"), ("007Y", None), ("1234Y", "f")], "a string, s string")
    assert [r[0] for r in ages.select(text.demographic_prompt(F.col("a"), F.col("s"), F.lit("t"))).collect()] == ["58 years old male: t", "07 years old None: t", "234 years old female: t"]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([3.0, 4.0], [3.0, 4.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(retrieval.cosine(F.col("a"), F.col("b"))).collect()] == [None, pytest.approx(1.0)]
    ys = spark.createDataFrame([([0, 0], [0, 0]), ([1, 0], [1, 1])], "a array<int>, b array<int>")
    assert [r[0] for r in ys.select(retrieval.label_similarity(F.col("a"), F.col("b"))).collect()] == [None, 0.5]


def test_top_k_blocks_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    want = {(i, int(j)) for i in range(60) for j in np.argsort(-(x @ x[i]), kind="stable")[:3]}
    assert {(r["q"], r["c"]) for r in retrieval.top_k(df, df, 3).collect()} == want
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 25)
    assert {(r["q"], r["c"]) for r in retrieval.top_k(df, df, 3).collect()} == want


def test_text_metrics_by_hand(spark):
    df = spark.createDataFrame([("1", "the cat sat down", "the cat sat"), ("2", "a b", "c")], "key string, ref string, hyp string")
    b = text_metrics.bleu(df).first()
    assert b["bleu_1"] == pytest.approx(math.exp(1 - 6 / 4) * 3 / 4) and b["bleu_4"] == 0
    r = [x[0] for x in df.orderBy("key").select(text_metrics.rouge_l("ref", "hyp")).collect()]
    p, q = 1, 3 / 4
    assert r[0] == pytest.approx((1 + 1.44) * p * q / (q + 1.44 * p)) and r[1] == 0
    same = spark.createDataFrame([("1", "a b c d e", "a b c d e"), ("2", "v w x y z", "p q r s t")], "key string, ref string, hyp string")
    assert [x["cider"] for x in text_metrics.cider(same).orderBy("key").collect()] == [pytest.approx(10.0), 0.0]


def test_frechet(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(300, 5)), rng.normal(1, 2, size=(300, 5))
    rows = [("g", "a", v.tolist()) for v in a] + [("g", "b", v.tolist()) for v in b]
    got = distribution.frechet(spark.createDataFrame(rows, "g string, side string, v array<double>"), "g", "side", "v").first()["frechet"]
    ca, cb = np.cov(a, rowvar=False), np.cov(b, rowvar=False)
    w = np.linalg.eigvals(ca @ cb)
    want = ((a.mean(0) - b.mean(0)) ** 2).sum() + np.trace(ca) + np.trace(cb) - 2 * np.sqrt(w.real).sum()
    assert got == pytest.approx(want)
    with pytest.raises(Exception, match="two rows"):
        distribution.frechet(spark.createDataFrame(rows[:1] + rows[-2:], "g string, side string, v array<double>"), "g", "side", "v").collect()


def test_conversations(spark):
    t = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "user", "v"), (1, 3, "assistant", "w")], "k long, turn long, role string, text string")
    kept = conversations.drop_lead(t, "k", "turn", "role").orderBy("turn").collect()
    assert [(r["turn"], r["alternates"]) for r in kept] == [(1, True), (2, False), (3, True)]
    assert [r["question"] for r in conversations.next_turn_pairs(t, "k", "turn", "role", "text").collect()] == ["v"]
    one = spark.createDataFrame([("<1><q> a <a> b <2><1><q>c<a>d<1>",)], "t string")
    assert [(x["number"], x["body"]) for x in one.select(conversations.numbered_sections(F.col("t")).alias("s")).first()["s"]][0][0] == "1"


def test_documents_and_merges(spark):
    doc = sinks.metric_document({"a": spark.range(1).toDF("x"), "b": spark.createDataFrame([(0.5, None)], "y double, z double")}).first()["json"]
    assert doc == '{"a":{"x":0},"b":{"y":0.5}}'
    maps = spark.sql("select map('p', 1.0d, 'q', 2.0d) a, map('q', 3.0d, 'r', cast(null as double)) b, cast(null as map<string,double>) c")
    assert maps.select(sinks.flat_merge([F.col("a"), F.col("b"), F.col("c")])).first()[0] == '{"p":1.0,"q":3.0}'
    assert maps.select(sinks.flat_merge([F.col("c")])).first()[0] == '{"status":"failed"}'


def test_files(spark, tmp_path):
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "a.json").write_text("[]")
    assert submissions.first_json(spark, str(tmp_path)).endswith("a.json")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        submissions.first_json(spark, str(tmp_path / "none"))
    (tmp_path / "t.csv").write_text('AccessionNo,a\r\nx,1\ny,0\n')
    assert submissions.read_csv(spark, str(tmp_path / "t.csv"), "AccessionNo string, a int", limit=1).collect()[0]["AccessionNo"] == "x"
    (tmp_path / "v1_metadata.json").write_text('{"PatientAge": "058Y"}')
    assert submissions.read_sidecars(spark, str(tmp_path / "v1_metadata.json"), "PatientAge string").first()["volume"] == "v1"
    assert submissions.list_files(spark, str(tmp_path), "*.csv").first()["file"] == "t.csv"


def test_hooks(spark):
    df = spark.createDataFrame([("1", "Emphysema seen"), ("2", None)], "key string, t string")
    got = {(r["key"], r["label"]): r["score"] for r in hooks.label_scores(df, "key", "t", ["a", "b"], hooks.keyword_model([["emphysema"], ["nodule"]])).collect()}
    assert got == {("1", "a"): 1.0, ("1", "b"): 0.0, ("2", "a"): 0.0, ("2", "b"): 0.0}
