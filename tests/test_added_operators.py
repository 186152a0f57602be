import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import text, values
from larkspur.functions import volumes as N
from larkspur.operators import align, distribution, ranked, ranks, resampling, retrieval, tokens
from larkspur.sources import files
from larkspur.sources import volumes as V


@pytest.mark.parametrize("slices", [1, 3, 256])
def test_global_rank_equals_a_sort(spark, monkeypatch, slices):
    monkeypatch.setattr(ranks, "SLICES", slices)
    rng = np.random.default_rng(1)
    rows = [(int(x), f"k{x}", int(x) % 3) for x in rng.permutation(300)] + [(None, None, 0), (None, None, 1)]
    df = spark.createDataFrame(rows, "n long, s string, g long").repartition(3)
    for column in ("n", "s"):
        want = {r: i for i, r in enumerate(sorted(r[0 if column == "n" else 1] for r in rows if r[0] is not None))}
        got = ranks.global_rank(df, F.col(column), "pos").where(f"{column} is not null").collect()
        assert all(r["pos"] == want[r[column]] + 2 for r in got) and len(got) == 300
    by = ranks.global_rank(df.where("n is not null"), F.col("n"), "pos", by=("g",)).collect()
    assert all(r["pos"] == r["n"] // 3 for r in by)
    assert ranks.global_rank(df.limit(0), F.col("n"), "pos").count() == 0


def test_splits_cover_all_rows(spark):
    df = spark.range(101).select(F.col("id").alias("k"))
    split = {r["split"]: r["count"] for r in resampling.hash_split(df, "k", 0.8).groupBy("split").count().collect()}
    assert split == {"train": 80, "valid": 21}
    sizes = [r["count"] for r in resampling.worker_chunks(df, "k", 7).groupBy("worker").count().orderBy("worker").collect()]
    assert sizes == [15, 15, 15, 14, 14, 14, 14]
    assert [r["worker"] for r in resampling.worker_chunks(df.limit(3), "k", 5).orderBy("k").collect()] == [0, 1, 2]


def test_file_pairs(spark):
    made = spark.createDataFrame([("a", 1), ("b", 2)], "name string, v int")
    true = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "name string, v int")
    assert {tuple(r) for r in align.file_pairs(made, true, "name", "v").collect()} == {("a", 1, 10), ("b", 2, 20)}
    with pytest.raises(Exception, match="no true file"):
        align.file_pairs(made, true.where("name <> 'b'"), "name", "v").collect()
    with pytest.raises(Exception, match="several true files"):
        align.file_pairs(made, true.union(true), "name", "v").collect()


def test_bootstrap_metrics_equal_a_plain_draw(spark):
    rng = np.random.default_rng(2)
    n = 40
    y, s = rng.integers(0, 2, n), rng.integers(0, 6, n) / 5
    rows = spark.createDataFrame([(i, "a", int(y[i]), float(s[i]), int(s[i] >= 0.5)) for i in range(n)], "pos long, label string, y int, score double, yhat int")
    got = {r["round"]: r for r in resampling.bootstrap_metrics(spark, rows, n, 20).collect()}
    import hashlib

    for b in range(20):
        at = [int(hashlib.md5(f"{b}_{i}".encode()).hexdigest()[:8], 16) % n for i in range(n)]
        yy, ss = y[at], s[at]
        pos, neg = ss[yy == 1], ss[yy == 0]
        auroc = np.mean([(p > q) + (p == q) / 2 for p in pos for q in neg])
        hit = ss >= 0.5
        tp, fp, fn = int((hit & (yy == 1)).sum()), int((hit & (yy == 0)).sum()), int((~hit & (yy == 1)).sum())
        r = got[b]
        assert (r["auroc"], r["f1"], r["accuracy"], r["precision"]) == pytest.approx((auroc, 2 * tp / (2 * tp + fp + fn), (hit == yy).mean(), tp / (tp + fp)))


def test_frechet_by_chunk(spark):
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=(9, 3)), rng.normal(size=(9, 3))
    df = spark.createDataFrame([(f"n{i}", x[i].tolist(), z[i].tolist()) for i in range(9)], "name string, real array<double>, made array<double>")
    got = {r["g"]: r["frechet"] for r in distribution.frechet_by_chunk(df, "name", "real", "made").collect()}
    sums = lambda a: (len(a), a.sum(axis=0), a.T @ a)
    assert got["0"] == pytest.approx(distribution.frechet_from(*sums(z[:4]), *sums(x[:4]))) and got["1"] == pytest.approx(distribution.frechet_from(*sums(z[4:8]), *sums(x[4:8])))
    assert got["2"] is None  # a lone pair


def test_top_k_of_too_few_and_large_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(12)], "id long, v array<double>")
    with pytest.raises(ValueError, match="fewer than 13"):
        retrieval.top_k(df, df, 13, whole=True)
    want = {tuple(r) for r in retrieval.top_k(df, df, 3).collect()}
    monkeypatch.setattr(retrieval, "TILE", 5)
    assert {tuple(r) for r in retrieval.top_k(df, df, 3).collect()} == want


@pytest.mark.parametrize("use_cosine", [False, True])
def test_top_k_in_tiles_equals_numpy(spark, monkeypatch, use_cosine):
    """Both sides dealt to blocks; many ties, a zero vector and a null one."""
    g = np.random.default_rng(6)
    v = g.integers(-2, 3, size=(70, 3)).astype(float)
    v[9] = 0
    df = spark.createDataFrame([*((i, x.tolist()) for i, x in enumerate(v)), (99, None)], "id long, v array<double>")
    unit = np.divide(v, np.linalg.norm(v, axis=1, keepdims=True), out=np.full_like(v, np.nan), where=np.linalg.norm(v, axis=1, keepdims=True) > 0) if use_cosine else v
    sims = np.round(unit @ unit.T, 12)
    want = {(i, int(c), r + 1) for i in range(70) for r, c in enumerate([c for c in np.lexsort((np.arange(70), -sims[i])) if sims[i, c] == sims[i, c]][:4])}
    for block in (1_000, 16):
        monkeypatch.setattr(retrieval, "QUERY_BLOCK", block)
        assert {(r.q, r.c, r["rank"]) for r in retrieval.top_k(df, df, 4, use_cosine).collect()} == want


def test_column_moments_equal_numpy(spark):
    g = np.random.default_rng(2)
    x = g.normal(size=(200, 5)) @ g.normal(size=(5, 5)) + 1e6
    df = spark.createDataFrame([*((v.tolist(),) for v in x), (None,)], "v array<double>").repartition(4)
    got = {(r.i, r.j): (r.mean_i, r.cov) for r in distribution.column_moments(df, "v").collect()}
    want = np.cov(x.T)
    assert len(got) == 25 and all(np.isclose(got[i, j][1], want[i, j], rtol=1e-6, atol=1e-6) and np.isclose(got[i, j][0], x[:, i].mean()) for i, j in got)
    assert distribution.column_moments(df.limit(0), "v").count() == 0
    assert {r.cov for r in distribution.column_moments(df.where("v IS NOT NULL").limit(1), "v").collect()} == {None}


def test_top_k_accuracy(spark):
    df = spark.createDataFrame([("1", "a", 0, 0.9), ("1", "b", 1, 0.5), ("1", "c", 0, 0.1), ("2", "a", 0, 0.9), ("2", "b", 0, 0.5), ("2", "c", 1, 0.1)], "key string, label string, y int, score double")
    assert [ranked.top_k_accuracy(df, k).first()[0] for k in (1, 2, 3)] == [0.0, 0.5, 1.0]


def plain_similarity(a, b):
    """Slice by slice and window by window."""
    at = np.arange(11) - 5
    k = np.exp(-(at**2) / 4.5)
    k = np.outer(k, k) / np.outer(k, k).sum()
    span = max(np.ptp(a), np.ptp(b))
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    out = []
    for x, y in zip(a.astype(float), b.astype(float)):
        for i in range(5, x.shape[0] - 5):
            for j in range(5, x.shape[1] - 5):
                p, q = x[i - 5 : i + 6, j - 5 : j + 6], y[i - 5 : i + 6, j - 5 : j + 6]
                mp, mq = (k * p).sum(), (k * q).sum()
                vp, vq, cov = (k * p * p).sum() - mp * mp, (k * q * q).sum() - mq * mq, (k * p * q).sum() - mp * mq
                out.append((2 * mp * mq + c1) * (2 * cov + c2) / ((mp * mp + mq * mq + c1) * (vp + vq + c2)))
    return np.mean(out)


def test_image_errors():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 256, (3, 16, 18)).astype(np.float32), rng.integers(0, 256, (3, 16, 18)).astype(np.float32)
    mse, psnr, ssim = N.image_errors(a, b)
    assert mse == pytest.approx(((a - b) ** 2).mean()) and psnr == pytest.approx(10 * np.log10(b.max() ** 2 / mse)) and ssim == pytest.approx(plain_similarity(a, b))
    assert N.image_errors(a, a)[1:] == (None, pytest.approx(1.0))
    assert N.structural_similarity(np.zeros((1, 4, 4)), np.zeros((1, 4, 4))) == 1


def test_mosaic():
    got = N.mosaic(np.arange(12).reshape(3, 2, 2), 2)
    assert got.tolist() == [[0, 1, 4, 5], [2, 3, 6, 7], [8, 9, 0, 0], [10, 11, 0, 0]]


def test_sentinels_and_masks(spark):
    encode = lambda t: [1, *(ord(c) for c in t)]
    assert tokens.with_sentinels("a<image>b<image>", encode, bos=1) == [1, 97, -200, 98, -200]
    assert tokens.with_sentinels("a<image>b", lambda t: [ord(c) for c in t]) == [97, -200, 98]
    df = spark.createDataFrame([(1, [("user", "<image>q"), ("assistant", "ab")]), (2, None)], "id long, t array<struct<role:string,text:string>>")
    got = {r["id"]: r["m"] for r in df.select("id", tokens.masked_ids("t", encode, bos=1).alias("m")).collect()}
    assert got[1]["ids"] == [1, -200, 113, 97, 98] and got[1]["labels"] == [-100, -100, -100, 97, 98] and got[2]["ids"] == []
    assert spark.createDataFrame([("x<image>",), (None,)], "p string").select(tokens.image_token_ids(F.col("p"), encode, bos=1).alias("i")).collect()[1]["i"] == [1]


def test_unescaped_and_judge_request(spark):
    df = spark.createDataFrame([("&amp;lt;b&#233;", "<s>yes</s>"), (None, None)], "t string, a string")
    assert [r[0] for r in df.select(text.unescaped(F.col("t"))).collect()] == ["<bé", None]
    got = df.select(text.judge_request(F.lit("multiple_choice"), F.lit("<multiple_choice>Which?"), F.lit("B"), F.col("a"))).first()[0]
    assert got == "Question type: Multiple choice\n\nQuestion: Which?\n\nGround truth answer: B\n\nGenerated answer: yes"


def test_articles(spark):
    xml = "<a><article-title>T <i>x</i></article-title><body><sec><title> One </title><p>Two</p><fig>no</fig></sec></body></a>"
    df = spark.createDataFrame([(xml,), ("<a/>",), ("no xml",), (None,)], "x string")
    assert [tuple(r["a"]) for r in df.select(files.parse_articles(F.col("x")).alias("a")).collect()] == [("T ", "One\nTwo"), ("No Title", ""), (None, None), (None, None)]


def test_npz_and_conversion(spark, tmp_path):
    out = str(tmp_path / "npz")
    rows = spark.createDataFrame([("k.npz", [1.0, 2.5])], "name string, v array<double>").select("name", files.npz_content(F.col("v")).alias("content"))
    assert [r["name"] for r in files.write_files(rows, out).collect()] == ["k.npz"]
    assert np.load(f"{out}/k.npz")["arr"].tolist() == [[1.0, 2.5]] and V.read_npz(spark, out).first()["vector"] == [1.0, 2.5]
    src, dst = tmp_path / "mha" / "deep", tmp_path / "nii"
    src.mkdir(parents=True)
    dst.mkdir()
    x = np.arange(24).reshape(2, 3, 4)
    for name in ("b", "a"):
        (src / f"{name}.mha").write_bytes(V.write_mha(x, (2.0, 1.0, 0.5)))
    (dst / "b.nii.gz").write_bytes(b"old")
    assert [r["name"] for r in files.convert_volumes(spark, str(tmp_path / "mha"), str(dst)).collect()] == ["a.nii.gz", "b.nii.gz"]
    assert (dst / "b.nii.gz").read_bytes() == b"old" and sorted(p.name for p in dst.iterdir()) == ["a.nii.gz", "b.nii.gz"]
    array, spacing = V.parse_nifti((dst / "a.nii.gz").read_bytes())
    assert array.tolist() == x.tolist() and spacing == pytest.approx((2.0, 1.0, 0.5)) and gzip.decompress((dst / "a.nii.gz").read_bytes())[344:347] == b"n+1"


def test_values(spark):
    df = spark.createDataFrame([(0, 2.5, [1, 2], 0.1, 0.7)], "n int, x double, a array<int>, p double, q double").withColumn("Findings_X", F.lit(1)).withColumn("FINDINGS", F.lit(2))
    assert values.without_prefix(df).columns == ["n", "x", "a", "p", "q"]
    r = df.select(values.count_bucket(F.lit(13)).alias("b"), values.round_half_even(F.col("x")).alias("r"), values.reversed_if(F.lit(True), F.col("a")).alias("a"), values.sigmoid(F.lit(0)).alias("s"), values.softmax(F.col("p"), F.col("q"))[0].alias("m")).first()
    assert (r["b"], r["r"], r["a"], r["s"]) == (5, 2.0, [2, 1], 0.5) and r["m"] == pytest.approx(1 / (1 + np.exp(0.6)))
    assert values.external_labels(df, "n", {"one": ("p",), "two": ("p", "q")}).first().asDict() == {"n": 0, "one": 0.1, "two": 0.7}


def test_plane_slices(spark):
    df = spark.createDataFrame([("v", [2, 3, 4], np.arange(24, dtype="<f4").tobytes())], "path string, shape array<int>, voxels binary")
    got = N.plane_slices(df, lambda x: [float(x.sum())]).collect()
    assert len(got) == 9 and {r["plane"]: r["feature"][0] for r in got if r["index"] == 0} == {"xy": 66.0, "xz": 60.0, "yz": 60.0}
