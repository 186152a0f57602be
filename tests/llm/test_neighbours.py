import numpy as np
import pytest

from larkspur.llm import neighbours


def exact(x, ids, q, k):
    s = x @ x[q]
    order = [i for i in np.lexsort((ids, -s)) if i != q][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


@pytest.mark.parametrize(("n", "leaf", "spread"), [(1500, 128, 1.0), (600, 64, 0.05)])
def test_recall(spark, monkeypatch, n, leaf, spread):
    monkeypatch.setattr(neighbours, "LEAF", leaf)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24))
    x = (centres[rng.integers(30, size=n)] + spread * rng.normal(size=(n, 24))).astype(np.float32).astype(float)
    ids = np.arange(n) * 2
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    q = df.where("vec_id % 40 = 0").select("vec_id")
    hit = total = 0
    rows = neighbours.nearest(df, q, 10).collect()
    for i in range(0, n, 20):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in rows if r["query_id"] == ids[i])
        want = exact(x, ids, i, 10)
        assert [r[0] for r in own] == list(range(1, 11)) and all(r[2] == pytest.approx(float(x[i] @ x[ids.tolist().index(r[1])]), abs=1e-9) for r in own)
        hit += len({r[1] for r in own} & {w[0] for w in want})
        total += 10
    assert hit / total >= 0.9


def test_equal_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(60)] + [(100 + i, [0.1 * i, 1.0, 0.0]) for i in range(10)]
    bad = [(200, None), (201, [0.0, 0.0, 0.0]), (202, [1.0, None, 1.0]), (203, [float("nan"), 1.0, 1.0]), (204, [float("inf"), 1.0, 1.0]), (205, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0").select("vec_id"), 20).orderBy("query_id", "rank").collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(by) == {0, 20, 40, 100}
    assert by[0] == list(range(1, 21)) and by[20] == [*range(20)] and by[40] == [*range(20)]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    assert by[100] == [i for i, _ in exact(x, ids, 60, 20)]


@pytest.mark.parametrize(("kind", "factor"), [("float", 1e20), ("double", 1e100), ("double", 1e-100), ("double", None)])
def test_any_finite_magnitude(spark, kind, factor):
    """Components whose products no float holds; without a factor, lengths from 1 to 10**12 and queries far below."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 8)) * (factor or 10.0 ** rng.integers(0, 13, size=(400, 1)))
    if factor is None:
        x[::20] *= 1e-120
    x = x.astype(np.float32).astype(float) if kind == "float" else x
    ids = np.arange(400)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], f"vec_id long, embedding array<{kind}>")
    rows = neighbours.nearest(df, df.where("vec_id % 20 = 0").select("vec_id"), 20).collect()
    assert len(rows) == 400
    hit = 0
    for q in range(0, 400, 20):
        own = {r["vec_id"] for r in rows if r["query_id"] == q}
        hit += len(own & {i for i, _ in exact(x, ids, q, 20)})
    assert hit >= 0.97 * 400


def test_large_and_small_answers(spark):
    df = spark.createDataFrame([(i, [1e30 * (i + 1), 1.0]) for i in range(30)], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, df.where("vec_id = 0").select("vec_id"), 3).orderBy("rank").collect()
    assert [r["vec_id"] for r in rows] == [29, 28, 27]


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert neighbours.nearest(df, df.select("vec_id").where("vec_id % 20 = 0"), 20).count() == 4
    assert neighbours.nearest(df.limit(0), df.select("vec_id").limit(0), 20).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0"), df.select("vec_id"), 20).count() == 0


def test_rounds_go_on_until_settled(spark, monkeypatch):
    changes = [900, 400, 50, 7, 3, 2]
    monkeypatch.setattr(neighbours, "descent_step", lambda graph, codes, seed, k: spark.createDataFrame([(0, changes.pop(0))], "u long, changed int"))
    monkeypatch.setattr(neighbours, "stage_table", lambda df, name: df)
    last = neighbours.descend(spark.createDataFrame([(0, 1000)], "u long, changed int"), None, 1, 10, 400)
    assert last.first()["changed"] == 3 and changes == [2]


def test_repeated_ids(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    plain = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    again = spark.createDataFrame([*rows, *rows[:20], (7, [9.0] * 6)], "vec_id long, embedding array<double>")
    ask = plain.where("vec_id % 20 = 0").select("vec_id")
    want = {(r["query_id"], r["vec_id"]): r["score"] for r in neighbours.nearest(plain, ask, 49).collect()}
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in neighbours.nearest(again, ask, 49).collect()}
    assert len(got) == len(want) == 3 * 49
    assert all(got[k] == pytest.approx(want[k]) or k[1] == 7 and got[k] == pytest.approx(9 * x[k[0]].sum()) for k in want)


def test_width_grows_with_the_table():
    widths = [neighbours.search_width(n) for n in (0, 1_000, 51_282, 200_000, 1_000_000, 10**9)]
    assert widths == sorted(widths) and widths[0] == 400 and widths[4] == 1_100
