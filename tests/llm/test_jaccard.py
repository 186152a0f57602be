import re

import numpy as np
import pytest

from larkspur.llm import jaccard
from larkspur.llm.graphs import connected_components


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_equals_brute_force(docs, rows):
    assert got(jaccard.near_duplicates(docs)) == brute(rows)


def test_chains_large_groups_and_small_tiles(spark, monkeypatch):
    """A chain whose ends are not alike, a group of near copies, small tiles and few frequent shingles."""
    monkeypatch.setattr(jaccard, "TILE", 4)
    monkeypatch.setattr(jaccard, "SAME", 3)
    monkeypatch.setattr(jaccard, "FREQUENT", 10)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(12):  # each step changes eight words, which costs about forty shingles of two hundred
        own = list(base)
        for j in range(k * 4):
            own[(j * 23) % 200] = f"x{j}"
        rows.append((100 + k, " ".join(own)))
    rng = np.random.default_rng(2)
    for k in range(40):
        own = list(base)
        own[rng.integers(200)] = f"y{k}"
        rows.append((500 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jaccard.near_duplicates(df)) == brute(rows)


def test_edge_cases(spark, odd_docs, rows, no_docs):
    found = jaccard.near_duplicates(odd_docs).collect()
    assert len(found) == len(rows) + 6
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None} == brute(rows)
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None]
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_exact_threshold_links(spark):
    a = " ".join(f"a{i}" for i in range(13))  # 9 shingles
    b = a.rsplit(" ", 1)[0]  # 8 of 9: 88 %
    c = " ".join(f"a{i}" for i in range(12)) + " z q"  # 8 of 11: 72 %
    d = " ".join(f"b{i}" for i in range(14))  # 10 shingles
    e = " ".join(f"b{i}" for i in range(12))  # 8 of 10: 80 %
    df = spark.createDataFrame(list(enumerate([a, b, c, d, e])), "doc_id long, text string")
    assert {k: v[1] for k, v in got(jaccard.near_duplicates(df)).items()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3} or brute(list(enumerate([a, b, c, d, e]))) == got(jaccard.near_duplicates(df))


@pytest.mark.parametrize("groups", [64, 256])
def test_tree_never_loses_a_pair(groups):
    rng = np.random.default_rng(5)
    base = rng.poisson(3, (20, groups))
    points = np.maximum(0, np.repeat(base, 15, axis=0) + rng.integers(-1, 2, (300, groups))).astype(np.uint16)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = jaccard.CountVectorTree(points, sizes)
    for q in range(0, 300, 17):
        bound = np.minimum(points, points[q]).sum(axis=1)
        want = set(np.flatnonzero((bound >= jaccard.needed(sizes + sizes[q], 80)) & (sizes * 80 <= sizes[q] * 100) & (sizes * 100 >= sizes[q] * 80)))
        assert set(tree.search(points[q], int(sizes[q]), 80)) == want


def test_points_of_different_fineness_bound_the_overlap():
    rng = np.random.default_rng(1)
    for n in (50, 63, 64, 65, 100, 128, 130, 1000, 5000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 20], rng.integers(0, 1 << 63, n // 6).astype(np.uint64)])
        x, y = (jaccard.unpack_counts(jaccard.pack_counts(jaccard.group_counts(np.unique(v)))) for v in (a, b))
        g = min(len(x), len(y))
        shared = len(np.intersect1d(a, b))
        assert np.minimum(jaccard.fold(x, g), jaccard.fold(y, g)).sum() >= shared
        sizes = np.array([len(np.unique(a)), len(np.unique(b))])
        for few in (0, 48):  # by the tree, and directly
            tile = jaccard.Points([jaccard.pack_counts(v) for v in (x, y)], sizes, 80)
            tile.FEW = few
            assert tile.near(1, np.array([0])).tolist() == [0]


def near_copies(spark, m):
    base = [f"w{i}" for i in range(200)]
    rng = np.random.default_rng(3)
    rows = []
    for k in range(m):  # two of them are alike or not, about half and half
        own = list(base)
        for _ in range(int(rng.integers(2, 7))):
            own[rng.integers(200)] = f"y{rng.integers(1 << 30)}"
        rows.append((k, " ".join(own)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_links_of_a_near_copy_group_grow_with_it(spark, monkeypatch):
    """No task gives all pairs of a group: links stay below the points that it has received."""
    monkeypatch.setattr(jaccard, "TILE", 40)
    made = []
    tiles, stage = jaccard.tile_links, jaccard.stage_table
    monkeypatch.setattr(jaccard, "tile_links", lambda t, *a: made.append([stage(t, "t").count(), 0]) or tiles(t, *a))

    def staged(df, name):
        out = stage(df, name)
        if name in ("group-links", "strip-links"):
            made[-1][1] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stage_table", staged)
    rows, df = near_copies(spark, 240)
    assert got(jaccard.near_duplicates(df)) == brute(rows)
    assert len(made) == 4 and made[0][1] and all(links <= points + before for (points, links), (_, before) in zip(made, [(0, 0), *made], strict=False))


@pytest.mark.parametrize("tile", [jaccard.Points, jaccard.Sets])
def test_spanning_links_join_what_pairs_join(tile):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, (6, 120)).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(120) < 0.06, rng.integers(0, 1 << 63, 120).astype(np.uint64), base[i % 6])) for i in range(90)]
    own = [jaccard.pack_counts(jaccard.group_counts(s)) if tile is jaccard.Points else s.tobytes() for s in sets]
    sizes = np.array([len(s) for s in sets])
    for few in (0, 48):
        jaccard.Points.FEW = few
        it = tile(own, sizes, 80)
        for start in (np.arange(90), np.arange(90) // 7):
            def classes(links, start=start):
                root = start.copy()
                for a, b in links:
                    root[root == root[a]] = root[b]
                return {frozenset(np.flatnonzero(root == r).tolist()) for r in root}

            links = jaccard.spanning_links(it, start)
            every = [(q, int(h)) for q in range(90) for h in it.near(q, np.arange(90))]
            assert classes(links) == classes(every) and len(links) == len(set(start.tolist())) - len(classes(every))
    jaccard.Points.FEW = 48


def test_rows_of_one_id_with_different_texts_are_linked(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    df = spark.createDataFrame([(3, a), (7, a), (7, b), (9, b), (9, b), (11, c)], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()} == {(3, 3), (7, 3), (9, 3), (11, 11)}


@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (9, 8), (3, 9)], [(i, i + 1) for i in range(30)], []])
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    comp = {r["node"]: r["component"] for r in connected_components(df).collect()}
    nodes = {x for e in links for x in e}
    assert set(comp) == nodes and all(v == min(nodes) for v in comp.values())


def test_components_go_on_until_nothing_changes(spark, monkeypatch):
    from unittest.mock import MagicMock

    from larkspur.llm import graphs

    tables = [MagicMock(**{"agg.return_value.first.return_value": i}) for i in [*range(80), 79]]
    monkeypatch.setattr(graphs, "stage_table", lambda df, name: tables.pop(0))
    monkeypatch.setattr(graphs, "drop_table", lambda df: None)
    graphs.connected_components(MagicMock())
    assert not tables


def test_links_are_contracted_inside_tasks(spark, monkeypatch):
    """Each round of components writes a table; links that tasks hold together need few."""
    from larkspur.llm import graphs

    staged, names = graphs.stage_table, []
    monkeypatch.setattr(graphs, "stage_table", lambda df, name: names.append(name) or staged(df, name))
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join([*[f"x{i}" for i in range(3 * k)], *base[3 * k :]])) for k in range(16)]
    assert got(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    assert names.count("edges") <= 4
