"""b-bit MinHash components against all pairs of sets."""

import re

import numpy as np
import pytest

from larkspur.llm import jaccard, minhash


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if len(w) == 1 else {tuple(w[i : i + 2]) for i in range(len(w) - 1)}


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
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_equals_brute_force(docs, rows):
    assert got(minhash.near_duplicates(docs)) == brute(rows)


def test_limits_chains_and_large_buckets(spark, monkeypatch):
    """Pairs exactly at 80 % and just below it, a chain, a group of near copies in buckets cut into strips, many short texts."""
    monkeypatch.setattr(minhash, "TILE", 4)
    monkeypatch.setattr(minhash, "SET_TILE", 3)
    monkeypatch.setattr(jaccard, "SAME", 3)
    rows = []
    for k in range(40):  # 36 shared shingles of 45, or of 46
        own = [f"p{k}_{i}" for i in range(37)]
        rows += [(k * 10, " ".join(own)), (k * 10 + 1, " ".join([*own, *(f"q{i}" for i in range(9))])), (k * 10 + 2, " ".join([*own, *(f"r{k}_{i}" for i in range(10))]))]
    base = [f"w{i}" for i in range(200)]
    for k in range(12):
        own = list(base)
        for j in range(k * 8):
            own[(j * 23) % 200] = f"x{j}"
        rows.append((1_000 + k, " ".join(own)))
    g = np.random.default_rng(2)
    for k in range(40):
        own = list(base)
        own[g.integers(200)] = f"y{k}"
        rows.append((2_000 + k, " ".join(own)))
    rows += [(3_000 + k, f"s{k % 5} t{k % 7} u") for k in range(35)]
    want = brute(rows)
    assert sum(want[k * 10 + 1][1] == k * 10 for k in range(40)) == 40 and want[2][2]
    assert got(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_odd_rows_and_empty_table(spark, odd_docs, rows, no_docs):
    found = minhash.near_duplicates(odd_docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.count() == odd_docs.count()
    want = {**brute(rows), None: (4, None, True)}
    assert got(found) == want
    assert got(minhash.near_duplicates(no_docs)) == {}
    several = spark.createDataFrame([(1, "a b c d"), (1, "v w x y z"), (2, "v w x y z"), (3, "a b c d"), (4, "other")], "doc_id long, text string")
    assert {i: c for i, (_, c, _) in got(minhash.near_duplicates(several)).items()} == {1: 1, 2: 1, 3: 1, 4: 4}


@pytest.mark.parametrize("similarity", [0.3, 0.8])
def test_estimates(similarity):
    """Corrected estimates lie around the true similarity with the spread of independent functions; at the limit none is left out."""
    g = np.random.default_rng(4)
    pairs, size = 1_500, 300
    both = round(2 * size * similarity / (1 + similarity))
    a, b = [], []
    for _ in range(pairs):
        x = g.integers(1 << 63, size=2 * size - both, dtype=np.uint64)
        a.append(np.sort(x[:size]))
        b.append(np.sort(x[size - both :]))
    p, q = minhash.minima(a), minhash.minima(b)
    true = both / (2 * size - both)
    unlike = np.bitwise_or.reduce(minhash.pack_low_bits(p) ^ minhash.pack_low_bits(q), axis=1)
    matches = minhash.HASHES - np.bitwise_count(unlike).sum(axis=1, dtype=np.int64)
    found = minhash.estimate(matches)
    assert abs(found.mean() - true) < 0.01 and found.std() < 1.3 * (true * (1 - true) / minhash.HASHES) ** 0.5 + 0.01
    kept = matches >= minhash.least_matches(80)
    met = (minhash.band_keys(p) == minhash.band_keys(q)).any(axis=1)
    if similarity == 0.8:
        assert kept.all() and met.all()
    else:
        assert not kept.any() and abs(met.mean() - (1 - (1 - true**minhash.ROWS) ** minhash.BANDS)) < 0.05


@pytest.mark.parametrize("together", [1 << 20, 50])
def test_contracted_components(spark, monkeypatch, together):
    """Chains, stars around large and small ids, random links and repeated ones, over several tasks."""
    from larkspur.llm import graphs

    monkeypatch.setattr(graphs, "TOGETHER", together)
    g = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(200, 260)] + [(150, i) for i in range(600, 640)] + [tuple(map(int, x)) for x in g.integers(700, 1_000, size=(200, 2))] + [(3, 4), (7, 7)]
    g.shuffle(links)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in links], "a long, b long").repartition(7)
    want = {r.node: r.component for r in jaccard.connected_components(df).collect()}
    got = graphs.contracted_components(df).collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert graphs.contracted_components(df.limit(0)).count() == 0
