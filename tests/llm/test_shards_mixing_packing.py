import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkspur.llm import mixing, packing, shards, spark_util
from larkspur.llm.queries import tokenizer_path


@pytest.mark.parametrize("per_slice", [2_000, 8])
def test_shards(docs, rows, monkeypatch, per_slice):
    monkeypatch.setattr(shards, "slices_for", lambda n: spark_util.slices_for(n, per_slice))
    got = shards.shard_documents(docs, 7).collect()
    text = {r[0]: (r[1] or "").encode() for r in rows}
    assert sorted(r["doc_id"] for r in got) == sorted(text)
    assert all(r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) and r["law"] == "rows" and r["grown_shard"] is None for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    # proportional: every source is near its share in every shard
    share = Counter(r["source"] for r in got)
    cells = Counter((r["shard"], r["source"]) for r in got)
    assert all(abs(cells[s, x] - share[x] * sizes[s] / len(got)) <= 2 for s in range(7) for x in share)
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in shards.shard_documents(docs.repartition(3), 7).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in got}


def plain_interleaving(rows, shards, seed=17):
    """{(doc_id, crc): (shard, slot)} by sorting in one place."""
    def h(*parts):
        return int(hashlib.md5(":".join("" if p is None else str(p) for p in (seed, *parts)).encode()).hexdigest()[:15], 16)

    by = defaultdict(list)
    for doc, text, _, source, _ in rows:
        raw = (text or "").encode()
        by[source].append((h(doc, zlib.crc32(raw), len(raw) + 16), doc, zlib.crc32(raw)))
    order = sorted(((k + 0.5) / len(own), h(source, k), *r) for source, own in by.items() for k, r in enumerate(sorted(own)))
    out, n = {}, len(order)
    for g, (*_, doc, crc) in enumerate(order):
        shard = g * shards // n
        out[doc, crc] = (shard, g - -(-shard * n // shards))
    return out


@pytest.mark.parametrize(("per_slice", "block"), [(2_000, 1_024), (4, 3)])
def test_shards_equal_a_plain_sort(docs, rows, monkeypatch, per_slice, block):
    monkeypatch.setattr(shards, "slices_for", lambda n: spark_util.slices_for(n, per_slice))
    monkeypatch.setattr(spark_util, "BLOCK", block)
    long = rows + [(7000, "very long " * 100_000, "en", "a", 1)]
    got = shards.shard_documents(docs.sparkSession.createDataFrame(long, docs.schema).repartition(3), 7).collect()
    assert {(r["doc_id"], r["text_crc32"]): (r["shard"], r["slot"]) for r in got} == plain_interleaving(long, 7)


def test_shard_edge_cases(odd_docs, rows, no_docs):
    assert shards.shard_documents(odd_docs).count() == len(rows) + 6
    assert shards.shard_documents(no_docs).count() == 0
    assert shards.mixture_error(shards.shard_documents(odd_docs, 4)).agg({"max_off": "max"}).first()[0] < 3


def water(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return full
        level = (total - sum(full.values())) / sum(w[s] for s in rest)
        over = [s for s in rest if level * w[s] > cap * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in rest}
        full |= {s: float(cap * sizes[s]) for s in over}


def test_mix(docs, rows):
    got = mixing.mix_sources(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    words = {r[0]: len((r[1] or "").split()) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += words[r[0]]
    target = water(sizes)
    taken = Counter()
    for r in got:
        assert r["size"] == words[r["doc_id"]] and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in target:
        assert taken[s] == pytest.approx(target[s], abs=max(20, 0.02 * target[s]))
    again = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs.repartition(9)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in got}


def test_mix_edge_cases(spark, odd_docs, rows, no_docs):
    assert mixing.mix_sources(odd_docs).count() == len(rows) + 6
    assert mixing.mix_sources(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix_sources(blank).collect()] == [(0, 0, 0.0)] * 2
    long = spark.createDataFrame([(1, "w " * 300_000, "a"), (2, "w", "b"), (3, "x y", "b")], "doc_id long, text string, source string")
    assert {r["doc_id"]: r["size"] for r in mixing.mix_sources(long).collect()} == {1: 300_000, 2: 1, 3: 2}
    one = spark.createDataFrame([(i, "w " * (i % 7 + 1), None) for i in range(50)], "doc_id long, text string, source string")
    assert sum(r["taken"] for r in mixing.mix_sources(one).collect()) == sum(i % 7 + 1 for i in range(50))


def test_rates_solve_the_dual(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 40), "a" if i % 4 else "b") for i in range(800)], "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    for s in ("a", "b"):
        own = [r for r in got if r["source"] == s]
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=1e-5)
        free = [r for r in own if 0 < r["rate"] < 3]
        slope = np.polyfit([r["size"] for r in free], np.log([r["rate"] for r in free]), 1)
        assert np.allclose(np.polyval(slope, [r["size"] for r in free]), np.log([r["rate"] for r in free]), atol=1e-6)


def sequences(got, seq_len):
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= seq_len
    return len(by)


def test_pack(docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.best_fit_pack(docs, tokenizer_path(), 128).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert set(by) == {r[0] for r in rows}
    total = 0
    for doc, text, *_ in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        own = sorted(by[doc], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]])
            assert len(own) == 1 or k == 0 or r["length"] == 128
            at += r["length"]
        assert at == len(ids)
    assert sequences(got, 128) <= total / 128 * 1.02 + 1


def best_fit_decreasing(lengths, seq_len):
    """Sequences that plain best fit needs, one piece at a time."""
    gaps, used = [], 0
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        gap = min(fits) if fits else seq_len
        used += not fits
        if fits:
            gaps.remove(gap)
        gaps.append(gap - length)
    return used


def pieces_of(spark, lengths):
    rows = [(k, 0, 0, n, 7, k) for k, n in enumerate(lengths)]
    return spark.createDataFrame(rows, packing.PIECES).repartition(3)


@pytest.mark.parametrize(("seed", "seq_len"), [(1, 16), (2, 100), (3, 1024)])
def test_one_range_is_best_fit(spark, seed, seq_len):
    rng = np.random.default_rng(seed)
    lengths = [int(x) for x in np.concatenate([rng.integers(1, seq_len + 1, 150), rng.integers(1, seq_len // 4 + 1, 300), np.full(60, seq_len // 3)])]
    got = packing.place_pieces(pieces_of(spark, lengths), seq_len).collect()
    assert Counter(r["length"] for r in got) == Counter(lengths) and len({r["doc_id"] for r in got}) == len(lengths)
    assert sequences(got, seq_len) == best_fit_decreasing(lengths, seq_len)


def test_many_ranges_are_near_best_fit(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE", 300)
    rng = np.random.default_rng(4)
    lengths = [int(min(x, 256)) for x in np.concatenate([rng.lognormal(3, 1, 2500) + 1, np.full(900, 37)])]  # a hot length
    got = packing.place_pieces(pieces_of(spark, lengths), 256).collect()
    assert Counter(r["length"] for r in got) == Counter(lengths) and len({r["doc_id"] for r in got}) == len(lengths)
    assert sequences(got, 256) <= best_fit_decreasing(lengths, 256) * 1.02 + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.booleans()), max_size=40))
def test_gaps_give_the_successor(moves):
    gaps, plain = packing.Gaps(), []
    for k, (size, put) in enumerate(moves):
        if put:
            gaps.put(size, k)
            plain.append((size, k))
        else:
            found = gaps.take(size)
            fits = [g for g in plain if g[0] >= size]
            assert (found is None) == (not fits)
            if fits:
                assert found[0] == min(fits)[0] and found in plain
                plain.remove(found)


def test_pack_edge_cases(odd_docs, rows, no_docs):
    got = packing.best_fit_pack(odd_docs, tokenizer_path(), 128).collect()
    assert len({r["doc_id"] for r in got}) == len(rows) + 1
    sequences(got, 128)
    assert packing.best_fit_pack(no_docs, tokenizer_path()).count() == 0
