import hashlib
import re

import pytest

from larkspur.llm import lines, substrings

sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


def brute_repeats(rows, k):
    words = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][i : i + k]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize(("window", "kmer"), [(50, 10), (12, 4), (3, 2)])
def test_repeats_equal_brute_force(docs, rows, window, kmer):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(docs, window, kmer).collect()}
    assert got == brute_repeats(rows, window)
    assert window != 50 or any(v[1] for v in got.values())


def test_repeats_inside_one_document_stay(spark):
    phrase = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{phrase} {phrase}"), (2, f"x {phrase} y {phrase}"), (3, "ab " * 200), (4, "ab " * 70)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_repeats(rows, 50)
    assert got[1][1] == 0 and got[2][1] == 120 and got[4][1] == 70


def test_words_that_share_a_hash_are_told_apart(spark):
    """Two words of 2,048 letters whose 64-bit prefix-sum hashes are equal: the graph takes the texts for copies, the words at the coordinates do not."""
    a, b = ("".join("xy"[(i.bit_count() + flip) % 2] for i in range(2048)) for flip in (0, 1))
    before, after, more = ([f"{x}{i}" for i in range(60)] for x in "pqr")
    rows = [(1, " ".join([*before, a, *after])), (2, " ".join([*before, b, *after])), (3, " ".join([*more, *before[:20], b, *after[:30]])), (4, " ".join([*before[5:], a, *after, "end"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = df.selectExpr("doc_id", "xxhash64(text) tag", "text")
    assert substrings.differing_paths(substrings.judge(keyed, 50, 10)).count() > 0
    assert substrings.differing_paths(substrings.judge(keyed, 50, 10, strong=True)).count() == 0
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(df).collect()}
    assert got == brute_repeats(rows, 50)


def brute_lines(rows):
    spaces = "\t\n\x0b\x0c\r "
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(spaces))
    held = {}
    for d, t in ((r[0], r[1]) for r in rows):
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(d)
    out = {}
    for d, t in ((r[0], r[1]) for r in rows):
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= 10 and len(held[key(x)]) >= 2 and d > min(held[key(x)]))]
        out[d] = (len(every), len(every) - len(kept), sha("\n".join(kept)))
    return out


def test_lines_equal_brute_force(docs, rows):
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in lines.dedup_lines(docs).collect()}
    assert got == brute_lines(rows)
    assert any(v[1] for v in got.values())


def test_line_threshold(spark):
    df = spark.createDataFrame([(i, "shared by three here" if i < 3 else "shared by two here") for i in range(5)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_dropped"] for r in lines.dedup_lines(df, min_docs=3).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 4: 0}


@pytest.mark.parametrize("operator", [lines.dedup_lines, substrings.remove_repeats])
def test_edge_cases(odd_docs, rows, no_docs, operator):
    out = operator(odd_docs)
    found = out.collect()
    assert len(found) == len(rows) + 6 and {"rep", "p", "__drop"} <= set(out.columns)
    plain = {r[0]: r for r in rows}
    want = (brute_lines if operator is lines.dedup_lines else lambda x: brute_repeats(x, 50))(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["text"] == "no id here at all"
        else:
            assert r["kept_sha256"] == want[r["doc_id"]][2] and r["source"] == plain[r["doc_id"]][3]
    assert operator(no_docs).count() == 0
