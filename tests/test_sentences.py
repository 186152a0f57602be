"""The learned splitter against a plain implementation."""

import math
import re
from collections import Counter

import numpy as np

from larkspur.operators import sentences as S


def log_likelihood(k, n, p):
    part = lambda m, q: 0.0 if m <= 0 else m * math.log(max(q, 1e-300))
    return part(k, p) + part(n - k, 1 - p)


def pair_ratio(k, a, b, n):
    args = [(k, a, b / n), (b - k, n - a, b / n), (k, a, k / a), (b - k, n - a, (b - k) / max(n - a, 1))]
    x = [log_likelihood(*v) for v in args]
    return -2 * (x[0] + x[1] - x[2] - x[3])


def plain_sentences(docs):
    bare = lambda w: re.sub(r"^[\"'«“‘(\[]+", "", re.sub(r"[\"'»”’)\]]*$", "", w))
    plain = lambda w: re.sub(r"[.!?,;:]+$", "", w).lower()
    end = lambda w: "!" if w[-1:] in ("!", "?") and w else "." if w.endswith(".") else ""
    rows = []
    for key, text in docs.items():
        p = re.findall(r"\S+\s*", text or "")
        b = [bare(w.rstrip()) for w in p]
        rows += [(key, i, plain(w), end(w), plain(f), bool(f) and f[0] != f[0].lower()) for i, (w, f) in enumerate(zip(b, (b[1:] + [""])[: len(b)], strict=True))]
    stopped, other = Counter(r[2] for r in rows if r[3] == "." and r[2]), Counter(r[2] for r in rows if r[3] != "." and r[2])
    total, stops = sum(stopped.values()) + sum(other.values()), sum(stopped.values())
    count = lambda w: stopped[w] + other[w]
    score = {}
    for w in {*stopped, *other}:
        if any(c.isalpha() for c in w):
            inner = w.count(".")
            ratio = -2 * (log_likelihood(stopped[w], count(w), stops / total) - log_likelihood(stopped[w], count(w), 0.99))
            score[w] = ratio * math.exp(inner - len(w)) * (inner + 1) * float(len(w) - inner) ** -other[w]
    short = {w for w, s in score.items() if s >= 0.3}
    pairs = Counter((r[2], r[4]) for r in rows if r[3] == "." and r[2] and r[4])
    tied = {(w, f) for (w, f), k in pairs.items() if k > 1 and w in score and f in score and pair_ratio(k, stopped[w], count(f), total) >= 7.88 and k / stopped[w] > count(f) / total}
    behind = Counter(r[4] for r in rows if r[3] and r[4] and r[2] not in short)
    first = sum(behind.values())
    starts = {f for f, k in behind.items() if f in score and pair_ratio(k, first, count(f), total) >= 30 and k / first > count(f) / total}
    ends = {}
    for key, i, w, e, f, upper in rows:
        if e == "!" or e == "." and (w, f) not in tied and (w not in short or f in starts and upper):
            ends.setdefault(key, set()).add(i)
    out = {}
    for key, text in docs.items():
        p = re.findall(r"\S+\s*", text or "")
        done, own = 0, []
        for i in sorted(ends.get(key, set()) | ({len(p) - 1} if p else set())):
            own.append("".join(p[done : i + 1]).rstrip())
            done = i + 1
        out[key] = own
    return score, out


def made():
    g = np.random.default_rng(4)
    nouns = [a + b for a in ("lung", "heart", "node", "scan", "lobe", "rib", "vein") for b in ("s", "ing", "ia", "o", "el")]
    docs = {}
    for k in range(150):
        text = []
        for _ in range(g.integers(1, 9)):
            words = [str(x) for x in g.choice(nouns, size=g.integers(3, 9))]
            words[0] = str(g.choice(["The", "It", "No", words[0].title()]))
            if g.random() < 0.4:
                words.insert(2, str(g.choice(["Dr.", "approx.", "e.g.", "ca."])))
            if g.random() < 0.2:
                words[1] = f"({words[1]})"
            text.append(" ".join(words) + str(g.choice([".", ".", ".", "!", "?", ".)", ".\""])))
        docs[k] = str(g.choice([" ", "  ", "\n"])).join(text)
    return {**docs, 900: None, 901: "  \n ", 902: "one", 903: "... .", 904: "Stop.  Go on \n now? yes"}


def test_splits_equal_a_plain_implementation(spark):
    docs = made()
    df = spark.createDataFrame(list(docs.items()), "id long, text string").repartition(3)
    score, want = plain_sentences(docs)
    got = {r.word: r.score for r in S.word_statistics(S.word_places(df, "id", "text")).collect()}
    assert got.keys() == score.keys() and all(math.isclose(got[w], score[w], rel_tol=1e-9, abs_tol=1e-12) for w in got)
    assert {w for w, s in got.items() if s >= 0.3} >= {"dr", "approx", "e.g", "ca"}
    assert {r.id: list(r.sentences) for r in S.sentences(df, "id", "text").collect()} == want
    assert any("Dr. " in s for own in want.values() for s in own) and sum(map(len, want.values())) > 400
    assert S.sentences(df.limit(0), "id", "text").count() == 0
