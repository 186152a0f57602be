"""Shares and distances of groups against a dense computation."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from larkspur.llm import divergence


def brute(docs, least_docs, top):
    """{(lang, source, part): [(item, value)] in order} of rows (text, lang, source)."""
    words, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in found]
        words[lang, source].update(found)
        held[lang].update(set(found))
    out = {}
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least_docs]
        own = sorted(s for x, s in groups if x == lang)

        def shares(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(words[lang, s]) for s in own}
        q = shares(sum((words[lang, s] for s in own), Counter()))
        for s in own:
            rank = lambda rows: sorted(rows, key=lambda r: (-r[1], r[0].encode()))
            out[lang, s, "pair"] = rank([(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s])
            out[lang, s, "term"] = rank([(t, p[s][t] - q[t]) for t in kept if words[lang, s][t] and p[s][t] > q[t]])[:top]
    return {k: v for k, v in out.items() if v}


def audit(spark, docs, least_docs, top=50):
    rows = divergence.divergence_audit(spark.createDataFrame(docs, "text string, lang string, source string, term string, n long"), least_docs, top).collect()
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.lang, r.source, r.part, r["rank"])):
        out[r.lang, r.source, r.part].append((r["item"], r.value))
        assert r["rank"] == len(out[r.lang, r.source, r.part])
    return dict(out)


@pytest.mark.parametrize("least_docs, top", [(1, 3), (3, 50), (1_000, 50)])
def test_equals_dense_shares(spark, least_docs, top):
    g = np.random.default_rng(least_docs)
    vocabulary = ["Alpha", "alpha", "beta", "été", "ÉTÉ", "日本", "x", "Zed", "gamma9delta", "\U0001f600", "İ", "ﬁn"]
    docs = []
    for i in range(120):
        own = [vocabulary[int(x)] for x in np.minimum(g.geometric(0.25 + 0.02 * (i % 4), size=g.integers(0, 30)) - 1, 11)]
        docs.append((" ,".join(own) if i % 17 else None, [None, "", "de", "en", "en"][i % 5], [None, "a", "b", "c", "a"][i % 7 % 5], "t", 1))
    docs += docs[:20]
    docs += [("lonely " * 40, "fr", "one", "t", 1), ("", "it", "a", "t", 1), (None, "it", "b", "t", 1), ("beta " * 30_000, "en", "a", "t", 1)]
    assert audit(spark, docs, least_docs, top) == brute([d[:3] for d in docs], least_docs, top)


def test_large_counts_stay_exact(spark):
    count, total = 3_000_000_000_123, 9_000_000_000_001
    (row,) = spark.range(1).selectExpr(f"{count} AS c", f"{total} AS n", "7L AS v").select(divergence.share("c", "n", "v").alias("p")).collect()
    assert row.p == 1 + 1_000_000_000 * (count + 5) // (total + 35)


def test_empty_table(spark):
    assert audit(spark, [], 1) == {}
