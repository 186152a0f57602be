"""T4, METEOR with its exact and stem stages only, and named so: synonyms and paraphrases need data that isn't here.

Words match if they are equal or their stems are. Of all alignments with the most matches, the one with the fewest chunks (runs that
are adjacent in both texts) counts. Stems are ordered rewrites of endings on the JVM; the alignment of one pair is a search over the
hypothesis' words that keeps the ``BEAM`` best states, exact for short texts. Scores are the published ones: recall weighs nine times as
much as precision, and half the cube of chunks over matches is taken off. Without a match, or a text, the score is 0.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.functions.text import words

#: States that a search keeps.
BEAM = 256
#: Endings and what they become, in this order.
REWRITES = [(r"sses$", "ss"), (r"ies$", "y"), (r"([^s])s$", "$1"), (r"([a-z]{3,})(?:ing|ed)$", "$1"), (r"([a-z]{3,})ly$", "$1"), (r"([bdfgmnprt])\1$", "$1"), (r"([a-z]{3,})e$", "$1")]


def stem(word: Column) -> Column:
    out = F.lower(word)
    for ending, new in REWRITES:
        out = F.regexp_replace(out, ending, new)
    return out


def alignment(hyp: list[str], ref: list[str], beam: int = BEAM) -> tuple[int, int]:
    """(matches, chunks) of the best alignment of equal items."""
    have, own = Counter(ref), Counter(hyp)
    wide = (len(ref) + 1).bit_length()
    shift = wide + len(ref)  # bits of a state
    places: dict[str, list[tuple[int, int, int]]] = {}
    mask = dict.fromkeys(have, 0)
    for j, w in enumerate(ref):
        places.setdefault(w, []).append((1 << j, j + 1, 1 << j << wide | j + 2))
        mask[w] |= 1 << j
    low = (1 << wide) - 1
    # a state has the taken places above ``wide`` bits, and below the place of the word before and 2, or 0; it has chunks
    states, seen, apart = {0: 0}, Counter(), True
    for w in hyp:
        after: dict[int, int] = {}
        if w not in places:
            if not apart:  # else no word before has a place, and nothing changes
                for state, chunks in states.items():
                    state &= ~low
                    if chunks < after.get(state, 1 << 30):
                        after[state] = chunks
                states, apart = after, True
            continue
        apart, mine, held = False, places[w], mask[w]
        skips = seen[w] - max(own[w] - have[w], 0)  # so many of it must have a place for one more to stay without
        for state, chunks in states.items():
            taken, last = state >> wide, state & low
            rest = state ^ last
            for bit, before, to in mine:
                if not taken & bit:
                    n = chunks if last == before else chunks + 1
                    to |= rest
                    if n < after.get(to, 1 << 30):
                        after[to] = n
            if skips < (taken & held).bit_count() and chunks < after.get(rest, 1 << 30):
                after[rest] = chunks
        seen[w] += 1
        if len(after) > beam:
            cut = sorted([n << shift | state for state, n in after.items()])[:beam]
            after = {x & (1 << shift) - 1: x >> shift for x in cut}
        states = after
    taken, chunks = min((((s >> wide).bit_count(), n) for s, n in states.items()), key=lambda x: (-x[0], x[1]))
    return taken, chunks


@F.pandas_udf(T.StructType([T.StructField("matches", T.LongType()), T.StructField("chunks", T.LongType())]))
def aligned(hyp: pd.Series, ref: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([alignment(list(h), list(r)) for h, r in zip(hyp, ref, strict=True)], columns=["matches", "chunks"])


def meteor_exact_stem(pairs: DataFrame) -> DataFrame:
    """(key, matches, chunks, meteor) of (key, ref, hyp)."""
    stems = lambda c: F.transform(words(F.coalesce(F.col(c), F.lit(""))), stem)
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.select("key", "hyp", "ref").repartition(parts, F.xxhash64("key", "hyp"))  # few bytes, but a search for each: a given number is not coalesced
    rows = dealt.select("key", stems("hyp").alias("h"), stems("ref").alias("r"))
    met = rows.select("key", F.size("h").alias("h"), F.size("r").alias("r"), aligned("h", "r").alias("a")).select("key", "h", "r", "a.matches", "a.chunks")
    m = F.col("matches")
    p, r = m / F.col("h"), m / F.col("r")
    score = 10 * p * r / (r + 9 * p) * (1 - 0.5 * F.pow(F.col("chunks") / m, F.lit(3.0)))
    return met.select("key", "matches", "chunks", F.when(m > 0, score).otherwise(0.0).alias("meteor"))
