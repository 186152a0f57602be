import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return: they must not clash.
CLASHES = ["tag", "rep", "rank", "drop", "tree", "copies", "size", "slot", "n_lines", "n_words", "tox_score", "__drop", "__tag", "_h", "p", "last"]


def make_docs(seed=7, n=160):
    """Texts with exact and near copies, shared passages and lines, one hot source, nulls, empties and odd spaces."""
    r = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "tu") for b in ("ra", "se", "no") for c in ("n", "st", "é", "")]
    words = lambda k: [r.choice(vocab) for _ in range(k)]
    passage, line = " ".join(words(70)), "A Line That Many Documents Share"
    out = []
    for i in range(n):
        kind = i % 8
        w = words(r.randint(1, 150))
        if kind == 1 and out:
            t = r.choice(out)[1]
        elif kind == 2 and out:
            old = (r.choice(out)[1] or "x").split(" ")
            for _ in range(max(1, len(old) // 60)):
                old[r.randrange(len(old))] = r.choice(vocab)
            t = " ".join(old)
        elif kind == 3:
            t = " ".join(w[:40]) + " " + passage + "\n" + " ".join(w[40:])
        elif kind == 4:
            t = " ".join(w) + f"\n  {line}\t\n" + " ".join(w[:3])
        else:
            t = " ".join(w)
        out.append((i * 3, t, r.choice(["en", "de", None]), "hot" if i % 3 else r.choice(["a", "b", None]), len(t)))
    out += [(5000, None, "en", "a", None), (5001, "", None, None, 0), (5002, " \n\t ", "en", "b", 4), (5003, "one two", "en", "hot", 7), (5004, "one  two", "en", "hot", 8), (5005, "ONE two", "en", "hot", 7)]
    out += [(6000, " ".join(words(4000)), "en", "hot", 1)]
    return out


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark, docs):
    """Extra columns with clashing names, repeated rows, and a row without id."""
    from pyspark.sql import functions as F

    odd = docs.union(docs.limit(5)).union(spark.createDataFrame([(None, "no id here at all", "en", "a", 1)], SCHEMA))
    for c in CLASHES:
        odd = odd.withColumn(c, F.lit("x"))
    return odd
