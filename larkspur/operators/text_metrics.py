"""N-gram text metrics over (key, ref, hyp). Tokens are white-space separated.

The formulas are the published ones (corpus BLEU with the reference length of its own pair,
ROUGE-L with beta 1.2, CIDEr-D with sigma 6); equality with any library is not claimed.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from larkspur.functions.text import words


def ngrams(tokens: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))


def ngram_counts(df: DataFrame, top: int = 4) -> DataFrame:
    """(key, n, gram, h, r): how often each n-gram of a key is in its hypotheses and references. Texts move to their key's task
    once and grams are made and counted there; a given number of partitions is not coalesced to the few that short texts fill."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = df.select("key", "hyp", "ref").repartition(parts, "key").select("key", words(F.col("hyp")).alias("h"), words(F.col("ref")).alias("r"))
    each = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(side == "h").cast("long").alias("h"), F.when(F.size(side) >= n, ngrams(F.col(side), n)).alias("g")) for n in range(1, top + 1) for side in "hr"])
    rows = t.select("key", F.explode(each).alias("x")).select("key", "x.n", "x.h", F.explode("x.g").alias("gram"))
    return rows.groupBy("key", "n", "gram").agg(F.sum("h").alias("h"), F.sum(1 - F.col("h")).alias("r"))


def bleu(df: DataFrame) -> DataFrame:
    """Corpus BLEU-1 to 4 and their mean."""
    clipped = ngram_counts(df).where("h > 0").groupBy("n").agg(F.sum(F.least("h", "r")).alias("hit"), F.sum("h").alias("all"))
    sums = clipped.agg(*[F.coalesce(F.max(F.when(F.col("n") == n, F.col("hit") / F.col("all"))), F.lit(0.0)).alias(f"p{n}") for n in range(1, 5)])
    size = df.agg(F.sum(F.size(words(F.col("hyp")))).alias("h"), F.sum(F.size(words(F.col("ref")))).alias("r"))
    one = sums.crossJoin(size)  # one row each
    penalty = F.when((F.col("h") >= F.col("r")) | (F.col("h") == 0), 1.0).otherwise(F.exp(1 - F.col("r") / F.col("h")))
    product = F.lit(1.0)
    out = []
    for n in range(1, 5):
        product = product * F.col(f"p{n}")
        out.append((penalty * F.pow(product, F.lit(1.0 / n))).alias(f"bleu_{n}"))
    scored = one.select(*out)
    return scored.withColumn("bleu_mean", (F.col("bleu_1") + F.col("bleu_2") + F.col("bleu_3") + F.col("bleu_4")) / 4)


@F.pandas_udf(DoubleType())
def rouge_l(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """F-measure of the longest common subsequence with beta 1.2, in bit-parallel form: one integer per row holds
    the state of a whole reference."""
    beta2 = 1.2**2
    out = []
    for r, h in zip(ref, hyp, strict=True):
        a, b = (r or "").split(), (h or "").split()
        if not a or not b:
            out.append(0.0)
            continue
        masks: dict[str, int] = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        full = (1 << len(a)) - 1
        v = full
        for w in b:
            m = v & masks.get(w, 0)
            v = ((v + m) | (v - m)) & full
        lcs = len(a) - v.bit_count()
        p, q = lcs / len(b), lcs / len(a)
        out.append((1 + beta2) * p * q / (q + beta2 * p) if lcs else 0.0)
    return pd.Series(out)


def cider(df: DataFrame, sigma: float = 6.0) -> DataFrame:
    """(key, cider). Document frequencies come from the references; the product of clipped weights is damped by
    the difference in bigram counts. A gram of a key meets its frequency once, with both its counts, and only sums go back."""
    grams = ngram_counts(df)
    docs = df.agg(F.log(F.count(F.lit(1)).cast("double")).alias("logn"))
    freq = grams.where("r > 0").groupBy("n", "gram").agg(F.count(F.lit(1)).alias("d")).where("d > 1")  # any other weighs as one of a single document
    met = grams.join(freq, ["n", "gram"], "left").crossJoin(F.broadcast(docs))  # docs is one row
    weight = F.col("logn") - F.log(F.coalesce("d", F.lit(1)).cast("double"))
    met = met.select("key", "n", (F.col("h") * weight).alias("h"), (F.col("r") * weight).alias("r"))
    per = met.groupBy("key", "n").agg(F.sum(F.least("h", "r") * F.col("r")).alias("v"), F.sqrt(F.sum(F.col("h") * F.col("h"))).alias("h"), F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("r"))
    per = per.groupBy("key").agg(F.sum(F.coalesce(F.col("v") / F.nullif(F.col("h") * F.col("r"), F.lit(0.0)), F.lit(0.0))).alias("s"))
    bigrams = lambda text: F.greatest(F.size(words(F.col(text))) - 1, F.lit(0))
    per = df.groupBy("key").agg(F.sum(bigrams("hyp") - bigrams("ref")).alias("delta")).join(per, "key", "left")
    damp = F.exp(-F.pow(F.col("delta").cast("double"), F.lit(2.0)) / (2 * sigma * sigma))
    return df.select("key").join(per, "key", "left").select("key", F.coalesce(F.col("s") / 4 * damp * 10, F.lit(0.0)).alias("cider"))
