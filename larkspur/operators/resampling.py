"""Bootstrap draws, order statistics, splits and batches, all from portable md5 draws so that reruns agree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.operators.ranks import global_rank

#: Fixed values of MD5.
SINES = np.array([int(abs(math.sin(k + 1)) * 2**32) for k in range(64)], np.uint32)
TURNS = np.array([7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4, np.uint32)


def draw(*parts: Column | str) -> Column:
    """An integer below 2**32 from the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("_", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def md5_heads(prefix: bytes, numbers: np.ndarray) -> np.ndarray:
    """``draw`` of a short prefix and the decimal digits of each number, for all at once: MD5 of messages of one block."""
    n, start, length = len(numbers), len(prefix), np.ones(len(numbers), np.int64)
    for power in range(1, len(str(int(numbers.max(initial=0))))):
        length += numbers >= 10**power
    block, each, rest = np.zeros((n, 64), np.uint8), np.arange(n), numbers.astype(np.int64)
    block[:, :start] = np.frombuffer(prefix, np.uint8)
    for d in range(int(length.max(initial=0))):
        has = length > d
        block[each[has], start + length[has] - 1 - d] = 48 + rest[has] % 10
        rest = rest // 10
    block[each, start + length] = 128
    words = np.ascontiguousarray(block.view("<u4").T).astype(np.uint32)
    words[14] = (start + length) * 8
    first = np.uint32(0x67452301)
    a, b, c, d = (np.full(n, x, np.uint32) for x in (first, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    for k in range(64):
        if k < 16:
            mixed, at = d ^ (b & (c ^ d)), k
        elif k < 32:
            mixed, at = c ^ (d & (b ^ c)), 5 * k + 1
        elif k < 48:
            mixed, at = b ^ c ^ d, 3 * k + 5
        else:
            mixed, at = c ^ (b | ~d), 7 * k
        mixed = mixed + a + SINES[k] + words[at % 16]
        a, d, c, b = d, c, b, b + ((mixed << TURNS[k]) | (mixed >> (np.uint32(32) - TURNS[k])))
    return (a + first).byteswap().astype(np.int64)


def numbered(df: DataFrame, order: str, out: str = "pos") -> DataFrame:
    """0-based positions by ``order``."""
    return global_rank(df, F.col(order), out)


def drawn_positions(spark: SparkSession, n: int, rounds: int) -> DataFrame:
    """(round, i, pos): ``n`` positions below ``n`` for each round, made where they are used."""
    whole, n = n > 0, max(n, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            b, i = at // n, at % n
            cuts = np.flatnonzero(np.diff(b)) + 1
            heads = [md5_heads(b"%d_" % x[0], y) for x, y in zip(np.split(b, cuts), np.split(i, cuts), strict=True) if len(x)]
            pos = np.concatenate([np.zeros(0, np.int64), *heads]) % n
            yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(i), pa.array(pos)], ["round", "i", "pos"])

    return spark.range(rounds * n if whole else 0).mapInArrow(run, "round long, i long, pos long")


def bootstrap_rows(spark: SparkSession, rows: DataFrame, n: int, rounds: int) -> DataFrame:
    """``rows`` (with ``pos``) drawn ``n`` times with replacement in each of ``rounds`` rounds; the seed is the round."""
    return drawn_positions(spark, n, rounds).join(rows, "pos")


def bootstrap_metrics(spark: SparkSession, rows: DataFrame, n: int, rounds: int) -> DataFrame:
    """W3 with the metrics of each label and round: (label, round, auroc, f1, accuracy, precision). ``rows``: (pos, label, y,
    score, yhat) with the same positions 0 to ``n - 1`` for each label. Draws move once, to the rows, and are counted there for all
    labels together; what is ordered are the distinct scores of a round; a round without both classes has no AUROC."""
    drawn = drawn_positions(spark, n, rounds).select("round", "pos")
    each = rows.groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("label", "score", "yhat", "y"))).alias("of"))  # a row for each label
    kinds = each.groupBy("of").agg(F.min("pos").alias("kind"))  # equal rows are one kind, named by the least position
    known = each.join(kinds, "of").select("pos", "kind")
    counts = drawn.join(known.hint("shuffle_hash"), "pos").groupBy("round", "kind").agg(F.count(F.lit(1)).alias("w"))
    met = counts.join(kinds, "kind").select("round", "w", F.explode("of").alias("x"))
    met = met.select("round", "w", "x.label", "x.score", "x.yhat", "x.y")
    cells = met.groupBy("label", "round", "score", "yhat").agg(F.sum(F.col("w") * F.col("y")).alias("p"), F.sum(F.col("w") * (1 - F.col("y"))).alias("q"))
    below = Window.partitionBy("label", "round").orderBy("score").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("lower", F.sum("q").over(below))
    same = Window.partitionBy("label", "round", "score")
    won = F.col("p") * (F.col("lower") - F.sum("q").over(same) / 2)  # pairs won, ties by half
    sums = cells.withColumn("won", won).groupBy("label", "round").agg(
        F.sum("p").alias("P"), F.sum("q").alias("N"), F.sum("won").alias("won"),
        F.sum(F.when(F.col("yhat") == 1, F.col("p")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("yhat") == 1, F.col("q")).otherwise(0)).alias("fp"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("P") - F.col("tp")
    zero = F.lit(0.0)
    return sums.select(
        "label", "round", (F.col("won") / F.nullif(F.col("P") * F.col("N"), F.lit(0))).alias("auroc"),
        F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), zero).alias("f1"),
        ((tp + F.col("N") - fp) / (F.col("P") + F.col("N"))).alias("accuracy"), F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), zero).alias("precision"),
    )


def poisson_weights(df: DataFrame, key: str, rounds: int) -> DataFrame:
    """W3 for tables of any size: each row's number of draws in each round is a Poisson(1) value of its key, so rows
    need no positions and nothing is joined."""
    u = draw(F.col("round").cast("string"), F.col(key)) / F.lit(2.0**32)
    bounds = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183, 0.9999167588507119, 0.9999897508033253]
    weight = sum((u >= b).cast("long") for b in bounds)
    return df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn("weight", weight).where("weight > 0")


def interval(df: DataFrame, value: str, by: str, level: float = 0.05) -> DataFrame:
    """Mean, lower and upper order statistics, rounded to 4; the lower index is kept at 0 at least."""
    ordered = df.groupBy(by).agg(F.array_sort(F.collect_list(value)).alias("a"), F.avg(value).alias("m"))
    n = F.size("a")
    lower, upper = F.greatest(F.floor(F.lit(level / 2) * n).cast("int") - 1, F.lit(0)), F.greatest(F.floor(F.lit(1 - level / 2) * n).cast("int") - 1, F.lit(0))
    return ordered.select(by, F.round("m", 4).alias("mean"), F.round(F.get("a", lower), 4).alias("lower"), F.round(F.get("a", upper), 4).alias("upper"))


def hash_split(df: DataFrame, key: str, share: float) -> DataFrame:
    """An exact share of the rows by md5 order."""
    ranked = global_rank(df, F.md5(F.col(key).cast("string").cast("binary")), "_r", (F.col(key),))
    return ranked.withColumn("split", F.when(F.col("_r") < int(df.count() * share), "train").otherwise("valid")).drop("_r")


def first_share(df: DataFrame, order: str, share: float) -> DataFrame:
    """The first share of the rows."""
    return global_rank(df, F.col(order), "_r").where(F.col("_r") < int(df.count() * share)).drop("_r")


def worker_chunks(df: DataFrame, order: str, workers: int) -> DataFrame:
    """Contiguous chunks, sizes at most one apart."""
    size, larger = divmod(df.count(), workers)
    edge = larger * (size + 1)  # the first chunks have one row more
    worker = F.when(F.col("_r") < edge, F.floor(F.col("_r") / (size + 1))).otherwise(larger + F.floor((F.col("_r") - edge) / max(size, 1)))
    return global_rank(df, F.col(order), "_r").withColumn("worker", worker.cast("long")).drop("_r")


def size_batches(df: DataFrame, group: str, order: str, batch: int, seed: int | None = None) -> DataFrame:
    """Batches of rows of equal ``group``; the last batch of a group repeats its first rows up to ``batch``. With a ``seed``, rows
    are shuffled first, by the md5 of the seed and ``order``."""
    if seed is None:
        ranked = global_rank(df, F.col(order), "_r", by=(group,))
    else:
        mixed = F.md5(F.concat(F.lit(f"{seed}_"), F.col(order).cast("string")).cast("binary"))
        ranked = global_rank(df, mixed, "_r", (F.col(order),), by=(group,))
    rows = ranked.withColumn("batch", F.floor(F.col("_r") / batch).cast("long")).withColumn("slot", (F.col("_r") % batch).cast("long")).drop("_r")
    size = F.count(F.lit(1)).over(Window.partitionBy(group, "batch"))
    copies = F.floor((F.lit(batch) - 1 - F.col("slot")) / F.col("_n")).cast("int")
    return rows.withColumn("_n", size).withColumn("_c", F.explode(F.sequence(F.lit(0), copies))).withColumn("slot", F.col("slot") + F.col("_c") * F.col("_n")).drop("_n", "_c")


def length_groups(df: DataFrame, key: str, length: str, mega: int, workers: int) -> DataFrame:
    """Seeded megabatches, sorted by length inside, dealt over workers so that each gets the same number and
    lengths balance; positive and negative lengths (modalities) never mix."""
    kind = F.when(F.col(length) > 0, 1).otherwise(-1)
    rows = global_rank(df.withColumn("modality", kind), F.md5(F.col(key).cast("string").cast("binary")), "_r", (F.col(key),), by=("modality",))
    rows = rows.withColumn("megabatch", F.floor(F.col("_r") / mega).cast("long"))

    def deal(pdf):
        pdf = pdf.assign(_l=pdf[length].abs()).sort_values(["_l", key], ascending=[False, True])
        per = -(-len(pdf) // workers)
        load, count, out = [0] * workers, [0] * workers, []
        for value in pdf["_l"]:
            open_ = [w for w in range(workers) if count[w] < per]
            w = min(open_, key=lambda i: (load[i], i))
            load[w] += int(value)
            count[w] += 1
            out.append(w)
        return pdf.assign(worker=out)[[key, "modality", "megabatch", "worker"]]

    return rows.groupBy("modality", "megabatch").applyInPandas(deal, f"{key} {df.schema[key].dataType.simpleString()}, modality int, megabatch long, worker long")


def centre_slices(arr: Column, ratio: float, step: int) -> Column:
    """Items from the middle ``ratio`` of an array, every ``step``-th."""
    n = F.size(arr)
    start, end = F.floor((1 - ratio) / 2 * n), F.floor((1 + ratio) / 2 * n)
    return F.filter(arr, lambda x, i: (i >= start) & (i < end) & ((i - start) % step == 0))
