"""Near duplicates by b-bit MinHash: bands of full minima find candidates, packed low bits thin them out, sets decide.

A document's set holds its distinct ``n``-word shingles. ``HASHES`` hash functions give it as many
minima. The minima of ``ROWS`` functions together are the key of a band, and sets that share a
band meet in its bucket. Of each minimum only the low ``BITS`` bits are kept, as ``BITS`` planes of
one bit for each function, packed to 80 bytes a document. Two signatures are compared by exclusive or,
or over the planes, and a bit count: functions whose low bits agree. Unequal minima agree in ``BITS`` bits by chance,
``2**-BITS`` of the time; corrected for these, the agreement estimates the similarity. Pairs go on
where the estimate is not below ``percent`` by more than its error: a pair at the limit is below
``least_matches`` once in 10^9. What goes on is joined to clusters, and inside clusters the full sets are compared.

At ``percent`` = 80 a band agrees with probability 0.8**4, so a pair at the very limit is in none of 40
buckets once in 1.4 * 10^9; a more similar pair less often. No bucket has a cap: equal sets are one
class, a bucket joins the ends of its pairs (at most m - 1 links of m members) instead of listing
them, buckets of the same members are compared once, and a bucket of more than ``TILE`` members is cut into
strips, as the trees of ``jaccard`` are; so is a cluster of more than ``SET_TILE``. Components are those of exact links.

* null or empty text, or one without words: empty set, linked with nothing;
* fewer words than ``n``: one shingle, the whole sequence;
* a null ``doc_id``: a null component, ``kept``; rows that share a ``doc_id`` are linked by it;
* repeated rows stay rows; very long texts are whole; exactly ``percent`` links; an empty table gives none;
* other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.graphs import contracted_components
from larkspur.llm.jaccard import Sets, group_links, sets_of, shared_routes, shingle_sets
from larkspur.llm.spark_util import arrow_rows, drop_table, give_back_memory, give_back_shuffles, stage_table
from larkspur.llm.text_arrays import _CODES, U, as_long, mix, sequence_hashes

#: Bands, functions in a band, low bits kept of a minimum.
BANDS, ROWS, BITS = 40, 4, 4
HASHES = BANDS * ROWS
#: How often a pair exactly at the limit may be estimated too low.
MISSED = 1e-9
#: Signatures of a strip (0.7 MB), whatever the size of their sets, and sets of one.
TILE, SET_TILE = 8_192, 4_096
#: Shingles whose minima are taken together.
TOGETHER = 1 << 16

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=U) * U(0x9E3779B97F4A7C15))
_FLIPS, _FACTORS = (_SEEDS[:HASHES] >> U(32)).astype(np.uint32), _SEEDS[HASHES:].astype(np.uint32) | np.uint32(1)


def least_matches(percent: int) -> int:
    """The functions that must agree in their low bits: a pair of ``percent`` similarity has fewer with probability ``MISSED`` at most."""
    chance = 0.5**BITS
    p = chance + (1 - chance) * percent / 100
    below, m = 0.0, 0
    while (below := below + comb(HASHES, m) * p**m * (1 - p) ** (HASHES - m)) <= MISSED:
        m += 1
    return m


def estimate(matches: np.ndarray) -> np.ndarray:
    """Similarity from matches of low bits, corrected for those by chance."""
    chance = 0.5**BITS
    return np.clip((matches / HASHES - chance) / (1 - chance), 0, 1)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, HASHES): the least value of each function on each set; no set is empty."""
    out = np.empty((len(sets), HASHES), np.uint32)
    size = np.array([len(x) for x in sets], np.int64)
    flat = (mix(np.concatenate(sets)) >> U(32)).astype(np.uint32)
    begin = np.cumsum(size) - size
    value = np.empty_like(flat)
    for k in range(HASHES):
        np.bitwise_xor(flat, _FLIPS[k], out=value)
        np.multiply(value, _FACTORS[k], out=value)
        out[:, k] = np.minimum.reduceat(value ^ (value >> np.uint32(15)), begin)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """(sets, BANDS): a hash of each band's minima, different for each band."""
    row = np.concatenate([np.arange(BANDS, dtype=U)[None, :].repeat(len(least), 0)[:, :, None], least.astype(U).reshape(len(least), BANDS, ROWS)], axis=2)
    flat = row.reshape(-1)
    starts = np.arange(len(least) * BANDS) * (ROWS + 1)
    return sequence_hashes(mix(flat), starts, starts + ROWS + 1).reshape(len(least), BANDS)


def pack_low_bits(least: np.ndarray) -> np.ndarray:
    """(sets, BITS, HASHES / 8) bytes: the planes of the low bits."""
    planes = (least[:, None, :] >> np.arange(BITS, dtype=np.uint32)[None, :, None]) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8), axis=2)


class Signatures:
    """The signatures of a tile."""

    def __init__(self, packed: list[bytes], sizes: np.ndarray, percent: int) -> None:
        planes = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), BITS, HASHES // 8)
        self.planes, self.sizes, self.percent, self.least = planes, sizes, percent, least_matches(percent)

    def near(self, q: int, rest: np.ndarray) -> np.ndarray:
        """Those of ``rest`` whose estimate allows similarity with ``q``."""
        size, percent = self.sizes[q], self.percent
        rest = rest[(self.sizes[rest] * percent <= size * 100) & (self.sizes[rest] * 100 >= size * percent)]
        unlike = np.bitwise_or.reduce(self.planes[rest] ^ self.planes[q], axis=1)
        return rest[HASHES - np.bitwise_count(unlike).sum(axis=1, dtype=np.int64) >= self.least]


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands, own): size and digest of the set, its band keys, its packed low bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "d1", "d2", "bands", "own"]

        def answer(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
            some = [i for i, x in enumerate(sets) if len(x)]
            keys, packed = [[]] * len(sets), [b""] * len(sets)
            if some:
                least = minima([sets[i] for i in some])
                for i, key, low in zip(some, as_long(band_keys(least)), pack_low_bits(least), strict=True):
                    keys[i], packed[i] = key, low.tobytes()
            digest = lambda code: pa.array([int(mix(x ^ _CODES[code]).sum(dtype=U).view(np.int64)) for x in sets], pa.int64())
            return pa.RecordBatch.from_arrays([ids, pa.array([len(x) for x in sets], pa.int64()), digest(1), digest(2), pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.binary())], names)

        for batch in batches:
            held, size, first = [], 0, 0
            for own in shingle_sets(batch.column(1), n):
                held.append(own)
                size += len(own)
                if size >= TOGETHER:
                    yield answer(batch.column(0)[first : first + len(held)], held)
                    held, size, first = [], 0, first + len(held)
            if held:
                yield answer(batch.column(0)[first:], held)
        give_back_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, own binary")


def bucket_members(points: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n) of buckets with two members at least; large ones are known beforehand, so that no task sorts them whole."""
    members = points.select(F.explode("bands").alias("tree"), "rep", "n")
    large = stage_table(members.groupBy("tree").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > TILE).select("tree"), "large-buckets")
    if large.isEmpty():
        return shared_routes(members, percent).toDF("key", "rep", "n")
    small = shared_routes(members.join(large, "tree", "left_anti"), percent)
    return small.union(members.join(large, "tree", "left_semi")).toDF("key", "rep", "n")


def near_duplicates(docs: DataFrame, n: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the least doc_id that a document reaches by links, itself included, and whether it is that one."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_rows(spark, 2000):
        signed = stage_table(signatures(docs, n), "minhash")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # one row for each set, with the signature of the document that stands for it; an id's several sets have a row each
    first = F.min_by(F.struct("bands", "own"), "doc_id").alias("p")
    points = stage_table(some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), first).select("d1", "d2", "n_shingles", "rep", F.col("n_shingles").alias("n"), "p.bands", "p.own"), "class-points")
    classes = points.select("d1", "d2", "n_shingles", "rep")
    members = stage_table(signed.select("doc_id", "n_shingles", "d1", "d2"), "set-digests")
    drop_table(signed)
    buckets = stage_table(bucket_members(points.select("rep", "n", "bands"), percent), "buckets")
    give_back_shuffles(spark)
    near = group_links(buckets, points.select("rep", "own"), Signatures, percent, TILE, 1 << 62)
    clusters = contracted_components(near).toDF("rep", "key")
    clusters = stage_table(clusters.join(points.select("rep", "n"), "rep").select("key", "rep", "n"), "clusters")
    for table in (buckets, near):
        drop_table(table)
    several = members.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("d1").alias("_lo"), F.max("d1").alias("_hi")).where("_lo < _hi").select("doc_id")
    own_id = members.join(several, "doc_id").join(classes, ["d1", "d2", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    with arrow_rows(spark, 500):
        sets = stage_table(sets_of(clusters.select("rep"), docs, n), "cluster-sets")
        links = group_links(clusters, sets, Sets, percent, SET_TILE)
    drop_table(sets)
    final = stage_table(contracted_components(links.union(own_id)).toDF("_rep", "_component"), "components")
    named = classes.join(final, classes["rep"] == final["_rep"], "left").select("d1", "d2", "n_shingles", F.coalesce("_component", "rep").alias("component_id"))
    found = members.join(named, ["d1", "d2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return found.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
