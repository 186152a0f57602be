"""Repeated-passage removal on a De Bruijn graph of token k-mers.

A window is ``window`` consecutive words. Each window is represented by its least-hash
k-mer (leftmost on ties), so two equal windows always pick the same k-mer at the same
place; picked k-mers are the graph's nodes and the text from one to the next is an edge.
One aggregation finds nodes that occur in two documents and whether all their occurrences
enter by one edge and leave by one edge. Joined back to their source coordinates, nodes
compact into nonbranching paths: text that every occurrence of a node has in common. A
window that lies inside the common text of its node occurs in exactly the node's documents,
so nothing about it has to be counted; only windows across a branch are hashed whole and
grouped.

No hash of hashes decides alone. Each document digests the words of each of its paths at
their source coordinates, and a path's digest must be the same in all its documents, the one
that keeps the passage among them; if any differs, the graph is built again with words coded by a
cryptographic digest. Windows across branches are compared by 64 bits of the graph's hash and 64
of a digest of their words.

* words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null or empty text has none;
* windows that repeat only inside one document, or among rows that share a ``doc_id``, stay;
* a null ``doc_id``: the row keeps all its words and is not counted;
* a very common passage is one node: partial aggregation and the engine's skew rule take care of it;
* texts shorter than a window are never cut; other columns pass through, whatever their
  names; a column of a name that is added (``names``) is replaced.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.spark_util import arrow_rows, drop_table, fresh_names, stage_table
from larkspur.llm.text_arrays import as_long, find_words, sequence_hashes, sliding_argmin, text_slices, word_hashes

KMER = 10
_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


def word_codes(data: np.ndarray, offsets: np.ndarray, strong: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit code of each word, its start and end, and each text's first word; ``strong`` codes are cryptographic digests."""
    if not strong:
        return word_hashes(data, offsets)
    starts, ends, first = find_words(data, offsets)
    raw = data.tobytes()
    digests = b"".join(hashlib.blake2b(raw[s:e], digest_size=8).digest() for s, e in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.frombuffer(digests, np.uint64), starts, ends, first


def digest(words: bytes) -> tuple[int, int]:
    """128 bits of words that are joined by one space, as two longs."""
    return struct.unpack("<2q", hashlib.blake2b(words, digest_size=16).digest())


def picked_kmers(words: np.ndarray, first: np.ndarray, window: int, kmer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each whole window, its k-mer's position, hashes of all k-mers) over the words of several texts."""
    n = len(words) - kmer + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    kmers = sequence_hashes(words, at, at + kmer)
    least = sliding_argmin(kmers, window - kmer + 1)
    owner = np.searchsorted(first, np.arange(len(least)), "right") - 1
    whole = np.flatnonzero(np.arange(len(least)) + window <= first[owner + 1])
    return whole, least[whole], kmers


def graph_nodes(docs: DataFrame, window: int, kmer: int, strong: bool = False) -> DataFrame:
    """(doc_id, tag, pos, node, into, out): each picked k-mer with the hashes of its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in text_slices(batch.column(2)):
                words, _, _, first = word_codes(data, offsets, strong)
                _, least, kmers = picked_kmers(words, first, window, kmer)
                if not len(least):
                    continue
                nodes = least[np.append(True, least[1:] != least[:-1])]
                owner = np.searchsorted(first, nodes, "right") - 1
                same = owner[1:] == owner[:-1]
                begin = np.append(first[owner[0]], np.where(same, nodes[:-1], first[owner[1:]]))
                into = sequence_hashes(words, begin, nodes + kmer)
                into[~np.append(False, same)] ^= _START
                end = np.append(np.where(same, nodes[1:] + kmer, first[owner[:-1] + 1]), first[owner[-1] + 1])
                out = sequence_hashes(words, nodes, end)
                out[~np.append(same, False)] ^= _END
                rows = pa.array(owner + low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array((nodes - first[owner]).astype(np.int32)), pa.array(as_long(kmers[nodes])), pa.array(as_long(into)), pa.array(as_long(out))],
                    ["doc_id", "tag", "pos", "node", "into", "out"],
                )

    return docs.mapInArrow(run, "doc_id long, tag long, pos int, node long, into long, out long")


def common_reach(pos: np.ndarray, one_in: np.ndarray, one_out: np.ndarray, kmer: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """How far left and right the text around each repeated node is the same in all its occurrences.

    If all occurrences enter by one edge, the node before is repeated too and stands before
    this one in the list; with none before, the edge comes from the start of the text.
    """
    n = len(pos)
    left, right = pos.copy(), pos + kmer
    for i in range(n):
        if one_in[i]:
            left[i] = left[i - 1] if i else 0
    for i in range(n - 1, -1, -1):
        if one_out[i]:
            right[i] = right[i + 1] if i + 1 < n else n_words
    return left, right


def as_runs(marks: np.ndarray) -> list[int]:
    """Flat [start, end, start, end, ...] of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edges.tolist()


def path_heads(one_in: np.ndarray, one_out: np.ndarray) -> np.ndarray:
    """First nodes of the nonbranching paths: runs of nodes of which each leads to the next only, and the next comes from it only."""
    return np.flatnonzero(np.append(True, ~(one_out[:-1] & one_in[1:])))


JUDGED = "doc_id long, tag long, gone array<int>, pos array<int>, hash array<long>, words_hash array<long>, paths array<struct<path: long, least: long, d1: long, d2: long>>"


def judge_windows(docs: DataFrame, found: DataFrame, window: int, kmer: int, strong: bool = False) -> DataFrame:
    """(doc_id, tag, gone, pos, hash, words_hash, paths): runs of windows that are known to repeat earlier, the windows across
    branches, and each path with its least document and the digest of the words that its windows cover."""
    nodes = found.toDF("_d", "_t", "nodes")
    joined = docs.join(nodes, (F.col("doc_id") == F.col("_d")) & (F.col("tag") == F.col("_t"))).select("doc_id", "tag", "text", F.col("nodes.pos").alias("at"), F.col("nodes.least_doc").alias("least"), F.col("nodes.one_in").alias("one_in"), F.col("nodes.one_out").alias("one_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tag", "gone", "pos", "hash", "words_hash", "paths"]
        path = pa.struct([("path", pa.int64()), ("least", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])
        types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(path)]
        for batch in batches:
            ids, tags = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for low, high, data, offsets in text_slices(batch.column(2)):
                words, begins, ends, first = word_codes(data, offsets, strong)
                starts, least, kmers = picked_kmers(words, first, window, kmer)
                edge = np.searchsorted(starts, first)
                raw = data.tobytes()
                out: list[list] = [[] for _ in names]
                for i in range(high - low):
                    row, a, b = low + i, edge[i], edge[i + 1]
                    f, n = int(first[i]), int(first[i + 1] - first[i])
                    pos, doc, one_in, one_out = (np.array(batch.column(c)[row].as_py()) for c in range(3, 7))
                    left, right = common_reach(pos, one_in, one_out, kmer, n)
                    s, node = starts[a:b] - f, least[a:b] - f
                    k = np.minimum(np.searchsorted(pos, node), len(pos) - 1)
                    repeated = pos[k] == node
                    inside = repeated & (left[k] <= s) & (s + window <= right[k])
                    # a node's least document bounds that of its windows from below
                    open_ = s[repeated & ~inside]
                    joined_words = b" ".join([raw[x:y] for x, y in zip(begins[f : f + n].tolist(), ends[f : f + n].tolist(), strict=True)])
                    at = np.append(0, np.cumsum(ends[f : f + n] - begins[f : f + n] + 1)).tolist()
                    out[0].append(ids[row])
                    out[1].append(tags[row])
                    out[2].append(as_runs(inside & (doc[k] < ids[row])))
                    out[3].append(open_)
                    own = words[f : f + n]
                    out[4].append(as_long(sequence_hashes(own, open_, open_ + window)) if len(open_) else open_)
                    out[5].append([digest(joined_words[at[x] : at[x + window] - 1])[0] for x in open_.tolist()])
                    heads = path_heads(one_in, one_out)
                    lows = np.maximum(left[heads], pos[heads] - (window - kmer))
                    highs = np.minimum(right[heads], pos[np.append(heads[1:], len(pos)) - 1] + window)
                    long_ = highs - lows >= window
                    out[6].append(
                        [
                            dict(zip(("path", "least", "d1", "d2"), (x, y, *digest(joined_words[at[lo] : at[hi] - 1])), strict=True))
                            for x, y, lo, hi in zip(as_long(kmers[f + pos[heads[long_]]]).tolist(), doc[heads[long_]].tolist(), lows[long_].tolist(), highs[long_].tolist(), strict=True)
                        ]
                    )
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names)

    return joined.mapInArrow(run, JUDGED)


def differing_paths(judged: DataFrame) -> DataFrame:
    """Paths whose words are not the same in all their documents, or whose least document does not hold them."""
    paths = judged.select("doc_id", F.explode("paths").alias("p")).select("doc_id", "p.*")
    one = paths.groupBy("path").agg(F.min("doc_id").alias("first"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("least", "d1", "d2") for f in (F.min, F.max)])
    return one.where("first <> min_least OR min_least <> max_least OR min_d1 <> max_d1 OR min_d2 <> max_d2")


def judge(keyed: DataFrame, window: int, kmer: int, strong: bool = False) -> DataFrame:
    """``judge_windows`` of (doc_id, tag, text), from the graph of all texts, as a staged table."""
    with arrow_rows(keyed.sparkSession, 2000):
        nodes = stage_table(graph_nodes(keyed, window, kmer, strong), "repeat-nodes")
        degrees = nodes.groupBy("node").agg(F.min("doc_id").alias("least_doc"), F.max("doc_id").alias("_last"), (F.min("into") == F.max("into")).alias("one_in"), (F.min("out") == F.max("out")).alias("one_out"))
        repeated = stage_table(degrees.where("least_doc < _last").drop("_last"), "repeat-paths")
        placed = nodes.select("doc_id", "tag", "pos", "node").join(repeated, "node").dropDuplicates(["doc_id", "tag", "pos"])
        found = placed.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list(F.struct("pos", "least_doc", "one_in", "one_out"))).alias("nodes"))
        judged = stage_table(judge_windows(keyed, found, window, kmer, strong), "repeat-judged")
    drop_table(nodes)
    return judged


def remove_repeats(docs: DataFrame, window: int = 50, kmer: int = KMER, names: tuple[str, str, str] = ("n_words", "n_removed", "kept_sha256")) -> DataFrame:
    """``docs`` with the kept words, joined by one space, as ``text``, and three more columns called ``names``."""
    docs = docs.drop(*names)
    own, d, t, g, a = fresh_names(docs.columns, "_own_tag", "_doc", "_tag", "_gone", "_across")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    judged = judge(keyed, window, kmer)
    if not differing_paths(judged).isEmpty():
        drop_table(judged)
        judged = judge(keyed, window, kmer, strong=True)
        if not differing_paths(judged).isEmpty():
            raise RuntimeError("different passages share their hashes and those of digests: use a shorter window")
    across = judged.select("doc_id", "tag", F.explode(F.arrays_zip("pos", "hash", "words_hash")).alias("w")).select("doc_id", "tag", "w.pos", "w.hash", "w.words_hash")
    least = across.groupBy("hash", "words_hash").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_last")).where("_least < _last").drop("_last")
    later = across.join(stage_table(least, "repeat-across"), ["hash", "words_hash"]).where("doc_id > _least").groupBy("doc_id", "tag").agg(F.collect_set("pos").alias("across"))
    runs = judged.where(F.size("gone") > 0).select("doc_id", "tag", "gone").distinct()
    cuts = stage_table(runs.join(later, ["doc_id", "tag"], "full").toDF(d, t, g, a), "repeat-cuts")
    drop_table(judged)
    both = docs.withColumn(own, F.xxhash64(text)).join(cuts, (F.col("doc_id") == F.col(d)) & (F.col(own) == F.col(t)), "left")
    kept_names = docs.columns
    at = kept_names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()), T.StructField(names[2], T.StringType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(kept_names))]
            gone, across = batch.column(len(kept_names)), batch.column(len(kept_names) + 1)
            texts, n_words, n_removed, digests = [], [], [], []
            for low, high, data, offsets in text_slices(columns[at]):
                starts, ends, first = find_words(data, offsets)
                raw = data.tobytes()
                for i in range(high - low):
                    a, b = int(first[i]), int(first[i + 1])
                    covered = np.zeros(b - a + 1, np.int64)
                    runs = gone[low + i].as_py() or ()
                    for s, e in zip(runs[::2], runs[1::2], strict=True):
                        covered[s] += 1
                        covered[e - 1 + window] -= 1
                    single = across[low + i].as_py()
                    if single:
                        single = np.array(single)
                        np.add.at(covered, single, 1)
                        np.add.at(covered, single + window, -1)
                    keep = np.flatnonzero(np.cumsum(covered)[:-1] == 0) + a
                    kept = b" ".join([raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)])
                    texts.append(kept.decode())
                    n_words.append(b - a)
                    n_removed.append(b - a - len(keep))
                    digests.append(hashlib.sha256(kept).hexdigest())
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())], [*kept_names, *names])

    return both.select(*[F.col(f"`{c}`") for c in kept_names], g, a).mapInArrow(cut, schema)
