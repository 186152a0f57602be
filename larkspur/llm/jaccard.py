"""Near duplicates by n-gram Jaccard similarity on a count-vector R-tree.

A document's set holds its distinct ``n``-word shingles (64-bit hashes). Shingles hash into
groups, about one for two members of the set, and a set becomes the point of its group
counts; a point with twice as many groups folds onto one with fewer. Two sets share at most
``sum(min(a_g, b_g))`` shingles, and a set and any set under a tree node at most
``sum(min(a_g, hi_g))`` of the node's box, so the tree leaves out boxes and pairs whose
bound is below what similarity needs; pairs that survive are verified on the sets.

The tree is dealt over the cluster so that no point meets all others: sets with similarity
``t`` share one of the ``n - ceil(t n) + 1`` first shingles of each in any one order, so a
point goes to the tree of each of those. The order puts shingles that many documents hold
last, which keeps boilerplate from making large trees. Points of a tree that no other point
of it is near in size leave it.

Groups of copies cost no pairs. Equal sets are one class. A tree does not list the pairs that
its bounds leave but joins their ends: of ``m`` points it gives at most ``m - 1`` links, and
points that are joined already are not compared again. What is joined over all trees is a
cluster; no similar pair lies across two clusters. Inside a cluster the sets themselves are
compared, again joining ends only, so components are exact.

A large tree or cluster is cut into strips of bounded size. Each strip is first joined on its
own and with a few pivots of its group, which all strips receive; then the points outside the
group's largest component meet each strip, and each other.

* null or empty text, or one without words: empty set, linked with nothing;
* a null ``doc_id``: kept with a null component; rows that share a ``doc_id`` are linked by it;
* very long texts are whole; equal similarity (exactly the threshold) links.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.graphs import connected_components, contracted_components  # noqa: F401  the first for callers from here
from larkspur.llm.spark_util import arrow_rows, drop_table, give_back_memory, stage_table
from larkspur.llm.text_arrays import _CODES, U, as_long, mix, sequence_hashes, text_slices, word_hashes

#: Fewest and most groups of a point.
GROUPS, MOST_GROUPS = 64, 4_096
#: Shingles held by the most documents that the order knows; bounds what the driver gathers (1 MB).
FREQUENT = 65_536
#: Points of a strip, and shingles of its sets (8 MB).
TILE, TILE_SHINGLES = 1_024, 1_000_000
#: Pivots of a group of several strips, about.
PIVOTS = 8
SAME = 256
MOST_BITS = 1 << 25
_NODE = 16


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for low, high, data, offsets in text_slices(column):
        words, _, _, first = word_hashes(data, offsets, lower=True)
        starts = np.arange(max(len(words) - n + 1, 0))
        runs = sequence_hashes(words, starts, starts + n) if len(starts) else np.zeros(0, U)
        for i in range(high - low):
            a, b = int(first[i]), int(first[i + 1])
            if a == b:
                yield np.zeros(0, U)
            elif b - a < n:
                yield sequence_hashes(words, np.array([a]), np.array([b]))
            else:
                yield np.unique(runs[a : b - n + 1])


def needed(total: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least intersection of two sets with ``total`` members together: 100 i >= percent (total - i)."""
    return -(-percent * total // (100 + percent))


def groups_for(n: int) -> int:
    """Groups of a set of ``n``: the power of two from ``n / 2`` up, within bounds."""
    return min(MOST_GROUPS, max(GROUPS, (1 << (max(n, 1) - 1).bit_length()) >> 1))


def group_counts(hashes: np.ndarray) -> np.ndarray:
    g = groups_for(len(hashes))
    return np.bincount((hashes >> U(40)).astype(np.int64) & (g - 1), minlength=g).astype(np.uint16)


def pack_counts(counts: np.ndarray) -> bytes:
    """Entropy-coded; the first byte tells the width of a count."""
    width = 1 if counts.max(initial=0) < 256 else 2
    coder = zlib.compressobj(6, zlib.DEFLATED, -15, 9, zlib.Z_HUFFMAN_ONLY)
    return bytes([width]) + coder.compress(counts.astype(f"<u{width}").tobytes()) + coder.flush()


def unpack_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed[1:], -15), f"<u{packed[0]}").astype(np.uint16)


def fold(counts: np.ndarray, groups: int) -> np.ndarray:
    """The counts over fewer groups; works on the last axis."""
    while counts.shape[-1] > groups:
        half = counts.shape[-1] // 2
        counts = counts[..., :half] + counts[..., half:]
    return counts


class CountVectorTree:
    """An R-tree over count vectors, packed by set size and the count of half the groups, with boxes of ``_NODE`` children."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        half = vectors[:, : vectors.shape[1] // 2].sum(axis=1)
        self.order = np.lexsort((half, sizes))
        self.points, self.sizes = vectors[self.order], sizes[self.order]
        self.levels = []
        hi, small, large = self.points, self.sizes, self.sizes
        while len(hi) > _NODE:
            cut = np.arange(0, len(hi), _NODE)
            hi, small, large = np.maximum.reduceat(hi, cut), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)
            self.levels.append((hi, small, large))

    def search(self, vector: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Positions of the points that may reach ``percent`` similarity with a point."""
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.points))
        for depth in range(len(self.levels) - 1, -1, -1):
            hi, small, large = self.levels[depth]
            fits = (small[at] * percent <= size * 100) & (large[at] * 100 >= size * percent)
            at = at[fits]
            bound = np.minimum(hi[at], vector).sum(axis=1, dtype=np.int64)
            at = at[bound >= needed(size + np.maximum(small[at], -(-size * percent // 100)), percent)]
            width = len(self.levels[depth - 1][0]) if depth else len(self.points)
            at = (at[:, None] * _NODE + np.arange(_NODE)).ravel()
            at = at[at < width]
        near = (self.sizes[at] * percent <= size * 100) & (self.sizes[at] * 100 >= size * percent)
        at = at[near]
        bound = np.minimum(self.points[at], vector).sum(axis=1, dtype=np.int64)
        return self.order[at[bound >= needed(size + self.sizes[at], percent)]]


class Points:
    """The points of a tile. Points are indexed by their number of groups; similar sets differ by one doubling at
    most, and the finer point is folded."""

    FEW = 48

    def __init__(self, packed: list[bytes], sizes: np.ndarray, percent: int) -> None:
        self.vectors, self.sizes, self.percent = [unpack_counts(x) for x in packed], sizes, percent
        self.groups = np.array([len(v) for v in self.vectors])
        self.trees: dict[tuple[int, int], tuple[np.ndarray, CountVectorTree]] = {}

    def tree(self, g: int, to: int) -> tuple[np.ndarray, CountVectorTree]:
        if (g, to) not in self.trees:
            rows = np.flatnonzero(self.groups == g)
            self.trees[g, to] = rows, CountVectorTree(fold(np.stack([self.vectors[i] for i in rows]), to), self.sizes[rows])
        return self.trees[g, to]

    def near(self, q: int, rest: np.ndarray) -> np.ndarray:
        """Those of ``rest`` that may be similar to point ``q``."""
        size, own, percent = int(self.sizes[q]), self.vectors[q], self.percent
        rest = rest[(self.sizes[rest] * percent <= size * 100) & (self.sizes[rest] * 100 >= size * percent)]
        if len(rest) <= self.FEW:
            bounds = [np.minimum(fold(own, g), fold(v, g)).sum(dtype=np.int64) for v, g in ((self.vectors[i], min(len(own), len(self.vectors[i]))) for i in rest)]
            return rest[np.array(bounds, np.int64) >= needed(size + self.sizes[rest], percent)]
        left = np.zeros(len(self.sizes), bool)
        left[rest] = True
        found = []
        for g in np.unique(self.groups[rest]).tolist():
            to = min(g, len(own))
            rows, index = self.tree(g, to)
            found.append(rows[index.search(fold(own, to), size, percent)])
        found = np.concatenate(found)
        return found[left[found]]


class Sets:
    """The sets of a tile, their shingles numbered from 0."""

    def __init__(self, packed: list[bytes], sizes: np.ndarray, percent: int) -> None:
        self.sizes, self.percent = np.array([len(x) // 8 for x in packed], np.int64), percent
        values, self.flat = np.unique(np.frombuffer(b"".join(packed), U), return_inverse=True)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.mark = np.zeros(len(values), bool)

    def near(self, q: int, rest: np.ndarray) -> np.ndarray:
        """Those of ``rest`` that are similar to set ``q``."""
        size, percent = int(self.sizes[q]), self.percent
        rest = rest[(self.sizes[rest] * percent <= size * 100) & (self.sizes[rest] * 100 >= size * percent)]
        if not len(rest):
            return rest
        own = self.flat[self.begin[q] : self.begin[q] + size]
        length = self.sizes[rest]
        first = np.cumsum(length) - length
        at = np.repeat(self.begin[rest] - first, length) + np.arange(int(length.sum()))
        self.mark[own] = True
        shared = np.add.reduceat(self.mark[self.flat[at]].astype(np.int64), first)
        self.mark[own] = False
        return rest[100 * shared >= percent * (size + length - shared)]


def spanning_links(tile: Points | Sets, components: np.ndarray) -> list[tuple[int, int]]:
    """Positions (a, b) of links that join all points that ``near`` joins, fewer than there are points. Points of one
    component are joined from the start."""
    order = np.argsort(components, kind="stable")
    cuts = np.flatnonzero(np.diff(components[order])) + 1
    member = np.split(order, cuts)
    of = np.empty(len(order), np.int64)
    for i, own in enumerate(member):
        of[own] = i
    alive = np.ones(len(order), bool)
    out: list[tuple[int, int]] = []
    for own in sorted(member, key=len, reverse=True):  # a large component meets what is left of the others
        if not alive[own[0]]:
            continue
        alive[own] = False
        open_ = own.tolist()
        rest = np.flatnonzero(alive)
        while open_ and len(rest):
            q = open_.pop()
            hits = tile.near(q, rest)
            for h in hits.tolist():
                if alive[h]:
                    out.append((q, h))
                    alive[member[of[h]]] = False
                    open_ += member[of[h]].tolist()
            if len(hits):
                rest = rest[alive[rest]]
    return out


def frequent_shingles(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``FREQUENT`` shingles that most documents hold, sorted by count, and the counts. Only the order of shingles and
    the way of their trees depend on them, never which links exist; a shingle counts where a task sees it in at least
    three documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def seen() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= 3
            return pa.RecordBatch.from_arrays([pa.array(as_long(values[often])), pa.array(counts[often])], ["s", "n"])

        for batch in batches:
            for own in shingle_sets(batch.column(0), n):
                held.append(own)
                size += len(own)
                if size > 4_000_000:
                    yield seen()
                    held, size = [], 0
        if size:
            yield seen()

    with arrow_rows(docs.sparkSession, 2000):
        rows = docs.select("text").mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "s").limit(FREQUENT).toArrow()
    return rows.column("s").to_numpy()[::-1].astype(np.int64).view(U), rows.column("n").to_numpy()[::-1].astype(np.int64)


def signatures(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, held_by: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, route, hot, counts): digest of the set, the trees it goes to, those of them that are
    large for certain, and its point."""
    order = np.argsort(frequent)
    known = frequent[order]
    large = held_by[order] > TILE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "d1", "d2", "route", "hot", "counts"]
        for batch in batches:
            sizes, d1, d2, routes, hot, points = [], [], [], [], [], []
            for own in shingle_sets(batch.column(1), n):
                m = len(own)
                sizes.append(m)
                d1.append(int(mix(own ^ _CODES[1]).sum(dtype=U).view(np.int64)) if m else 0)
                d2.append(int(mix(own ^ _CODES[2]).sum(dtype=U).view(np.int64)) if m else 0)
                take = m - (-(-percent * m // 100)) + 1 if m else 0
                if take and len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    often = known[at] == own
                    rare = own[~often][:take]
                    ranked = at[often][np.argsort(order[at[often]])][: take - len(rare)]  # then the least frequent of the frequent
                    hot.append(as_long(known[ranked[large[ranked]]]))
                    routes.append(as_long(np.concatenate([rare, known[ranked[~large[ranked]]]])))
                else:
                    routes.append(as_long(own[:take]))
                    hot.append(as_long(own[:0]))
                points.append(pack_counts(group_counts(own)) if m else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(routes, pa.list_(pa.int64())), pa.array(hot, pa.list_(pa.int64())), pa.array(points, pa.binary())], names
            )
        give_back_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, route array<long>, hot array<long>, counts binary")


def shared_routes(routes: DataFrame, percent: int) -> DataFrame:
    """Rows (tree, rep, n) of trees with two points at least. A tree is cut where the sizes of its points, in order, jump by
    more than similar sets differ. Near copies share many routes and so make many trees of the same points: a tree of at
    most ``SAME`` points is named by a hash of its points, which leaves one of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3  # the last tree so far, with the points that are not yet passed on
        name, route, large, last = 0, 0, False, 0  # of a tree that goes on: its name and route, whether it has more than SAME points, its last size
        seen: set[int] = set()
        for batch in itertools.chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            tree, rep, n = held if batch is None else [np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate(held)]
            if not len(tree):
                continue
            new = np.append(True, (tree[1:] != tree[:-1]) | (n[1:] * percent > n[:-1] * 100))
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(tree)))
            goes_on = large and tree[0] == route and n[0] * percent <= last * 100
            named = np.add.reduceat(mix(rep.view(U)), begin).view(np.int64) ^ size
            first = mix(tree[begin].view(U) ^ mix(n[begin].view(U))).view(np.int64)  # a large tree's name
            keep = (size > 1) & (size <= SAME)
            big = size > SAME
            if goes_on:
                keep[0], big[0], first[0] = False, True, name
            held = [np.zeros(0, np.int64)] * 3
            if batch is not None:  # the last run may go on
                large, route, last, name = bool(big[-1]), int(tree[-1]), int(n[-1]), int(first[-1])
                if not large:
                    held = [x[begin[-1] :] for x in (tree, rep, n)]
                    keep[-1] = False
            fresh = np.zeros(len(begin), bool)
            _, at = np.unique(named[keep], return_index=True)
            for i in np.flatnonzero(keep)[at].tolist():
                if int(named[i]) not in seen:
                    fresh[i] = True
                    if len(seen) < 500_000:  # bounds memory; what it misses goes in the next step
                        seen.add(int(named[i]))
            rows = np.repeat(fresh | big, size)
            names = np.repeat(np.where(big, first, named), size)
            yield pa.RecordBatch.from_arrays([pa.array(names[rows]), pa.array(rep[rows]), pa.array(n[rows])], ["tree", "rep", "n"])

    return routes.repartition("tree").sortWithinPartitions("tree", "n", "rep").mapInArrow(run, "tree long, rep long, n long").distinct()


def tile_links(tiles: DataFrame, payload: DataFrame, kind: type[Points] | type[Sets], percent: int) -> DataFrame:
    """(a, b): links that join the points of each tile. ``tiles``: (key, x, y, rep, n, component); ``payload``: (rep, own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(rows: list[tuple]) -> None:
            components = np.array([r[5] for r in rows], np.int64)
            if (components == components[0]).all():
                return
            rows = sorted(rows, key=lambda r: (r[3], r[4], r[6]))  # one order, whichever way they came
            tile = kind([r[6] for r in rows], np.array([r[4] for r in rows], np.int64), percent)
            for i, j in spanning_links(tile, np.array([r[5] for r in rows], np.int64)):
                a.append(rows[i][3])
                b.append(rows[j][3])

        held: list[tuple] = []
        a: list[int] = []
        b: list[int] = []
        for batch in itertools.chain(batches, [None]):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else ():
                if held and held[0][:3] != row[:3]:
                    answer(held)
                    held = []
                held.append(row)
            if batch is None and held:
                answer(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a, b = [], []

    full = tiles.join(payload, "rep").select("key", "x", "y", "rep", "n", "component", "own")
    return full.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, "a long, b long").distinct()


def group_links(points: DataFrame, payload: DataFrame, kind: type, percent: int, tile: int | None = None, shingles: int | None = None) -> DataFrame:
    """(a, b): links that join all points of a group that ``kind`` finds near. ``points``: a staged table (key, rep, n).
    A strip has at most ``tile`` points and ``shingles`` members of their sets, about."""
    tile, shingles = tile or TILE, shingles or TILE_SHINGLES
    sizes = points.groupBy("key").agg(F.count(F.lit(1)).alias("_m"), F.greatest(F.ceil(F.count(F.lit(1)) / tile), F.ceil(F.sum("n") / shingles)).cast("int").alias("_k"))
    strips = stage_table(sizes.where("_k > 1"), "strips")
    own = F.col("rep").alias("component")
    if strips.isEmpty():
        return stage_table(tile_links(points.select("key", F.lit(0).alias("x"), F.lit(0).alias("y"), "rep", "n", own), payload, kind, percent), "group-links")
    cut = points.join(strips, "key", "left").withColumn("_x", F.pmod(F.xxhash64("rep"), F.coalesce("_k", F.lit(1))).cast("int"))
    pivot = F.coalesce(F.pmod(F.xxhash64(F.lit(1), "rep"), F.col("_m")) < PIVOTS, F.lit(False))
    tiles = cut.withColumn("x", F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("_k") - 1)).otherwise(F.array("_x"))))
    first = stage_table(tile_links(tiles.select("key", "x", F.lit(0).alias("y"), "rep", "n", own), payload, kind, percent), "strip-links")
    joined = stage_table(contracted_components(first).toDF("rep", "component"), "strip-components")
    placed = points.join(strips, "key").join(joined, "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    placed = stage_table(placed, "strip-points")
    counts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_c"))
    main = counts.groupBy("key").agg(F.max_by("component", F.struct("_c", "component")).alias("_main"), F.max("_c").alias("_inner"), F.sum("_c").alias("_m"))
    main = main.where("_inner < _m").join(strips.select("key", "_k"), "key")
    outer = F.ceil((F.col("_m") - F.col("_inner")) * F.col("_k") / F.col("_m")).cast("int")  # strips of the others, as large as the group's
    dealt = placed.join(main.withColumn("_o", outer), "key").withColumn("_in", F.col("component") == F.col("_main"))
    dealt = dealt.withColumn("_x", F.pmod(F.xxhash64("rep"), F.when(F.col("_in"), F.col("_k")).otherwise(F.col("_o"))).cast("int"))
    # a tile (x, y) has strip x of the others and strip y of the largest component, or strip -1 - y of the others
    at = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
    inner = F.transform(F.sequence(F.lit(0), F.col("_o") - 1), lambda x: at(x, F.col("_x")))
    with_inner = F.transform(F.sequence(F.lit(0), F.col("_k") - 1), lambda y: at(F.col("_x"), y))
    each_other = F.transform(F.sequence(F.lit(0), F.col("_o") - 1), lambda i: at(F.greatest(i, F.col("_x")), -1 - F.least(i, F.col("_x"))))
    tiles = dealt.withColumn("_t", F.explode(F.when(F.col("_in"), inner).otherwise(F.concat(with_inner, each_other))))
    more = tile_links(tiles.select("key", "_t.x", "_t.y", "rep", "n", "component"), payload, kind, percent)
    return stage_table(first.union(more), "group-links")


def bitmap(ids: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """Marks of hashed ids and their number of bits: 64 for each id, ``MOST_BITS`` at most (4 MB). Rows without a mark
    need not move; with more ids than bits more rows move, and joins still decide."""
    bits = 1 << 16
    n = ids.count()
    while bits < 64 * n and bits < MOST_BITS:
        bits *= 2
    hashed = ids.select(F.pmod(F.xxhash64(column), F.lit(bits)).alias("b"))
    words = hashed.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("m")).toArrow()
    marks = np.zeros(bits >> 6, np.int64)
    marks[words.column("w").to_numpy()] = words.column("m").to_numpy()
    return marks, bits


def sets_of(ids: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """(rep, own): the sets of documents ``ids`` (rep), made again from their texts, and of some others."""
    marks, bits = bitmap(ids, "rep")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((marks[b >> 6] >> (b & 63)) & 1 == 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in shingle_sets(batch.column(1), n)], pa.binary())], ["rep", "own"])

    marked = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("rep"), "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("b"))
    return marked.mapInArrow(sets, "rep long, own binary").where(F.length("own") > 0)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that a document reaches by links, itself included."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    frequent, held_by = frequent_shingles(docs, n)
    with arrow_rows(spark, 2000):
        signed = stage_table(signatures(docs, n, percent, frequent, held_by), "signatures")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stage_table(some.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = classes.select("rep", F.col("d1").alias("_d1"), F.col("d2").alias("_d2"))
    chosen = some.join(firsts, (F.col("doc_id") == F.col("rep")) & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")))
    chosen = stage_table(chosen.dropDuplicates(["rep", "_d1", "_d2"]).select("rep", F.col("n_shingles").alias("n"), "counts", "route", "hot"), "class-points")
    members = stage_table(signed.select("doc_id", "n_shingles", "d1", "d2"), "set-digests")
    drop_table(signed)
    cold = shared_routes(chosen.select(F.explode("route").alias("tree"), "rep", "n"), percent)
    hot = chosen.select(F.explode("hot").alias("tree"), "rep", "n")
    trees = stage_table(cold.union(hot).toDF("key", "rep", "n"), "shared-routes")
    # what the bounds join, over all trees
    near = group_links(trees, chosen.select("rep", F.col("counts").alias("own")), Points, percent)
    clusters = contracted_components(near).toDF("rep", "key")
    clusters = stage_table(clusters.join(chosen.select("rep", "n"), "rep").select("key", "rep", "n"), "clusters")
    for table in (chosen, trees, near):
        drop_table(table)
    # rows that share an id, with different sets
    several = members.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("d1").alias("_lo"), F.max("d1").alias("_hi")).where("_lo < _hi").select("doc_id")
    own_id = members.join(several, "doc_id").join(classes, ["d1", "d2", "n_shingles"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    with arrow_rows(spark, 500):
        sets = stage_table(sets_of(clusters.select("rep"), docs, n), "cluster-sets")
        links = group_links(clusters, sets, Sets, percent)
    drop_table(sets)
    final = stage_table(contracted_components(links.union(own_id)).toDF("_rep", "_component"), "components")
    named = classes.join(final, classes["rep"] == final["_rep"], "left").select("d1", "d2", "n_shingles", F.coalesce("_component", "rep").alias("component_id"))
    member = members.join(named, ["d1", "d2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return member.select("doc_id", "n_shingles", own.alias("component_id"))
