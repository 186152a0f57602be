"""Approximate nearest neighbours (largest inner product) on an NN-descent graph.

Equal vectors are one node. A first graph comes from random-projection trees: nodes of a
leaf are compared with each other. NN-descent then repeats until few neighbours change
(``SETTLED``): every node sends its vector to its neighbours and to nodes it is a neighbour
of (a join), each node compares what it has received, neighbours of neighbours, and pairs
better than a node's worst neighbour go back to be merged. Queries are answered by greedy
graph search in rounds, until every candidate is expanded: the best unexpanded candidates of
each query travel to their adjacency rows, which answer with the neighbours that beat the
query's worst candidate. The best candidates are scored again in double
precision on the original vectors. Graph and search work on floats, so all vectors are first divided by
one power of two, that of the largest component, and each query by its own: no magnitude is out of range,
and the order of products stays.

* vectors that are null, zero, hold null or non-finite components, or whose length is not
  the commonest one take no part; nor do rows without id; rows that repeat a vector under its id
  count once, and of rows that share an id with different vectors the one with the least hash counts;
* ties go to the smaller id; of equal vectors all ids are candidates (the ``k + 1`` smallest
  are enough for any answer);
* all rows are indexed. The trees' split points are fitted on a bounded sample (``SAMPLE``).
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larkspur.llm.spark_util import arrow_rows, delete_path, drop_table, give_back_shuffles, shared_dir, stage_table

#: Vectors that tree splits are fitted on.
SAMPLE = 16_384
LEAF = 512
NEIGHBOURS = 32
#: Share of the graph's neighbours that the last NN-descent round may still change.
SETTLED = 0.001


def _pack(x: np.ndarray, dtype: str) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(x, dtype)]


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """Rows of equally long packed vectors."""
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signed bytes and each row's scale."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    return np.rint(x / scale[:, None]).astype(np.int8), scale.astype(np.float32)


def exponent(largest: float) -> int:
    """The power of two below which a magnitude lies."""
    return int(np.frexp(largest)[1])


def shrunk(x: np.ndarray, power: int | np.ndarray) -> np.ndarray:
    """Doubles divided by a power of two, which keeps the order of products and brings any magnitude into the range of floats."""
    return np.ldexp(x, -np.asarray(power))


def restore(codes: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return codes.astype(np.float32) * scale[:, None]


def usable_vectors(table: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(id, v): packed doubles of the vectors that take part, and their length."""
    v = F.col(vector_column).cast("array<double>")
    fine = table.select(F.col(id_column).cast("long").alias("id"), v.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    fine = fine.where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("x", lambda e: e != 0))
    sizes = fine.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "d").first()
    dim = sizes["d"] if sizes else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch.column(0)), -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_pack(flat + 0.0, "<f8"), pa.binary())], ["id", "v"])

    return fine.where(F.size("x") == dim).mapInArrow(pack, "id long, v binary"), dim


def _largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The largest magnitude of each batch's (id, v)."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.abs(_matrix(batch.column(1), "<f8")).max())])], ["m"])


class ProjectionTree:
    """Median splits along random directions, fitted on a sample; deeper levels split at zero."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.depth = depth
        self.axes = rng.normal(size=(depth, sample.shape[1])).astype(np.float32)
        self.cuts: list[np.ndarray] = []
        code = np.zeros(len(sample), np.int64)
        for level in range(depth):
            p = sample @ self.axes[level]
            if (1 << level) * 16 > len(sample):
                cuts = np.zeros(1, np.float32)
                code = code * 2 + (p > 0)
            else:
                cuts = np.zeros(1 << level, np.float32)
                for c in np.unique(code):
                    cuts[c] = np.median(p[code == c])
                code = code * 2 + (p > cuts[code])
            self.cuts.append(cuts)

    def route(self, x: np.ndarray) -> np.ndarray:
        code = np.zeros(len(x), np.int64)
        for level in range(self.depth):
            cuts = self.cuts[level]
            code = code * 2 + (x @ self.axes[level] > (cuts[code] if len(cuts) > 1 else cuts[0]))
        return code


def best_of(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best distinct ids, best first; ties to the smaller id."""
    order = np.lexsort((-sims, ids))
    ids, sims = ids[order], sims[order]
    keep = np.append(True, ids[1:] != ids[:-1]) if len(ids) else np.zeros(0, bool)
    ids, sims = ids[keep], sims[keep]
    order = np.lexsort((ids, -sims))[:k]
    return ids[order], sims[order]


GRAPH = "u long, ids binary, sims binary"
#: A merged row also marks the neighbours that the row before did not have, and counts them.
MERGED = GRAPH + ", fresh binary, changed int"


def _runs(batches: Iterator[pa.RecordBatch], key: int, limit: int | None = None) -> Iterator[list[tuple]]:
    """Rows of equal ``key`` column, at most ``limit`` at a time, from sorted batches."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (held[0][key] != row[key] or limit and len(held) >= limit):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _graph_batch(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].astype("<i8").tobytes() for r in rows], pa.binary()), pa.array([r[2].astype("<f4").tobytes() for r in rows], pa.binary())], ["u", "ids", "sims"]
    )


def leaf_graph(nodes: DataFrame, dim: int, trees: int, count: int, seed: int, power: int = 0) -> DataFrame:
    """(u, ids, sims): the best of each node's leaf, for every tree. Vectors are divided by ``2**power``."""
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))
    got = nodes.select("id", "v").orderBy(F.xxhash64(F.lit(seed), "id")).limit(SAMPLE).collect()  # bounded by SAMPLE
    sample = shrunk(np.array([np.frombuffer(r["v"], "<f8") for r in got]).reshape(len(got), dim), power).astype(np.float32)
    forest = [ProjectionTree(sample, depth, seed + t) for t in range(trees)]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shrunk(_matrix(batch.column(1), "<f8"), power)
            if not len(x):
                continue
            codes, scale = quantise(x)
            x = x.astype(np.float32)
            packed = pa.array(_pack(codes, "i1"), pa.binary())
            for t, tree in enumerate(forest):
                leaf = tree.route(x) * trees + t
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), packed, pa.array(scale)], ["leaf", "u", "c", "s"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, 0, 2 * LEAF):  # a leaf of many nodes is compared in pieces
            if len(rows) < 2:
                continue
            u = np.array([r[1] for r in rows])
            x = restore(np.frombuffer(b"".join(r[2] for r in rows), np.int8).reshape(len(rows), -1), np.array([r[3] for r in rows], np.float32))
            sims = x @ x.T
            np.fill_diagonal(sims, -np.inf)
            k = min(20, len(rows) - 1)
            top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            yield _graph_batch([(int(u[i]), u[top[i]], sims[i, top[i]]) for i in range(len(rows))])

    dealt = nodes.select("id", "v").mapInArrow(route, "leaf long, u long, c binary, s float").repartition("leaf").sortWithinPartitions("leaf", F.xxhash64("u"))
    return dealt.mapInArrow(compare, GRAPH)


def merged(parts: DataFrame, k: int, graph: DataFrame | None = None) -> DataFrame:
    """One row for each node with its ``k`` best neighbours of ``parts`` and of ``graph``; those that ``graph`` has not are fresh."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, fresh = [], []

        def batch_of() -> pa.RecordBatch:
            marks = [pa.array([f.tobytes() for f in fresh], pa.binary()), pa.array([int(f.sum()) for f in fresh], pa.int32())]
            return pa.RecordBatch.from_arrays([*_graph_batch(out).columns, *marks], ["u", "ids", "sims", "fresh", "changed"])

        for rows in _runs(batches, 0):
            ids, sims = best_of(np.frombuffer(b"".join(r[1] for r in rows), "<i8"), np.frombuffer(b"".join(r[2] for r in rows), "<f4"), k)
            known = [np.frombuffer(r[1], "<i8") for r in rows if r[3] == 0]
            out.append((rows[0][0], ids, sims))
            fresh.append((~np.isin(ids, known[0]) if known else np.ones(len(ids), bool)).astype(np.int8))
            if len(out) == 2000:
                yield batch_of()
                out, fresh = [], []
        yield batch_of()

    both = parts.select("u", "ids", "sims", F.lit(1).alias("t"))
    if graph is not None:
        both = both.union(graph.select("u", "ids", "sims", F.lit(0).alias("t")))
    return both.repartition("u").sortWithinPartitions("u").mapInArrow(merge, MERGED)


def exchanged(graph: DataFrame, codes: DataFrame, backward: int, seed: int) -> DataFrame:
    """(c, x, code, scale, worst, fresh): the vectors that centre ``c`` receives, from all its neighbours and from up to
    ``backward`` nodes that have it as a neighbour, of fresh edges first."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fresh = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            u = np.repeat(batch.column(0).to_numpy(), [len(f) for f in fresh])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(np.frombuffer(b"".join(ids), "<i8")), pa.array(np.frombuffer(b"".join(fresh), np.int8))], ["u", "v", "f"])

    pairs = graph.select("u", "ids", "fresh").mapInArrow(edges, "u long, v long, f byte")
    back = Window.partitionBy("v").orderBy(F.col("f").desc(), F.xxhash64(F.lit(seed), "u"))
    chosen = pairs.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= backward)
    asked = pairs.select(F.col("u").alias("c"), F.col("v").alias("x"), "f").union(chosen.select(F.col("v").alias("c"), F.col("u").alias("x"), "f"))
    asked = asked.groupBy("c", "x").agg(F.max("f").alias("fresh"))
    return asked.join(codes, "x").select("c", "x", "code", "scale", "worst", "fresh")


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """What each centre has received, (x, vectors, worst, fresh), from sorted batches."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        c, x, code, scale, worst, fresh = batch.columns
        own = [c.to_numpy(), x.to_numpy(), restore(_matrix(code, "i1"), scale.to_numpy()), worst.to_numpy(), fresh.to_numpy() > 0]
        if held is not None:
            own = [np.concatenate(p) for p in zip(held, own, strict=True)]
        cuts = [0, *(np.flatnonzero(np.diff(own[0])) + 1).tolist()]
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield [p[low:high] for p in own[1:]]
        held = [p[cuts[-1] :] for p in own]  # goes on in the next batch
    if held is not None:
        yield held[1:]


def descent_step(graph: DataFrame, codes: DataFrame, seed: int, k: int) -> DataFrame:
    """One NN-descent round: neighbours of neighbours compared at the node between them. Pairs of two edges that are
    not fresh were compared there before; of the others all that beat a node's worst neighbour are merged."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for x, v, worst, fresh in _centres(batches):
            if fresh.any():
                sims = v @ v.T
                np.fill_diagonal(sims, -np.inf)
                better = (sims > worst[:, None]) & (fresh[:, None] | fresh)
                for i in np.flatnonzero(better.any(axis=1)):
                    out.append((int(x[i]), x[better[i]], sims[i, better[i]]))
            if len(out) > 5000:
                yield _graph_batch(out)
                out = []
        yield _graph_batch(out)

    with_worst = codes.join(graph.select(F.col("u").alias("x"), "sims"), "x")

    def worst_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            worst = []
            for sims in batch.column(3).to_pylist():
                own = np.frombuffer(sims, "<f4")
                worst.append(float(own[-1]) if len(own) >= k else -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(worst, pa.float32())], ["x", "code", "scale", "worst"])

    known = with_worst.select("x", "code", "scale", "sims").mapInArrow(worst_of, "x long, code binary, scale float, worst float")
    sent = exchanged(graph, known, 16, seed)
    better = sent.repartition("c").sortWithinPartitions("c").mapInArrow(compare, GRAPH)
    return merged(better, k, graph)


def descend(graph: DataFrame, codes: DataFrame, seed: int, k: int, count: int) -> DataFrame:
    """NN-descent rounds over a staged graph until one changes at most ``SETTLED`` of the neighbours. Neighbours only ever get better, so it ends."""
    step = 0
    while (graph.agg(F.sum("changed")).first()[0] or 0) > SETTLED * k * count:
        nxt = stage_table(descent_step(graph, codes, seed + step, k), "graph")
        drop_table(graph)
        graph, step = nxt, step + 1
        give_back_shuffles(graph.sparkSession)
    return graph


STATE = "q long, v binary, ids binary, sims binary, open binary"


def choose(ids: np.ndarray, sims: np.ndarray, still: np.ndarray, expand: int) -> np.ndarray:
    """Positions of the best unexpanded candidates; candidates are sorted."""
    return np.flatnonzero(still)[:expand]


def graph_search(queries: DataFrame, adjacency: DataFrame, rounds: tuple[int, ...], width: int) -> DataFrame:
    """(q, ids, sims): up to ``width`` candidates, all of them expanded; the last of ``rounds`` is repeated until they are. ``queries``: (q, v as packed floats), nodes of the graph, where the search starts."""

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            own = [np.frombuffer(x, "<f4") for x in v]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([np.array([x], "<i8").tobytes() for x in q], pa.binary()), pa.array([np.array([x @ x], "<f4").tobytes() for x in own], pa.binary()), pa.array([b"\x01"] * len(q), pa.binary())],
                ["q", "v", "ids", "sims", "open"],
            )

    state = stage_table(queries.mapInArrow(begin, STATE), "search")
    for number in itertools.count():
        expand = rounds[min(number, len(rounds) - 1)]
        if number >= len(rounds) and state.where(F.instr(F.hex("open"), "1") > 0).isEmpty():
            break

        def ask(batches: Iterator[pa.RecordBatch], expand: int = expand) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node, q, vectors, limits = [], [], [], []
                for a, v, ids, sims, still in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids, sims = np.frombuffer(ids, "<i8"), np.frombuffer(sims, "<f4")
                    pick = choose(ids, sims, np.frombuffer(still, np.int8), expand)
                    node.append(ids[pick])
                    q += [a] * len(pick)
                    vectors += [v] * len(pick)
                    limits += [float(sims[-1]) if len(sims) >= width else -np.inf] * len(pick)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(node) if node else [], pa.int64()), pa.array(q, pa.int64()), pa.array(vectors, pa.binary()), pa.array(limits, pa.float32())], ["node", "q", "v", "least"])

        def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for q, v, least, ids, codes, scale in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids, scale = np.frombuffer(ids, "<i8"), np.frombuffer(scale, "<f4")
                    v = np.frombuffer(v, "<f4")
                    sims = (np.frombuffer(codes, np.int8).reshape(len(ids), -1).astype(np.float32) @ v) * scale
                    keep = sims > least
                    if keep.any():
                        out.append((q, ids[keep], sims[keep]))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1].tobytes() for r in out], pa.binary()), pa.array([r[2].astype("<f4").tobytes() for r in out], pa.binary())], ["q", "ids", "sims"])

        def merge(batches: Iterator[pa.RecordBatch], expand: int = expand) -> Iterator[pa.RecordBatch]:
            out = []

            def batch_of() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if i == 0 else pa.binary()) for i in range(5)], ["q", "v", "ids", "sims", "open"])

            for rows in _runs(batches, 0):
                q, v, ids, sims, still = rows[0][:5]  # the state comes first
                old_ids, still = np.frombuffer(ids, "<i8"), np.frombuffer(still, np.int8).copy()
                old_sims = np.frombuffer(sims, "<f4")
                still[choose(old_ids, old_sims, still, expand)] = 0
                closed = old_ids[still == 0]
                new_ids, new_sims = best_of(np.concatenate([old_ids, *(np.frombuffer(r[2], "<i8") for r in rows[1:])]), np.concatenate([old_sims, *(np.frombuffer(r[3], "<f4") for r in rows[1:])]), width)
                out.append((q, v, new_ids.astype("<i8").tobytes(), new_sims.astype("<f4").tobytes(), (~np.isin(new_ids, closed)).astype(np.int8).tobytes()))
                if len(out) == 500:
                    yield batch_of()
                    out = []
            yield batch_of()

        with arrow_rows(state.sparkSession, 1000):
            frontier = state.mapInArrow(ask, "node long, q long, v binary, least float")
            answers = frontier.join(adjacency, frontier["node"] == adjacency["u"]).select("q", "v", "least", "ids", "codes", "scales").mapInArrow(reply, "q long, ids binary, sims binary")
            both = state.withColumn("t", F.lit(0)).unionByName(answers.select("q", F.lit(None).cast("binary").alias("v"), "ids", "sims", F.lit(None).cast("binary").alias("open"), F.lit(1).alias("t")))
            nxt = stage_table(both.repartition("q").sortWithinPartitions("q", "t").mapInArrow(merge, STATE), "search")
        drop_table(state)
        state = nxt
        give_back_shuffles(state.sparkSession)
    return state.select("q", "ids", "sims")


@contextmanager
def adjacency_table(graph: DataFrame, codes: DataFrame, seed: int, buckets: int) -> Iterator[DataFrame]:
    """(u, ids, codes, scales), a table in the shared folder that goes at the end: neighbours in both directions with their quantised vectors, bucketed by ``u`` so that
    search rounds move queries only."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if i == 0 else pa.binary()) for i in range(4)], ["u", "ids", "codes", "scales"])

        for rows in _runs(batches, 0):
            out.append((rows[0][0], np.array([r[1] for r in rows], "<i8").tobytes(), b"".join(r[2] for r in rows), np.array([r[3] for r in rows], "<f4").tobytes()))
            if len(out) == 500:
                yield batch_of()
                out = []
        yield batch_of()

    sent = exchanged(graph, codes.withColumn("worst", F.lit(0.0).cast("float")), NEIGHBOURS, seed)
    rows = sent.select("c", "x", "code", "scale").repartition(buckets, "c").sortWithinPartitions("c").mapInArrow(gather, "u long, ids binary, codes binary, scales binary")
    spark = graph.sparkSession
    name = f"adjacency_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    try:
        rows.write.option("path", path).bucketBy(buckets, "u").sortBy("u").saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # its files stay, as the path was given
        delete_path(spark, path)


def search_width(count: int) -> int:
    """Candidates of a search: more in larger tables, where true neighbours lie among more that are as near."""
    return max(400, round(11 * count ** (1 / 3)))


def one_of_each_id(vectors: DataFrame) -> DataFrame:
    """``vectors`` (staged) with one row for each id; only where ids repeat does anything move but ids and hashes."""
    several = vectors.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("h1", "h2")).alias("_h")).where("_n > 1")
    if several.isEmpty():
        return vectors
    marked = vectors.join(several, "id", "left")
    chosen = marked.where(F.col("_n").isNull() | (F.struct("h1", "h2") == F.col("_h")))
    return stage_table(chosen.drop("_n", "_h").dropDuplicates(["id"]), "vectors")


def nearest(table: DataFrame, query_ids: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", trees: int = 8, rounds: tuple[int, ...] = (1, 64, 128, 160), width: int | None = None, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query among all rows but its own.

    ``query_ids`` has one column with ids of rows of ``table``. A search keeps ``width`` candidates, by default
    ``search_width`` of the number of vectors.
    """
    spark = table.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with arrow_rows(spark, 4000):
        vectors, dim = usable_vectors(table, id_column, vector_column)
        vectors = stage_table(vectors.withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(1), "v")), "vectors")
        vectors = one_of_each_id(vectors)
        # of equal vectors the k + 1 smallest ids can be answers; window group limits cut them before the shuffle
        equal = Window.partitionBy("h1", "h2").orderBy("id")
        small = vectors.select("id", "h1", "h2").withColumn("_r", F.row_number().over(equal)).where(F.col("_r") <= k + 1)
        classes = stage_table(small.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("members")), "vector-classes")
        nodes = stage_table(vectors.join(classes.select(F.col("rep").alias("id"), "h1", "h2"), ["id", "h1", "h2"]).select("id", "v"), "nodes")
        count = nodes.count()
        power = exponent(nodes.mapInArrow(_largest, "m double").agg(F.max("m").alias("m")).first()["m"] or 1.0)

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes, scale = quantise(shrunk(_matrix(batch.column(1), "<f8"), power)) if len(batch.column(0)) else (np.zeros((0, 1), np.int8), np.zeros(0, np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_pack(codes, "i1"), pa.binary()), pa.array(scale, pa.float32())], ["x", "code", "scale"])

        codes = stage_table(nodes.mapInArrow(encode, "x long, code binary, scale float"), "codes")
        graph = stage_table(merged(leaf_graph(nodes, dim, trees, count, seed, power), NEIGHBOURS), "graph")
        graph = descend(graph, codes, seed, NEIGHBOURS, count)
        # a query's class is where its search starts
        wanted = vectors.join(query_ids.toDF("id").distinct(), "id").join(classes.select("h1", "h2", "rep"), ["h1", "h2"]).select("id", "rep")
        wanted = stage_table(wanted, "queries")

        def floats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), "<f8")
                own = np.frexp(np.abs(x).max(axis=1, initial=0))[1]  # a query's length changes nothing in its order
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_pack(shrunk(x, own[:, None]), "<f4"), pa.binary())], ["q", "v"])

        starts = nodes.join(wanted.select(F.col("rep").alias("id")).distinct(), "id").select("id", "v").mapInArrow(floats, "q long, v binary")
        with adjacency_table(graph, codes, seed, buckets) as adjacency:
            found = graph_search(starts, adjacency, rounds, width or search_width(count))

        def finalists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                q, y = [], []
                for a, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    top = np.frombuffer(ids, "<i8")[: 3 * k]
                    q.append(np.full(len(top), a))
                    y.append(top)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q) if q else [], pa.int64()), pa.array(np.concatenate(y) if y else [], pa.int64())], ["q", "y"])

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = _matrix(batch.column(2), "<f8"), _matrix(batch.column(3), "<f8")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a * b).sum(axis=1) if len(a) else np.zeros(0), pa.float64())], ["q", "y", "score"])

        pairs = found.select("q", "ids").mapInArrow(finalists, "q long, y long")
        full = pairs.join(nodes.toDF("q", "_a"), "q").join(nodes.toDF("y", "_b"), "y").select("q", "y", "_a", "_b")
        scored = stage_table(full.mapInArrow(score, "q long, y long, score double"), "scored")
    members = classes.select(F.col("rep").alias("y"), "members")
    answers = wanted.join(scored, wanted["rep"] == scored["q"]).join(members, "y").select(F.col("id").alias("query_id"), "score", F.explode("members").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")

