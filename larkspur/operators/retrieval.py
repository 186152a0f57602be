"""Vector similarity, top-k retrieval and label similarity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Most queries that are sent to the candidates; queries of a block beyond that, about.
QUERY_BLOCK = 20_000
#: Candidates of a packet of those that pass the queries of a block.
PACKET = 2_048
#: Most queries that one matrix product takes, and its most cells: they bound a task's memory, whatever the blocks.
TILE, CELLS = 500, 1 << 20
#: Neighbouring candidates that are weighed by their best first.
GROUP = 16


def dot(a: Column, b: Column) -> Column:
    """V1, in double precision."""
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """V2; null for a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def similarity_score(a: Column, b: Column) -> Column:
    """V3: 100 times the cosine, at least 0."""
    return F.greatest(100 * cosine(a, b), F.lit(0.0))


def normalised(a: Column) -> Column:
    """V4."""
    n = F.nullif(norm(a), F.lit(0.0))
    return F.transform(a.cast("array<double>"), lambda x: x / n)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows by their length; not a number for a zero row."""
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.full_like(x, np.nan), where=length > 0)


def best_of(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``x``, row of ``y``, similarity) of the ``k`` best of each row of ``x``; equal to 12 digits is equal, then the earlier
    row of ``y``. What is below the k-th best of the best of every ``GROUP`` rows of ``y`` is neither rounded nor sorted."""
    sims = x @ y.T
    wide = sims.shape[1] // GROUP
    most = sims[:, : wide * GROUP].reshape(len(sims), wide, GROUP).max(axis=2) if wide > k else None
    if most is not None and np.isfinite(most).all() and not np.isnan(sims[:, wide * GROUP :]).any():
        # the k-th best of the groups' best is at most the k-th best of all; rounding moves a value by less than the slack
        last = np.partition(most, wide - k, axis=1)[:, wide - k][:, None]
        row, col = np.nonzero(sims >= last - 2e-12 - 1e-15 * np.abs(last))
    else:
        row, col = np.nonzero(~np.isnan(sims))
    near = np.round(sims[row, col], 12)
    keep = near > -np.inf
    row, col, near = row[keep], col[keep], near[keep]
    order = np.lexsort((col, -near, row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return row[keep], col[keep], sims[row[keep], col[keep]]


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), -1)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, use_cosine: bool = False, whole: bool = False) -> DataFrame:
    """(q, c, sim, rank) of the ``k`` most similar candidates; ties to the smaller id. Frames are (id, vector).

    Up to ``QUERY_BLOCK`` queries go to the candidates, which then stay where they are. More of them are dealt to blocks that
    all candidates pass in packets (see ``nearest``), so nothing of either side passes the driver. A product has at most
    ``TILE`` queries and about ``CELLS`` cells. Vectors move in their own type and are doubles in a task. With ``whole``, fewer
    than ``k`` candidates are an error.
    """
    q, c = _sides(queries, candidates)
    if whole and c.limit(k).count() < k:
        raise ValueError(f"fewer than {k} candidates")
    if q.limit(QUERY_BLOCK + 1).count() > QUERY_BLOCK:
        each = nearest(queries, candidates, k, "cosine" if use_cosine else "dot").select("q", F.posexplode(F.arrays_zip("c", "sim")))
        return each.select("q", "col.c", "col.sim", (F.col("pos") + 1).cast("long").alias("rank"))
    best = Window.partitionBy("q").orderBy(F.round("sim", 12).desc(), "c")
    return _met_by_broadcast(q, c, k, use_cosine).withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= k)


def _sides(queries: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    q = queries.select(F.col(queries.columns[0]).alias("q"), F.col(queries.columns[1]).alias("v")).where("v IS NOT NULL")
    return q, candidates.select(F.col(candidates.columns[0]).alias("c"), F.col(candidates.columns[1]).alias("v")).where("v IS NOT NULL")


def _schema(q: DataFrame, c: DataFrame) -> str:
    return f"q {q.schema['q'].dataType.simpleString()}, c {c.schema['c'].dataType.simpleString()}, sim double"


def _met(q_ids: pa.Array, x: np.ndarray, c_ids: pa.Array, y: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Candidates in the order of their ids against so many queries at a time that the product is bounded."""
    by_id = pc.sort_indices(c_ids).to_numpy()
    y = y[by_id]
    step = max(1, min(TILE, CELLS // max(len(y), 1)))
    for low in range(0, len(q_ids), step):
        row, col, sim = best_of(x[low : low + step], y, k)
        yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(row + low)), c_ids.take(pa.array(by_id[col])), pa.array(sim)], ["q", "c", "sim"])


def _met_by_broadcast(q: DataFrame, c: DataFrame, k: int, use_cosine: bool) -> DataFrame:
    rows = q.toArrow().combine_chunks()
    ids = pa.array(rows.column("q").to_pylist(), rows.schema.field("q").type)
    matrix = _vectors(rows.column("v").combine_chunks()) if len(ids) else np.zeros((0, 0))
    sent = q.sparkSession.sparkContext.broadcast((ids, unit_rows(matrix) if use_cosine else matrix))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, x = sent.value
        for batch in batches:
            if len(own_ids) and batch.num_rows:
                y = _vectors(batch.column(1))
                yield from _met(own_ids, x, batch.column(0), unit_rows(y) if use_cosine else y, k)

    return c.mapInArrow(score, _schema(q, c))


class Best:
    """The ``k`` best candidates of the rows of ``x`` while candidates pass: what is held is cut as soon as it is twice too much.

    Cells are weighed in single precision first. What might be among the best by the bound of its error is scored in double
    precision; nothing else depends on single precision. Values that a float does not hold well go to ``best_of``.
    """

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.k = x, k
        self.single, self.length = None, None
        if np.abs(x).max(initial=0) <= 1e15:
            self.single, self.length = x.astype(np.float32), np.linalg.norm(x, axis=1)
        self.last = np.full(len(x), -np.inf)  # the k-th best of what was cut so far
        self.found: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        self.held, self.most = 0, max(3 * k * len(x), CELLS // 4)

    def meet(self, ids: pa.Array, y: np.ndarray) -> None:
        by_id = pc.sort_indices(ids)
        ids, y = ids.take(by_id), y[by_id.to_numpy()]
        slack = None
        if self.single is not None and np.abs(y).max(initial=0) <= 1e15:
            single = np.ascontiguousarray(y.astype(np.float32).T)
            # sums and both roundings: their relative errors add up to less than (width + 3) / 2**24 of the lengths' product
            slack = self.length * (np.linalg.norm(y, axis=1).max(initial=0) * (y.shape[1] + 3) * 2.0**-23)
        step = max(1, min(TILE, CELLS // max(len(y), 1)))
        for low in range(0, len(self.x), step):
            part = slice(low, low + step)
            got = None if slack is None else self._better(part, y, single, slack[part])
            row, col, sim = best_of(self.x[part], y, self.k) if got is None else got
            self.found.append((row + low, ids.take(pa.array(col)), sim))
            self.held += len(row)
            if self.held > self.most and not self._thinned():
                self._cut()

    def _better(self, part: slice, y: np.ndarray, single: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Cells that are not below the k-th best so far; none of it if they are many, or if there are no k yet."""
        last = self.last[part]
        if not np.isfinite(last).all():
            return None
        last = last - 2e-12 - 1e-15 * np.abs(last)  # as in best_of
        least = np.nextafter((last - slack).astype(np.float32), np.float32(-np.inf))
        cell = np.flatnonzero(self.single[part] @ single >= least[:, None])
        if len(cell) > len(last) * len(y) // 8:
            return None
        row, col = np.divmod(cell, len(y))
        x = self.x[part]
        sim = np.concatenate([np.einsum("ij,ij->i", x[row[i : i + 8192]], y[col[i : i + 8192]]) for i in range(0, len(row), 8192)] or [np.zeros(0)])
        keep = sim >= last[row]
        return row[keep], col[keep], sim[keep]

    def _thinned(self) -> bool:
        """Leave out what is below the k-th best of its row, unless rows differ too much in number or ties leave too many."""
        row, sim = (np.concatenate([x[i] for x in self.found]) for i in (0, 2))
        n = np.bincount(row, minlength=len(self.x))
        wide = n.max()
        if wide <= self.k or wide > 8 * self.k:
            return False
        order = np.argsort(row.astype(np.min_scalar_type(len(self.x))), kind="stable")
        row, sim = row[order], sim[order]
        each = np.full((len(self.x), wide), -np.inf)
        each[row, np.arange(len(row)) - (np.cumsum(n) - n)[row]] = sim
        last = np.round(np.partition(each, wide - self.k, axis=1)[:, wide - self.k], 12)
        keep = np.round(sim, 12) >= last[row]
        if keep.sum() > self.most // 2:
            return False
        ids = pa.concat_arrays([x[1] for x in self.found]).take(pa.array(order[keep]))
        self.last, self.found, self.held = last, [(row[keep], ids, sim[keep])], len(ids)
        return True

    def _cut(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """The ``k`` best of each row in order: by similarity to 12 digits, then by id."""
        row, sim = (np.concatenate([x[i] for x in self.found]) if self.found else np.zeros(0, int) for i in (0, 2))
        ids = pa.concat_arrays([x[1] for x in self.found]) if self.found else pa.array([])
        near = np.round(sim, 12)
        place = pc.rank(ids, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy() if len(ids) else row
        order = np.lexsort((place, -near, row))
        order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < self.k]
        row, ids, sim = row[order], ids.take(pa.array(order)), sim[order]
        full = np.flatnonzero(np.bincount(row, minlength=len(self.x)) == self.k)
        self.last[full] = np.round(sim[np.searchsorted(row, full, "right") - 1], 12)
        self.found, self.held = [(row, ids, sim)], len(row)
        return row, ids, sim

    def batches(self, q_ids: pa.Array, taken: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(q, c, sim) with arrays, best first, for rows that have any; ``taken`` is what is taken from a row's similarities."""
        row, ids, sim = self._cut()
        sim = sim - taken[row]
        for low in range(0, len(self.x), TILE):
            own = np.arange(low, min(low + TILE, len(self.x)))
            start, end = np.searchsorted(row, [own[0], own[-1] + 1])
            n = np.bincount(row[start:end] - low, minlength=len(own))
            ends = pa.array(np.concatenate([[0], np.cumsum(n[n > 0])]), pa.int32())
            lists = (pa.ListArray.from_arrays(ends, x) for x in (ids.slice(start, end - start), pa.array(sim[start:end])))
            yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(own[n > 0])), *lists], ["q", "c", "sim"])


def nearest(queries: DataFrame, candidates: DataFrame, k: int, measure: str = "dot") -> DataFrame:
    """(q, c, sim) with arrays of the ``k`` best candidates of each query, best first; ties to the smaller id.

    Queries are dealt to blocks of at most about ``QUERY_BLOCK``, one a task. All candidates pass every block in packets of
    ``PACKET``, so a task holds its queries and their best only, and one row for each query leaves it. ``measure`` is dot, cosine or
    distance; the last has the negative squared distance, ranked by ``2 xy - yy``.
    """
    q, c = _sides(queries, candidates)
    n, cores = q.count(), q.sparkSession.sparkContext.defaultParallelism
    least = max(1, -(-n // QUERY_BLOCK))
    blocks = max(least, min(n // 256 + 1, -(-least // cores) * cores))
    type_of = lambda df, i: df.schema[i].dataType.simpleString()
    ids = pa.list_(to_arrow_type(q.schema["q"].dataType)), pa.list_(to_arrow_type(c.schema["c"].dataType))
    width = ["<f4" if type_of(df, "v") == "array<float>" else "<f8" for df in (q, c)]
    packets = f"i int, side int, q array<{type_of(q, 'q')}>, c array<{type_of(c, 'c')}>, m binary"

    def packet(i: int, side: int, own: pa.Array, vectors: np.ndarray) -> pa.RecordBatch:
        sides = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own) if s == side else pa.nulls(1, ids[s]) for s in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([side], pa.int32()), *sides, pa.array([vectors.astype(width[side]).tobytes()], pa.binary())], ["i", "side", "q", "c", "m"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, block = _vectors(batch.column(1)) if batch.num_rows else None, batch.column(2).to_numpy()
            for i in np.unique(block):
                at = np.flatnonzero(block == i)
                yield packet(i, 0, batch.column(0).take(pa.array(at)), vectors[at])

    def offered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, PACKET):
                part = batch.slice(low, PACKET)
                yield packet(0, 1, part.column(0), _vectors(part.column(1)))

    def sided(m: np.ndarray, side: int) -> np.ndarray:
        if measure == "cosine":
            return unit_rows(m)
        if measure == "distance":
            return np.column_stack([m, (m * m).sum(axis=1)] if side else [2 * m, np.full(len(m), -1.0)])
        return m

    def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best = [], None
        for batch in batches:
            for r in range(batch.num_rows):
                side = batch.column("side")[r].as_py()
                keys = batch.column("qc"[side])[r].values
                m = np.frombuffer(batch.column("m")[r].as_buffer(), width[side]).astype(float).reshape(len(keys), -1)
                x = sided(m, side)
                there = ~np.isnan(x).any(axis=1)  # the others are near nothing
                keys, x = keys.filter(pa.array(there)), x[there]
                if not side:
                    own.append((keys, x, (m[there] ** 2).sum(axis=1) if measure == "distance" else np.zeros(len(x))))
                elif own:
                    best = best or Best(np.concatenate([o[1] for o in own]), k)
                    best.meet(keys, x)
        if best:
            yield from best.batches(pa.concat_arrays([o[0] for o in own]), np.concatenate([o[2] for o in own]))

    left = q.select("q", "v", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("i")).mapInArrow(asked, packets)
    right = c.mapInArrow(offered, packets).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = left.unionByName(right).repartitionById(blocks, F.col("i")).sortWithinPartitions("side")
    return met.mapInArrow(pass_by, f"q {type_of(q, 'q')}, c array<{type_of(c, 'c')}>, sim array<double>")


def recall_at(ranked: DataFrame, n_queries: int, ks: tuple[int, ...] = (5, 10, 50, 100)) -> DataFrame:
    """V5: share of queries whose own item is among the first K, from one ranking to the largest K."""
    own = ranked.where("q = c")
    rows = [F.struct(F.lit(k).cast("long").alias("k"), (F.count_if(F.col("rank") <= k) / F.lit(n_queries)).alias("recall")) for k in ks]
    return own.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def label_similarity(a: Column, b: Column) -> Column:
    """V7: both positive over any positive; null if neither has a positive. Arguments are arrays of 0 and 1."""
    both = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0), lambda s, x: s + x)
    some = F.aggregate(F.zip_with(a, b, lambda x, y: F.greatest(x, y)), F.lit(0), lambda s, x: s + x)
    return both / F.nullif(some, F.lit(0))


def mean_label_similarity(ranked: DataFrame, labels: DataFrame, ks: tuple[int, ...] = (1, 5, 10, 50)) -> DataFrame:
    """V6: for each K the mean over queries of the mean label similarity of their first K; ``labels`` is (id, ys)."""
    a, b = labels.toDF("q", "_ya"), labels.toDF("c", "_yb")
    pairs = ranked.join(a, "q").join(b, "c").withColumn("s", label_similarity(F.col("_ya"), F.col("_yb")))
    per_query = pairs.groupBy("q").agg(*[F.avg(F.when(F.col("rank") <= k, F.col("s"))).alias(f"_{k}") for k in ks])
    rows = [F.struct(F.lit(k).cast("long").alias("k"), F.avg(f"_{k}").alias("similarity")) for k in ks]
    return per_query.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
