"""V8, t-SNE of latents: affinities over near neighbours, repulsion through a grid, iterations as staged tables.

* **Affinities.** Every row keeps its ``3 * perplexity`` nearest rows in arrays. Its bandwidth is bisected in Arrow batches until
  the entropy of its neighbours is that of the perplexity. What is then symmetric is an edge table of at most
  ``6 * perplexity`` edges a row; there is no table of all pairs.
* **Attraction** of a row is a sum over its edges. Rows are dealt to blocks; the edges between two blocks are one row of
  packed numbers (a tile), made once and cached where their block's step is. A step sends positions only, 16 bytes a row to each block.
* **Repulsion** is a convolution. Rows give their weight to the nodes of a grid, the driver convolves the grid (at most about
  ``MOST_STEPS`` nodes a side), and rows take the potential of the nodes around them. At most ``FAR`` rows outside of the grid come to the driver.
* A step (momentum, gains) writes the next table of positions; a lost executor costs one step.

Rows with a null vector take no part; rows that are equal stay apart by their seeded starts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.resampling import draw
from larkspur.operators.retrieval import nearest
from larkspur.staging import dropped, staged

#: Steps of a side of the grid at least and at most, and the widest step as long as it has fewer: the kernel bends at a width of 1.
STEPS, MOST_STEPS, WIDEST = 160, 1_200, 0.25
#: Most rows outside of the grid, all of which the driver meets with the grid's nodes, and what a node's convolution costs in such meetings, about.
FAR, NODE_COST = 4_096, 80
#: Rows of a block, about, and edges whose forces are made at once.
BLOCK, EDGES = 16_384, 1 << 15
BISECTIONS = 60
#: Rows that are bisected at once.
BISECTED = 512


def neighbour_distances(vectors: DataFrame, k: int) -> DataFrame:
    """(q, c, sim): arrays of the ``k + 1`` nearest rows of each row of ``vectors`` (id, v), mostly with itself, and their negative squared distances."""
    rows = vectors.where("v IS NOT NULL").select("id", "v")
    return nearest(rows, rows, k + 1, "distance")


def bisected(d: np.ndarray, there: np.ndarray, perplexity: float) -> np.ndarray:
    """Probabilities of each row of ``d`` (distances above the least; only where ``there``) with an entropy of ``log(perplexity)``."""
    lo, hi = np.full(len(d), -30.0), np.full(len(d), 30.0)
    for _ in range(BISECTIONS):
        middle = (lo + hi) / 2
        beta = np.exp(middle)
        w = np.exp(-beta[:, None] * d) * there
        total = w.sum(axis=1)
        wide = np.log(total) + beta * (w * d).sum(axis=1) / total > np.log(perplexity)
        lo, hi = np.where(wide, middle, lo), np.where(wide, hi, middle)
    w = np.exp(-np.exp((lo + hi) / 2)[:, None] * d) * there
    return w / w.sum(axis=1, keepdims=True)


def conditional_affinities(near: DataFrame, perplexity: float) -> DataFrame:
    """(i, j, p): each row with arrays of its neighbours and of their probabilities, whose entropy is ``log(perplexity)``, or all equal if there are too few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BISECTED):
                q, c, sim = batch.slice(low, BISECTED).columns
                row = np.repeat(np.arange(len(q)), pc.list_value_length(c).to_numpy())
                other = pc.not_equal(c.flatten(), q.take(pa.array(row)))
                row, j, d2 = row[other.to_numpy(zero_copy_only=False)], c.flatten().filter(other), np.maximum(-sim.flatten().filter(other).to_numpy(), 0.0)
                n = np.bincount(row, minlength=len(q))
                some = np.flatnonzero(n)
                there = np.arange(n.max(initial=0)) < n[some, None]
                d = np.full(there.shape, np.inf)
                d[there] = d2
                d = np.where(there, d - d.min(axis=1, keepdims=True), 0.0) if len(some) else d
                ends = pa.array(np.concatenate([[0], np.cumsum(n[some])]), pa.int32())
                lists = (pa.ListArray.from_arrays(ends, x) for x in (j, pa.array(bisected(d, there, perplexity)[there])))
                yield pa.RecordBatch.from_arrays([q.take(pa.array(some)), *lists], ["i", "j", "p"])

    kind = near.schema["q"].dataType.simpleString()
    return near.mapInArrow(run, f"i {kind}, j array<{kind}>, p array<double>")


def affinities(vectors: DataFrame, perplexity: float = 30.0) -> DataFrame:
    """(i, j, p): the symmetric affinities of ``vectors`` (id, v), which sum up to 1."""
    own = staged(conditional_affinities(neighbour_distances(vectors, round(3 * perplexity)), perplexity), "tsne-conditional")
    each = own.select("i", F.explode(F.arrays_zip("j", "p")).alias("e")).select("i", "e.j", "e.p")
    both = own.select("i", F.explode(F.arrays_zip("j", "p")).alias("e")).select(F.explode(F.array(F.struct("i", "e.j", "e.p"), F.struct(F.col("e.j").alias("i"), F.col("i").alias("j"), "e.p"))).alias("e")).select("e.*")
    total = each.agg(F.sum("p").alias("n"))  # one row
    return both.groupBy("i", "j").agg(F.sum("p").alias("p")).crossJoin(F.broadcast(total)).select("i", "j", (F.col("p") / (2 * F.col("n"))).alias("p"))


def start_positions(ids: DataFrame, seed: int) -> DataFrame:
    """Seeded normal positions, a ten-thousandth wide."""
    u, w = ((draw(F.lit(f"{seed}_{s}"), F.col("id").cast("string")) + 1) / F.lit(2.0**32 + 1) for s in "ab")
    radius = 1e-4 * F.sqrt(-2 * F.log(u))
    turn = 2 * float(np.pi) * w
    return ids.select(F.col("id").cast("long"), (radius * F.cos(turn)).alias("x"), (radius * F.sin(turn)).alias("y"))


class Grid:
    """Equally spaced nodes over the square of ``half`` around the origin. A row's weight goes to the 3 x 3 nodes around it, by quadratic
    interpolation; potentials of nodes, from one convolution, come back to a row by the same shares."""

    def __init__(self, half: float):
        self.half = max(half, 1e-9)
        steps = int(min(max(STEPS, np.ceil(2 * self.half / WIDEST)), MOST_STEPS))
        self.h, self.n = 2 * self.half / steps, steps + 3

    def shares(self, x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(nodes, shares) of the rows, for each of the nine."""
        at = [(v + self.half) / self.h + 1 for v in (x, y)]
        near = [np.clip(np.rint(v), 1, self.n - 2).astype(np.int64) for v in at]
        by = [(u * (u - 1) / 2, 1 - u * u, u * (u + 1) / 2) for u in (v - k for v, k in zip(at, near, strict=True))]
        for a in range(3):
            for b in range(3):
                yield (near[0] + a - 1) * self.n + near[1] + b - 1, by[0][a] * by[1][b]

    def weights(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        total = np.zeros(self.n * self.n)
        for node, share in self.shares(x, y):
            total += np.bincount(node, share, minlength=len(total))
        return total

    def inside(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(x), np.abs(y)) <= self.half

    def potentials(self, weights: np.ndarray, rows: int, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """The sums of ``d / (1 + d^2)^2`` over all rows, for each node and axis and for each of the rows ``far`` (x, y) outside, and the sum of
        ``1 / (1 + d^2)`` over ordered pairs of different rows."""
        n = self.n
        away = self.h * np.concatenate([np.arange(n), np.arange(-n, 0)])
        kernel = 1 / (1 + away[:, None] ** 2 + away**2)
        spread = np.fft.rfft2(weights.reshape(n, n), (2 * n, 2 * n))
        around = lambda k: np.fft.irfft2(spread * np.fft.rfft2(k), (2 * n, 2 * n))[:n, :n].ravel()
        push = np.stack([around(kernel**2 * away[:, None]), around(kernel**2 * away)])
        z = float(weights @ around(kernel)) - (rows - far.shape[1])
        used = np.flatnonzero(weights)
        place = self.h * (np.stack(np.divmod(used, n)) - 1) - self.half
        pushed = np.zeros(far.shape)
        step = max(1, (1 << 20) // max(len(used) + far.shape[1], 1))
        for low in range(0, far.shape[1], step):
            own = slice(low, low + step)
            for at, weight in ((place, weights[used]), (far, np.ones(far.shape[1]))):
                d = far[:, own, None] - at[:, None, :]
                k = 1 / (1 + (d**2).sum(axis=0))
                sums = k @ weight
                d *= k * k
                pushed[:, own] += d @ weight
                if at is place:
                    push[:, used] -= d.sum(axis=1)
                z += float(2 * sums.sum() if at is place else sums.sum() - len(sums))
        return push, pushed, max(z, 1e-12)


#: Rows are counted by four times the binary logarithm of how far they are.
RINGS = 800
WEIGHTS = "rings binary, node binary, weight binary, far_b binary, far binary"
WEIGHT_COLUMNS = [c.split()[0] for c in WEIGHTS.split(", ")]


def _weighed(grid: Grid, b: int, x: np.ndarray, y: np.ndarray) -> tuple[bytes, ...]:
    """Rows by ring, the nodes that have weight, and the rows outside of the grid, unless they are too many."""
    reach = np.maximum(np.abs(x), np.abs(y))
    rings = np.bincount(np.clip(np.ceil(4 * np.log2(np.maximum(reach, 1e-60))), -RINGS, RINGS).astype(int) + RINGS, minlength=2 * RINGS + 1)
    inside = grid.inside(x, y)
    far = np.flatnonzero(~inside)[: FAR + 1]
    weights = grid.weights(x[inside], y[inside])
    node = np.flatnonzero(weights)
    return rings.astype("<i8").tobytes(), node.astype("<i8").tobytes(), weights[node].tobytes(), np.full(len(far), b, "<i4").tobytes(), np.stack([x[far], y[far]], axis=1).tobytes()


def _weights_of(grid: Grid, weighed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows by ring, the weights of all nodes, the blocks and the places (x, y) of rows outside; summed up inside tasks first."""

    def summed(rows: Iterator[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rings, total, blocks, far, held = np.zeros(2 * RINGS + 1, np.int64), np.zeros(grid.n * grid.n), [np.zeros(0, "<i4")], [np.zeros((0, 2))], 0
        for ring, node, weight, b, xy in rows:
            rings += np.frombuffer(ring, "<i8")
            total[np.frombuffer(node, "<i8")] += np.frombuffer(weight, float)
            if held <= FAR:
                blocks.append(np.frombuffer(b, "<i4"))
                far.append(np.frombuffer(xy, float).reshape(-1, 2))
                held += len(blocks[-1])
        return rings, total, np.concatenate(blocks), np.concatenate(far).T

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rings, total, blocks, far = summed(tuple(v.as_buffer() for v in row) for batch in batches for row in zip(*batch.columns, strict=True))
        node = np.flatnonzero(total)
        yield from _row(WEIGHTS, rings.tobytes(), node.astype("<i8").tobytes(), total[node].tobytes(), blocks.tobytes(), np.ascontiguousarray(far.T).tobytes()).to_batches()

    return summed(weighed.coalesce(weighed.sparkSession.sparkContext.defaultParallelism).mapInArrow(add, WEIGHTS).collect())  # a grid for each core at most


def _best_half(rings: np.ndarray) -> float:
    """Half the width of the narrowest grid that costs about least with the rows outside, of those that leave at most ``FAR`` rows outside."""
    outside = rings.sum() - np.cumsum(rings)
    half = 2.0 ** (np.arange(-RINGS, RINGS + 1) / 4)
    nodes = np.minimum(np.maximum(2 * half / WIDEST, STEPS), MOST_STEPS) ** 2
    cost = np.where(outside <= FAR, nodes * (NODE_COST + outside) * np.maximum(1, 2 * half / WIDEST / MOST_STEPS), np.inf)
    return float(half[np.argmax(cost <= 2 * cost.min())])  # narrow, as its steps are then


def _row(schema: str, *values) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    return pa.table([pa.array([v], kinds[c.split()[1]]) for v, c in zip(values, schema.split(", "), strict=True)], names)


def _doubles(value: pa.Scalar, columns: int) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), float).reshape(columns, -1)


STATE = f"b int, xy binary, vg binary, {WEIGHTS}"


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _to_all(packed: DataFrame, blocks: int, *own: str) -> DataFrame:
    """Rows of blocks for every block; the columns ``own`` for itself only."""
    sent = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("to"))
    return sent.withColumns({c: F.when(F.col("to") == F.col("b"), F.col(c)) for c in own}).repartitionById(blocks, F.col("to"))


def _keys_and_start(ids: DataFrame, blocks: int, grid: Grid, seed: int) -> tuple[DataFrame, DataFrame]:
    """(b, ids) and the first state, a row for each block; ids in ascending order."""
    rows = start_positions(ids, seed).withColumn("b", _block("id", blocks)).repartitionById(blocks, F.col("b"))
    packed = "b int, ids binary, xy binary"

    def pack(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        return _row(packed, part["b"][0].as_py(), part["id"].to_numpy().astype("<i8").tobytes(), np.stack([part["x"].to_numpy(), part["y"].to_numpy()]).tobytes())

    both = staged(rows.groupBy("b").applyInArrow(pack, packed), "tsne-start")

    def begin(part: pa.Table) -> pa.Table:
        x, y = _doubles(part["xy"][0], 2)
        return _row(STATE, part["b"][0].as_py(), part["xy"][0].as_py(), np.repeat([0.0, 0.0, 1.0, 1.0], len(x)).tobytes(), *_weighed(grid, part["b"][0].as_py(), x, y))

    return both.select("b", "ids"), staged(both.groupBy("b").applyInArrow(begin, STATE), "tsne")


TILE = "b int, other int, i binary, j binary, p binary"


def _tiles(edges: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """The edges between two blocks as one row, ends as places in their blocks."""
    rows = edges.select(F.col("i").cast("long"), F.col("j").cast("long"), "p").select("*", _block("i", blocks).alias("b"), _block("j", blocks).alias("other"))

    def tile(own: pa.Table, ids: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _row(TILE, 0, 0, b"", b"", b"").slice(0, 0)
        b = own["b"][0].as_py()
        places = {k: np.frombuffer(v.as_buffer(), "<i8") for k, v in zip(ids["b"].to_pylist(), ids["ids"], strict=True)}
        i, j, p, other = (own[c].to_numpy() for c in ("i", "j", "p", "other"))
        order = np.lexsort((i, other))
        i, j, p, other = i[order], j[order], p[order], other[order]
        small = lambda at, n: at.astype("<u2" if n <= 1 << 16 else "<u4").tobytes()
        found = []
        for k in np.unique(other).tolist():
            low, high = np.searchsorted(other, [k, k + 1])
            ends = ((np.searchsorted(places[x], v[low:high]), len(places[x])) for x, v in ((b, i), (k, j)))
            found.append(_row(TILE, b, k, *(small(*e) for e in ends), p[low:high].tobytes()))
        return pa.concat_tables(found)

    left = rows.repartitionById(blocks, F.col("b")).groupBy("b")
    return left.cogroup(_to_all(keys, blocks).groupBy("to")).applyInArrow(tile, TILE)


def _pulled(tiles: pa.Table, x: np.ndarray, y: np.ndarray, others: dict[int, np.ndarray]) -> np.ndarray:
    """The sums of ``p (1 + d^2)^-1 d`` over the edges of each row."""
    pull = np.zeros((2, len(x)))
    for other, *ends, p in zip(tiles["other"].to_pylist(), tiles["i"], tiles["j"], tiles["p"], strict=True):
        p = np.frombuffer(p.as_buffer(), float)
        i, j = (np.frombuffer(e.as_buffer(), f"<u{len(e.as_buffer()) // len(p)}") for e in ends)
        for low in range(0, len(p), EDGES):
            a, b = i[low : low + EDGES], j[low : low + EDGES]
            dx, dy = x[a] - others[other][0][b], y[a] - others[other][1][b]
            w = p[low : low + EDGES] / (1 + dx * dx + dy * dy)
            first = int(a[0])
            for axis, d in enumerate((dx, dy)):
                sums = np.bincount(a - a[0], w * d)
                pull[axis, first : first + len(sums)] += sums
    return pull


def moved(state: DataFrame, tiles: DataFrame, blocks: int, grid: Grid, push: np.ndarray, far: dict[int, np.ndarray], z: float, after: Grid, rate: float, momentum: float, exaggeration: float) -> DataFrame:
    """The state after one step; ``tiles`` are cached by block, so positions are all that moves."""

    def step(edges: pa.Table, there: pa.Table) -> pa.Table:
        others = {b: _doubles(xy, 2) for b, xy in zip(there["b"].to_pylist(), there["xy"], strict=True)}
        b = there["to"][0].as_py()
        pos, vg = others[b], _doubles(there["vg"][there["b"].to_pylist().index(b)], 4)
        v, g = vg[:2], vg[2:]
        pushed = np.zeros_like(pos)
        inside = grid.inside(*pos)
        if not inside.all():
            pushed[:, ~inside] = far[b]
        for node, share in grid.shares(*pos[:, inside]):
            pushed[:, inside] += share * push[:, node]
        slope = 4 * (exaggeration * _pulled(edges, *pos, others) - pushed / z)
        g = np.maximum(np.where(slope * v < 0, g + 0.2, g * 0.8), 0.01)
        v = momentum * v - rate * g * slope
        pos = pos + v
        return _row(STATE, b, pos.tobytes(), np.concatenate([v, g]).tobytes(), *_weighed(after, b, *pos))

    there = _to_all(state.select("b", "xy", "vg"), blocks, "vg")
    return tiles.groupBy("b").cogroup(there.groupBy("to")).applyInArrow(step, STATE)


def layout(edges: DataFrame, iterations: int = 300, exaggerated: int = 250, exaggeration: float = 12.0, rate: float | None = None, seed: int = 41) -> DataFrame:
    """(id, x, y): positions in the plane after ``iterations`` steps, the first ``exaggerated`` of them with stronger attraction."""
    edges = staged(edges, "tsne-edges")
    ids = staged(edges.select(F.col("i").alias("id")).distinct(), "tsne-ids")
    rows, cores = ids.count(), edges.sparkSession.sparkContext.defaultParallelism
    least = max(1, -(-rows // BLOCK))
    blocks = max(least, min(rows // 2_000 + 1, -(-least // cores) * cores))
    grid = Grid(1e-3)  # wider than any start
    keys, state = _keys_and_start(ids, blocks, grid, seed)
    tiles = staged(_tiles(edges, keys, blocks), "tsne-tiles").repartitionById(blocks, F.col("b")).persist()
    rate = rate or max(rows / exaggeration / 4, 50.0)
    for i in range(iterations):
        rings, weights, owner, far = _weights_of(grid, state.select(*WEIGHT_COLUMNS))
        half = _best_half(rings)
        if len(owner) > FAR or half > 2 * grid.half or half < grid.half / 2:
            grid = Grid(half)
            _, weights, owner, far = _weights_of(grid, _reweighed(grid, state))
        push, pushed, z = grid.potentials(weights, rows, far)
        early, after = i < exaggerated, Grid(half)
        outside = {b: pushed[:, owner == b] for b in np.unique(owner).tolist()}
        stepped = staged(moved(state, tiles, blocks, grid, push, outside, z, after, rate, 0.5 if early else 0.8, exaggeration if early else 1.0), "tsne")
        dropped(state)
        state, grid = stepped, after
    tiles.unpersist()

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, xy in zip(batch.column(0), batch.column(1), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(own.as_buffer(), "<i8")), *(pa.array(v) for v in _doubles(xy, 2))], ["id", "x", "y"])

    return keys.join(state.select("b", "xy"), "b").select("ids", "xy").mapInArrow(plain, "id long, x double, y double")


def _reweighed(grid: Grid, state: DataFrame) -> DataFrame:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, xy in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from _row(WEIGHTS, *_weighed(grid, b, *_doubles(xy, 2))).to_batches()

    return state.select("b", "xy").mapInArrow(weigh, WEIGHTS)


def divergence(edges: DataFrame, positions: DataFrame) -> float:
    """The Kullback-Leibler divergence of positions from affinities."""
    if edges.isEmpty():
        return 0.0

    def weighed(grid: Grid) -> tuple[np.ndarray, ...]:
        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _row(WEIGHTS, *_weighed(grid, 0, *(c.to_numpy() for c in batch.columns))).to_batches()

        return _weights_of(grid, positions.select("x", "y").mapInArrow(weigh, WEIGHTS))

    rings = weighed(Grid(1.0))[0]
    grid = Grid(_best_half(rings))
    _, weights, _, far = weighed(grid)
    z = grid.potentials(weights, int(rings.sum()), far)[2]
    here = positions.toDF("i", "xi", "yi")
    there = positions.toDF("j", "xj", "yj")
    d2 = (F.col("xi") - F.col("xj")) ** 2 + (F.col("yi") - F.col("yj")) ** 2
    return edges.join(here, "i").join(there, "j").agg(F.sum(F.col("p") * F.log(F.col("p") * z * (1 + d2))).alias("kl")).first()["kl"]
