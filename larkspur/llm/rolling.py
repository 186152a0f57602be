"""Rolling exact median and median absolute deviation of each series, over haloed chunks.

A series (a kind) is cut into chunks of time as long as the window. A chunk starts with the
histogram that its halo leaves: what of the chunk before still lies in the window, each value with
the time at which it goes. The chunk then slides: values come and go, and every time that a click
asks for has two levels of sparse counts, coarse ones of the high digits and, under each high digit
that occurs, fine ones of the low digits. The median is found by walking the coarse counts and then
the fine counts of one high digit; the deviation by the run of values that lie nearest to it, whose
two ends move outward from it, so no window is ever sorted or even listed. Times of one batch are
answered together in numpy. Digits are those of a value's rank among the distinct values of its
chunk, so that they are dense.

Equal values at one time are one row with a count before anything is dealt out, and results are made
once for each (kind, time), so no single time is too large for a task. A chunk with more than
``CHUNK`` such rows is halved in time until its parts are small; a part starts with pre-aggregated
histograms of the halved intervals that its window covers, at most two of each length.

* repeated rows of one ``click_id`` are one click: of copies that differ, the least by (time, kind, cents)
  among those with a time; rows without ``click_id`` are copies of one click;
* clicks without ``ts`` are dropped; a null kind is a kind, other than an empty one;
* a null value, one that isn't finite and one of 2**58 cents or more have no cents: such a click gets its
  window's results, and a null ``far``;
* fewer than two cents in the window: ``median2``, ``mad4`` and ``far`` are null;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.spark_util import give_back_shuffles, stage_table

MINUTE = 60_000_000
#: Rows (distinct times and values) of a chunk beyond which it is halved.
CHUNK = 1 << 18
#: Most halvings.
MOST_LEVELS = 20
#: Rows that a task answers together, and times of a large chunk.
BATCH, TIMES = 1 << 14, 1 << 12
#: What a row tells: a value that comes and is asked for, one that is there until its time, one that stays.
COMES, UNTIL, STAYS = 0, 1, 2


def micros(ts: Column) -> Column:
    """Exact microseconds since 1970 of a timestamp without zone, from its parts."""
    seconds = F.unix_date(ts.cast("date")).cast("long") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def cents_of(value: Column) -> Column:
    scaled = value.cast("double") * 100.0
    return F.when(F.abs(scaled) < float(1 << 58), F.floor(scaled + 0.5)).cast("long")


def clicks_once(clicks: DataFrame) -> DataFrame:
    """(click_id, at, kind, cents): every click with a time once."""
    rows = clicks.where("ts IS NOT NULL").select("click_id", micros(F.col("ts")).alias("at"), "kind", cents_of(F.col("value")).alias("cents"))
    return rows.groupBy("click_id").agg(F.min(F.struct("at", "kind", "cents")).alias("c")).select("click_id", "c.at", "c.kind", "c.cents")


class Window:
    """The two-level histograms of some chunks at each time that is asked for.

    ``asked``: sorted keys (chunk, time) of these times; ``key, chunk, value, count``: what comes (positive) and goes,
    in any order. Nothing carries over from one chunk to the next."""

    def __init__(self, asked: np.ndarray, chunk_of_asked: np.ndarray, key: np.ndarray, chunk: np.ndarray, value: np.ndarray, count: np.ndarray) -> None:
        row = np.searchsorted(asked, key)
        use = row < len(asked)
        use[use] = chunk_of_asked[row[use]] == chunk[use]  # what comes or goes after a chunk's last time counts nowhere
        row, chunk, value, count = row[use], chunk[use], value[use], count[use]
        order = np.lexsort((value, chunk))
        c, v = chunk[order], value[order]
        new = np.append(True, (c[1:] != c[:-1]) | (v[1:] != v[:-1]))[: len(c)]
        self.values = v[new]
        self.offset = np.searchsorted(c[new], chunk_of_asked)  # of each asked time's chunk in ``values``
        digit = np.empty(len(c), np.int64)
        digit[order] = np.cumsum(new) - 1
        digit -= np.searchsorted(c[new], chunk)
        most = int(digit.max(initial=0)) + 1
        self.bits = ((most - 1).bit_length() + 1) // 2
        high, low = digit >> self.bits, digit & ((1 << self.bits) - 1)
        width, rows = (most - 1 >> self.bits) + 1, len(asked)
        first = np.searchsorted(chunk_of_asked, chunk_of_asked)  # first asked time of the same chunk
        coarse = np.zeros((rows + 1, width), np.int64)
        coarse[1:] = np.bincount(row * width + high, count, rows * width).reshape(rows, width)
        np.cumsum(coarse, axis=0, out=coarse)
        self.coarse = np.cumsum(coarse[1:] - coarse[first], axis=1)
        self.n = self.coarse[:, -1]
        # fine counts change only where something of the same high digit comes or goes: one line for each such (digit, time)
        self.lines, line = np.unique(high * rows + row, return_inverse=True)
        fine = np.zeros((len(self.lines) + 1, 1 << self.bits), np.int64)
        fine[1:] = np.bincount((line << self.bits) + low, count, len(self.lines) << self.bits).reshape(-1, 1 << self.bits)
        np.cumsum(fine, axis=0, out=fine)
        self.fine = np.cumsum(fine, axis=1, out=fine)
        self.first, self.rows = first, rows

    def smallest(self, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank ``k`` (from 0) in the windows of the asked times ``at``."""
        coarse = self.coarse[at]
        high = (coarse <= k[:, None]).sum(axis=1)
        below = np.where(high > 0, coarse[np.arange(len(at)), high - 1], 0)
        now = np.searchsorted(self.lines, high * self.rows + at, "right")
        start = np.searchsorted(self.lines, high * self.rows + self.first[at])
        low = (self.fine[now] - self.fine[start] <= (k - below)[:, None]).sum(axis=1)
        return self.values[self.offset[at] + (high << self.bits) + low]

    def medians(self) -> tuple[np.ndarray, np.ndarray]:
        """Doubled medians, and doubled medians of the doubled distances from them, where ``n`` is 2 or more; else 0."""
        median2, mad4 = np.zeros(self.rows, np.int64), np.zeros(self.rows, np.int64)
        at = np.flatnonzero(self.n >= 2)
        if not len(at):
            return median2, mad4
        n = self.n[at]
        middle = self.smallest(at, (n - 1) // 2) + self.smallest(at, n // 2)
        median2[at] = middle
        # the k values nearest to the median are a run of the ordered window; it begins at the least rank whose end is farther out
        k = (n + 1) // 2
        low, high = np.zeros(len(at), np.int64), n - k
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            a, b = self.smallest(at[open_], mid), self.smallest(at[open_], mid + k[open_])
            right = middle[open_] - 2 * a > 2 * b - middle[open_]
            low[open_] = np.where(right, mid + 1, low[open_])
            high[open_] = np.where(right, high[open_], mid)
        reach = np.maximum(middle - 2 * self.smallest(at, low), 2 * self.smallest(at, low + k - 1) - middle)
        after = reach.copy()  # an even window's second middle distance is the next one outward
        even = n % 2 == 0
        far = np.iinfo(np.int64).max
        left, right = np.full(len(at), far), np.full(len(at), far)
        x = np.flatnonzero(even & (low > 0))
        left[x] = middle[x] - 2 * self.smallest(at[x], low[x] - 1)
        x = np.flatnonzero(even & (low + k < n))
        right[x] = 2 * self.smallest(at[x], low[x] + k[x]) - middle[x]
        after[even] = np.minimum(left, right)[even]
        mad4[at] = reach + after
        return median2, mad4


def slide(chunk: np.ndarray, time: np.ndarray, value: np.ndarray, valued: np.ndarray, count: np.ndarray, role: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, n, median2, mad4) of every time of ``COMES``. ``chunk``: numbers in ascending order; ``time``: from 0 to ``window``
    in its chunk; the key is ``chunk << bits | time``."""
    bits = window.bit_length() + 1
    begin = chunk << bits
    key = begin | time
    asked = np.unique(key[role == COMES])
    comes, goes = valued, valued & (role == UNTIL)
    keys = np.concatenate([np.where(role == COMES, key, begin)[comes], key[goes]])
    chunks, values = np.concatenate([chunk[comes], chunk[goes]]), np.concatenate([value[comes], value[goes]])
    counts = np.concatenate([count[comes], -count[goes]])
    if len(asked) <= TIMES or chunk[0] != chunk[-1]:
        w = Window(asked, asked >> bits, keys, chunks, values, counts)
        return asked, w.n, *w.medians()
    # a large chunk: runs of times, each of which starts with the histogram that the runs before leave
    order = np.argsort(keys, kind="stable")
    keys, values, counts = keys[order], values[order], counts[order]
    distinct, place = np.unique(values, return_inverse=True)
    state = np.zeros(len(distinct), np.int64)
    parts, done = [], 0
    for i in range(0, len(asked), TIMES):
        run = asked[i : i + TIMES]
        to = np.searchsorted(keys, run[-1], "right")
        held = np.flatnonzero(state)
        own = np.concatenate([np.full(len(held), run[0]), keys[done:to]])
        w = Window(run, run >> bits, own, np.full(len(own), chunk[0]), np.concatenate([distinct[held], values[done:to]]), np.concatenate([state[held], counts[done:to]]))
        parts.append((run, w.n, *w.medians()))
        np.add.at(state, place[done:to], counts[done:to])
        done = to
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def answers(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows (kind, span, part, time, cents, m, role), chunk by chunk, to (kind, at, n, median2, mad4)."""
    held, rows, enough = [], 0, BATCH
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            rows += batch.num_rows
        if not held or batch is not None and rows < enough:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        column = {c: t.column(c).combine_chunks() for c in t.column_names}
        kind = pc.dictionary_encode(column["kind"], null_encoding="encode")
        kind = (kind.combine_chunks() if isinstance(kind, pa.ChunkedArray) else kind).indices.to_numpy()
        span, part = column["span"].to_numpy(), column["part"].to_numpy()
        new = np.append(True, (kind[1:] != kind[:-1]) | (span[1:] != span[:-1]) | (part[1:] != part[:-1]))[: len(kind)]
        starts = np.flatnonzero(new)
        end = len(kind) if batch is None else int(starts[-1]) if len(starts) else 0  # the last chunk may go on
        held, rows = ([], 0) if batch is None else ([t.slice(end).combine_chunks().to_batches()[0]], len(kind) - end)
        enough = max(BATCH, 2 * rows)
        if not end:
            continue
        chunk = np.cumsum(new) - 1
        cents = column["cents"]
        valued = cents.is_valid().to_numpy(zero_copy_only=False)
        every = [x[:end] for x in (chunk, column["time"].to_numpy(), cents.fill_null(0).to_numpy(), valued, column["m"].to_numpy(), column["role"].to_numpy())]
        cuts = [0]  # whole chunks of together at most ``BATCH`` rows, or one larger chunk
        for a, b in itertools.pairwise([*starts[starts < end].tolist(), end]):
            if b - cuts[-1] > BATCH and a > cuts[-1]:
                cuts.append(a)
        cuts.append(end)
        for a, b in itertools.pairwise(cuts):
            key, n, median2, mad4 = slide(*(x[a:b] for x in every), window)
            if len(key):
                bits = window.bit_length() + 1
                of = starts[key >> bits]
                yield pa.RecordBatch.from_arrays(
                    [column["kind"].take(pa.array(of)), pa.array(span[of] * window + (key & ((1 << bits) - 1))), pa.array(n), pa.array(median2), pa.array(mad4)], ["kind", "at", "n", "median2", "mad4"]
                )


def halvings(cells: DataFrame, window: int, chunk: int) -> DataFrame:
    """(kind, span, level) of the chunks with over ``chunk`` rows: halved ``level`` times, their fullest sixtieth is cut enough too."""
    minutes = cells.groupBy("kind", "span", F.expr(f"time div {window // 60}").alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    spans = minutes.groupBy("kind", "span").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    level = F.least(F.lit(MOST_LEVELS), F.greatest(F.lit(1), F.ceil(F.log2(F.col("most") * 60.0 / chunk)))).cast("int")
    return spans.where(F.col("n") > chunk).select("kind", "span", level.alias("level"))


def halo_parts(cells: DataFrame, span: Column, part: Column, level: Column, odd: int) -> DataFrame:
    """What stays for the whole of a part: the counts of each halved interval go to all parts under its sibling. ``odd`` = 0: intervals
    before, of the same chunk; 1: intervals of the chunk before that the window still covers, whatever the time in the part."""
    counts = cells.groupBy("kind", span.alias("span"), level.alias("level"), part.alias("part"), "cents").agg(F.sum("m").alias("m"))
    each = counts.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("level") - 1)))
    each = each.withColumn("node", F.expr("shiftright(part, j)")).where(F.col("node") % 2 == odd)
    nodes = each.groupBy("kind", "span", "j", "node", "cents").agg(F.sum("m").alias("m"))
    first = F.expr(f"shiftleft(node {'-' if odd else '+'} 1, j)")
    return nodes.select("kind", "span", F.explode(F.sequence(first, first + F.expr("shiftleft(1, j) - 1"))).alias("part"), F.lit(0).cast("long").alias("time"), "cents", "m", F.lit(STAYS).alias("role"))


def window_statistics(once: DataFrame, minutes: int = 60, chunk: int = CHUNK) -> DataFrame:
    """(kind, at, n, median2, mad4) of every (kind, at) of ``once``, a staged table of ``clicks_once``."""
    window = minutes * MINUTE
    cells = once.groupBy("kind", "at", "cents").agg(F.count(F.lit(1)).alias("m"))
    cells = cells.withColumn("time", F.pmod(F.col("at"), F.lit(window))).withColumn("span", F.expr(f"(at - time) div {window}"))
    levels = stage_table(halvings(cells, window, chunk), "rolling-levels")
    give_back_shuffles(once.sparkSession)
    halved = not levels.isEmpty()
    if halved:
        own = levels.toDF("_k0", "_s0", "level")
        then = levels.toDF("_k1", "_s1", "next_level")
        cells = cells.join(own, F.col("kind").eqNullSafe(F.col("_k0")) & (F.col("span") == F.col("_s0")), "left")
        cells = cells.join(then, F.col("kind").eqNullSafe(F.col("_k1")) & (F.col("span") + 1 == F.col("_s1")), "left")
        cells = cells.select("kind", "at", "cents", "m", "span", "time", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("next_level", F.lit(0)).alias("next_level"))
    else:
        cells = cells.withColumn("level", F.lit(0)).withColumn("next_level", F.lit(0))
    part = lambda level: F.expr(f"(time * shiftleft(1L, {level})) div {window}").cast("int")
    row = lambda span, at, role: F.struct(span.alias("span"), at.alias("part"), F.lit(role).alias("role"))
    two = F.array(row(F.col("span"), part("level"), COMES), row(F.col("span") + 1, part("next_level"), UNTIL))
    rows = cells.select("kind", "time", "cents", "m", F.explode(two).alias("r")).where(f"r.role = {COMES} OR cents IS NOT NULL")
    rows = rows.select("kind", "r.span", "r.part", "time", "cents", "m", "r.role")
    if halved:
        valued = cells.where("cents IS NOT NULL")
        rows = rows.unionByName(halo_parts(valued.where("level > 0"), F.col("span"), part("level"), F.col("level"), 0))
        rows = rows.unionByName(halo_parts(valued.where("next_level > 0"), F.col("span") + 1, part("next_level"), F.col("next_level"), 1))
    dealt = rows.repartition("kind", "span", "part").sortWithinPartitions("kind", "span", "part")
    return dealt.mapInArrow(lambda batches: answers(batches, window), "kind string, at long, n long, median2 long, mad4 long")


def rolling_medians(clicks: DataFrame, minutes: int = 60, chunk: int = CHUNK) -> DataFrame:
    """(click_id, kind, n, median2, mad4, far) of every click with a time: its window are the cents of its kind
    in the ``minutes`` up to its time, itself and all at its time included."""
    once = stage_table(clicks_once(clicks), "clicks-once")
    give_back_shuffles(clicks.sparkSession)
    found = stage_table(window_statistics(once, minutes, chunk).toDF("_kind", "_at", "n", "median2", "mad4"), "window-statistics")
    give_back_shuffles(clicks.sparkSession)
    rows = once.join(found, once["kind"].eqNullSafe(found["_kind"]) & (once["at"] == found["_at"]))
    several = lambda x: F.when(F.col("n") >= 2, x)
    far = 2 * F.abs(2 * F.col("cents") - F.col("median2")) > 3 * F.col("mad4")
    return rows.select("click_id", "kind", "n", several(F.col("median2")).alias("median2"), several(F.col("mad4")).alias("mad4"), several(far).alias("far"))
