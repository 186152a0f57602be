"""Best-fit packing of tokenised documents into fixed-length sequences, bulk-synchronous.

Documents are tokenised where they are read and cut into pieces. Pieces longer than half a
sequence open one each; what they leave is the first table of gaps. Shorter pieces follow in
supersteps of halving lengths, longest first. In a superstep the pieces of its lengths and all
gaps that hold the shortest of them are sorted together by size over the cluster, in ranges
of bounded size. Each range is swept from large to small: a piece takes its successor, the
smallest gap that holds it; pieces of a range that want the same gap take it by rank, in the
order of the sweep; what it leaves is a gap of the sweep again. Pieces whose successor lies in
another range are left over; they and the remaining gaps are dealt evenly and swept once more,
where a piece without a gap opens a sequence. Then the gaps are updated, and the next
superstep begins. Where one range holds everything, this is best fit by decreasing length.

* null text counts as empty: one end token; equal rows are packed like any others;
* documents longer than ``seq_len`` are cut into pieces, the first of which may be shorter;
* an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.bpe import ByteBpe
from larkspur.llm.spark_util import arrow_rows, drop_table, give_back_memory, stage_table

#: Rows of a range, about.
RANGE = 50_000
#: The last superstep holds all lengths up to this one.
SHORT = 32
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, id long"
#: A piece that has its place (1), one that is left over (2), or a gap (0) of sequence ``id``.
SWEPT = "kind int, size long, id long, doc_id long, piece int, start long, ids_crc32 long, sequence_id long, offset long"
_GAP, _PLACED, _LEFT = 0, 1, 2


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, seq_len: int, end_id: int) -> DataFrame:
    """One row for each piece; ``id`` is unique in the table once it is staged."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at_id = TaskContext.get().partitionId() << 36
        bpe = ByteBpe.load(tokenizer_path)
        for batch in batches:
            ids = batch.column(0)
            rows: list[list] = [[], [], [], []]
            keep = []
            for at, tokens in bpe.encode_column(batch.column(1)):
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                n = len(tokens)
                first = (n - 1) % seq_len + 1
                edges = [0, *range(first, n + 1, seq_len)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    keep.append(at)
                    for column, value in zip(rows, (k, a, b - a, zlib.crc32(tokens[a:b])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())), pa.array(rows[0], pa.int32()), *[pa.array(x, pa.int64()) for x in rows[1:4]], pa.array(at_id + np.arange(len(keep)))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "id"],
            )
            at_id += len(keep)
        give_back_memory()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


class Gaps:
    """Gaps by size, each of one sequence."""

    def __init__(self) -> None:
        self.sizes: list[int] = []  # sizes that have gaps, sorted
        self.of: dict[int, list[int]] = {}

    def put(self, size: int, sequence: int) -> None:
        if size <= 0:
            return
        if size not in self.of:
            insort(self.sizes, size)
            self.of[size] = []
        self.of[size].append(sequence)

    def take(self, length: int) -> tuple[int, int] | None:
        """(size, sequence) of the smallest gap that holds ``length``."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        size = self.sizes[at]
        own = self.of[size]
        sequence = own.pop()
        if not own:
            del self.of[size], self.sizes[at]
        return size, sequence


def sweep(rows: DataFrame, seq_len: int, step: int, opens: bool) -> DataFrame:
    """One sweep over sorted partitions. ``rows``: (kind, size, id, doc_id, piece, start, ids_crc32); with ``opens`` a piece
    that no gap holds opens a sequence, else it is left over."""
    names = [x.split(" ")[0] for x in SWEPT.split(", ")]
    types = [pa.int32() if x.endswith(" int") else pa.int64() for x in SWEPT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fresh = itertools.count(step << 57 | TaskContext.get().partitionId() << 36)
        gaps = Gaps()

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * len(names), types, strict=True)], names)

        for batch in batches:
            out = []
            for kind, size, key, doc, piece, start, crc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == _GAP:
                    gaps.put(size, key)
                    continue
                found = gaps.take(size)
                if found is None and not opens:
                    out.append((_LEFT, size, key, doc, piece, start, crc, None, None))
                    continue
                gap, sequence = found or (seq_len, next(fresh))
                out.append((_PLACED, size, key, doc, piece, start, crc, sequence, seq_len - gap))
                gaps.put(gap - size, sequence)
            yield batch_of(out)
        every = ((_GAP, size, key, None, None, None, None, None, None) for size in gaps.sizes for key in gaps.of[size])
        while some := list(itertools.islice(every, 10_000)):
            yield batch_of(some)

    return rows.sortWithinPartitions(F.col("size").desc(), "kind", F.xxhash64("id"), "id").mapInArrow(run, SWEPT)


def best_fit_pack(docs: DataFrame, tokenizer_path: str, seq_len: int = 1024, end_id: int = 2) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    with arrow_rows(docs.sparkSession, 2000):
        pieces = stage_table(tokenised_pieces(docs, tokenizer_path, seq_len, end_id), "pack-pieces")
    return place_pieces(pieces, seq_len)


def place_pieces(pieces: DataFrame, seq_len: int) -> DataFrame:
    """The places of a staged table of pieces."""
    half = seq_len // 2
    steps, high = [], half
    while high:
        low = high // 2 if high > SHORT else 0
        steps.append((low, high))
        high = low
    band = F.lit(0)
    for i, (low, high) in enumerate(steps, 1):
        band = F.when((F.col("length") > low) & (F.col("length") <= high), i).otherwise(band)
    # one row for each superstep comes back
    counts = {r["band"]: r["n"] for r in pieces.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = pieces.select(F.lit(_LEFT).alias("kind"), F.col("length").alias("size"), "id", "doc_id", "piece", "start", "ids_crc32")
    columns = asked.columns
    none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("piece", "int"), ("start", "long"), ("ids_crc32", "long"))]
    placed = asked.where(F.col("size") > half).withColumn("sequence_id", F.col("id")).withColumn("offset", F.lit(0).cast("long"))
    gaps = placed.where(F.col("size") < seq_len).select(F.lit(_GAP).alias("kind"), (seq_len - F.col("size")).alias("size"), "id", *none)
    for step, (low, high) in enumerate(steps, 1):
        if not counts.get(step):
            continue
        todo = asked.where((F.col("size") > low) & (F.col("size") <= high))
        both = todo.unionByName(gaps.where(F.col("size") > low))
        ranges = -(-(counts[step] + gaps.where(F.col("size") > low).count()) // RANGE)
        if ranges > 1:  # with one range nothing is left over
            swept = stage_table(sweep(both.repartitionByRange(ranges, F.col("size").desc(), F.xxhash64("id")), seq_len, step, False), "pack-swept")
            placed = placed.unionByName(swept.where(F.col("kind") == _PLACED).select(placed.columns))
            both = swept.where(F.col("kind") != _PLACED).select(columns)
        last = stage_table(sweep(both.repartition(ranges, F.xxhash64("id")), seq_len, step, True), "pack-swept")
        placed = placed.unionByName(last.where(F.col("kind") == _PLACED).select(placed.columns))
        small, before = gaps.where(F.col("size") <= low), gaps
        gaps = stage_table(small.unionByName(last.where(F.col("kind") == _GAP).select(columns)), "pack-gaps")
        drop_table(before)
    return placed.select("doc_id", "piece", "start", F.col("size").alias("length"), "ids_crc32", "sequence_id", "offset")
