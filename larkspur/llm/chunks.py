"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes is taken at every byte. Cuts are normalised: below the
target size a chunk ends only where eight hash bits are zero, above it where five are, so
sizes gather near the target, and a cut depends on nearby content only: an insertion moves
the cuts around it and no others. A fingerprint is the set of chunk digests with their
lengths; two are compared by the length of the chunks they share.

* null text counts as empty; the fingerprint of an empty text is the empty string, which
  is like another empty one (1) and like nothing else (0);
* equal texts have equal fingerprints; repeated rows are kept, in the order of their texts;
* rows without ``doc_id`` come before all others; rows that share an id are sorted by one task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.text_arrays import _CODES, mix, span_hashes, text_slices

MIN_BYTES, TARGET_BYTES, MAX_BYTES = 32, 64, 256
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash ``sum gear[b[i-j]] << j`` of the last 32 bytes, by doubling."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h = longer
    return h


def cut_points(n: int, hard: list[int], easy: list[int], lo: int, hard_at: int, easy_at: int) -> list[int]:
    """Ends of the chunks of ``n`` bytes from ``lo`` on; ``hard`` and ``easy`` hold the ends allowed by either mask."""
    cuts, at, stop = [], lo, lo + n
    while stop - at > MIN_BYTES:
        hard_at = bisect_left(hard, at + MIN_BYTES, hard_at)
        if hard_at < len(hard) and hard[hard_at] < min(at + TARGET_BYTES, stop):
            at = hard[hard_at]
        else:
            easy_at = bisect_left(easy, at + TARGET_BYTES, easy_at)
            found = easy[easy_at] if easy_at < len(easy) else stop
            at = min(found, at + MAX_BYTES, stop)
        cuts.append(at)
    if at < stop:
        cuts.append(stop)
    return cuts


def fingerprints(column: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct chunk values: 56 bits of digest, 8 of length - 1."""
    out: list[np.ndarray] = []
    for low, high, data, offsets in text_slices(column):
        if not len(data):
            out += [np.zeros(0, np.uint64)] * (high - low)
            continue
        h = gear_hashes(data)
        hard = (np.flatnonzero(h >> np.uint32(24) == 0) + 1).tolist()
        easy = (np.flatnonzero(h >> np.uint32(27) == 0) + 1).tolist()
        ends: list[int] = []
        counts = []
        for i in range(high - low):
            a, b = int(offsets[i]), int(offsets[i + 1])
            own = cut_points(b - a, hard, easy, a, bisect_left(hard, a), bisect_left(easy, a))
            ends += own
            counts.append(len(own))
        stops = np.array(ends, np.int64)
        starts = np.empty_like(stops)
        first = np.cumsum(counts) - counts
        starts[1:] = stops[:-1]
        has = np.array(counts) > 0
        starts[first[has]] = offsets[:-1][has]
        values = (span_hashes(_CODES[data], starts, stops) & np.uint64(0xFFFFFFFFFFFFFF00)) | (stops - starts - 1).astype(np.uint64)
        out += [np.unique(values[f : f + c]) for f, c in zip(first.tolist(), counts, strict=True)]
    return out


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").tobytes().hex()


def weight(fingerprint: np.ndarray) -> int:
    return int((fingerprint & np.uint64(0xFF)).sum()) + len(fingerprint)


def containment(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Share of ``a`` found in ``b`` and of ``b`` found in ``a``, by chunk length."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    shared = weight(np.intersect1d(a, b, assume_unique=True))
    return shared / weight(a), shared / weight(b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The smaller containment: 1 for equal fingerprints only."""
    return min(containment(a, b))


#: Bytes of text in a part, about.
PART_BYTES = 32 << 20


def parts_for(docs: DataFrame) -> int:
    """Parts of bounded size: as many as the corpus needs, and not fewer than the session's shuffles have."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))


def in_id_order(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (p, last, _id, doc_id, text) sorted by (p, last, _id, text): each part holds a range of ids and, marked
    ``last``, the first row of the next part (of the first part after the last). One shuffle moves the texts; a number or
    two for each part come to the driver."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = keyed.select("_id")
    bounds = sorted({int(x) for x in ids.approxQuantile("_id", [i / parts for i in range(1, parts)], 0.2 / parts)}) if parts > 1 else []
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def part(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, x.to_numpy(), "right").astype(np.int32))

    firsts = sorted((r["p"], r["_id"]) for r in ids.groupBy(part("_id").alias("p")).agg(F.min("_id").alias("_id")).collect())
    heads = np.array([first for _, first in firsts], np.int64)
    before = np.array([firsts[k - 1][0] for k in range(len(firsts))], np.int32)

    @F.pandas_udf("array<struct<p:int,last:boolean>>")
    def places(x: pd.Series) -> pd.Series:
        own = x.to_numpy()
        p = np.searchsorted(edges, own, "right")
        at = np.minimum(np.searchsorted(heads, own), len(heads) - 1)
        return pd.Series([[{"p": int(a), "last": False}] + ([{"p": int(before[k]), "last": True}] if first else []) for a, k, first in zip(p, at, heads[at] == own, strict=True)])

    copies = places("_id")
    spread = keyed.select("_id", "doc_id", "text", F.explode(copies).alias("c")).select("c.p", "c.last", "_id", "doc_id", "text")
    return spread.repartition(parts, "p").sortWithinPartitions("p", "last", "_id", "text")


def edited_pairs(docs: DataFrame, parts: int) -> DataFrame:
    """Fingerprints of each text and of its edited text: the last quarter of its code points replaced by as many of the
    next document by ``doc_id`` (the first after the last), with the likeness to the edited and to the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def answer(rows: list[tuple]) -> pa.RecordBatch:
            """For all rows but the last, which is only their neighbour."""
            texts = [r[3] for r in rows]
            own = fingerprints(pa.array(texts, pa.string()))
            out = []
            edited = []
            for (p, last, doc, text), (p2, _, _, following) in zip(rows, rows[1:], strict=False):
                quarter = len(text) // 4
                edited.append(text[: len(text) - quarter] + following[:quarter] if p == p2 and not last else "")
                out.append((doc, len(text)))
            changed = fingerprints(pa.array(edited, pa.string()))
            keep = [i for i in range(len(rows) - 1) if not rows[i][1]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([out[i][0] for i in keep], pa.int64()),
                    pa.array([out[i][1] for i in keep], pa.int64()),
                    pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
                    pa.array([as_text(own[i]) for i in keep], pa.string()),
                    pa.array([as_text(changed[i]) for i in keep], pa.string()),
                    pa.array([likeness(own[i], changed[i]) for i in keep], pa.float64()),
                    pa.array([likeness(own[i], own[i + 1]) for i in keep], pa.float64()),
                ],
                names,
            )

        held: list[tuple] = []
        size = 0
        for batch in batches:
            for p, last, doc, text in zip(batch.column(0), batch.column(1), batch.column(2), batch.column(3), strict=True):
                row = (p.as_py(), last.as_py(), doc.as_py(), text.as_py())
                held.append(row)
                size += len(row[3])
                if size > 1_000_000 and len(held) > 1:
                    yield answer(held)
                    held = held[-1:]
                    size = len(held[0][3])
        if len(held) > 1:
            yield answer(held)

    ordered = in_id_order(docs, parts).select("p", "last", "doc_id", "text")
    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
