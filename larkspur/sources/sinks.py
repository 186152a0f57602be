"""Writers: metric documents, report wrappers, CSV, JSON lines and manifests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ranks import global_rank


def wide(long: DataFrame, value: str, labels: list[str]) -> DataFrame:
    """O1: one column for each label; the label list makes the pivot one pass."""
    return long.groupBy(F.col("key").alias("AccessionNo")).pivot("label", labels).agg(F.first(value))


def write_csv(df: DataFrame, path: str) -> None:
    """O1."""
    df.write.mode("overwrite").csv(path, header=True)


def metric_document(sections: dict[str, DataFrame]) -> DataFrame:
    """O2 and O3: one row ``json``: each one-row frame becomes a named section."""
    parts = [df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)) for name, df in sections.items()]
    one = reduce(lambda a, b: a.crossJoin(b), parts)  # one row each
    return one.select(F.to_json(F.struct(*sections)).alias("json"))


def flat_merge(maps: list[Column], sentinel: str = "failed") -> Column:
    """Later maps win, nulls go; an empty result says that the run failed."""
    entries = F.flatten(F.array(*[F.map_entries(F.coalesce(m, F.create_map().cast("map<string,double>"))) for m in maps]))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    last = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
    kept = F.map_filter(last, lambda _, v: v.isNotNull())
    return F.when(F.size(kept) == 0, F.to_json(F.struct(F.lit(sentinel).alias("status")))).otherwise(F.to_json(kept))


#: Reports of one wrapper document.
WRAPPED = 256


def _wrapped(rows: Column, name: str, kind: str) -> Column:
    version = F.struct(F.lit(1).alias("major"), F.lit(0).alias("minor"))
    return F.to_json(F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), rows.alias("generated_reports"), version.alias("version")))


def report_wrapper(reports: DataFrame, name: str, kind: str) -> DataFrame:
    """``{name, type, generated_reports[], version}`` as one JSON row, reports in key order. For tables that fit in a row."""
    rows = F.array_sort(F.collect_list(F.struct("input_image_name", "report")))
    return reports.agg(rows.alias("r")).select(_wrapped(F.col("r"), name, kind).alias("json"))


def report_wrappers(reports: DataFrame, name: str, kind: str, size: int = WRAPPED) -> DataFrame:
    """O5 for tables of any size: (part, json) documents of ``size`` reports each; parts and the reports in them are in key order."""
    placed = global_rank(reports.select("input_image_name", "report"), F.col("input_image_name"), "_r", (F.col("report"),))
    parts = placed.groupBy(F.floor(F.col("_r") / size).alias("part")).agg(F.array_sort(F.collect_list(F.struct("input_image_name", "report"))).alias("r"))  # size at most
    return parts.select("part", _wrapped(F.col("r"), name, kind).alias("json"))


def ordered_digest(rows: DataFrame, order: str, line: str, separator: str = "|") -> DataFrame:
    """One row (digest, n): the md5 of all ``line`` in the order of ``order``, joined by ``separator`` (null lines left out, null without any),
    and the number of rows. An md5 of a whole is a fold over its bytes in order, so they pass one task, which sorts on disk and holds a batch."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, some, n = hashlib.md5(), False, 0
        for batch in batches:
            n += batch.num_rows
            for value in batch.column(0).cast(pa.binary()):
                if value.is_valid:
                    if some:
                        state.update(separator.encode())
                    state.update(value.as_buffer())
                    some = True
        yield pa.RecordBatch.from_pydict({"digest": pa.array([state.hexdigest() if some else None], pa.string()), "n": pa.array([n], pa.int64())})

    one = rows.select(F.col(order).alias("_o"), F.col(line).alias("_l")).repartition(1).sortWithinPartitions("_o", "_l")
    return one.select("_l").mapInArrow(fold, "digest string, n long").agg(F.max("digest").alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def write_chunked(df: DataFrame, path: str, rows: int = 10_000) -> None:
    """O11."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("append").json(path)


def write_manifests(df: DataFrame, name: str, split: str, path: str) -> None:
    """One text folder for each split, names sorted."""
    for value in ("train", "valid"):
        df.where(F.col(split) == value).select(F.col(name).alias("value")).orderBy("value").write.mode("overwrite").text(f"{path}/{value}")


def summary_by_run(metrics: DataFrame, runs: list[str]) -> DataFrame:
    """(label, run, value) as one column for each run."""
    return metrics.groupBy("label").pivot("run", runs).agg(F.first("value"))
