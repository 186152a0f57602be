"""Files that Spark has no writer for, and XML articles.

Writers put one file for each row into a folder that all executors and the driver mount; a file
is complete when it has its name, so a task that runs again changes nothing.
"""

from __future__ import annotations

import gzip
import io
import os
import struct
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.sources.volumes import read_volumes


def write_files(files: DataFrame, directory: str) -> DataFrame:
    """Write rows (name, content) as files; the written names come back. Lazy: the files exist once the result is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(directory, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = os.path.join(directory, f".{uuid.uuid4().hex}")
                with open(part, "wb") as f:
                    f.write(content.as_py())
                os.replace(part, os.path.join(directory, name))
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    return files.select("name", "content").mapInArrow(run, "name string")


def npz_content(values: Column, name: str = "arr") -> Column:
    """The bytes of an NPZ file with one array, a leading axis of 1 as its readers expect."""

    @F.pandas_udf("binary")
    def run(rows: pd.Series) -> pd.Series:
        def one(x: np.ndarray | None) -> bytes | None:
            if x is None:
                return None
            out = io.BytesIO()
            np.savez(out, **{name: np.asarray(x, np.float32)[None]})
            return out.getvalue()

        return rows.map(one)

    return run(values)


def nifti_bytes(array: np.ndarray, spacing: tuple[float, ...]) -> bytes:
    """A compressed single-file NIfTI of 32-bit floats."""
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, array.ndim, *array.shape, *[1] * (7 - array.ndim))
    struct.pack_into("<2h", head, 70, 16, 32)
    struct.pack_into("<8f", head, 76, 1.0, *spacing, *[1.0] * (7 - array.ndim))
    struct.pack_into("<3f", head, 108, 352.0, 1.0, 0.0)
    head[344:348] = b"n+1\0"
    return gzip.compress(bytes(head) + np.asfortranarray(array, "<f4").tobytes(order="F"), 1, mtime=0)


def convert_volumes(spark, source: str, target: str) -> DataFrame:  # noqa: ANN001
    """Every MetaImage below ``source`` as ``<stem>.nii.gz`` in ``target``; those that are there already are not made
    again. The names of all, sorted, are the file list. Axes keep the order of the array."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"(?i)\.mha$", "")
    volumes = read_volumes(spark, source).where(F.lower("path").endswith(".mha")).withColumn("name", F.concat(stem, F.lit(".nii.gz")))
    here = spark.createDataFrame([(x,) for x in (os.listdir(target) if os.path.isdir(target) else ())], "name string")

    @F.pandas_udf("binary")
    def content(voxels: pd.Series, shape: pd.Series, spacing: pd.Series) -> pd.Series:
        return pd.Series([nifti_bytes(np.frombuffer(v, "<f4").reshape(tuple(s)), tuple(p)) for v, s, p in zip(voxels, shape, spacing, strict=True)])

    new = volumes.join(here, "name", "left_anti").select("name", content("voxels", "shape", "spacing").alias("content"))
    return write_files(new, target).union(volumes.select("name").join(here, "name", "left_semi")).distinct().orderBy("name")


def parse_articles(xml: Column) -> Column:
    """S16, the half without network: a struct of an article's title and of the text of the ``sec``, ``title`` and ``p``
    elements of its body, one a line. No title: ``No Title``; text that is not XML: null."""

    @F.pandas_udf("title string, full_text string")
    def run(texts: pd.Series) -> pd.DataFrame:
        def one(text: str | None) -> tuple[str | None, str | None]:
            try:
                root = ET.fromstring(text or "")
            except ET.ParseError:
                return None, None
            title = root.find(".//article-title")
            parts = [x.text.strip() for body in root.iter("body") for x in body.iter() if x.tag in ("sec", "title", "p") and x.text]
            return ("No Title" if title is None else title.text), "\n".join(parts)

        return pd.DataFrame([one(x) for x in texts], columns=["title", "full_text"])

    return run(xml)
