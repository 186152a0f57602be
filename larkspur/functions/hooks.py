"""Model hooks: a model is a picklable factory; each Python worker loads it once for a task and gets whole batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Model = Callable[[list], np.ndarray]


def embed(df: DataFrame, key: str, column: str, load: Callable[[], Model]) -> DataFrame:
    """M2, M4 to M6 and M9: (key, embedding) from a model that maps a list of inputs to a matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            out = np.asarray(model(batch.column(1).to_pylist()), np.float32) if batch.num_rows else np.zeros((0, 1), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.tolist(), pa.list_(pa.float32()))], [key, "embedding"])

    return df.select(key, column).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, embedding array<float>")


def label_scores(df: DataFrame, key: str, column: str, labels: list[str], load: Callable[[], Model]) -> DataFrame:
    """M1 and M3: (key, label, score) from a model that maps inputs to one row of label scores each, also for a batch of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = np.asarray(model(batch.column(1).to_pylist()), float).reshape(batch.num_rows, len(labels))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), len(labels)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(labels * batch.num_rows), pa.array(scores.ravel())], [key, "label", "score"])

    return df.select(key, column).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, label string, score double")


def keyword_model(keywords: list[list[str]]) -> Callable[[], Model]:
    """A stand-in model: a label scores 1 where one of its words occurs."""

    def load() -> Model:
        return lambda texts: np.array([[float(any(w in (t or "").lower() for w in words)) for words in keywords] for t in texts])

    return load
