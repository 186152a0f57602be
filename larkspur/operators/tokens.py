"""Token ids through an encoder hook: image sentinels and loss masks. Hooks run on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the id that stands for an image and of the label that takes no part in the loss.
IMAGE_ID = -200
IGNORED = -100
#: Tokens that a task gives on at once, about.
HELD = 1 << 18
Encoder = Callable[[str], list[int]]


def with_sentinels(prompt: str, encode: Encoder, bos: int | None = None, image_id: int = IMAGE_ID) -> list[int]:
    """The ids of the pieces between ``<image>`` marks, one sentinel between two; only the first piece keeps the start id."""
    first, *rest = [encode(piece) for piece in prompt.split("<image>")]
    starts = bos is not None and first[:1] == [bos]
    out = list(first)
    for ids in rest:
        out += [image_id, *ids[int(starts) :]]
    return out


def image_token_ids(prompt: Column, encode: Encoder, bos: int | None = None, image_id: int = IMAGE_ID) -> Column:
    """X15 for a column; null counts as empty."""

    @F.pandas_udf("array<long>")
    def run(prompts: pd.Series) -> pd.Series:
        return prompts.map(lambda p: with_sentinels(p or "", encode, bos, image_id))

    return run(prompt)


def _both(conversation: list[dict] | None, encode: Encoder, bos: int | None) -> dict[str, list[int]]:
    ids, labels = [], []
    for i, turn in enumerate(conversation if conversation is not None else ()):
        own = with_sentinels(turn["text"] or "", encode, bos)
        own = own[1:] if i and bos is not None and own[:1] == [bos] else own
        ids += own
        labels += own if turn["role"] == "assistant" else [IGNORED] * len(own)
    return {"ids": ids, "labels": labels}


def masked_ids(turns: Column, encode: Encoder, bos: int | None = None) -> Column:
    """X10 by token: ``turns`` is an array of (role, text); a struct of the conversation's ids and of its labels, which
    are the ids of assistant turns and ``IGNORED`` elsewhere. Later turns lose the start id."""

    @F.pandas_udf("ids array<long>, labels array<long>")
    def run(conversations: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_both(x, encode, bos) for x in conversations], columns=["ids", "labels"])

    return run(turns)


def masked_rows(rows: DataFrame, key: str, turns: str, encode: Encoder, bos: int | None = None) -> DataFrame:
    """X10 by token for a table: (key, ids, labels). A task holds the ids of about ``HELD`` tokens, not those of a whole batch of conversations."""
    kind = rows.schema[key].dataType.simpleString()
    lists = lambda parts: pa.LargeListArray.from_arrays(np.cumsum([0, *map(len, parts)]), np.concatenate(parts)).cast(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, held, ids, labels = 0, 0, [], []
            for n in range(batch.num_rows):
                both = _both(batch.column(1)[n].as_py(), encode, bos)
                ids.append(np.array(both["ids"], np.int64))
                labels.append(np.array(both["labels"], np.int64))
                held += len(ids[-1])
                if held >= HELD or n + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n + 1 - first), lists(ids), lists(labels)], ["key", "ids", "labels"])
                    first, held, ids, labels = n + 1, 0, [], []

    return rows.select(F.col(key).alias("key"), turns).mapInArrow(run, f"key {kind}, ids array<long>, labels array<long>").withColumnRenamed("key", key)
