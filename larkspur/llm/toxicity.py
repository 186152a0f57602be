"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of hashed embeddings of the word and of its prefixes, so
inflected forms of a known stem are near it. Filters of several widths run over all words
of a text, the maximum over positions is taken, and a logistic unit weighs the maxima. The
model is trained in numpy on a bounded sample of labelled rows, a fifth of which takes no part
in the steps: its loss ends the training and it calibrates the thresholds by language.
Scoring streams whole texts through Arrow batches and moves no text between executors.

* scores depend on the text only; empty and null texts get the model's score of no words;
* very long texts are scored whole: the maximum runs over every word;
* rows of ``labels`` without label or document are not used, of several rows of a document
  the largest label counts; with no labelled rows all texts get score 0;
* other columns pass through untouched; a column called as the score (``name``) is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur.llm.spark_util import arrow_rows, give_back_memory
from larkspur.llm.text_arrays import _CODES, _LOWER, U, span_hashes, text_slices

#: Bounds of the labelled rows that training reads, and of their texts together; every feature of two of them has an embedding.
TRAIN_ROWS, TRAIN_BYTES = 6_000, 64 << 20
#: Most passes over them; the loss on the rows that are kept out ends them sooner.
EPOCHS = 8
PREFIXES = (4, 5, 6)
WIDTHS = (1, 2, 3)
FILTERS, DIM = 8, 8
_WORD = np.zeros(256, bool)
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, distinct words' features, word number at each position, first position of each text)."""
    for low, high, data, offsets in text_slices(column):
        data = _LOWER[data]
        word = _WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        first = np.searchsorted(starts, offsets)
        if not len(starts):
            yield low, high, np.zeros((0, 1 + len(PREFIXES)), U), np.zeros(0, np.int64), first
            continue
        codes = _CODES[data]
        whole = span_hashes(codes, starts, ends)
        _, example, at = np.unique(whole, return_index=True, return_inverse=True)
        s, e = starts[example], ends[example]
        features = [whole[example]]
        for k in PREFIXES:  # a word shorter than the prefix has no such feature
            h = span_hashes(codes, s, np.minimum(s + k, e)) ^ U(0x1234567 * k)
            features.append(np.where(e - s > k, h, U(0)))
        yield low, high, np.stack(features, axis=1), at, first


@dataclass
class ConvModel:
    keys: np.ndarray  # sorted feature hashes
    table: np.ndarray  # their embeddings, and a last row of zeros
    filters: list[np.ndarray]  # for each width (width, DIM, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str, float]

    def copy(self) -> ConvModel:
        return ConvModel(self.keys, self.table.copy(), [f.copy() for f in self.filters], self.bias.copy(), self.weights.copy(), self.offset, dict(self.thresholds))

    def rows_of(self, features: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(features.shape, len(self.table) - 1)
        at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
        return np.where(self.keys[at] == features, at, len(self.table) - 1)

    def pooled(self, vectors: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Maxima of all filters over each text; ``vectors`` has the words of several texts one after another."""
        n = len(first) - 1
        out = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        if not len(vectors):
            return out
        has = first[1:] > first[:-1]
        begins = first[:-1][has]
        ends = first[1:][has]
        for k, (width, filters) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            conv = vectors @ filters[0]
            for j in range(1, width):  # beyond a text's end there are no words
                part = np.zeros_like(conv)
                part[:-j] = (vectors @ filters[j])[j:]
                for back in range(1, j + 1):
                    tail = ends - back
                    part[tail[tail >= begins]] = 0
                conv += part
            conv += self.bias[k * FILTERS : (k + 1) * FILTERS]
            out[has, k * FILTERS : (k + 1) * FILTERS] = np.maximum(np.maximum.reduceat(conv, begins, axis=0), 0)
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for low, high, features, at, first in word_features(column):
            words = self.table[self.rows_of(features)].sum(axis=1) if len(features) else np.zeros((0, DIM), np.float32)
            logit = self.pooled(words[at], first) @ self.weights + self.offset
            out[low:high] = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        return out


def log_loss(scores: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(scores, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def train(texts: list[str] | pa.Array, labels: np.ndarray, langs: list[str | None], epochs: int = EPOCHS, seed: int = 5) -> ConvModel:
    """Fit on a bounded sample. Embeddings start from smoothed log odds of a feature's documents, then all
    parameters take gradient steps; only the positions of the maxima have gradients. Every fifth row of either label is
    kept out; passes end when its loss grows, and the pass before counts."""
    rng = np.random.default_rng(seed)
    everything = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    out = np.zeros(len(labels), bool)
    for value in (0, 1):
        out[np.flatnonzero(labels == value)[4::5]] = True
    kept_out, used = np.flatnonzero(out), np.flatnonzero(~out)
    column, y = everything.take(pa.array(used)), labels[used].astype(np.float64)
    check_column, check_y = everything.take(pa.array(kept_out)), labels[kept_out].astype(np.float64)
    del everything
    rate = min(max(y.mean() if len(y) else 0.0, 1e-3), 1 - 1e-3)
    # documents and toxic documents of each feature, summed slice by slice
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for low, high, features, at, first in word_features(column):
        seen = [np.unique(features[np.unique(at[first[i] : first[i + 1]])]) for i in range(high - low)]
        own, inverse, n = np.unique(np.concatenate(seen), return_inverse=True, return_counts=True)
        parts.append((own, n, np.bincount(inverse, weights=np.repeat(y[low:high], [len(s) for s in seen]), minlength=len(own))))
    if parts:
        every, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]), minlength=len(every))
        toxic = np.bincount(inverse, weights=np.concatenate([p[2] for p in parts]), minlength=len(every))
        use = np.flatnonzero((counts >= 2) & (every != 0))
        keys, counts, toxic = every[use], counts[use], toxic[use]
        del every, inverse, parts
    else:
        keys, counts, toxic = np.zeros(0, U), np.zeros(0), np.zeros(0)
    pseudo = 4.0
    odds = np.log((toxic + pseudo * rate) / (counts - toxic + pseudo * (1 - rate))) - np.log(rate / (1 - rate))
    table = np.zeros((len(keys) + 1, DIM), np.float32)
    table[:-1, 0] = np.maximum(odds, -1) / 4
    table[:-1, 1:] = rng.normal(0, 0.02, (len(keys), DIM - 1))
    filters = []
    for width in WIDTHS:
        w = rng.normal(0, 0.1, (width, DIM, FILTERS)).astype(np.float32)
        w[:, 0, 0] = 1 / np.sqrt(width)
        filters.append(w)
    model = ConvModel(keys, table, filters, np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS), float(np.log(rate / (1 - rate))), {})
    model.bias[::FILTERS] = -0.3
    model.weights[::FILTERS] = 1.0
    if not len(y) or y.min() == y.max():
        return model
    # for each document the rows of its distinct words and the word at each position
    docs: list[tuple[np.ndarray, np.ndarray]] = []
    for low, high, features, at, first in word_features(column):
        rows = model.rows_of(features).astype(np.int32)
        for i in range(high - low):
            own, inverse = np.unique(at[first[i] : first[i + 1]], return_inverse=True)
            docs.append((rows[own], inverse.astype(np.int32)))
    # moments for the dense part, sums of squares for the rest
    square_w, square_o = np.zeros_like(model.weights), 0.0
    square_f, square_b = [np.zeros_like(f) for f in filters], np.zeros_like(model.bias)
    best = log_loss(model.scores(check_column), check_y) if len(check_y) else np.inf
    for epoch in range(epochs):
        before = model.copy()
        for i in rng.permutation(len(docs)):
            f, at = docs[i]
            if not len(at):
                continue
            distinct = model.table[f].sum(axis=1)
            words = distinct[at]
            pooled, places = np.zeros(len(model.weights)), np.zeros(len(model.weights), np.int64)
            padded = np.concatenate([words, np.zeros((max(WIDTHS) - 1, DIM), np.float32)])
            for k, (width, w) in enumerate(zip(WIDTHS, filters, strict=True)):
                conv = sum(padded[j : j + len(words)] @ w[j] for j in range(width))
                top = conv.argmax(axis=0)
                span = slice(k * FILTERS, (k + 1) * FILTERS)
                places[span] = top
                pooled[span] = np.maximum(conv[top, np.arange(FILTERS)] + model.bias[span], 0)
            logit = pooled @ model.weights + model.offset
            error = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[i]
            if abs(error) < 1e-3:
                continue
            step = 0.3 / (1 + epoch)
            back = error * model.weights * (pooled > 0)
            g = error * pooled
            square_w += g * g
            model.weights -= step * g / (1 + np.sqrt(square_w))
            square_o += error * error
            model.offset -= step * error / (1 + np.sqrt(square_o))
            square_b += (back * back).astype(np.float32)
            model.bias -= (0.2 * step * back / (1 + np.sqrt(square_b))).astype(np.float32)
            for k, width in enumerate(WIDTHS):
                for c in np.flatnonzero(back[k * FILTERS : (k + 1) * FILTERS]):
                    b, p = back[k * FILTERS + c], places[k * FILTERS + c]
                    for j in range(width):
                        g = b * padded[p + j]
                        square_f[k][j, :, c] += g * g
                        if p + j < len(words):
                            np.add.at(model.table, f[at[p + j]], (-0.1 * step * b * filters[k][j, :, c]).astype(np.float32))
                        filters[k][j, :, c] -= 0.2 * step * g / (1 + np.sqrt(square_f[k][j, :, c]))
                model.table[-1] = 0
        loss = log_loss(model.scores(check_column), check_y) if len(check_y) else -float(epoch)
        if loss >= best:
            model = before
            break
        best = loss
    model.thresholds = language_thresholds(model.scores(check_column), labels[kept_out], [langs[i] for i in kept_out])
    return model


def language_thresholds(scores: np.ndarray, labels: np.ndarray, langs: list[str | None], default: float = 0.3, least: int = 10) -> dict[str, float]:
    """For each language with enough toxic rows the threshold of best F1, halfway to the next lower score, kept in
    [0.15, 0.6]; others use ``default``."""
    out = {"": default}
    names = np.array([x or "" for x in langs])
    for name in np.unique(names):
        own = names == name
        s, y = scores[own], labels[own]
        if y.sum() < least or y.min() == y.max():  # too few to tell
            continue
        order = np.argsort(-s, kind="stable")
        hit = np.cumsum(y[order])
        f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
        cut = int(f1.argmax())
        low = s[order][cut + 1] if cut + 1 < len(s) else 0.0
        out[str(name)] = float(np.clip((s[order][cut] + low) / 2, 0.15, 0.6))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> tuple[pa.Array, np.ndarray, list[str | None]]:
    """Texts, labels and languages of at most ``rows`` labelled documents that are not held out, in the order of a hash of
    the id; a document that would bring the texts above ``most_bytes`` is left out. Of rows that share an id one counts."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_y")).orderBy(F.xxhash64(F.lit(3), "_id"), "_id").limit(rows)
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), lang.alias("_lang"))
    # at most ``rows`` rows of two numbers are broadcast, and as many come back
    own = known["doc_id"] == F.col("_id")
    sizes = known.join(F.broadcast(picked), own).groupBy("_id", "_y").agg(F.min(F.struct(F.xxhash64("text").alias("tag"), F.octet_length("text").alias("n"))).alias("t"))
    taken, total = [], 0
    for r in sizes.orderBy(F.xxhash64(F.lit(3), "_id"), "_id").collect():
        if total + r["t"]["n"] <= most_bytes:
            total += r["t"]["n"]
            taken.append((r["_id"], int(r["_y"]), r["t"]["tag"]))
    chosen = docs.sparkSession.createDataFrame(taken, "_id long, _y int, _tag long")
    found = known.join(F.broadcast(chosen), own & (F.xxhash64("text") == F.col("_tag"))).select("_id", "_y", "_lang", "text")
    got = found.dropDuplicates(["_id"]).toArrow().sort_by([("_id", "ascending")])
    return got.column("text").combine_chunks(), (got.column("_y").to_numpy() > 0).astype(int), got.column("_lang").to_pylist()


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ConvModel:
    model = train(*labelled_sample(docs, labels, rows))
    give_back_memory()
    return model


def score_documents(docs: DataFrame, model: ConvModel, name: str = "tox_score") -> DataFrame:
    """``docs`` with the score as column ``name``."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(at)), pa.float64())], [*names, name])
        give_back_memory()

    with arrow_rows(docs.sparkSession, 2000):
        return docs.mapInArrow(run, schema)


def flagged(score: Column, lang: Column, thresholds: dict[str, float]) -> Column:
    """Whether a score reaches its language's threshold."""
    limit = F.lit(thresholds.get("", 0.3))
    for name, value in thresholds.items():
        if name:
            limit = F.when(lang == name, F.lit(value)).otherwise(limit)
    return score >= limit
