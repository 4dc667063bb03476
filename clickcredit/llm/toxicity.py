"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A document's features are which hashed character n-grams (orders 3 to 5 of the
lower-cased text, 2**18 cells) occur in it. Each feature is scaled by the log ratio of
its share among toxic and clean training texts; a logistic regression is fitted on the
scaled features, and the two factors make one weight per cell, so that scoring is one
lookup per n-gram over the whole text.

Bounds: at most ``ratio_rows`` labelled rows feed the ratios and at most ``fit_rows``
the regression, taken by the smallest hash of the id; the model is 2**18 weights of
four bytes. Only these bounded things are broadcast or reach the driver; every
document is scored, by whole text. Labels, language, source and id never enter a score.

Defined results: a null or empty text, or one of under three characters, has no
feature and scores the fitted prior. A null label is no label. Several labels of one
id are several training rows. Without two classes to learn from every score is the
share of label 1 (0.0 if there are no labels). An empty table gives an empty result.
Extra columns are ignored by ``score`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_BITS = 18
CELLS = 1 << CELL_BITS
ORDERS = (3, 4, 5)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # float32, one per cell
    bias: float


def cells(text: str | None) -> np.ndarray:
    """Cell of each n-gram of the text, repeats included."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    grams, out = points.astype(np.uint64), []
    for n in range(2, ORDERS[-1] + 1):
        if len(points) < n:
            break
        grams = grams[:-1] * _STEP
        grams += points[n - 1:]
        if n in ORDERS:
            out.append((((grams + np.uint64(n)) * _SPREAD)
                        >> np.uint64(64 - CELL_BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def held_out(doc_id: Column) -> Column:
    """Rows of a fixed fifth of the ids, never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0,
                      F.lit(True))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, toxic, text) of at most ``rows`` labelled training rows. The bounded
    label list is broadcast, so the texts are not shuffled."""
    chosen = (labels.where(labels["toxic"].isNotNull() & ~held_out(labels["doc_id"]))
              .select(labels["doc_id"].cast("long").alias("doc_id"),
                      (labels["toxic"].cast("int") > 0).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                        docs["text"].cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class that hold each cell; row -1 counts documents."""
    seen = np.zeros((2, CELLS), np.int64)
    total = np.zeros(2, np.int64)
    for batch in batches:
        for y, text in zip(batch["toxic"].to_pylist(), batch["text"], strict=True):
            seen[y, np.unique(cells(text.as_py()))] += 1
            total[y] += 1
    used = np.flatnonzero(seen.any(axis=0))
    yield pa.record_batch({
        "cell": np.append(used, -1).astype(np.int32),
        "clean": np.append(seen[0, used], total[0]),
        "toxic": np.append(seen[1, used], total[1])})


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = [np.unique(cells(t.as_py())).astype(np.int32).tobytes() for t in batch["text"]]
        yield pa.record_batch({"doc_id": batch["doc_id"], "toxic": batch["toxic"],
                               "cells": pa.array(packed, pa.binary())})


def _regress(rows: list, ratios: np.ndarray, steps: int = 40, rate: float = 0.05,
             ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression by full-batch Adam over the scaled features; deterministic."""
    y = np.array([r["toxic"] for r in rows], np.float64)
    blocks = []  # of documents: (first, end, start of each, cells, scaled values)
    for k in range(0, len(rows), 128):
        found = [np.frombuffer(r["cells"], np.int32) for r in rows[k:k + 128]]
        cell = np.concatenate(found)
        blocks.append((k, k + len(found), np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found]),
                       cell, ratios[cell].astype(np.float32)))
    rows.clear()
    norm = float(np.sqrt(sum(float(np.dot(b[-1], b[-1])) for b in blocks) / len(y))) or 1.0
    share = y.mean()
    bias = float(np.log(share / (1 - share)))
    weight = np.where(y == 1, 0.7 + 0.3 * (1 - share) / share, 1.0)
    weight /= weight.sum()
    w = np.zeros(CELLS)
    first, second = np.zeros(CELLS), np.zeros(CELLS)
    for step in range(1, steps + 1):
        slope, total = ridge * w, 0.0
        for lo, hi, owner, cell, x in blocks:
            z = np.bincount(owner, weights=x * w[cell], minlength=hi - lo) / norm + bias
            error = (1 / (1 + np.exp(-z)) - y[lo:hi]) * weight[lo:hi]
            slope += np.bincount(cell, weights=x * error[owner], minlength=CELLS) / norm
            total += float(error.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        bias -= total
    return w / norm, bias


def fit(docs: DataFrame, labels: DataFrame, ratio_rows: int = 12_000,
        fit_rows: int = 2_000) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fifth."""
    counts = (_sample(docs, labels, ratio_rows).select("toxic", "text")
              .mapInArrow(_count, "cell int, clean long, toxic long")
              .groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .toArrow())  # a row per cell at most
    seen = np.zeros((2, CELLS + 1))
    for k, name in enumerate(("clean", "toxic")):
        seen[k, counts["cell"].to_numpy()] = counts[name].to_numpy()  # -1: the totals
    total = seen[:, -1]
    rows = sorted(_sample(docs, labels, fit_rows).mapInArrow(
        _features, "doc_id long, toxic int, cells binary").collect(),
        key=lambda r: (r["doc_id"], r["toxic"], r["cells"]))
    if not total.min() or len({r["toxic"] for r in rows}) < 2:
        share = float(total[1] / total.sum()) if total.sum() else 0.0
        return ToxicityModel(np.zeros(CELLS, np.float32),
                             float(np.log(share / (1 - share))) if 0 < share < 1
                             else (50.0 if share else -np.inf))
    ratios = np.log(((seen[1, :-1] + 1) / total[1]) / ((seen[0, :-1] + 1) / total[0]))
    w, bias = _regress(rows, ratios)
    return ToxicityModel((w * ratios).astype(np.float32), bias)


def _scorer(model: ToxicityModel):
    weights, bias = model.weights, model.bias

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros(CELLS, np.int64)  # position that wrote a cell last
        for batch in batches:
            z = np.empty(batch.num_rows)
            for i, text in enumerate(batch["text"]):
                cell = cells(text.as_py())
                at = np.arange(len(cell))
                last[cell] = at
                once = cell[last[cell] == at]  # each cell of the document once
                z[i] = np.sort(weights[once]).sum(dtype=np.float64) + bias
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-z))
            yield pa.record_batch({"doc_id": batch["doc_id"], "score": p})

    return score


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"),
                        docs["text"].cast("string").alias("text"))
    scored = texts.mapInArrow(_scorer(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` predicted clean, with all their columns, in one pass."""
    schema = docs.schema
    names = [f.name for f in schema]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _scorer(model)
        for batch in batches:
            at = names.index("text")
            own = pa.record_batch({"doc_id": pa.nulls(batch.num_rows, pa.int64()),
                                   "text": batch.column(at).cast(pa.string())})
            (scored,) = judge(iter([own]))
            yield batch.filter(pa.array(scored["score"].to_numpy() < 0.5))

    return docs.mapInArrow(keep, schema)
