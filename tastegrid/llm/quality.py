"""Quality classifier: logistic regression over hashed word n-grams, fitted by FTRL.

Features are hashed word unigrams, n-grams of word shapes (letter case, marks;
runs collapsed) and immediate repeats of a word, scaled to length 1 per text.
The model is fitted by follow-the-regularised-leader updates on a bounded sample
of labelled rows (``samples.FIT_ROWS``) in one task; its ``2 ** DIM_BITS``
weights are all that is broadcast.  Scoring is a sparse dot product per text.

Null and empty texts have no features and score the model's intercept.  Without
labels every score is 0.5.  Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.arrays import Slices, lists, mixed, text_chunks, word_hashes
from tastegrid.llm.memo import tidy
from tastegrid.llm.samples import FIT_ROWS, fit_sample, held_out

DIM_BITS = 18
THRESHOLD = 0.7
EPOCHS = 3

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[ord("a"):ord("z") + 1] = ord("a")
SHAPE[128:] = ord("a")
SHAPE[ord("A"):ord("Z") + 1] = ord("A")
SHAPE[ord("0"):ord("9") + 1] = ord("9")


def shaped(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as letter shapes with runs of one shape collapsed."""
    shape = SHAPE[raw]
    keep = np.ones(len(raw), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[offsets[:-1][offsets[:-1] < len(raw)]] = True
    return shape[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def text_features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, text of each feature, feature, value), sorted by text and feature."""
    space = np.uint64(1 << DIM_BITS)
    for first, end, raw, offsets in text_chunks(column):
        words, bounds = word_hashes(raw, offsets, lower=True)
        shapes, _ = word_hashes(*shaped(raw, offsets))
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        hashes, texts = [words], [text]
        grams = Slices(shapes, 1)
        for n in (1, 2, 3):
            at = np.arange(max(0, len(text) - n + 1))
            at = at[text[at] == text[at + n - 1]]
            hashes.append(grams.hashed(at, at + n))
            texts.append(text[at])
        again = np.flatnonzero((words[1:] == words[:-1]) & (text[1:] == text[:-1]))
        hashes.append(np.full(len(again), 0x5EED, np.uint64))
        texts.append(text[again])
        code = (np.concatenate(texts).astype(np.uint64) << np.uint64(DIM_BITS)) | (
            mixed(np.concatenate(hashes)) % space)
        code.sort()
        new = np.ones(len(code), bool)
        new[1:] = code[1:] != code[:-1]
        at = np.flatnonzero(new)
        count = np.diff(np.append(at, len(code)))
        of = (code[at] >> np.uint64(DIM_BITS)).astype(np.int64)
        value = np.sqrt(count)
        norm = np.sqrt(np.bincount(of, value * value, minlength=len(bounds) - 1))
        yield first, end, of, (code[at] % space).astype(np.int64), value / norm[of]


def ftrl(texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-2) -> np.ndarray:
    """Weights after per-coordinate FTRL updates over the texts; the last is the intercept."""
    size = (1 << DIM_BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for (at, value), target in zip(texts, y, strict=True):
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2), 0.0)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - target) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - sigma * w
            n[at] = ni + g * g
    return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 4, fold: int = 2,
           most: int = FIT_ROWS) -> np.ndarray:
    """Weights learned from labelled rows outside the held-out fold."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, of, feature, value in text_features(batch.column(1)):
                count = np.bincount(of, minlength=end - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), batch.column(2).slice(first, end - first),
                     lists(feature.astype(np.int32), count, pa.int32()),
                     lists(value.astype(np.float32), count, pa.float32())],
                    ["doc_id", "y", "at", "value"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id").sample(frac=1, random_state=7)
        bias = 1 << DIM_BITS
        texts = [(np.append(a, bias), np.append(v, 1.0)) for a, v in zip(pdf["at"], pdf["value"], strict=True)]
        return pd.DataFrame({"weights": [ftrl(texts, pdf["y"].to_numpy()).astype(np.float32).tobytes()]})

    rows = (fit_sample(docs, labels, label, parts, fold, most).select("doc_id", "text", "y")
            .mapInArrow(tidy(features), "doc_id long, y int, at array<int>, value array<float>")
            .groupBy(F.lit(0).alias("all")).applyInPandas(fit, "weights binary").collect())
    if not rows:
        return np.zeros((1 << DIM_BITS) + 1, np.float32)
    return np.frombuffer(rows[0]["weights"], np.float32)


def scored(docs: DataFrame, weights: np.ndarray, also: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``also`` and ``score`` (0 to 1, higher is better) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = "score double" + "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in also)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, end, of, feature, value in text_features(batch.column(0)):
                out[first:end] = np.bincount(of, w[feature] * value, minlength=end - first)
            out = 1 / (1 + np.exp(-np.clip(out + w[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([pa.array(out), *batch.columns[1:]], ["score", *also])

    return docs.select("text", *also).mapInArrow(tidy(score), schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scored(rows, fitted(docs, labels), ("doc_id",)).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more, with their own columns."""
    rows = docs.select("text", F.struct(*docs.columns).alias("_row"))
    return scored(rows, fitted(docs, labels), ("_row",)).where(F.col("score") >= THRESHOLD).select("_row.*")
