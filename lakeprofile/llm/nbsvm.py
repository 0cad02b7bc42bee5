"""Quality classifier: naive Bayes support vectors.

Indicators of byte n-grams (all orders of ``ORDERS``, in ``2 ** BITS`` slots each)
and of words said twice in a row (at least ``TWICE`` times) are scaled by the log ratio of their smoothed frequencies in good and in poor
documents; on them a linear hinge-loss model is fitted by dual coordinate
descent.  The margin becomes a score between 0 and 1 by the logistic function.

Labels are those of rows whose ``crc32(doc_id) mod 3`` is not 1; of these the
``fit_rows`` (20,000) with the least digests are used, a bounded sample that is
small enough to travel to the documents and to be fitted in one task.  The model
is one number per slot.  All documents are then scored in place, over their
whole texts, without a shuffle.  Neither labels nor ids, languages or sources
enter a score.

Null text counts as empty and is scored as such; a null ``doc_id`` is not held
out and has no label; labels that contradict each other are averaged (1 from a
half on); equal rows get equal scores; an empty table gives an empty result.
Without labels of both classes every score is the share of good labels, or 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_grams import pieces, slots, text_bytes
from .common import doc_rows, small_batches

ORDERS = (2, 4)
BITS = 18
TWICE = (1, 4, 16, 64)
SLOTS = (len(ORDERS) << BITS) + len(TWICE)
FIT_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, fit_rows: int) -> DataFrame:
    """``_id`` and ``label`` of at most ``fit_rows`` documents that are not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """Different slots of every text; slots of each order follow one another."""
    raw, offsets = text_bytes(texts)
    grams = [slots(raw, order, BITS) + number * (1 << BITS) for number, order in enumerate(ORDERS)]
    for low, high, text in zip(offsets[:-1].tolist(), offsets[1:].tolist(), texts.to_pylist(), strict=True):
        words = text.split()
        twice = sum(map(eq, words, words[1:]))
        above = [SLOTS - len(TWICE) + i for i, least in enumerate(TWICE) if twice >= least]
        parts = [g[low : max(high - order + 1, low)] for g, order in zip(grams, ORDERS, strict=True)]
        yield np.unique(np.concatenate([*parts, np.array(above, np.int32)]))


def log_ratios(rows: list[np.ndarray], good: np.ndarray, smooth: float) -> np.ndarray:
    counts = [np.full(SLOTS, smooth), np.full(SLOTS, smooth)]
    for slot, label in zip(rows, good, strict=True):
        counts[int(label)][slot] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def fit(rows: list[np.ndarray], good: np.ndarray, smooth: float = 1.0, cost: float = 0.1, passes: int = 12, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weight per slot and bias of the linear hinge-loss model, classes weighing the same."""
    ratio = log_ratios(rows, good, smooth)
    y = np.where(good == 1, 1.0, -1.0)
    bound = cost * len(y) / (2.0 * np.where(good == 1, (good == 1).sum(), (good == 0).sum()))
    weight, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    square = np.array([ratio[s] @ ratio[s] + 1.0 for s in rows])
    order = np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(y)).tolist():
            slot = rows[i]
            x = ratio[slot]
            slope = y[i] * (weight[slot] @ x + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), bound[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weight[slot] += step * x
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-6:
            break
    return weight * ratio, bias


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **settings: float) -> np.ndarray:
    """The model: one number per slot, and the bias last."""
    small_batches(docs.sparkSession)
    sample = F.broadcast(training_labels(labels, fit_rows))  # at most ``fit_rows`` rows of an id and a label
    rows = doc_rows(docs).join(sample, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot_rows: list[np.ndarray] = []
        good: list[int] = []
        for batch in pieces(batches, 0):
            slot_rows.extend(indicators(batch.column(0)))
            good.extend(batch.column(1).to_pylist())
        labels_ = np.array(good, np.int64)
        if len(set(good)) == 2:
            weight, bias = fit(slot_rows, labels_, **settings)
        else:
            share = (labels_.sum() + 1e-3) / (len(labels_) + 2e-3)
            weight, bias = np.zeros(SLOTS), float(np.log(share / (1 - share)))
        model = np.r_[weight, bias].astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "label")
    solved = ordered.mapInArrow(solve, "model binary").first()  # no row where Spark sees that no text has a label
    return np.zeros(SLOTS + 1, np.float32) if solved is None else np.frombuffer(solved["model"], np.float32)


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **settings: float) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    model = train(docs, labels, fit_rows, **settings)
    weight, bias = model[:-1], float(model[-1])
    rows = doc_rows(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            margin = np.array([weight[slot].sum(dtype=np.float64) for slot in indicators(batch.column(2))]) + bias
            score = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(apply, f"doc_id {kind}, held_out boolean, score double, predicted int")
