"""Quality scores by a naive Bayes support vector machine.

Features are indicators of a text's lower-cased words and word pairs, hashed to `BUCKETS`.
1. Over all rows that may be learned from, Spark counts each bucket's documents of either class; their
   smoothed log-count ratio r is the bucket's weight (a vector of BUCKETS numbers, whatever the input).
2. On a bounded sample of those rows (`SAMPLE`, drawn by a hash of the id), a linear hinge-loss model
   over the indicators scaled by r, each document at unit length, is fitted by dual coordinate descent;
   either class weighs the same.  A fifth of the sample is kept back to turn margins into probabilities.
3. Every text is scored whole, in tasks.

A document with several labels takes the label of most of them; with as many of either, none.  Null
and empty texts have no features and get the score of a margin of the bias alone.  Without labels of
both classes every score is the share of label 1, or 0.5 without labels.  Every row gives one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, in_train, lean

BUCKETS, SAMPLE, EPOCHS, COST = 1 << 18, 12_000, 8, 1.0


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, one text after the other, and where each text's begin."""
    words = Words(texts, lower=True)
    _, pairs = words.grams(2)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.first))
    start = np.arange(len(words.hash))
    of_pair = doc[start[start + 2 <= words.end]]
    key = np.concatenate((doc, of_pair)).astype(np.int64) * BUCKETS + (np.concatenate((words.hash, pairs ^ np.uint64(1))) % np.uint64(BUCKETS)).astype(np.int64)
    key = np.sort(key)
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    return (key % BUCKETS).astype(np.int32), np.searchsorted(key, np.arange(len(texts) + 1) * BUCKETS)


def text_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of each text's values, the same for a text wherever it stands."""
    out = np.add.reduceat(np.append(values, 0.0), first[:-1])
    out[first[1:] == first[:-1]] = 0.0
    return out


def coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: np.ndarray, width: int, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their squared norm and the hinge losses times `cost`, by the dual."""
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(rows))
    square = np.array([(v * v).sum() + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                alpha[i] = new
                w[at] += step * v
                bias += step
    return w, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to probabilities, by Newton steps; a small ridge keeps them finite."""
    t = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y <= 0) + 2))
    x, p = np.stack((margin, np.ones_like(margin)), 1), np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        grad = x.T @ (q - t) + 1e-3 * p
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        p = p - np.linalg.solve(hess, grad)
    return float(p[0]), float(p[1])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, good of labelled rows; joined by a shuffle at every size, as labels grow with documents."""
    mean = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.avg("quality").alias("q")).where("q <> 0.5")
    return docs.where(in_train()).select("doc_id", "text").join(mean.select("doc_id", (F.col("q") > 0.5).alias("good")).hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE):
    """(folded weights, squared ratios, bias, slope, offset), or the constant score where a class is missing."""
    known = _labelled(docs, labels)

    def count(batches):
        n, docs_of = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for some in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), size=lambda r: len(r[0])):
                at, first = features([r[0] for r in some])
                good = np.array([r[1] for r in some])
                of = np.repeat(good, np.diff(first))
                n[1] += np.bincount(at[of], minlength=BUCKETS)
                n[0] += np.bincount(at[~of], minlength=BUCKETS)
                docs_of += (np.sum(~good), np.sum(good))
        at = np.flatnonzero(n.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(n[0, at], docs_of[0])), pa.array(np.append(n[1, at], docs_of[1]))], ["bucket", "bad", "good"])

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    got = known.select(body, "good").mapInArrow(lean(count), "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow()
    at, bad, good = (got[k].to_numpy() for k in ("bucket", "bad", "good"))
    total = bad[at < 0].sum(), good[at < 0].sum()
    if not min(total):
        return float(total[1] / sum(total)) if sum(total) else 0.5
    n = np.ones((2, BUCKETS))
    n[0, at[at >= 0]] += bad[at >= 0]
    n[1, at[at >= 0]] += good[at >= 0]
    ratio = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())

    share = min(1.0, most / float(sum(total)))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)

    def extract(batches):
        for batch in batches:
            for some in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), size=lambda r: len(r[0])):
                at, first = features([r[0] for r in some])
                yield pa.RecordBatch.from_arrays([pa.array([at[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()), pa.array([r[1] for r in some], pa.bool_())], ["at", "good"])

    got = _labelled(docs.where(draw < share), labels).select(body, "good").mapInArrow(lean(extract), "at binary, good boolean").toArrow()
    pairs = sorted(zip(got["at"].to_pylist(), got["good"].to_pylist(), strict=True))[: 2 * most]
    order = np.random.default_rng(3).permutation(len(pairs))
    rows, y = [], np.array([1.0 if pairs[i][1] else -1.0 for i in order])
    for i in order:
        at = np.frombuffer(pairs[i][0], np.int32)
        v = ratio[at]
        rows.append((at, v / max(np.sqrt(v @ v), 1e-12)))
    kept = len(rows) // 5 if min(np.sum(y[: len(rows) // 5] > 0), np.sum(y[: len(rows) // 5] < 0)) >= 5 else 0
    part = y[kept:]
    cost = np.where(part > 0, COST * len(part) / (2 * max(1, np.sum(part > 0))), COST * len(part) / (2 * max(1, np.sum(part < 0))))
    w, bias = coordinate_descent(rows[kept:], part, cost, BUCKETS)
    held = range(kept) if kept else range(len(rows))
    slope, offset = calibrate(np.array([w[rows[i][0]] @ rows[i][1] + bias for i in held]), y[list(held)])
    return (ratio * w).astype(np.float64), (ratio * ratio).astype(np.float64), bias, slope, offset


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text), learned from labels (doc_id, quality)."""
    held = F.coalesce(~in_train(), F.lit(False)).alias("held_out")
    model = fit(docs, labels, most)
    if isinstance(model, float):
        scored = docs.select(F.col("doc_id").cast("long"), held, F.lit(model).alias("score"))
        return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    share = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        weight, square, bias, slope, offset = share.value
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2])):
                at, first = features([r[2] for r in some])
                sums = [text_sums(t[at], first) for t in (weight, square)]
                margin = sums[0] / np.sqrt(np.maximum(sums[1], 1e-24)) + bias
                p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -700, 700)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array([r[1] for r in some], pa.bool_()), pa.array(p)], ["doc_id", "held_out", "score"])

    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    out = docs.select(F.col("doc_id").cast("long"), held, body).mapInArrow(lean(score), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
