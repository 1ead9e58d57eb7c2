"""A linear classifier over feature vectors: class matrix, softmax, argmax and the best five, and an epoch's measures."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How many classes a prediction lists; digits of an epoch's measures.
BEST, DIGITS = 5, 4
#: A class matrix goes to every worker, so its size is checked.
MOST_WEIGHTS = 50_000_000


@dataclass
class Classes:
    """Ids in ascending order, and a weight vector and a bias for each."""

    ids: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def __post_init__(self):
        if self.weights.size > MOST_WEIGHTS:
            raise ValueError(f"{self.weights.size} weights are too many for one matrix")


def nearest_mean(rows: DataFrame, label: str, vector: str, dims: int) -> Classes:
    """The classifier whose logit is how much nearer a vector is to its class's mean: weights are the means, bias minus half their squared length.

    Rows whose label is null or whose vector hasn't dims components are left out. Sums are made in Spark; a row for each
    class and component comes to the driver, which the class matrix bounds.
    """
    known = rows.where(F.col(label).isNotNull() & (F.size(vector) == dims)).select(F.col(label).cast("long").alias("c"), F.posexplode(vector).alias("at", "x"))
    means = known.groupBy("c", "at").agg(F.avg(F.col("x").cast("double")).alias("m"))
    classes = known.select("c").distinct().count()
    if classes * dims > MOST_WEIGHTS:
        raise ValueError(f"{classes} classes of {dims} weights are too many for one matrix")
    found = means.toPandas()
    ids = np.sort(found["c"].unique()).astype(np.int64)
    weights = np.zeros((len(ids), dims))
    weights[np.searchsorted(ids, found["c"]), found["at"]] = found["m"]
    return Classes(ids, weights, -(weights**2).sum(1) / 2)


def softmax(logits: np.ndarray) -> np.ndarray:
    """Probabilities of each row's classes; the largest logit is taken off first, so nothing overflows."""
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def classified(rows: DataFrame, classes: Classes, vector: str, truth: str | None = None) -> DataFrame:
    """rows with class_id (the likeliest; of equals the smallest id), confidence, best (up to five ids, likeliest first, equals by id) and, with truth, loss: minus the logarithm of the true class's probability.

    A vector that is null, of another length or without finite numbers has no class; a truth that is null or no class has no loss. One Arrow pass.
    """
    shared = rows.sparkSession.sparkContext.broadcast(classes)
    names, made = rows.columns, ["class_id", "confidence", "best", *(["loss"] if truth else [])]
    types = {"class_id": "long", "confidence": "double", "best": "array<bigint>", "loss": "double"}

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        m = shared.value
        dims = m.weights.shape[1]
        for b in batches:
            given = b.column(vector).to_pylist()
            ok = np.array([v is not None and len(v) == dims and None not in v for v in given], dtype=bool)
            x = np.array([v for v, k in zip(given, ok, strict=True) if k], dtype=np.float64).reshape(-1, dims)
            ok[np.flatnonzero(ok)[~np.isfinite(x).all(axis=1)]] = False
            x = x[np.isfinite(x).all(axis=1)]
            if not len(m.ids):
                ok[:], x = False, x[:0]
            out = {k: [None] * len(given) for k in made}
            if len(x):
                p = softmax(x @ m.weights.T + m.bias)
                order = np.argsort(-p, axis=1, kind="stable")[:, :BEST]
                truths = b.column(truth).to_pylist() if truth else None
                for r, i in enumerate(np.flatnonzero(ok)):
                    out["class_id"][i], out["confidence"][i], out["best"][i] = int(m.ids[order[r, 0]]), float(p[r, order[r, 0]]), m.ids[order[r]].tolist()
                    if truth and truths[i] is not None and (at := int(np.searchsorted(m.ids, truths[i]))) < len(m.ids) and m.ids[at] == truths[i]:
                        out["loss"][i] = float(-np.log(max(p[r, at], np.finfo(float).tiny)))
            kinds = {"class_id": pa.int64(), "confidence": pa.float64(), "best": pa.list_(pa.int64()), "loss": pa.float64()}
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(out[k], kinds[k]) for k in made)], [*names, *made])

    return rows.mapInArrow(work, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), *(f"{k} {types[k]}" for k in made)]))


def epoch(scored: DataFrame, by: list[str], truth: str) -> DataFrame:
    """(*by, n, loss, accuracy) of classified rows with a loss: the mean over samples, so batches of any size weigh by their samples."""
    hit = F.avg((F.col("class_id") == F.col(truth).cast("long")).cast("double"))
    return scored.where(F.col("loss").isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("loss"), DIGITS).alias("loss"), F.round(hit, DIGITS).alias("accuracy"))


def processing_time(rows: DataFrame, by: list[str], ms: str = "processing_time_ms") -> DataFrame:
    """(*by, n_frames, total_s, avg_ms) of frames with the milliseconds that each took; null is 0."""
    t = F.coalesce(F.col(ms), F.lit(0.0))
    return rows.groupBy(*by).agg(F.count("*").alias("n_frames"), F.round(F.sum(t) / 1000, 1).alias("total_s"), F.round(F.avg(t), 1).alias("avg_ms"))
