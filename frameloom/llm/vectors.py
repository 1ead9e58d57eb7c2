"""What the vector operators share: integer vectors, exact squared distances, bounds that stay on their side, sums of tasks."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components must be below this in size, so that squared distances of up to 64 of them fit 64 bits; up to SMALL, doubles hold them exactly.
LARGEST, SMALL = 1 << 27, 1 << 22
#: Bounds are doubles; each step widens them by more than its rounding can have narrowed them.
WIDER, NARROWER = 1 + 2.0**-50, 1 - 2.0**-50


def finite(vector: Column) -> Column:
    """True if the vector is not null and all its components are numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """A batch's vectors as rows; doubles if these hold all distances exactly, else 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    most = max(-int(flat.min()), int(flat.max())) if len(flat) else 0
    if most >= LARGEST:
        raise ValueError(f"a component of {most} is too large for exact 64-bit distances")
    return flat.astype(np.float64 if most <= SMALL else np.int64).reshape(-1, dims)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, as integers."""
    d = v - c
    return np.einsum("ij,ij->i", d, d).astype(np.int64)


def at_most(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2) * WIDER


def at_least(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2) * NARROWER


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Upper bounds of how far each point has moved."""
    return at_most(((new - old) ** 2).sum(-1))


def lists(a: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Rows of a matrix as a column of arrays."""
    return pa.ListArray.from_arrays(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1], pa.array(a.reshape(-1), kind))


class Sums:
    """Counts and sums of what joined and left each slot, in one task: a few rows, whatever its input."""

    def __init__(self, slots: int, dims: int):
        self.n, self.of = np.zeros(slots, dtype=np.int64), np.zeros((slots, dims), dtype=np.int64)

    def move(self, v: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> None:
        """Rows of v leave slot old for slot new; old None: they are new."""
        if old is not None:
            v, old, new = v[x := old != new], old[x], new[x]
        for slots, sign in ((new, 1), (old, -1)):
            for s in np.unique(slots) if slots is not None else ():
                own = v[slots == s]
                self.n[s] += sign * len(own)
                self.of[s] += sign * own.astype(np.int64).sum(0)

    def rows(self) -> Iterable[tuple[int, int, np.ndarray]]:
        return ((s, self.n[s], self.of[s]) for s in np.flatnonzero((self.n != 0) | self.of.any(1)))


def added(table: DataFrame, slots: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and exact sums, as Python integers, of all tasks' rows (slot, n, sums): slots x dims of them come to the driver, however many vectors there are."""
    n, of = np.zeros(slots, dtype=object), np.zeros((slots, dims), dtype=object)
    parts = table.where("slot is not null").select("slot", "n", F.posexplode("sums").alias("place", "x"))
    for r in parts.groupBy("slot", "place").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        n[r["slot"]], of[r["slot"], r["place"]] = int(r["n"]), int(r["x"])
    return n, of


def means(points: np.ndarray, n: np.ndarray, of: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each slot that has vectors, in Python integers; the other points stay."""
    return np.array([[int(x // c) for x in s] if c else p for p, c, s in zip(points.tolist(), n, of, strict=True)], dtype=np.int64).reshape(points.shape)
