"""Centroid clustering with Drake's adaptive bounds.

Each vector keeps an upper bound of the distance to its own centroid, its several nearest other centroids with lower
bounds, and one lower bound for all the rest. A round shifts the bounds by the centroids' movement; as the bounds are
kept in order, the first one beyond the upper bound tells how many of the nearest could have come closer: none (the
vector is left alone), some (only those are compared), or any (an exact scan of all). How many are kept follows what the
last round needed. Bounds only ever spare work: distances are exact integers and ties go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written
from .vectors import NARROWER, WIDER, Sums, added, at_least, at_most, finite, integers, lists, matrix, means, moved, squared

#: Larger than any squared distance.
_FAR = np.iinfo(np.int64).max


class Assigner:
    """Assigns batches of vectors to centroids; `shift` has how far each centroid has moved since the bounds were made."""

    def __init__(self, centroids: np.ndarray, shift: np.ndarray, keep: int):
        self.c, self.shift, self.keep, self.k = centroids, shift, keep, len(centroids)
        #: Of the bounds kept, how many a vector has needed that was not scanned as a whole; and how many distances were made.
        self.needed, self.compared = 0, 0

    def fresh(self, n: int) -> tuple:
        """Bounds that certify nothing."""
        return np.zeros(n, dtype=np.int64), np.full(n, np.inf), np.zeros((n, self.keep), dtype=np.int64), np.zeros((n, self.keep + 1))

    def shifted(self, own, upper, near, low) -> tuple:
        """The bounds after the centroids' moves; low[j] holds for all centroids from place j on."""
        upper = (upper + self.shift[own]) * WIDER
        by = np.concatenate([self.shift[near], np.full((len(own), 1), self.shift.max())], axis=1)
        low = np.maximum((low - by) * NARROWER, 0)
        return upper, np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]

    def assign(self, v: np.ndarray, own, upper, near, low) -> tuple:
        """New (own, upper, near, low) of each row of v."""
        own, near = own.copy(), near.copy()
        upper, low = self.shifted(own, upper, near, low)
        rows = np.flatnonzero(low[:, 0] <= upper)
        exact = squared(v[rows], self.c[own[rows]])
        self.compared += len(rows)
        upper[rows] = at_most(exact)
        need = (low[rows] <= upper[rows, None]).sum(1)
        rows, exact, need = rows[need > 0], exact[need > 0], need[need > 0]
        whole = need > self.keep
        self.needed = max(self.needed, int(need[~whole].max(initial=0)))
        wanted = np.zeros((len(rows), self.k), dtype=bool)
        wanted[whole] = True
        for j in range(self.keep):
            at = np.flatnonzero(need > j)
            wanted[at, near[rows[at], j]] = True
        wanted[np.arange(len(rows)), own[rows]] = False
        d2 = np.full((len(rows), self.k), _FAR)
        d2[np.arange(len(rows)), own[rows]] = exact
        for c in range(self.k):
            if len(at := np.flatnonzero(wanted[:, c])):
                d2[at, c] = squared(v[rows[at]], self.c[c])
                self.compared += len(at)
        order = np.argsort(d2, axis=1, kind="stable")
        d2 = np.take_along_axis(d2, order, axis=1)
        own[rows], upper[rows] = order[:, 0], at_most(d2[:, 0])
        for j in range(self.keep):
            at = np.flatnonzero(need > j)
            near[rows[at], j], low[rows[at], j] = order[at, j + 1], at_least(d2[at, j + 1])
        low[rows[whole], self.keep] = at_least(d2[whole, self.keep + 1]) if self.k > self.keep + 1 else np.inf
        return own, upper, near, np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]


_TASK = "slot int, n long, sums array<long>, needed int"
_TASK_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32()]


def _nulls(n: int, kinds: list[pa.DataType]) -> list[pa.Array]:
    return [pa.nulls(n, k) for k in kinds]


def _assigned(table: DataFrame, centroids: np.ndarray, shift: np.ndarray, had: int, keep: int, dims: int, last: bool) -> DataFrame:
    """One pass over the vectors and their `had` bounds: the same with `keep` new ones, and each task's sums. The last pass has distances instead of bounds, and their sums."""
    kind = table.schema["vec_id"].dataType.simpleString()
    names = ["vec_id", "cluster", "distance"] if last else ["vec_id", "v", "cluster", "upper", "near", "low"]
    types = {"distance": "long", "vec_id": kind, "cluster": "int", "v": "array<int>", "upper": "double", "near": "array<int>", "low": "array<double>"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, sums, ids = Assigner(centroids, shift, keep), Sums(len(centroids), 1 if last else dims), None
        for b in batches:
            ids = b.column("vec_id").type
            v, own = matrix(b.column("v"), dims), None
            if "cluster" in b.schema.names:
                own = b.column("cluster").to_numpy().astype(np.int64)
                flat = lambda c: b.column(c).flatten().to_numpy()  # noqa: B023, E731
                near, low = flat("near").astype(np.int64).reshape(len(v), had), flat("low").reshape(len(v), had + 1)
                # bounds are in order, so the first that is dropped holds for all that follow
                state = own, b.column("upper").to_numpy(), near[:, :keep], low[:, : keep + 1]
            else:
                state = it.fresh(len(v))
            new, upper, near, low = it.assign(v, *state)
            if last:
                d2 = squared(v, centroids[new])
                sums.move(d2[:, None], None, new)
                made = [b.column("vec_id"), pa.array(new, pa.int32()), pa.array(d2, pa.int64())]
            else:
                sums.move(v, own, new)
                made = [b.column("vec_id"), b.column("v"), pa.array(new, pa.int32()), pa.array(upper), lists(near, pa.int32()), lists(low, pa.float64())]
            yield pa.RecordBatch.from_arrays([*made, *_nulls(len(v), _TASK_TYPES)], [*names, "slot", "n", "sums", "needed"])
            kinds = [x.type for x in made]
        if ids is not None and (rows := list(sums.rows())):
            parts = [pa.array([int(r[0]) for r in rows], pa.int32()), pa.array([int(r[1]) for r in rows], pa.int64()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64())), pa.array([it.needed] * len(rows), pa.int32())]
            yield pa.RecordBatch.from_arrays([*_nulls(len(rows), kinds), *parts], [*names, "slot", "n", "sums", "needed"])

    return table.mapInArrow(work, ", ".join(f"{x} {types[x]}" for x in names) + f", {_TASK}")


def cluster(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """One row per vector that has exactly `dims` components, all of them numbers: vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256.

    Vectors become integers floor(scale * x). The first centroids are the vectors of the k smallest sha256 of
    `seed:vec_id`, in that order; repeated vec_ids by their components. Rows without vec_id start no centroid but are
    assigned. Fewer rows give fewer centroids, none give none. Repeated vectors are vectors of their own. Other columns
    are ignored. A component of 2^27 or more (after scaling) raises, as its distance would not fit a long.
    Each round is one pass without a shuffle; the state is a written table, and k x dims sums come to the driver.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("_e")).where((F.size("_e") == dims) & finite(F.col("_e")))
    table = written(own.select("vec_id", integers(F.col("_e"), scale).alias("v")), "vectors")
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = table.where("vec_id is not null").orderBy(by, "v").limit(k).collect()
    kind = table.schema["vec_id"].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["v"] for r in first], dtype=np.int64)
    k, shift = len(first), np.zeros(len(first))
    had = keep = min(k - 1, max(1, k // 4))
    n, of = np.zeros(k, dtype=object), np.zeros((k, dims), dtype=object)
    for _ in range(rounds):
        new = written(_assigned(table, centroids, shift, had, keep, dims, False), "assigned")
        dropped(table)
        more, change = added(new, k, dims)
        n, of = n + more, of + change
        needed = new.where("slot is not null").agg(F.max("needed")).first()[0] or 0
        table = new.where("slot is null").drop("slot", "n", "sums", "needed")
        after = means(centroids, n, of)
        shift, centroids = moved(centroids, after), after
        had, keep = keep, min(keep, max(needed, k // 8, 1))
    last = written(_assigned(table, centroids, shift, had, keep, dims, True), "clusters")
    dropped(table)
    inertia = added(last, k, 1)[1][:, 0]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, int(inertia[c]), int(inertia.sum()), digests[c]) for c in range(k)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.where("slot is null").select("vec_id", "cluster", "distance").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
