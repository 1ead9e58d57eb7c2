"""Vector code compression: product codes whose codebooks are learned by Lloyd's rounds with Elkan's bounds.

Each part of a vector keeps an upper bound of the distance to its entry and one lower bound for every entry of its
codebook. A round shifts them by the entries' movement and only compares an entry with a part where neither the lower
bound nor half the distance between the two entries proves, strictly, that it is farther. Compared distances are exact
integers, so ties go to the lower index, as a full search would have it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, dropped, hot_rows, salted_join, written
from .vectors import NARROWER, WIDER, Sums, added, at_least, at_most, finite, integers, lists, matrix, means, moved, squared

#: Lower bounds are kept as 16-bit multiples of a power of two, rounded down; larger ones as the largest, which holds as well.
_UNITS = 65535


class Coder:
    """Codes batches of vectors. books: parts x entries x width integers; shift: how far each entry has moved since the bounds were made."""

    def __init__(self, books: np.ndarray, shift: np.ndarray, unit: float):
        self.books, self.shift, self.unit = books, shift, unit
        self.parts, self.entries, self.width = books.shape
        gaps = ((books[:, :, None] - books[:, None]) ** 2).sum(-1)
        self.half = at_least(gaps) / 2
        #: Distances that were made.
        self.compared = 0

    def fresh(self, n: int) -> tuple:
        return np.zeros((n, self.parts), dtype=np.uint8), np.full((n, self.parts), np.inf), np.zeros((n, self.parts, self.entries), dtype=np.uint16)

    def code(self, v: np.ndarray, codes, upper, low) -> tuple:
        """New (codes, upper, low) of each row of v."""
        codes, upper, low = codes.copy(), upper.copy(), np.maximum((low * self.unit - self.shift) * NARROWER, 0)
        for p in range(self.parts):
            x, a = v[:, p * self.width : (p + 1) * self.width], codes[:, p].astype(np.int64)
            u, l = (upper[:, p] + self.shift[p, a]) * WIDER, low[:, p]
            best = np.full(len(x), -1, dtype=np.int64)
            for e in range(self.entries):
                rows = np.flatnonzero((a != e) & (u >= l[:, e]) & (u >= self.half[p, a, e]))
                loose = rows[best[rows] < 0]
                self.measure(x, p, a, u, l, best, loose)
                rows = rows[(u[rows] >= l[rows, e]) & (u[rows] >= self.half[p, a[rows], e])]
                d2 = squared(x[rows], self.books[p, e])
                self.compared += len(rows)
                l[rows, e] = at_least(d2)
                nearer = (d2 < best[rows]) | (d2 == best[rows]) & (e < a[rows])
                to = rows[nearer]
                a[to], best[to] = e, d2[nearer]
                u[to] = at_most(best[to])
            codes[:, p], upper[:, p] = a, u
        return codes, upper, np.minimum(np.floor(low / self.unit), _UNITS).astype(np.uint16)

    def measure(self, x, p, a, u, l, best, rows) -> None:
        """The exact distance of rows to their own entries."""
        best[rows] = squared(x[rows], self.books[p, a[rows]])
        u[rows], l[rows, a[rows]] = at_most(best[rows]), at_least(best[rows])
        self.compared += len(rows)

    def errors(self, v: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of vectors to what their codes stand for."""
        return sum(squared(v[:, p * self.width : (p + 1) * self.width], self.books[p, codes[:, p]]) for p in range(self.parts))


def _coded(table: DataFrame, books: np.ndarray, shift: np.ndarray, unit: float, last: bool) -> DataFrame:
    """One pass over the vectors and their bounds: the same with new bounds, and each task's sums; the last has codes and errors."""
    parts, entries, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    names = ["vec_id", "label", "code", "error"] if last else ["vec_id", "label", "v", "codes", "upper", "low"]
    types = kinds | {"code": "string", "error": "long", "codes": "binary", "upper": "array<double>", "low": "binary"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, sums, made = Coder(books, shift, unit), Sums(parts * entries, width), None
        for b in batches:
            v, old = matrix(b.column("v"), parts * width), None
            if "codes" in b.schema.names:
                raw = lambda c, t, n=len(v): np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=t).reshape(n, -1)  # noqa: B023, E731
                old = raw("codes", np.uint8)
                state = old, b.column("upper").flatten().to_numpy().reshape(-1, parts), raw("low", np.uint16).reshape(-1, parts, entries)
            else:
                state = it.fresh(len(v))
            codes, upper, low = it.code(v, *state)
            made = [b.column("vec_id"), b.column("label")]
            if last:
                made += [pa.array([bytes(c).hex() for c in codes]), pa.array(it.errors(v, codes), pa.int64())]
            else:
                for p in range(parts):
                    at = lambda c, p=p: None if c is None else c[:, p].astype(np.int64) + p * entries
                    sums.move(v[:, p * width : (p + 1) * width], at(old), at(codes))
                made += [b.column("v"), pa.array([bytes(c) for c in codes], pa.binary()), lists(upper, pa.float64()), pa.array([x.tobytes() for x in low], pa.binary())]
            yield pa.RecordBatch.from_arrays([*made, *(pa.nulls(len(v), t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64())))], [*names, "slot", "n", "sums"])
        if made and not last and (rows := list(sums.rows())):
            more = [pa.array([int(r[0]) for r in rows], pa.int32()), pa.array([int(r[1]) for r in rows], pa.int64()), pa.array([r[2].tolist() for r in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), x.type) for x in made), *more], [*names, "slot", "n", "sums"])

    return table.mapInArrow(work, ", ".join(f"{x} {types[x]}" for x in names) + ", slot int, n long, sums array<long>")


def length_of(vectors: DataFrame, parts: int) -> int | None:
    """The length that most vectors have, of those that can be cut into equal parts; the larger of equally common ones."""
    sizes = vectors.groupBy(F.size("_e").alias("n")).agg(F.count("*").alias("c")).where((F.col("n") > 0) & (F.col("n") % parts == 0))
    found = sizes.agg(F.max(F.struct("c", "n")).alias("x")).first()["x"]
    return found and found["n"]


def compress(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """One row per vector whose components are all numbers: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256.

    Vectors become integers floor(scale * x), cut into equal consecutive parts. Rows of another length than most (see
    length_of) can't be cut alike and are left out. Codebooks start as the parts of the smallest vec_ids; repeated ones by their components.
    Rows without vec_id start no entry but are coded. Fewer rows give fewer entries, none give none. Repeated vectors are
    vectors of their own; null labels are one label. Other columns are ignored. A component of 2^27 or more (after scaling) raises, as its
    distance would not fit a long. entries is 256 at most. Each round is one pass without a shuffle over a written table;
    parts x entries x width sums come to the driver.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).alias("_e")).where(finite(F.col("_e")))
    dims, kind = length_of(own, parts), own.schema["vec_id"].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string")
    if dims is None:
        return empty
    table = written(own.where(F.size("_e") == dims).select("vec_id", "label", integers(F.col("_e"), scale).alias("v")), "vectors")
    first = table.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()
    if not first:
        return empty
    width, entries = dims // parts, len(first)
    books = np.array([r["v"] for r in first], dtype=np.int64).reshape(entries, parts, width).transpose(1, 0, 2).copy()
    unit = 2.0 ** max(0, int(np.ceil(np.log2((1 + 4 * np.abs(books).max() * np.sqrt(width)) / _UNITS))))
    slots, shift = parts * entries, np.zeros((parts, entries))
    n, of = np.zeros(slots, dtype=object), np.zeros((slots, width), dtype=object)
    for _ in range(rounds):
        new = written(_coded(table, books, shift, unit, False), "coded")
        dropped(table)
        more, change = added(new, slots, width)
        n, of = n + more, of + change
        table = new.where("slot is null").drop("slot", "n", "sums")
        after = means(books.reshape(slots, width), n, of).reshape(books.shape)
        shift, books = moved(books, after), after
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    # null labels are a key as any other
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("_label")
    out = written(_coded(table, books, shift, unit, True).select("vec_id", key, "code", "error"), "codes")
    dropped(table)
    sums = out.groupBy("_label").agg(F.sum("error").alias("label_error"))
    sums = written(sums, "labels")
    if sums.count() <= BROADCAST_ROWS:
        out = out.join(F.broadcast(sums), "_label")
    else:
        out = salted_join(out, sums, "_label", hot_rows(out, "_label"), F.col("vec_id"))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
