"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

One hash of each shingle decides its bin and its rank there, so a signature of BANDS x ROWS values takes one pass over a
set's sorted hashes. An empty bin takes the value of a full one that it draws at random (each bin has a fixed random
order of all others and takes the first full one), so two signatures agree at a place with a probability of the sets'
similarity, however few shingles they have. Documents that agree on all places of a band share a bucket; a link at the
threshold s shares none with probability (1 - s^ROWS)^BANDS: 2.5e-7 for 0.8, 6 and 50, less for more similar texts.

A bucket gives one candidate edge from its centre, the first document in a hashed order, to each other member, so their
number is at most BANDS a document. Edges are confirmed on the full sets. Where all members are linked with their
centre nothing is left to ask. Elsewhere two members may be linked with each other and not with the centre: those of
few members are compared with each unlinked one, and those of many go to the exact join of a group's differences (jaccard.group_links).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, dropped, hot_rows, hot_table, salted_join, union, written
from .jaccard import FAN, Hasher, cut_sets, group_links, normal, rows_of, similar_whole

BANDS, ROWS = 50, 6
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


class Signer:
    """Band hashes of a set of 64-bit hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        #: order[i] ranks all bins for bin i, at random and alike for every set
        self.order = np.random.default_rng(11).random((self.bins, self.bins)).argsort(axis=1).argsort(axis=1).astype(np.uint16)
        self.salt = np.random.default_rng(13).integers(1, 1 << 63, self.bands, dtype=np.uint64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """One value a bin, from sorted distinct hashes (at least one): a bin is a range of hashes, its smallest one the value."""
        bins = (hashes >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        full = bins[first].astype(np.int64)
        out = np.empty(self.bins, dtype=np.uint64)
        out[full] = hashes[first]
        if len(full) < self.bins:
            empty = np.ones(self.bins, dtype=bool)
            empty[full] = False
            out[empty] = hashes[first][self.order[np.ix_(empty, full)].argmin(axis=1)]
        return out

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.empty(0, dtype=np.int64)
        h = self.salt.copy()
        for column in self.signature(hashes).reshape(self.bands, self.rows).T:
            h = (h ^ column) * _MIX[0]
            h = (h ^ h >> np.uint64(33)) * _MIX[1]
        return (h ^ h >> np.uint64(29)).view(np.int64)


def read_documents(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, key, n_shingles, bands) of each row: key stands for its words, bands has a hash for each band."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, signer, out = Hasher(n), Signer(bands, rows), []
        for i, t, last in rows_of(batches):
            words = normal(t)
            g = hasher.set_of(words)
            out.append((i, hashlib.md5(words).digest() if words else None, len(g), signer.of(g)))
            if last:
                yield pd.DataFrame(out, columns=["doc_id", "key", "n_shingles", "bands"])
                out = []

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.mapInPandas(read, f"doc_id {kind}, key binary, n_shingles long, bands array<long>"), "signatures")


def stars(signed: DataFrame, percent: int) -> DataFrame:
    """(a, b, wide, fits, low, high) for documents (doc, n, bands): a is the centre of a bucket that b is in; wide, if one of them has more than these two; fits, if their sizes allow a link; low to high is b's size."""
    rows = signed.select("doc", "n", F.explode("bands").alias("bucket"))
    centres = written(rows.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("doc").alias("h"), "doc", "n")).alias("c"), F.count("*").alias("g")).where("g > 1"), "buckets")
    edges = salted_join(rows, centres, "bucket", hot_table(centres, "bucket", "g"), F.col("doc")).where("doc <> c.doc")
    sizes = {"low": F.min("n"), "high": F.max("n"), "low_a": F.min("c.n"), "high_a": F.max("c.n")}
    out = written(edges.groupBy(F.col("c.doc").alias("a"), F.col("doc").alias("b")).agg((F.max("g") > 2).alias("wide"), *[v.alias(k) for k, v in sizes.items()]), "stars")
    dropped(centres)
    return out.withColumn("fits", alike("low", "high", "low_a", "high_a", percent)).drop("low_a", "high_a")


def alike(low_x: str, high_x: str, low_y: str, high_y: str, percent: int) -> Column:
    """Whether sets of such sizes can be linked. Texts of one doc_id may have several sizes."""
    return 100 * F.least(high_x, high_y) >= percent * F.greatest(low_x, low_y)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n: int = 2, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself included), kept.

    A document's set is its distinct n-word shingles (all its words as one, if fewer); links are confirmed on full sets.
    Null and empty texts have no set and link with nothing. Repeated rows are linked copies; rows that share a doc_id
    but not their text count as one node of the graph and are told apart only in n_shingles. Rows without doc_id are
    their own component (null) and kept. Other columns of docs are ignored. A link at the threshold is missed with
    probability (1 - (percent/100)^rows)^bands.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = read_documents(docs, n, bands, rows)
    ids = written(signed.select("doc_id", "key", "n_shingles"), "ids")
    named = "key is not null and doc_id is not null"
    # copies: the smallest id of each key stands for all
    first = written(signed.where(named).groupBy("key").agg(F.min("doc_id").alias("doc"), F.count("*").alias("c"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands")), "first")
    dropped(signed)
    again = written(first.where("c > 1").select("key", "doc"), "copies")
    edges = stars(first.select("doc", "n", "bands"), percent)
    dropped(first)
    near = written(edges.where("fits").select("a", "b"), "near")
    # a centre that is linked with all its members leaves nothing open; sizes alone can rule links with it out, not those among them
    wide = edges.where("wide")
    nodes = near.union(wide.select("a", "b")).select(F.explode(F.array("a", "b")).alias("doc"))
    shared = docs.sparkSession.sparkContext.broadcast(np.zeros(2, dtype=np.uint8))
    sets = cut_sets(docs, shared, nodes, n)
    linked = similar_whole(near, sets, percent)
    seen = written(wide.select("a", "b", "low", "high").join(linked.select("a", "b", F.lit(True).alias("linked")), ["a", "b"], "left"), "seen")
    open_ = seen.groupBy("a").agg(F.count("*").alias("m"), F.count("linked").alias("k")).where("m > 1 and k < m")
    open_ = written(open_, "open")
    rest = written(salted_join(seen, open_, "a", hot_table(open_, "a", "m"), F.col("b")).select("a", F.col("b").alias("doc"), "low", "high", "linked", "m"), "rest")
    few, many = rest.where(F.col("m") <= FAN), rest.where(F.col("m") > FAN)
    # at most FAN partners for each unlinked member
    side = lambda x: few.select("a", "linked", *[F.col(c).alias(c + x) for c in ("doc", "low", "high")])
    both = side("x").where("linked is null").drop("linked").join(side("y").drop("linked"), "a").where("docx <> docy").where(alike("lowx", "highx", "lowy", "highy", percent))
    pairs = both.select(F.greatest("docx", "docy").alias("a"), F.least("docx", "docy").alias("b"))
    links, more = group_links(written(many.select(F.col("a").alias("gid"), "doc"), "members"), sets, percent)
    pairs = written(union(pairs, *more).distinct(), "candidates")
    links += [linked, similar_whole(pairs, sets, percent)]
    dropped(sets, pairs, seen, rest, *more)
    copies = salted_join(ids.where(named).select("key", "doc_id"), again, "key", hot_rows(ids.where(named), "key"), F.col("doc_id")).where("doc_id <> doc").select(F.col("doc").alias("a"), F.col("doc_id").alias("b"))
    labels = components(union(copies, *links))
    out = ids.join(labels, ids.doc_id == labels.node, "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
